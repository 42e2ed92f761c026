import re

import pytest
from pyspark.sql import functions as F

from tessella.operators import schema_rules as sr

SCHEMA = {
    "properties": {"runs": {"type": "array", "items": {"$ref": "#/$defs/Run"}}},
    "$defs": {
        "Platform": {"type": "string", "enum": ["ont", "hifi"]},
        "Run": {
            "type": "object",
            "additionalProperties": False,
            "required": ["run_id", "platform", "parts"],
            "properties": {
                "run_id": {"type": "string", "pattern": r"^[A-Za-z0-9][A-Za-z0-9_.-]*$"},
                "platform": {"$ref": "#/$defs/Platform"},
                "name": {"anyOf": [{"type": "string", "pattern": r"^\S(?:.*\S)?$"}, {"type": "null"}]},
                "size": {"type": ["integer", "null"], "minimum": 0, "maximum": 9},
                "share": {"type": "number", "minimum": 0, "exclusiveMaximum": 1},
                "parts": {"type": "array", "minItems": 1, "items": {"type": "string", "pattern": "^(bins|genes):.+$"}},
                "tool": {"type": "object", "additionalProperties": False, "required": ["version"], "properties": {"version": {"type": "string", "minLength": 2}}},
            },
        },
    },
}
COLUMNS = "run_id string, platform string, name string, size long, share double, parts array<string>, tool struct<version:string,other:string>"


def found(spark, *rows, columns=COLUMNS):
    got = sr.table_violations({"runs": spark.createDataFrame(list(rows), columns)}, SCHEMA, {"runs": "run_id"})
    return sorted((r.key or "", r.field, r.rule) for r in got.collect())


GOOD = ("a.1", "ont", "x y", 0, 0.0, ["bins:b"], ("1.0", None))


def changed(**values):
    names = ["run_id", "platform", "name", "size", "share", "parts", "tool"]
    return tuple((dict(zip(names, GOOD)) | values)[n] for n in names)


@pytest.mark.parametrize(
    ("values", "field", "rule"),
    [
        ({"run_id": "-a"}, "run_id", "pattern"), ({"run_id": "a\n"}, "run_id", "pattern"), ({"platform": "x"}, "platform", "enum"), ({"platform": None}, "platform", "required"), ({"name": "\xa0x"}, "name", "pattern"), ({"name": ""}, "name", "pattern"),
        ({"size": -1}, "size", "minimum"), ({"size": 10}, "size", "maximum"), ({"share": 1.0}, "share", "exclusiveMaximum"), ({"parts": []}, "parts", "minItems"), ({"parts": ["bins:b", "x"]}, "parts[]", "pattern"), ({"parts": ["bins:b", None]}, "parts[]", "required"),
        ({"parts": None}, "parts", "required"), ({"tool": ("1", None)}, "tool.version", "minLength"), ({"tool": (None, None)}, "tool.version", "required"), ({"tool": ("1.0", "x")}, "tool.other", "unknown field"),
    ],
)
def test_each_rule(spark, values, field, rule):
    row = changed(**values)
    assert found(spark, GOOD, changed(name=None, size=None, share=None, tool=None), row) == [(row[0], field, rule)]


def test_not_a_number_lies_outside_all_bounds(spark):
    assert found(spark, changed(share=float("nan"))) == [("a.1", "share", "exclusiveMaximum"), ("a.1", "share", "minimum")]


def test_strict_types_absent_and_unknown_columns(spark):
    got = found(spark, ("a", 1, "7", "x"), ("b", None, None, None), columns="run_id string, platform int, size string, extra string")
    assert got == [("a", "extra", "unknown field"), ("a", "parts", "required"), ("a", "platform", "type"), ("a", "size", "type"), ("b", "parts", "required"), ("b", "platform", "required")]


@pytest.mark.parametrize("pattern", [r"^[A-Za-z0-9][A-Za-z0-9_.-]*$", r"^\S(?:.*\S)?$", r"^[^\x22\x27\r\n]+$", r"a|^b$", r"^[]x]+$", r"[$^]", r"\$\^"])
def test_patterns_mean_the_same(spark, pattern):
    texts = ["a", "ab", "b", "b\n", "\xa0a", "a b", "a'", "", "]x", "$", "^", "$^", " ", "x ", "é"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").rlike(sr.java_pattern(pattern)).alias("hit")).collect()
    want = [bool(re.search(pattern.replace("$", r"\Z") if pattern.endswith("$") and not pattern.endswith("\\$") else pattern, t)) for t in texts]
    assert [r.hit for r in got] == want


def test_one_scan_and_no_shuffle(spark, tmp_path):
    spark.createDataFrame([GOOD], COLUMNS).write.parquet(f"{tmp_path}/runs")
    plan = sr.field_violations(spark.read.parquet(f"{tmp_path}/runs"), SCHEMA["$defs"]["Run"], ["run_id"], SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
