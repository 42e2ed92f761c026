"""Field rules compiled from a JSON schema: every rule is one column expression, all of a table run in one scan."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Schema = dict[str, Any]
Rule = tuple[str, str, Column, Column]  # field, rule, whether it is broken, the value as text

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TYPES: dict[str, tuple] = {
    "string": (T.StringType,), "integer": _INTEGERS, "number": (*_INTEGERS, T.FloatType, T.DoubleType, T.DecimalType),
    "boolean": (T.BooleanType,), "array": (T.ArrayType,), "object": (T.StructType, T.MapType),
}


def java_pattern(pattern: str) -> str:
    """A pattern that means in Spark what it means in the schema.

    The ends of a text are its ends (``$`` would accept a line break before
    it), and classes such as white space are those of Unicode.
    """
    out, k, inside = "", 0, False
    while k < len(pattern):
        c = pattern[k]
        if c == "\\":
            out += pattern[k : k + 2]
            k += 2
            continue
        if inside:
            inside = c != "]"
        elif c == "[":
            inside = True
            end = k + 1 + (pattern[k + 1 : k + 2] == "^")
            if pattern[end : end + 1] == "]":  # a bracket that stands first belongs to the class
                out += pattern[k:end] + "\\]"
                k = end + 1
                continue
        elif c in "^$":
            out += "\\A" if c == "^" else "\\z"
            k += 1
            continue
        out += c
        k += 1
    return "(?U)" + out


def resolved(field: Schema, whole: Schema) -> tuple[Schema, bool]:
    """(the field's schema without references and alternatives of null, whether null is one of its values)."""
    nullable = False
    while True:
        if "$ref" in field:
            at = whole
            for part in field["$ref"].removeprefix("#/").split("/"):
                at = at[part]
            field = {**at, **{k: v for k, v in field.items() if k != "$ref"}}
        elif "anyOf" in field or "oneOf" in field:
            name = "anyOf" if "anyOf" in field else "oneOf"
            some = [x for x in field[name] if x.get("type") != "null"]
            nullable |= len(some) < len(field[name])
            if len(some) != 1:
                raise ValueError(f"alternatives are not supported: {sorted(x.get('type', '?') for x in some)}")
            field = {**some[0], **{k: v for k, v in field.items() if k != name}}
        elif isinstance(field.get("type"), list):
            some = [x for x in field["type"] if x != "null"]
            nullable |= len(some) < len(field["type"])
            if len(some) != 1:
                raise ValueError(f"several types are not supported: {some}")
            field = {**field, "type": some[0]}
        else:
            return field, nullable


def _value_rules(name: str, c: Column, kind: T.DataType, field: Schema, whole: Schema) -> list[Rule]:
    """Rules of one value; each holds only where the value is there."""
    field, _ = resolved(field, whole)
    text = (F.to_json(c) if isinstance(kind, (T.StructType, T.MapType, T.ArrayType)) else c.cast("string")) if not isinstance(kind, T.NullType) else F.lit(None).cast("string")
    if "type" in field and not isinstance(kind, (_TYPES[field["type"]], T.NullType) if isinstance(_TYPES[field["type"]], type) else (*_TYPES[field["type"]], T.NullType)):
        return [(name, "type", c.isNotNull(), text)]
    out: list[Rule] = []
    if "enum" in field:
        out.append((name, "enum", ~c.isin(list(field["enum"])), text))
    if "const" in field:
        out.append((name, "const", c != F.lit(field["const"]), text))
    if "pattern" in field:
        out.append((name, "pattern", ~c.rlike(java_pattern(field["pattern"])), text))
    for rule, test in (("minimum", lambda b: c < b), ("maximum", lambda b: c > b), ("exclusiveMinimum", lambda b: c <= b), ("exclusiveMaximum", lambda b: c >= b)):
        if rule in field:
            broken = test(F.lit(field[rule]))
            out.append((name, rule, broken | F.isnan(c) if isinstance(kind, (T.FloatType, T.DoubleType)) else broken, text))
    for rule, test in (("minLength", lambda b: F.length(c) < b), ("maxLength", lambda b: F.length(c) > b), ("minItems", lambda b: F.size(c) < b), ("maxItems", lambda b: F.size(c) > b)):
        if rule in field:
            out.append((name, rule, test(F.lit(field[rule])), text))
    if field.get("uniqueItems"):
        out.append((name, "uniqueItems", F.size(F.array_distinct(c)) < F.size(c), text))
    if isinstance(kind, T.ArrayType) and "items" in field:
        out += _item_rules(name, c, kind.elementType, field["items"], whole)
    if isinstance(kind, T.StructType) and "properties" in field:
        out += _object_rules(f"{name}.", {f.name: (c.getField(f.name), f.dataType) for f in kind.fields}, field, whole, c.isNotNull())
    return out


def _item_rules(name: str, c: Column, kind: T.DataType, items: Schema, whole: Schema) -> list[Rule]:
    """For each rule of the items, whether any item breaks it."""
    out = [(f"{name}[]", "required", F.exists(c, lambda x: x.isNull()), F.to_json(c))] if not resolved(items, whole)[1] else []

    def breaks(k: int):
        return lambda x: F.coalesce(_value_rules(name, x, kind, items, whole)[k][2], F.lit(False))

    for k, (field, rule, _, _) in enumerate(_value_rules(f"{name}[]", F.lit(None).cast(kind), kind, items, whole)):
        out.append((field, rule, F.exists(c, breaks(k)), F.to_json(c)))
    return out


def _object_rules(prefix: str, columns: dict[str, tuple[Column, T.DataType]], schema: Schema, whole: Schema, there: Column) -> list[Rule]:
    out: list[Rule] = []
    known = schema.get("properties", {})
    nothing = F.lit(None).cast("string")
    for name, field in known.items():
        c, kind = columns.get(name, (nothing, T.NullType()))
        if name in schema.get("required", []) and not resolved(field, whole)[1]:
            out.append((prefix + name, "required", there & c.isNull(), nothing))
        if name in columns:
            out += _value_rules(prefix + name, c, kind, field, whole)
    if schema.get("additionalProperties") is False:
        out += [(prefix + n, "unknown field", c.isNotNull(), nothing) for n, (c, _) in columns.items() if n not in known]
    return out


def rules(rows: DataFrame, schema: Schema, whole: Schema | None = None) -> list[Rule]:
    """All rules of ``schema`` for the columns of ``rows``; references are looked up in ``whole``."""
    schema, _ = resolved(schema, whole or schema)
    return _object_rules("", {f.name: (F.col(f"`{f.name}`"), f.dataType) for f in rows.schema.fields}, schema, whole or schema, F.lit(True))


def field_violations(rows: DataFrame, schema: Schema, key: list[str], whole: Schema | None = None) -> DataFrame:
    """(key columns, field, rule, value) of every broken rule, from one scan without a shuffle.

    Types are strict: a field held in a column of another type breaks the
    rule ``type`` in every row that has it. A column that is not there counts
    as null. A number that is not a number lies outside any bound.
    """
    broken = [F.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(field).alias("field"), F.lit(rule).alias("rule"), value.alias("value"))) for field, rule, test, value in rules(rows, schema, whole)]
    if not broken:
        broken = [F.lit(None).cast("struct<field:string,rule:string,value:string>")]
    return rows.select(*key, F.explode(F.array_compact(F.array(*broken))).alias("x")).select(*key, "x.*")


def table_violations(tables: dict[str, DataFrame], schema: Schema, keys: dict[str, str]) -> DataFrame:
    """(table, key, field, rule, value) over the tables that ``schema`` names as lists of records in its properties."""
    parts = []
    for name, rows in tables.items():
        field, _ = resolved(schema["properties"][name], schema)
        found = field_violations(rows, field["items"], [], schema) if keys.get(name) is None else field_violations(rows, field["items"], [keys[name]], schema)
        parts.append(found.select(F.lit(name).alias("table"), (F.col(keys[name]).cast("string") if keys.get(name) else F.lit(None).cast("string")).alias("key"), "field", "rule", "value"))
    return reduce(DataFrame.unionByName, parts)

