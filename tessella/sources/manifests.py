"""JSON documents read strictly at every depth: stage manifests, sample sheets' kin, and metadata bundles in and out."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.sources import scratch

#: States of a stage, fields of a tool's entry and of a stage's manifest; those with True must be there.
STATES = ["completed", "failed", "skipped", "pending"]
TOOL = {"version": True, "output": True, "status": False, "database_name": False, "database_version": False, "reason": False, "command_file": False}
STAGE = {"stage": True, "status": True, "tool": True, "tool_version": True, "database_name": False, "database_version": False, "database_sha256": False, "reason": False, "command_file": False}
_KINDS = {T.StringType: "STRING", T.LongType: "BIGINT", T.IntegerType: "BIGINT", T.BooleanType: "BOOLEAN", T.DoubleType: "DOUBLE|BIGINT|DECIMAL"}


def _none() -> Column:
    return F.array().cast("array<string>")



def _struct(fields: dict[str, bool]) -> list[T.StructField]:
    return [T.StructField(n, T.StringType(), not must) for n, must in fields.items()]


TOOL_SCHEMA = T.StructType(_struct(TOOL))
STAGE_SCHEMA = T.StructType([*_struct(STAGE), T.StructField("command", T.VariantType(), False), T.StructField("outputs", T.MapType(T.StringType(), T.StringType())), T.StructField("tools", T.MapType(T.StringType(), TOOL_SCHEMA))])


def problems(v: Column, kind: T.DataType, path: str = "$", must: bool = False) -> Column:
    """An array of texts: fields that the schema does not know, values of another type, and values that must be there, at any depth of a variant."""
    there = v.isNotNull() & ~F.is_variant_null(v)
    name = F.schema_of_variant(v)
    lost = F.array(F.lit(f"{path}: missing")) if must else _none()
    if isinstance(kind, T.VariantType):
        found = _none()
    elif isinstance(kind, T.StructType):
        known = F.array(*[F.lit(f.name) for f in kind.fields])
        own = F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))
        strange = F.transform(F.array_except(own, known), lambda k: F.concat(F.lit(f"{path}."), k, F.lit(": unknown")))
        inner = [problems(F.try_variant_get(v, f"$.{f.name}", "variant"), f.dataType, f"{path}.{f.name}", not f.nullable) for f in kind.fields]
        found = F.when(name.startswith("OBJECT"), F.concat(F.coalesce(strange, _none()), *inner)).otherwise(F.array(F.lit(f"{path}: no object")))
    elif isinstance(kind, T.MapType):
        entries = F.map_values(F.try_variant_get(v, "$", "map<string,variant>"))
        inner = F.flatten(F.transform(entries, lambda x: problems(x, kind.valueType, f"{path}.*", True)))
        found = F.when(name.startswith("OBJECT"), F.coalesce(inner, _none())).otherwise(F.array(F.lit(f"{path}: no object")))
    elif isinstance(kind, T.ArrayType):
        inner = F.flatten(F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: problems(x, kind.elementType, f"{path}[]", True)))
        found = F.when(name.startswith("ARRAY"), F.coalesce(inner, _none())).otherwise(F.array(F.lit(f"{path}: no list")))
    else:
        wanted = _KINDS[type(kind)]
        found = F.when(name.rlike(rf"\A({wanted})(\(.*\))?\z"), _none()).otherwise(F.array(F.concat(F.lit(f"{path}: "), F.lower(name))))
    return F.when(there, found).otherwise(lost)


def _checked(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """(path, the typed fields, ``_found``: an array of problems) of every JSON document.

    A small file costs its opening, so files are opened once; whatever asks
    for fields or problems reads the table of their texts.
    """
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    raw = scratch.stable(texts.hint("rebalance")).select("path", F.try_parse_json("value").alias("v"))
    found = F.when(F.col("v").isNull(), F.array(F.lit("no JSON"))).otherwise(problems(F.col("v"), schema, must=True))
    fields = [F.try_variant_get("v", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    return raw.select("path", *fields, F.array_distinct(found).alias("_found"))


def documents(spark: SparkSession, path: str | list[str], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(path and the typed fields of every JSON document, problems as (path, detail)); nothing is coerced."""
    rows = _checked(spark, path, schema)
    return rows.drop("_found"), rows.select("path", F.explode("_found").alias("detail"))


def manifests(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(stage manifests, problems): one row for each file, ``command`` as text, a list of arguments as JSON."""
    rows = _checked(spark, path, STAGE_SCHEMA)
    text = F.coalesce(F.try_variant_get("command", "$", "string"), F.to_json("command"))
    listed = F.schema_of_variant("command")
    rows = rows.withColumns({"command": F.when(listed == "STRING", F.try_variant_get("command", "$", "string")).when(listed.startswith("ARRAY"), text), "outputs": F.coalesce("outputs", F.create_map().cast("map<string,string>")), "_kind": listed})
    states = F.filter(F.concat(F.array("status"), F.coalesce(F.transform(F.map_values("tools"), lambda x: F.coalesce(x["status"], F.lit("completed"))), _none())), lambda s: ~s.isin(STATES))
    more = F.transform(states, lambda s: F.concat(F.lit("unknown status: "), s))
    kinds = F.when(~F.col("_kind").startswith("ARRAY") & (F.col("_kind") != "STRING"), F.array(F.lit("$.command: no text or list"))).otherwise(_none())
    return rows.drop("_kind", "_found"), rows.select("path", F.explode(F.concat("_found", more, kinds)).alias("detail"))


def stages(rows: DataFrame) -> DataFrame:
    """Manifests with each tool of a grouped stage as a manifest of its own; a stage without tools is itself.

    A tool has the stage's state unless the stage is completed, the tool's
    reason or else the stage's, the stage's outputs and its own as ``result``.
    A stage of annotation and its tools all count.
    """
    tool = F.col("tool_.value")
    each = rows.select("*", F.explode(F.map_entries(F.coalesce("tools", F.create_map().cast(STAGE_SCHEMA["tools"].dataType)))).alias("tool_"))
    status = F.when(F.col("status") == "completed", F.coalesce(tool["status"], F.lit("completed"))).otherwise(F.col("status"))
    reason = F.coalesce(tool["reason"], F.col("reason"))
    because = F.concat(F.col("tool_.key"), F.lit(" had no applicable input in "), F.col("stage"), F.lit("."))
    children = each.select(
        "path", F.col("stage").alias("parent"), F.col("tool_.key").alias("stage"), status.alias("status"), F.col("tool_.key").alias("tool"), tool["version"].alias("tool_version"), tool["database_name"].alias("database_name"), tool["database_version"].alias("database_version"),
        F.lit(None).cast("string").alias("database_sha256"), F.when((status != "completed") & (F.coalesce(reason, F.lit("")) == ""), because).otherwise(reason).alias("reason"), tool["command_file"].alias("command_file"), "command", F.map_concat(F.map_filter("outputs", lambda k, _: k != "result"), F.create_map(F.lit("result"), tool["output"])).alias("outputs"),
    )
    alone = rows.where((F.size(F.coalesce("tools", F.create_map().cast(STAGE_SCHEMA["tools"].dataType))) == 0) | (F.col("stage") == "functional_annotation"))
    return alone.select("path", F.lit(None).cast("string").alias("parent"), *[c for c in children.columns if c not in ("path", "parent")]).unionByName(children)


def write_bundle(tables: dict[str, DataFrame], scalars: dict[str, str], keys: dict[str, list[str]], path: str) -> None:
    """One JSON document of all collections, its records sorted by ``keys``, in a single file at ``path``.

    Records are made, sorted and compared by range in many tasks; only the
    last step, which writes lines in order, is one task, as a document is one
    file. It holds a line at a time. Nulls are left out, as in the bundles
    that are read. A field whose value is a list stays a list.
    """
    spark = next(iter(tables.values())).sparkSession
    order = T.StructType([T.StructField("section", T.IntegerType()), T.StructField("place", T.IntegerType()), T.StructField("o", T.ArrayType(T.StringType())), T.StructField("text", T.StringType())])
    head = "{" + "".join(f"{_quoted(k)}: {_quoted(v)},\n" for k, v in scalars.items()).rstrip("\n")
    frame = [(-1, 0, [], head)]
    names = list(tables)
    for k, name in enumerate(names):
        frame += [(k, 0, [], f"{_quoted(name)}: ["), (k, 2, [], "]" if k == len(names) - 1 else "],")]
    frame.append((len(names), 0, [], "}"))
    marks = spark.createDataFrame(frame, order)
    parts = []
    for k, name in enumerate(names):
        rows = tables[name]
        by = F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys[name]])
        parts.append(rows.select(F.lit(k).alias("section"), F.lit(1).alias("place"), by.alias("o"), F.to_json(F.struct("*")).alias("text")))
    records = reduce(DataFrame.unionByName, parts)
    first = records.groupBy("section").agg(F.min(F.struct("o", "text")).alias("first"))
    both = records.join(F.broadcast(first), "section").withColumn("is", F.struct("o", "text") == F.col("first")).drop("first")
    # of equal records that all come first, one goes without a comma
    twins = both.where("is").withColumn("later", F.row_number().over(Window.partitionBy("section").orderBy("o")) > 1)
    marked = twins.unionByName(both.where("not is").withColumn("later", F.lit(True)))
    marked = marked.select("section", "place", "o", F.when(F.col("later"), F.concat(F.lit(","), "text")).otherwise(F.col("text")).alias("text"), "later")
    every = marks.withColumn("later", F.lit(False)).unionByName(marked).orderBy("section", "place", "later", "o", "text").select(F.col("text").alias("value")).coalesce(1)
    jvm = spark.sparkContext._jvm
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    staged = f"{path}._staging_{uuid.uuid4().hex}"
    try:
        every.write.text(staged)
        parts_ = [s.getPath() for s in fs.listStatus(at(staged)) if s.getPath().getName().startswith("part-")]
        if len(parts_) != 1:
            raise OSError(f"{len(parts_)} files where one was expected: {staged}")
        if fs.exists(at(path)):
            fs.delete(at(path), False)
        if not fs.rename(parts_[0], at(path)):
            raise OSError(f"cannot put the bundle in place: {path}")
    finally:
        fs.delete(at(staged), True)


def _quoted(text: str) -> str:
    return json.dumps(text, ensure_ascii=False)
