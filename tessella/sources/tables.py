"""Native tables: header-driven, tab-separated, all text until a column says otherwise."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.sources import scratch, splits

#: Lines of a bundle that are no records, beyond which it is read as a whole.
FRAME = 10_000


def read_table(spark: SparkSession, path: str | list[str], required: list[str] = [], hash_header: bool = False) -> DataFrame:  # noqa: B006
    """All columns as text; empty cells are empty text, never null.

    Raises if the header is missing, repeats a column or lacks a required one.
    A row with more or fewer cells than the header fails when it is read. With
    ``hash_header``, a leading # of the first column's name goes. Each of
    several files is read by its own header; a column that only some files
    have is empty in the rows of the others.
    """
    if not isinstance(path, str):
        parts = [read_table(spark, p, required, hash_header) for p in path]
        whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return whole.na.fill("")
    first = path
    head = spark.read.text(first).first()
    if head is None or not head[0].strip():
        raise ValueError(f"no header: {first}")
    names = head[0].rstrip("\r").split("\t")
    if hash_header:
        names[0] = names[0].removeprefix("#")
    if len(set(names)) < len(names):
        raise ValueError(f"repeated column: {first}")
    if lost := [c for c in required if c not in names]:
        raise ValueError(f"missing columns {', '.join(lost)}: {first}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    rows = spark.read.schema(schema).csv(path, sep="\t", header=True, mode="FAILFAST", quote='"', escape='"', enforceSchema=True, emptyValue="", nullValue="\u0001")
    return rows.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in names])


def ragged_rows(spark: SparkSession, path: str) -> DataFrame:
    """(line, cells, expected) of rows that have another number of cells than the header."""
    head = spark.read.text(path).first()
    expected = len(head[0].split("\t")) if head else 0
    cells = F.size(F.split("value", "\t"))
    return spark.read.text(path).where((F.col("value") != "") & (cells != expected)).select(F.col("value").alias("line"), cells.alias("cells"), F.lit(expected).alias("expected"))


def indexed(rows: DataFrame, key: Column, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the normalized key, keys that more than one row has)."""
    out = rows.withColumn(name, key)
    return out, out.groupBy(name).agg(F.count("*").alias("rows")).where("rows > 1")


def headerless(spark: SparkSession, path: str, widths: tuple[int, ...], names: list[str]) -> DataFrame:
    """Rows without a header, comments and blank lines; rows of another width raise when read."""
    lines = spark.read.text(path).where(~F.trim("value").startswith("#") & (F.trim("value") != "")).withColumn("c", F.split("value", "\t"))
    checked = F.when(F.size("c").isin(list(widths)), F.col("c")).otherwise(F.raise_error(F.concat(F.lit("row of another width: "), F.col("value"))))
    return lines.select(checked.alias("c")).select(*[F.coalesce(F.get("c", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)])


#: The header of an orthology table, to which some versions add a digest.
EGGNOG = ["#query", "seed_ortholog", "evalue", "score", "eggNOG_OGs", "max_annot_lvl", "COG_category", "Description", "Preferred_name", "GOs", "EC", "KEGG_ko", "KEGG_Pathway", "KEGG_Module", "KEGG_Reaction", "KEGG_rclass", "BRITE", "KEGG_TC", "CAZy", "BiGG_Reaction", "PFAMs"]


def eggnog(spark: SparkSession, path: str) -> DataFrame:
    """The rows of an orthology table, all cells text.

    Lines with two # and blank ones do not count. Raises for another header
    than the tool's 21 columns, with or without a digest; a further comment
    and a row of another width raise when they are read.
    """
    lines = spark.read.text(path).where(~F.col("value").startswith("##") & (F.trim("value") != ""))
    head = lines.where(F.col("value").startswith("#")).first()
    names = head[0].rstrip("\r").split("\t") if head else []
    if names not in (EGGNOG, [*EGGNOG, "md5"]):
        raise ValueError(f"unexpected eggNOG header: {path}")
    bad = lambda what: F.raise_error(F.concat(F.lit(f"{what}: "), F.col("value")))
    rows = lines.where(F.col("value") != head[0]).withColumn("c", F.split(F.regexp_replace("value", "\r$", ""), "\t"))
    checked = F.when(F.col("value").startswith("#"), bad("unexpected comment")).when(F.size("c") != len(names), bad("malformed row")).otherwise(F.col("c"))
    return rows.select(checked.alias("c")).select(*[F.col("c")[k].alias(n) for k, n in enumerate(names)])


def pending(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(bin_id of a list of pending bins, one on a line; those that it names more than once)."""
    rows = headerless(spark, path, (1,), ["bin_id"]).select(F.trim("bin_id").alias("bin_id"))
    return rows.distinct(), rows.groupBy("bin_id").agg(F.count("*").alias("rows")).where("rows > 1")


def fasta(spark: SparkSession, path: str | list[str], allow_empty: bool = True) -> DataFrame:
    """(path, header, name, sequence) of every record, inner white space removed.

    A > inside a header stays. Text before the first header, an empty header
    and an empty sequence raise when the row is read. Unless ``allow_empty``,
    files without any record raise at once.
    """
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value"))
    body = F.regexp_replace("value", "^>", "")
    header, sequence = F.substring_index(body, "\n", 1), F.regexp_replace(F.regexp_replace(body, "^[^\n]*\n?", ""), r"\s+", "")
    name = F.regexp_extract(header, r"^(\S+)", 1)
    if not allow_empty and not raw.where(F.col("value").rlike(r"\S")).limit(1).count():
        raise ValueError(f"no sequences: {path}")
    checked = F.when(name == "", F.raise_error(F.lit("empty header"))).when(sequence == "", F.raise_error(F.concat(F.lit("no sequence: "), name))).otherwise(sequence)
    return raw.where(F.col("value").rlike(r"\S")).select("path", F.rtrim(header).alias("header"), name.alias("name"), checked.alias("sequence"))


def contig_lengths(records: DataFrame) -> DataFrame:
    """(bin_id, contig_id, length_bp, gc_bp) from records whose file name is the bin."""
    from tessella.functions.text import bin_name

    upper = F.upper("sequence")
    return records.select(bin_name(F.col("path")).alias("bin_id"), F.col("name").alias("contig_id"), F.length("sequence").cast("long").alias("length_bp"), F.length(F.regexp_replace(upper, "[^GC]", "")).cast("long").alias("gc_bp"))


GFF = ["contig", "source", "feature", "start", "end", "score", "strand", "phase", "attributes"]


def gff(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Features with typed coordinates, an attribute map and the model code of their section.

    Lines after ``##FASTA`` do not count. The code in a ``# Model Data:``
    comment holds for the features below it, file by file; a comment without
    one leaves them without a code. A file is read in splits, which hand on
    the code and the mark. A row without nine columns, with an end before its
    start, or with a coordinate, strand or phase of no known form raises when
    it is read.
    """
    from tessella.functions.text import attributes

    text, model = F.col("text"), F.regexp_replace("text", "^# Model Data: *", "")
    code = F.when(text.startswith("# Model Data:"), F.regexp_extract(model, r"(?:^|;)transl_table=([0-9]+)(?:;|\s*$)", 1))
    lines = splits.lines(spark, path).withColumns({"code": code, "over": F.when(text.startswith("##FASTA"), F.lit(True))})
    lines = splits.placed(lines, ["code", "over"])[0].where("over is null")
    rows = lines.where(~text.startswith("#") & (F.trim("text") != "")).withColumn("c", F.split("text", "\t"))
    bad = lambda what: F.raise_error(F.concat(F.lit(f"{what} in line "), F.col("line") + 1, F.lit(" of "), F.col("path"), F.lit(": "), text))
    rows = rows.withColumn("c", F.when(F.size("c") == 9, F.col("c")).otherwise(bad("not nine columns")))
    rows = rows.select("path", "line", "text", F.nullif("code", F.lit("")).try_cast("int").alias("transl_table"), *[F.col("c")[i].alias(n) for i, n in enumerate(GFF)])
    place = lambda c: F.when(F.col(c).rlike(r"\A[1-9][0-9]*\z"), F.col(c).cast("long")).otherwise(bad("bad coordinate"))
    strand = F.element_at(F.create_map(*[F.lit(x) for x in ("+", "+", "-", "-", ".", "unknown", "?", "unknown")]), F.col("strand"))
    phase = F.when(F.col("phase").isin("0", "1", "2"), F.col("phase").cast("int")).when(F.col("phase") != ".", bad("bad phase"))
    rows = rows.withColumns({"start": place("start"), "end": place("end"), "strand": F.coalesce(strand, bad("bad strand")), "phase": phase, "attributes": attributes(F.col("attributes"))})
    return rows.withColumn("end", F.when(F.col("end") >= F.col("start"), F.col("end")).otherwise(bad("end before start"))).drop("text")


def feature_counts(features: DataFrame) -> DataFrame:
    """(path, feature, n): how many rows of each kind a feature file holds."""
    return features.groupBy("path", "feature").agg(F.count("*").alias("n"))


def verified(files: DataFrame, receipts: DataFrame) -> DataFrame:
    """``files`` (binaryFile rows) whose digest and size a receipt (path, sha256, size_bytes) confirms."""
    seen = files.select("path", "content", F.sha2("content", 256).alias("sha256"), F.length("content").cast("long").alias("size_bytes"))
    return seen.join(receipts.select("path", "sha256", "size_bytes"), ["path", "sha256", "size_bytes"])


def bundle(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """A metadata bundle per file by an explicit schema; a cell of another type fails the read.

    So does a field that the schema does not name, at the top or in a record.
    """
    text = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("v"))
    known = {f.name: f.dataType for f in schema.fields}
    lists = {n: t.elementType for n, t in known.items() if isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StructType)}
    keys = lambda v: F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))
    strange = [F.array_except(keys(F.col("v")), F.array(*[F.lit(n) for n in known]))]
    for name, record in lists.items():
        own = F.flatten(F.transform(F.try_variant_get("v", f"$.{name}", "array<map<string,variant>>"), F.map_keys))
        strange.append(F.coalesce(F.array_except(own, F.array(*[F.lit(f.name) for f in record.fields])), F.array().cast("array<string>")))
    found = text.select(F.array_distinct(F.flatten(F.array(*strange))).alias("names")).where(F.size("names") > 0).first()
    if found:
        raise ValueError(f"unknown fields: {', '.join(found.names)}")
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")


def bundle_tables(spark: SparkSession, path: str | list[str], schema: T.StructType) -> dict[str, DataFrame]:
    """Every list of records in metadata bundles of any size as a table, with the rules of ``bundle``.

    A bundle with one record on a line, the later ones behind a comma, as
    ``manifests.write_bundle`` writes it, is read in splits; what is left of it
    without its records must be a bundle with empty lists. Where any file has
    another layout, all go through ``bundle``, a document at a time.
    """
    lists = {f.name: f.dataType.elementType for f in schema.fields if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)}
    text = F.col("text")
    opens = F.coalesce(*[F.when(text == json.dumps(n, ensure_ascii=False) + ": [", F.lit(n)) for n in lists], F.lit(None).cast("string"))
    lines = splits.lines(spark, path).withColumn("section", F.coalesce(opens, F.when(text.isin("]", "],"), F.lit(""))))
    lines = splits.placed(lines, ["section"])[0].select("path", "line", "text", F.when(opens.isNull(), F.nullif("section", F.lit(""))).alias("section"))
    lines = scratch.stable(lines.withColumn("body", F.when(F.col("section").isNotNull() & text.rlike(r"\A,?\{"), F.regexp_replace("text", r"\A,", ""))))
    own = F.map_keys(F.try_variant_get(F.try_parse_json("body"), "$", "map<string,variant>"))
    known = F.coalesce(*[F.when(F.col("section") == n, F.array(*[F.lit(f.name) for f in r.fields])) for n, r in lists.items()], F.array().cast("array<string>"))
    rows = lines.select("path", "line", "section", F.col("section").isNotNull().alias("in"), own.alias("own"), known.alias("known"), text.startswith(",").alias("later"))
    strange = F.array_join(F.array_except("own", "known"), ", ")
    sums = rows.groupBy("path", "section").agg(F.count("*").alias("n"), F.count("own").alias("records"), F.count_if(~F.col("later")).alias("firsts"), F.min("line").alias("first"), F.min(F.when(~F.col("later"), F.col("line"))).alias("at"), F.max(F.nullif(strange, F.lit(""))).alias("strange"))
    sums = sums.withColumn("odd", F.when(F.col("section").isNull(), F.col("n") > FRAME).otherwise((F.col("records") < F.col("n")) | (F.col("firsts") != 1) | (F.col("at") != F.col("first"))))
    found = sums.agg(F.coalesce(F.bool_or("odd"), F.lit(False)).alias("odd"), F.max("strange").alias("strange")).first()
    if not found.odd:
        frame = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), "\n")
        frames = lines.where("section is null").groupBy("path").agg(frame.alias("value"), F.collect_set(opens).alias("open"), F.count(opens).alias("opened")).withColumn("v", F.try_parse_json("value"))
        size = lambda n: F.size(F.try_variant_get("v", f"$.{n}", "array<variant>"))
        empty = reduce(lambda a, b: a & b, [F.coalesce(size(n) == 0, ~F.array_contains("open", n)) for n in lists], F.col("opened") == F.size("open"))
        names = F.array_join(F.array_except(F.map_keys(F.try_variant_get("v", "$", "map<string,variant>")), F.array(*[F.lit(f.name) for f in schema.fields])), ", ")
        whole = F.from_json("value", schema, {"mode": "FAILFAST"})
        seen = frames.select(F.coalesce(empty & F.col("v").isNotNull(), F.lit(False)).alias("empty"), names.alias("names"), F.when(F.col("v").isNotNull(), F.to_json(whole)).alias("typed"))
        checked = seen.agg(F.coalesce(F.bool_and("empty"), F.lit(True)).alias("empty"), F.max(F.nullif("names", F.lit(""))).alias("names"), F.count("typed").alias("typed")).first()
        if checked.empty:
            if lost := checked.names or found.strange:
                raise ValueError(f"unknown fields: {lost}")
            record = lambda n, r: F.from_json("body", r, {"mode": "FAILFAST"}).alias("r")
            return {n: lines.where(F.col("section") == n).select(record(n, r)).select("r.*") for n, r in lists.items()}
    return collections(bundle(spark, path, schema))


def collections(bundles: DataFrame) -> dict[str, DataFrame]:
    """Every list of records in the bundles as a table of its own."""
    lists = [f.name for f in bundles.schema.fields if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)]
    return {name: bundles.select(F.explode(name).alias("r")).select("r.*") for name in lists}


def stage_lists(stages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stage_inputs, stage_expected_keys) from the stages' list columns."""
    scope = ["sample_id", "run_id", "stage_id"]
    inputs = stages.select(*scope, F.posexplode("input_artifact_ids").alias("position", "artifact_id"))
    key = F.split(F.col("k"), ":", 2)
    expected = stages.select(*scope, F.explode("expected_result_keys").alias("k")).select(*scope, key[0].alias("collection"), key[1].alias("record_id"))
    return inputs, expected
