"""Sequences staged by route: a folder for each bin with one ordered file, the sources of each, and the origins of their contigs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.sources.tables import fasta

SOURCES, ORIGINS = "sources", "origins"


def write(records: DataFrame, path: str, width: int = 60) -> None:
    """Records (route, bin_id, ordinal, name, sequence, parent_contig, start, end) below ``path``/sequences, with tables of sources and origins.

    The records of a bin go through one task, sorted by ordinal and name, so
    every bin has exactly one file, ``route=.../bin_id=...``, in that order. A
    task keeps its rows sorted on disk, not in memory. ``sources`` has a row
    for each bin, ``origins`` one for each sequence.
    """
    wrapped = F.regexp_replace("sequence", f"(.{{{width}}})(?=.)", "$1\n")
    text = F.concat(F.lit(">"), F.col("name"), F.lit("\n"), wrapped).alias("value")
    ordered = records.repartition("route", "bin_id").sortWithinPartitions("route", "bin_id", "ordinal", "name")
    ordered.select("route", "bin_id", text).write.option("maxRecordsPerFile", 0).partitionBy("route", "bin_id").text(f"{path}/sequences")
    sources = records.groupBy("route", "bin_id").agg(F.count("*").alias("sequences"), F.sum(F.length("sequence")).alias("length_bp"))
    sources.write.csv(f"{path}/{SOURCES}", sep="\t", header=True)
    records.select("bin_id", "name", "parent_contig", "start", "end", "ordinal").write.csv(f"{path}/{ORIGINS}", sep="\t", header=True)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(route, bin_id, name, sequence): the staged sequences, route and bin from their folders."""
    files = fasta(spark, f"{path}/sequences/*/*")
    return files.select(_folder("route"), _folder("bin_id"), "name", "sequence")


def _folder(name: str) -> Column:
    """The value that a folder is named for: escaped once in the name, and once more in the path of a file."""
    value = F.regexp_extract("path", f"/{name}=([^/]+)/", 1)
    for _ in range(2):
        value = F.url_decode(F.regexp_replace(value, r"\+", "%2B"))
    return value.alias(name)


def sources(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("route string, bin_id string, sequences long, length_bp long").csv(f"{path}/{SOURCES}", sep="\t", header=True)


def origins(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("bin_id string, name string, parent_contig string, start long, end long, ordinal long").csv(f"{path}/{ORIGINS}", sep="\t", header=True)


def problems(staged: DataFrame, sources_: DataFrame, origins_: DataFrame) -> DataFrame:
    """(bin_id, name, detail): contigs in more than one folder or twice in one, sequences and origins that do not cover each other, and bins whose totals differ."""
    by_name = staged.groupBy("name").agg(F.countDistinct("route", "bin_id").alias("folders"), F.count("*").alias("n"), F.min("bin_id").alias("bin_id"))
    several = by_name.where("n > 1").select("bin_id", "name", F.when(F.col("folders") > 1, F.lit("in more than one folder")).otherwise(F.lit("repeated")).alias("detail"))
    s, o = staged.select("bin_id", "name", F.length("sequence").alias("got")), origins_.select("bin_id", "name", (F.col("end") - F.col("start") + 1).alias("want"))
    both = s.join(o, ["bin_id", "name"], "full_outer")
    detail = F.when(F.col("want").isNull(), F.lit("no origin")).when(F.col("got").isNull(), F.lit("not staged")).when(F.col("got") != F.col("want"), F.lit("length differs from its origin"))
    seen = staged.groupBy("route", "bin_id").agg(F.count("*").alias("n"), F.sum(F.length("sequence")).alias("bp"))
    totals = seen.join(sources_, ["route", "bin_id"], "full_outer").where(~(F.col("n").eqNullSafe(F.col("sequences")) & F.col("bp").eqNullSafe(F.col("length_bp"))))
    return several.union(both.select("bin_id", "name", detail.alias("detail")).where("detail is not null")).union(totals.select("bin_id", F.lit(None).cast("string"), F.lit("totals differ from the sources")))
