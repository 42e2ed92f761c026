"""Outputs of a tool that must tell one story, and rows that another table renames or selects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lines of the completeness tool's log.
EMPTY_WARNING = r"^(?:\[[^\]]+\] )?WARNING: Skipping protein file (.+)\.faa as it was empty\.$"
LOG_ERROR = r"\b(?:ERROR|CRITICAL):|Traceback \(most recent call last\):"


def warned_bins(lines: DataFrame) -> DataFrame:
    """(bin_id) of each log line (value) that says a bin's protein file was empty; a repeated warning is a repeated row."""
    path = F.regexp_extract("value", EMPTY_WARNING, 1)
    return lines.select(F.substring_index(path, "/", -1).alias("bin_id")).where("bin_id <> ''")


def log_errors(lines: DataFrame) -> DataFrame:
    """Log lines for which the whole output must be refused."""
    return lines.where(F.col("value").rlike(LOG_ERROR))


def omitted_bins(expected: DataFrame, reported: DataFrame, proteins: DataFrame, warned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bins that the tool left out, problems as (bin_id, detail)).

    A bin may be left out only if its protein file (bin_id, size_bytes) is
    empty and the log warned of it once. All four tables meet in one aggregation.
    """
    sides = {"expected": expected, "reported": reported, "proteins": proteins, "empty": proteins.where("size_bytes = 0"), "warned": warned}
    rows = reduce(DataFrame.union, [d.select("bin_id", F.lit(n).alias("side")) for n, d in sides.items()])
    seen = rows.groupBy("bin_id").agg(*[F.count_if(F.col("side") == n).alias(n) for n in sides])
    has = lambda n: F.col(n) > 0
    left_out = ~has("reported")
    detail = F.when(~has("expected"), F.lit("unknown bin")).when(F.col("proteins") != 1, F.lit("not one protein file")).when(F.col("warned") > 1, F.lit("repeated warning"))
    detail = detail.when((left_out != has("empty")) | (left_out != has("warned")), F.lit("evidence disagrees"))
    return seen.where(has("expected") & left_out).select("bin_id"), seen.select("bin_id", detail.alias("detail")).where("detail is not null")


def restored(records: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records (name, sequence) under the original of their alias, names that no alias explains).

    Of an alias given twice, the records come twice; ``aliases`` is (alias, original).
    """
    both = records.join(aliases, records["name"] == aliases["alias"], "left")
    return both.where("alias is not null").select(F.col("original").alias("name"), "sequence"), both.where("alias is null").select("name")


def of_bins(alignments: DataFrame, contigs: DataFrame) -> DataFrame:
    """The alignments on the contigs (contig_id, bin_id) of bins, with their bin; others are left out."""
    return alignments.join(contigs.select("contig_id", "bin_id"), "contig_id")


def contig_problems(contigs: DataFrame) -> DataFrame:
    """(contig_id, detail) of contigs that several bins hold or one bin holds twice."""
    seen = contigs.groupBy("contig_id").agg(F.min("bin_id").alias("a"), F.max("bin_id").alias("b"), F.count("*").alias("n"))
    return seen.where("n > 1").select("contig_id", F.when(F.col("a") < F.col("b"), F.lit("several bins")).otherwise(F.lit("repeated")).alias("detail"))


def row_count_problems(rows: DataFrame, bins: DataFrame) -> DataFrame:
    """One row (rows, bins) if a table has not one row for each bin, else none."""
    return rows.agg(F.count("*").alias("rows")).join(F.broadcast(bins.agg(F.count("*").alias("bins"))), F.col("rows") != F.col("bins"))


IDENTITY = ["schema_version", "workflow_name", "workflow_version", "source_revision"]


def bundle_identities(bundles: DataFrame) -> DataFrame:
    """The different identities of the bundles; they may be merged if there is one."""
    return bundles.select(*IDENTITY).distinct()


def empty_gene_files(lines: DataFrame, code: int | None = None) -> DataFrame:
    """(path, detail) of gene files without genes that are no valid empty result.

    ``lines`` is (path, value). Such a file says that its version is 3, names
    a sequence and a model, and every model states a genetic code, ``code`` if given.
    """
    text = F.rtrim("value")
    version, model = text.startswith("##gff-version"), text.startswith("# Model Data:")
    table = F.regexp_extract(text, r"transl_table=([0-9]+)", 1)
    seen = lines.groupBy("path").agg(
        F.bool_and(F.when(version, text.rlike(r"\s3$"))).alias("version"), F.bool_or(text.startswith("# Sequence Data:")).alias("sequence"), F.bool_or(model).alias("model"),
        F.bool_or(model & (table == "")).alias("codeless"), F.bool_or(model & (table != "") & (table != F.lit(str(code)))).alias("other"),
    )
    detail = F.when(F.col("codeless"), F.lit("model without genetic code")).when(F.col("other") & F.lit(code is not None), F.lit("another genetic code"))
    detail = detail.when(~(F.coalesce("version", F.lit(False)) & F.col("sequence") & F.col("model")), F.lit("not an empty result"))
    return seen.select("path", detail.alias("detail")).where("detail is not null")


#: An error line of the completeness tool's log, and the one error with which it may end.
ERROR_LINE = r"(^|\s)ERROR([\s:]|$)"
NO_ANNOTATION = "] ERROR: No DIAMOND annotation was generated. Exiting"


def no_annotation_problems(lines: DataFrame, hits: DataFrame, bins: DataFrame, proteins: DataFrame, exit_code: int, has_report: bool) -> DataFrame:
    """(target, detail) for which a run without any annotation must not be accepted as one without results.

    It ended with code 1, without a report, and with the one error that says
    so; its hit tables (path, size_bytes) are there and empty; every bin file
    (bin_id, size_bytes) has content and a protein file, which is empty only
    if the log (value) warned of it once.
    """
    spark = lines.sparkSession
    facts = [(exit_code != 1, "run", "exit code"), (has_report, "run", "a report is there")]
    fixed = spark.createDataFrame([(t, d) for bad, t, d in facts if bad], "target string, detail string")
    error = F.col("value").rlike(ERROR_LINE)
    counts = lines.agg(F.count_if(error).alias("errors"), F.count_if(error & ~F.col("value").endswith(NO_ANNOTATION)).alias("others"))
    tables = hits.agg(F.count("*").alias("tables"), F.count_if(F.col("size_bytes") > 0).alias("filled"))
    say = lambda d, when, text: d.where(F.coalesce(when, F.lit(True))).select(F.lit("run").alias("target"), F.lit(text).alias("detail"))
    sides = {"bin": bins, "protein": proteins, "empty_bin": bins.where("size_bytes = 0"), "empty": proteins.where("size_bytes = 0"), "warned": warned_bins(lines)}
    rows = reduce(DataFrame.union, [d.select("bin_id", F.lit(n).alias("side")) for n, d in sides.items()])
    seen = rows.groupBy("bin_id").agg(*[F.count_if(F.col("side") == n).alias(n) for n in sides])
    detail = F.when(F.col("bin") != 1, F.lit("no bin of that name")).when(F.col("empty_bin") > 0, F.lit("empty bin")).when(F.col("protein") != 1, F.lit("no protein file")).when(F.col("warned") != F.col("empty"), F.lit("warnings and empty proteins differ"))
    parts = [
        fixed, say(counts, F.col("errors") != 1, "not one error"), say(counts, F.col("others") > 0, "another error"), say(tables, F.col("tables") == 0, "no hit table"), say(tables, F.col("filled") > 0, "hits are there"),
        say(bins.agg(F.count("*").alias("n")), F.col("n") == 0, "no bins"), seen.select(F.col("bin_id").alias("target"), detail.alias("detail")).where("detail is not null"),
    ]
    return reduce(DataFrame.union, parts)
