"""Sequencing reads: FASTQ files in splits, their statistics and the quality filter."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.sources import splits

#: Lines of a record, the code of quality zero, lowest length and mean quality of the platforms (no quality for HiFi).
LINES, ZERO = 4, 33
LIMITS = {"ont": (1000, 10), "hifi": (1000, None)}
#: Error probabilities are summed as whole numbers of this part, so that sums do not depend on their order.
PART = 10**12
#: Qualities that are looked up at once, or one longer read.
PIECE = 1 << 20


def errors(quality: int) -> int:
    """The error probability that a quality stands for, in parts."""
    return round(10 ** (-quality / 10) * PART)


def _inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records whose lines all lie within one split: path, record and the four lines."""
    split, held = None, None
    for batch in batches:
        for here, part in splits.runs(batch):
            text = part.column(2)
            if here == split and held is not None:
                text, first = pa.concat_arrays([held[0], text]), held[1]
            else:
                first = part.column(3)[0].as_py()
            split, skip = here, -first % LINES
            whole = max(0, len(text) - skip) // LINES
            at = np.arange(skip, skip + whole * LINES, LINES)
            if whole:
                found = [text.take(pa.array(at + k)) for k in range(LINES)]
                yield pa.record_batch([pa.array([here[0]] * whole, pa.string()), pa.array((first + at) // LINES), *found], names=["path", "record", "l0", "l1", "l2", "l3"])
            rest = min(skip + whole * LINES, len(text))
            held = (text[rest:], first + rest)


def fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, record, name, header, sequence, quality) of every four-line record.

    A large file is read in splits. Lines of a record that a split cuts, at
    most three at either end, go with the row of their split and meet by file
    and number. A record without its four lines, without the marks ``@`` and
    ``+``, without a name, or with sequence and quality of different lengths
    raises when it is read. Blank lines at the end of a file do not count.
    """
    rows = splits.lines(spark, path)
    placed, found = splits.placed(rows, edges=LINES - 1)
    inner = placed.select("path", "block", "text", "line").mapInArrow(_inner, "path string, record long, l0 string, l1 string, l2 string, l3 string")
    edges = found.select("path", "before", "count", F.explode("edges").alias("e"))
    edges = edges.select("path", "before", "count", (F.col("before") + F.col("e.n")).alias("line"), F.col("e.text").alias("text")).withColumn("record", F.expr(f"line div {LINES}"))
    first = F.col("record") * LINES
    cut = edges.where((first < F.col("before")) | (first + LINES > F.col("before") + F.col("count")))
    joined = cut.groupBy("path", "record").agg(*(F.max(F.when(F.col("line") % LINES == k, F.col("text"))).alias(f"l{k}") for k in range(LINES)))
    every = inner.union(joined).where(~((F.trim(F.concat(*(F.coalesce(f"l{k}", F.lit("")) for k in range(LINES)))) == "") & F.col("l3").isNull()))
    place = F.concat(F.lit(" in record "), F.col("record") + 1, F.lit(" of "), F.col("path"))
    bad = F.when(F.col("l3").isNull(), F.lit("missing lines")).when(~F.col("l0").startswith("@"), F.lit("no @")).when(~F.col("l2").startswith("+"), F.lit("no +"))
    bad = bad.when(F.regexp_extract("l0", r"^@(\S+)", 1) == "", F.lit("no name")).when(F.length("l1") != F.length("l3"), F.lit("sequence and quality differ in length"))
    checked = F.when(bad.isNotNull(), F.raise_error(F.concat(bad, place))).otherwise(F.col("l1"))
    return every.select("path", "record", F.regexp_extract("l0", r"^@(\S+)", 1).alias("name"), F.substring("l0", 2, 1 << 30).alias("header"), checked.alias("sequence"), F.col("l3").alias("quality"))


def measured(reads: DataFrame) -> DataFrame:
    """Adds ``length`` and ``error_sum``, the whole parts of the errors that the qualities of a read stand for."""

    @F.arrow_udf("long")
    def error_sum(quality: pa.Array) -> pa.Array:
        table = np.array([errors(max(0, b - ZERO)) for b in range(256)], np.int64)
        quality = quality.fill_null("").cast(pa.large_string())
        at = np.frombuffer(quality.buffers()[1], np.int64)[quality.offset : quality.offset + len(quality) + 1]
        data, out = np.frombuffer(quality.buffers()[2] or b"", np.uint8), np.zeros(len(quality), np.int64)
        lo = 0
        while lo < len(out):
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + PIECE, "right")) - 1)
            sums = np.append(0, np.cumsum(table[data[at[lo] : at[hi]]]))
            out[lo:hi] = np.diff(sums[at[lo : hi + 1] - at[lo]])
            lo = hi
        return pa.array(out)

    return reads.withColumns({"length": F.length("sequence").cast("long"), "error_sum": error_sum(F.col("quality"))})


def mean_quality() -> Column:
    """The quality that the mean error probability of a measured read stands for; null for an empty read."""
    return F.when(F.col("length") > 0, F.round(-10 * F.log10(F.col("error_sum") / (F.col("length") * F.lit(float(PART)))), 6))


def is_kept(platform: str = "ont", least_length: int | None = None, least_quality: int | None = None) -> Column:
    """Whether a measured read has the platform's least length and mean quality or more; both bounds belong to what is kept."""
    length, quality = LIMITS[platform]
    length, quality = least_length if least_length is not None else length, least_quality if least_quality is not None else quality
    long = F.col("length") >= length
    return long if quality is None else long & (F.col("error_sum") <= F.col("length") * F.lit(errors(quality)))


def kept(reads: DataFrame, platform: str = "ont", least_length: int | None = None, least_quality: int | None = None) -> DataFrame:
    return reads.where(is_kept(platform, least_length, least_quality))


def statistics(reads: DataFrame, keys: list[str]) -> DataFrame:
    """num_seqs, sum_len, min_len, max_len, gc, n50 and errors of measured reads, group by group.

    All come from the counts of equal lengths, so reads are parsed once. The
    errors of some million bases exceed 64 bits: their sum is a decimal.
    """
    gc = F.length(F.regexp_replace(F.upper("sequence"), "[^GC]", ""))
    by_length = reads.groupBy(*keys, "length").agg(F.count("*").alias("n"), F.sum("length").alias("bp"), F.sum(gc).alias("gc"), F.sum(F.col("error_sum").cast("decimal(19,0)")).alias("errors"))
    w = Window.partitionBy(*keys)
    run = by_length.withColumn("upto", F.sum("bp").over(w.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0))).withColumn("total", F.sum("bp").over(w))
    half = F.when(F.col("upto") >= F.expr("(total + 1) div 2"), F.col("length"))
    whole = run.groupBy(*keys).agg(F.sum("n").alias("num_seqs"), F.sum("bp").alias("sum_len"), F.min("length").alias("min_len"), F.max("length").alias("max_len"), F.sum("gc").alias("gc_bp"), F.max(half).alias("n50_bp"), F.sum("errors").cast("decimal(38,0)").alias("error_sum"))
    return whole.select(*keys, "num_seqs", "sum_len", "min_len", "max_len", "gc_bp", "n50_bp", "error_sum")


def write_fastq(reads: DataFrame, path: str) -> None:
    """Reads (header, sequence, quality) as FASTQ text, a file for each task."""
    reads.select(F.concat_ws("\n", F.concat(F.lit("@"), F.col("header")), "sequence", F.lit("+"), "quality").alias("value")).write.text(path)
