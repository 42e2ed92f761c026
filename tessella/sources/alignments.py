"""Alignment records as text (SAM), their reference blocks, and selection by flags and intervals."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators.parse import kept_alignments

#: Mandatory columns of a record, the operations of a CIGAR text, those that use the reference, and those of aligned bases.
COLUMNS = ["qname", "flag", "contig", "start", "mapq", "cigar", "next_contig", "next_start", "template", "sequence", "quality"]
OPERATIONS, ON_REFERENCE, ALIGNED = "MIDNSHP=X", "MDN=X", "M=X"
#: Positions of a window: records and intervals meet where they share one.
WINDOW = 1 << 16
BLOCKS = "array<struct<start:bigint,end:bigint>>"


def sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The first eleven columns of every record, numbers as numbers, and the file; header lines do not count.

    Fewer columns, a flag, place or quality that is no number, and a CIGAR
    text of another form raise when the row is read.
    """
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value"))
    # exploded, as a filter on cells would otherwise move below and divide the line again for each use of a cell
    rows = raw.where(~F.col("value").startswith("@") & (F.col("value") != "")).select("*", F.explode(F.array(F.split("value", "\t"))).alias("c"))
    bad = lambda what: F.raise_error(F.concat(F.lit(f"{what}: "), F.col("value")))
    rows = rows.withColumn("c", F.when(F.size("c") >= len(COLUMNS), F.col("c")).otherwise(bad("too few columns")))
    cell = {n: F.col("c")[k] for k, n in enumerate(COLUMNS)}
    number = lambda n, kind: F.when(cell[n].rlike(r"\A[0-9]{1,10}\z"), cell[n].cast("long").cast(kind)).otherwise(bad(f"no number in {n}"))
    cigar = F.when(cell["cigar"].rlike(rf"\A(\*|([0-9]+[{OPERATIONS}])+)\z"), cell["cigar"]).otherwise(bad("no CIGAR text"))
    typed = {"flag": number("flag", "int"), "start": number("start", "long"), "mapq": number("mapq", "int"), "cigar": cigar}
    return rows.select("path", *(typed.get(n, cell[n]).alias(n) for n in ("qname", "flag", "contig", "start", "mapq", "cigar", "sequence", "quality")))


def used(cigar: Column, operations: str) -> Column:
    """The summed lengths of some operations of a CIGAR text."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(f"([0-9]+)[{operations}]"), F.lit(1)), F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))


def is_spliced(cigar: Column) -> Column:
    """Whether the record leaves out part of the reference."""
    return cigar.contains("N")


def exons(cigar: Column, start: Column) -> Column:
    """Blocks of the reference between left out parts, ends counted in; built-in functions only.

    Their number is that of introns, so the sums before each stay short.
    """
    sizes = F.transform(F.split(cigar, "[0-9]+N"), lambda part: used(part, "MD=X"))
    gaps = F.transform(F.regexp_extract_all(cigar, F.lit("([0-9]+)N"), F.lit(1)), lambda x: x.cast("long"))
    total = lambda a, n: F.aggregate(F.slice(a, 1, n), F.lit(0).cast("long"), lambda s, x: s + x)
    first = lambda k: start + total(sizes, k) + total(gaps, k)
    blocks = F.transform(sizes, lambda size, k: F.struct(first(k).alias("start"), (first(k) + size - 1).alias("end")))
    return F.filter(blocks, lambda b: b["end"] >= b["start"])


def _cut(cigars: pa.Array, starts: pa.Array, breaks: bytes) -> pa.Array:
    cigars = cigars.fill_null("").cast(pa.large_string())
    at = np.frombuffer(cigars.buffers()[1], np.int64)[cigars.offset : cigars.offset + len(cigars) + 1]
    data = np.frombuffer(cigars.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    begin = np.nan_to_num(starts.to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
    digit = (data >= 48) & (data <= 57)
    op = np.flatnonzero(~digit & (data != ord("*")))
    place = np.flatnonzero(digit)
    of = np.searchsorted(op, place)
    inside = of < len(op)
    place, of = place[inside], of[inside]
    value = np.zeros(len(op), np.int64)
    np.add.at(value, of, (data[place].astype(np.int64) - 48) * 10 ** (op[of] - 1 - place).astype(np.int64))
    code = data[op]
    row = np.searchsorted(at - at[0], op, side="right") - 1
    moves = np.isin(code, np.frombuffer(ON_REFERENCE.encode(), np.uint8))
    step = np.where(moves, value, 0)
    after = np.cumsum(step)
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else row
    base = np.zeros(len(cigars), np.int64)
    base[row[first]] = (after - step)[first]
    lo = begin[row] + after - step - base[row]
    hi = lo + step
    gap = np.isin(code, np.frombuffer(breaks, np.uint8))
    # a block goes on over operations that use no reference, and ends at a break or at its record's end
    keep = moves & ~gap & (value > 0)
    group = np.cumsum(gap) * (len(cigars) + 1) + row
    lo, hi, group, row = lo[keep], hi[keep], group[keep], row[keep]
    new = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (row[1:] != row[:-1]))) if len(row) else row
    ends = np.append(new[1:], len(row))[: len(new)] - 1
    counts = np.bincount(row[new], minlength=len(cigars)) if len(new) else np.zeros(len(cigars), np.int64)
    blocks = pa.StructArray.from_arrays([pa.array(lo[new]), pa.array(hi[ends] - 1)], names=["start", "end"])
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), blocks)


def aligned_blocks(cigar: Column, start: Column) -> Column:
    """Blocks of aligned bases: deletions and left out parts end a block. Linear in the text, for reads with thousands of operations."""

    @F.arrow_udf(BLOCKS)
    def blocks(cigars: pa.Array, starts: pa.Array) -> pa.Array:
        return _cut(cigars, starts, b"DN")

    return blocks(cigar, start)


def with_end(rows: DataFrame) -> DataFrame:
    """Adds ``end``, the last place of the reference that a record spans, left out parts included."""
    return rows.withColumn("end", F.col("start") + F.greatest(F.lit(1), used(F.col("cigar"), ON_REFERENCE)) - 1)


def primary(rows: DataFrame, least: int = 20) -> DataFrame:
    """Mapped primary records of a mapping quality of ``least`` or more."""
    return kept_alignments(rows, least=least)


def selected(rows: DataFrame, intervals: DataFrame, name: str = "bin_id") -> DataFrame:
    """Records (contig, start, end) with the name of every interval set that they reach, once for each name.

    Records that are equal in all columns count as one.

    ``intervals`` has ``name``, contig, from and to: from zero, the end not
    counted, as interval files have it. Records and intervals meet in windows
    of ``WINDOW`` positions, so a large contig spreads over tasks.
    """
    windows = lambda lo, hi: F.explode(F.sequence(F.expr(f"({lo}) div {WINDOW}"), F.expr(f"({hi}) div {WINDOW}")))
    reach = intervals.where(F.col("to") > F.col("from")).select(name, "contig", (F.col("from") + 1).alias("_lo"), F.col("to").alias("_hi"))
    reach = reach.withColumn("_w", windows("_lo", "_hi"))
    each = rows.withColumn("_id", F.struct("*")).withColumn("_w", windows("start", "end"))
    met = each.join(reach, ["contig", "_w"]).where((F.col("_lo") <= F.col("end")) & (F.col("_hi") >= F.col("start")))
    # once for each interval, in the first window that it shares with the record; then once for each name
    met = met.where(F.col("_w") == F.expr(f"greatest(start, _lo) div {WINDOW}"))
    return met.select(name, "_id").distinct().select(name, "_id.*")
