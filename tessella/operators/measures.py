"""Aggregates over contigs, reads and bins."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.operators.keys import WIDTH


def n50(contigs: DataFrame, keys: list[str], length: str = "length_bp") -> DataFrame:
    """The length at which contigs of that length or more hold half of the total.

    Lengths are summed before they are ordered, so a group has one row for
    each different length in the window, not one for each contig.
    """
    by_length = contigs.groupBy(*keys, length).agg(F.sum(length).cast("long").alias("bp"))
    w = Window.partitionBy(*keys)
    run = by_length.withColumn("upto", F.sum("bp").over(w.orderBy(F.desc(length)).rowsBetween(Window.unboundedPreceding, 0))).withColumn("total", F.sum("bp").over(w))
    return run.where(F.col("upto") >= F.expr("(total + 1) div 2")).groupBy(*keys).agg(F.max(length).cast("long").alias("n50_bp"))


def totals(contigs: DataFrame, keys: list[str], length: str = "length_bp") -> DataFrame:
    return contigs.groupBy(*keys).agg(F.count("*").alias("contig_count"), F.sum(length).cast("long").alias("assembly_length_bp"), F.max(length).cast("long").alias("longest_bp"))


def gc_fraction(contigs: DataFrame, keys: list[str], gc: str = "gc_bp", length: str = "length_bp") -> DataFrame:
    return contigs.groupBy(*keys).agg((F.sum(gc).cast("double") / F.sum(length)).alias("gc_fraction"))


def assembly_summary(assemblies: DataFrame, contigs: DataFrame, keys: list[str]) -> DataFrame:
    """Totals and N50 of every assembly; one without contigs has zero counts and no N50.

    All come from the counts of equal lengths, so contigs are read and aggregated once.
    """
    by_length = contigs.groupBy(*keys, "length_bp").agg(F.count("*").alias("n"), F.sum("length_bp").cast("long").alias("bp"))
    w = Window.partitionBy(*keys)
    run = by_length.withColumn("upto", F.sum("bp").over(w.orderBy(F.desc("length_bp")).rowsBetween(Window.unboundedPreceding, 0))).withColumn("total", F.sum("bp").over(w))
    half = F.when(F.col("upto") >= F.expr("(total + 1) div 2"), F.col("length_bp"))
    whole = run.groupBy(*keys).agg(F.sum("n").alias("contig_count"), F.sum("bp").alias("assembly_length_bp"), F.max("length_bp").cast("long").alias("longest_bp"), F.max(half).cast("long").alias("n50_bp"))
    return assemblies.join(whole, keys, "left").na.fill(0, ["contig_count", "assembly_length_bp"])


def conserved_reads(raw: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """raw and kept have num_seqs and sum_len: total, retained and rejected reads and bases."""
    r, k = raw.toDF(*keys, "total_reads", "total_bases"), kept.toDF(*keys, "retained_reads", "retained_bases")
    both = r.join(k, keys)
    return both.withColumns({"rejected_reads": F.col("total_reads") - F.col("retained_reads"), "rejected_bases": F.col("total_bases") - F.col("retained_bases")})


def mapping_block(bins: DataFrame, members: DataFrame, counts: DataFrame, denominator: DataFrame, scope: list[str], bin_key: str = "bin_id", contig_key: str = "contig_id") -> tuple[DataFrame, DataFrame]:
    """(per bin, per scope) read counts. Reads are aligned, binned, unbinned or residual.

    ``denominator`` has the scope and total_reads. A negative rest is an error
    and shows as status ``error``.
    """
    hit = members.join(counts, [*scope, contig_key])
    by_bin = bins.join(hit.groupBy(*scope, bin_key).agg(F.sum("reads").cast("long").alias("binned_reads")), [*scope, bin_key], "left").na.fill(0, ["binned_reads"])
    aligned = counts.groupBy(*scope).agg(F.sum("reads").cast("long").alias("aligned_reads"))
    binned = by_bin.groupBy(*scope).agg(F.sum("binned_reads").cast("long").alias("binned_reads"))
    whole = denominator.join(aligned, scope, "left").join(binned, scope, "left").na.fill(0, ["aligned_reads", "binned_reads"])
    whole = whole.withColumns({"unbinned_reads": F.col("aligned_reads") - F.col("binned_reads"), "residual_reads": F.col("total_reads") - F.col("aligned_reads")})
    return by_bin, whole.withColumn("status", F.when((F.col("unbinned_reads") < 0) | (F.col("residual_reads") < 0), F.lit("error")).otherwise(F.lit("available")))


def inventory_status(assemblies: DataFrame, contigs: DataFrame, keys: list[str]) -> DataFrame:
    """``assemblies`` declares contig_count and assembly_length_bp: complete, partial or error."""
    seen = contigs.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("length_bp").cast("long").alias("bp"))
    both = assemblies.join(seen, keys, "left").na.fill(0, ["n", "bp"])
    status = F.when((F.col("n") == F.col("contig_count")) & (F.col("bp") == F.col("assembly_length_bp")), F.lit("complete"))
    status = status.when((F.col("n") > F.col("contig_count")) | (F.col("bp") > F.col("assembly_length_bp")), F.lit("error")).otherwise(F.lit("partial"))
    return both.select(*keys, "n", "bp", status.alias("status"))


def top_motif(counts: DataFrame, keys: list[str]) -> DataFrame:
    """The motif with the largest positive count; of equal counts the smallest motif."""
    return counts.where("n > 0").groupBy(*keys).agg(F.min_by("motif", F.struct(-F.col("n"), "motif")).alias("motif"), F.max("n").cast("long").alias("n"))


def masked_bases(sequences: DataFrame, keys: list[str], seq: str = "sequence") -> DataFrame:
    return sequences.groupBy(*keys).agg(F.sum(F.length(F.regexp_replace(seq, "[^a-z]", ""))).cast("long").alias("masked_bp"))


def sequence_digest(sequences: DataFrame, keys: list[str], name: str = "name", seq: str = "sequence") -> DataFrame:
    """A digest of each group's records that neither their order nor the letters' case changes.

    A task reads its groups' records in order and hashes them as they come, so
    a group may be of any size.
    """
    record = F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.upper(seq), F.lit("\n"))
    rows = sequences.select(*keys, record.alias("_record")).repartition(*keys).sortWithinPartitions(*keys, "_record")
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("digest", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, sha, kinds = None, None, []

        def out(done: list[tuple]) -> pa.RecordBatch:
            columns = zip(*[(*k, d) for k, d in done], strict=True)
            return pa.record_batch([pa.array(x, t) for x, t in zip(columns, [*kinds, pa.string()], strict=True)], names=[*keys, "digest"])

        for batch in batches:
            kinds = [c.type for c in batch.columns[:-1]]
            done = []
            columns = [c.to_pylist() for c in batch.columns]
            for key, text in zip(zip(*columns[:-1], strict=True), columns[-1], strict=True):
                if sha is None or key != group:
                    if sha is not None:
                        done.append((group, sha.hexdigest()))
                    group, sha = key, hashlib.sha256()
                if text is not None:
                    sha.update(text.encode())
            if done:
                yield out(done)
        if sha is not None:
            yield out([(group, sha.hexdigest())])

    return rows.mapInArrow(run, schema)


def _covered(stretches: DataFrame, keys: list[str], width: int) -> DataFrame:
    """numreads, aligned bases and covered bases of stretches (start, end, ends counted in; ``_n``, the reads that each stands for).

    Stretches are cut where a block of ``width`` positions ends, so no block
    needs what lies before it, and the stretches are made once. Pieces with
    one start are counted map-side and only the longest goes on, so a block
    has that many rows at most.
    """
    first, last = F.floor(F.col("start") / F.lit(width)), F.floor(F.col("end") / F.lit(width))
    cut = stretches.select("*", F.explode_outer(F.sequence(first, F.greatest(first, last))).alias("_block"))
    lo, border = F.greatest(F.col("start"), F.col("_block") * width), (F.col("_block") + 1) * width - 1
    hi = F.when(F.col("end") > border, border).otherwise(F.col("end"))
    n = F.when(F.col("start") < F.col("_block") * width, F.lit(0)).otherwise(F.col("_n"))
    pieces = cut.select(*keys, "_block", lo.alias("start"), hi.alias("end"), n.alias("_n"))
    at = pieces.groupBy(*keys, "_block", "start").agg(F.sum("_n").alias("n"), F.sum(F.expr("end - start + 1")).alias("bp"), F.max("end").alias("end"))
    before = F.max("end").over(Window.partitionBy(*keys, "_block").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    reached = F.greatest(F.coalesce(before, F.lit(0)), F.col("start") - 1)
    step = at.withColumn("fresh", F.greatest(F.lit(0), F.col("end") - reached))
    return step.groupBy(*keys).agg(F.sum("n").alias("numreads"), F.sum("bp").cast("long").alias("aligned_bp"), F.sum("fresh").cast("long").alias("covbases"))


def covered_bases(alignments: DataFrame, keys: list[str], width: int = WIDTH) -> DataFrame:
    """numreads, aligned bases and covered bases from one-based inclusive start and end."""
    return _covered(alignments.select(*keys, "start", "end", F.lit(1).cast("long").alias("_n")), keys, width)


def _of_contigs(contigs: DataFrame, sums: list[DataFrame], keys: list[str], length: str) -> DataFrame:
    both = reduce(lambda a, b: a.join(b, keys, "left"), sums, contigs.select(*keys, length)).na.fill(0, ["numreads", "aligned_bp", "covbases"])
    return both.select(*keys, length, "numreads", "covbases", (100 * F.col("covbases") / F.col(length)).alias("coverage"), (F.col("aligned_bp") / F.col(length)).alias("meandepth"))


def contig_coverage(contigs: DataFrame, alignments: DataFrame, blocks: DataFrame, keys: list[str], length: str = "length_bp", width: int = WIDTH) -> DataFrame:
    """numreads, covbases, coverage in percent and meandepth of every contig, zero where nothing aligns.

    ``alignments`` has a row for each record, ``blocks`` one for each stretch
    of aligned bases (start, end). Records of contigs that are not listed do
    not count.
    """
    reads = alignments.groupBy(*keys).agg(F.count("*").alias("numreads"))
    return _of_contigs(contigs, [reads, covered_bases(blocks, keys, width).drop("numreads")], keys, length)


def record_coverage(contigs: DataFrame, records: DataFrame, keys: list[str], blocks: str = "blocks", length: str = "length_bp", width: int = WIDTH) -> DataFrame:
    """``contig_coverage`` of records that have their stretches in a column, from one pass over them.

    A record's first stretch counts the read; one without stretches counts
    as a read that covers nothing.
    """
    each = records.select(*keys, F.posexplode_outer(blocks).alias("_at", "_b"))
    stretches = each.select(*keys, F.col("_b.start").alias("start"), F.col("_b.end").alias("end"), F.when(F.col("_at") > 0, F.lit(0)).otherwise(F.lit(1)).cast("long").alias("_n"))
    return _of_contigs(contigs, [_covered(stretches, keys, width)], keys, length)


def top_totals(rows: DataFrame, keys: list[str], total: str, n: int = 30) -> DataFrame:
    """The n groups with the largest totals; ties go to the smaller keys."""
    return rows.orderBy(F.desc(total), *keys).limit(n)
