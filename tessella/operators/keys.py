"""Keys between tables: exact coverage, references, duplicates, sets and intervals."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def coverage(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that only one side has, with ``side`` = missing or unexpected. Empty if the cover is exact."""
    e, a = expected.select(*keys).distinct().withColumn("in_e", F.lit(1)), actual.select(*keys).distinct().withColumn("in_a", F.lit(1))
    both = e.join(a, keys, "full_outer").where("in_e is null or in_a is null")
    return both.select(*keys, F.when(F.col("in_a").isNull(), F.lit("missing")).otherwise(F.lit("unexpected")).alias("side"))


def dangling(rows: DataFrame, parents: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose key is there but has no parent. ``on`` maps a row's columns to the parent's."""
    some = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    keys = parents.select(*[F.col(p).alias(c) for c, p in on.items()]).distinct()
    return rows.where(some).join(keys, list(on), "left_anti")


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def dangling_targets(rows: DataFrame, kinds: dict[str, tuple[DataFrame, str]], scope: list[str]) -> DataFrame:
    """Rows whose (target_kind, target_id) none of the tables by kind holds."""
    known = [d.select(*scope, F.lit(kind).alias("target_kind"), F.col(c).cast("string").alias("target_id")) for kind, (d, c) in kinds.items()]
    return rows.join(reduce(DataFrame.unionByName, known).distinct(), [*scope, "target_kind", "target_id"], "left_anti")


def conflicts(rows: DataFrame, keys: list[str], value: str, label: Column) -> DataFrame:
    """Groups with more than one value, and their sorted labels."""
    found = rows.groupBy(*keys).agg(F.size(F.collect_set(value)).alias("values"), F.array_join(F.array_sort(F.collect_set(label)), ",").alias("assertions"))
    return found.where(F.col("values") > 1)


def deduplicated(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(one row for each key, keys whose rows differ). Equal repeats collapse."""
    rest = [c for c in rows.columns if c not in keys]
    clash = rows.groupBy(*keys).agg(F.countDistinct(F.struct(*[F.coalesce(F.to_json(F.struct(c)), F.lit("")) for c in rest])).alias("versions")).where("versions > 1")
    return rows.dropDuplicates(keys), clash


#: Positions of a block: what lies in one block of a contig is one task's, however long the contig.
WIDTH = 1 << 20


def in_blocks(rows: DataFrame, by: list[str], place: str, width: int, state: Column, over: Callable[[Column], Column]) -> DataFrame:
    """Adds ``_block``, where ``place`` lies, and ``_carry``, what the earlier blocks of the group hand on.

    ``state`` sums a block up and aggregates map-side; ``over`` takes the
    states of earlier blocks, in their order. Only these meet in one window.
    """
    blocks = rows.withColumn("_block", F.floor(F.col(place) / F.lit(width)))
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    states = blocks.groupBy(*by, "_block").agg(state.alias("_state")).withColumn("_carry", over(F.col("_state")).over(earlier)).drop("_state")
    keys = [*by, "_block"]
    same = reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in keys])
    # most groups have one block, to which nothing is handed on
    return blocks.alias("l").join(states.where(F.col("_carry").isNotNull()).alias("r"), same, "left").select("l.*", "r._carry")


def overlaps(intervals: DataFrame, parent: list[str], start: str = "start", end: str = "end", name: str = "name", width: int = WIDTH) -> DataFrame:
    """Intervals that begin before the one ahead of them ends, both ends counted in.

    The one ahead is looked up within a block of positions; the first of a
    block has the last of the blocks before it ahead.
    """
    last = F.max_by(F.struct(F.col(name).alias("name"), F.col(end).alias("end")), F.struct(start, end, name))
    seen = in_blocks(intervals, parent, start, width, last, lambda s: F.last(s, ignorenulls=True))
    w = Window.partitionBy(*parent, "_block").orderBy(start, end, name)
    ahead = F.coalesce(F.lag(F.struct(F.col(name).alias("name"), F.col(end).alias("end"))).over(w), F.col("_carry"))
    return seen.withColumn("_ahead", ahead).where(F.col("_ahead.end") >= F.col(start)).select(*parent, name, F.col("_ahead.name").alias("before"))


def not_contained(inner: DataFrame, outer: DataFrame, on: str) -> DataFrame:
    """Inner features outside their outer one: other contig or strand, or beyond its bounds."""
    i, o = inner.alias("i"), outer.alias("o")
    within = F.expr("i.contig = o.contig and i.strand = o.strand and i.start >= o.start and i.end <= o.end")
    return i.join(o, on).where(~within).select("i.*")


def lifted(genes: DataFrame, origins: DataFrame, on: str = "contig_id") -> DataFrame:
    """Gene coordinates on the parent contig; ``fits`` is false beyond the staged piece."""
    g, o = genes.alias("g"), origins.alias("o")
    start, end = F.col("o.start") + F.col("g.start") - 1, F.col("o.start") + F.col("g.end") - 1
    return g.join(o, on).select("gene_id", F.col("o.parent_contig").alias("parent_contig"), start.cast("long").alias("start"), end.cast("long").alias("end"), (end <= F.col("o.end")).alias("fits"))


def edge_phase(cds: DataFrame, transcript: str = "transcript") -> DataFrame:
    """The phase of each transcript's first coding part in reading direction."""
    first, last = F.min_by("phase", F.struct("start", "end")), F.max_by("phase", F.struct("end", "start"))
    both = cds.groupBy(transcript, "strand").agg(first.alias("first"), last.alias("last"))
    return both.select(transcript, "strand", F.when(F.col("strand") == "-", F.col("last")).otherwise(F.col("first")).alias("phase"))


def carried(rows: DataFrame, value: str, order: str, partition: list[str], width: int = WIDTH) -> DataFrame:
    """``value`` filled from the last row before that has one; ``order`` is a whole number."""
    last = F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order)))
    seen = in_blocks(rows, partition, order, width, last, lambda s: F.last(s, ignorenulls=True))
    w = Window.partitionBy(*partition, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return seen.withColumn(value, F.coalesce(F.last(value, ignorenulls=True).over(w), F.col("_carry"))).select(*rows.columns)
