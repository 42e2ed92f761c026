"""Line files read in splits, where a line depends on the lines before it.

Spark reads a large file in splits, each by a task of its own, and no task
knows what came before its split. Here every task numbers the lines of its
split and carries values forward within it. What a split hands on, one small
row, is summed up over the splits of the file and joined back. So no task
holds a file, and nothing is shuffled but the row of each split.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Up to so many splits (some 60 bytes each) their table is broadcast; beyond, lines and table meet by a shuffle.
BROADCAST_SPLITS = 1_000_000


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, block, text): every line with its file and the place where its split starts."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.regexp_replace("value", "\r$", "").alias("text"))


def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The parts of a batch that lie within one split, in order; the first two columns tell the split."""
    n, cuts = batch.num_rows, [0]
    if n > 1:
        other = pc.or_(pc.not_equal(batch.column(0)[1:], batch.column(0)[:-1]), pc.not_equal(batch.column(1)[1:], batch.column(1)[:-1]))
        cuts += [k + 1 for k in pc.indices_nonzero(other).to_pylist()]
    for lo, hi in zip(cuts, [*cuts[1:], n], strict=True):
        if hi > lo:
            yield (batch.column(0)[lo].as_py(), batch.column(1)[lo].as_py()), batch.slice(lo, hi - lo)


def numbered(rows: DataFrame, carried: list[str] = []) -> DataFrame:  # noqa: B006
    """Adds ``n``, a line's place in its split, from 0; null cells of ``carried`` take the last value before them in the split."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, n, last = None, 0, {}
        for batch in batches:
            for here, part in runs(batch):
                if here != split:
                    split, n, last = here, 0, {}
                columns = list(part.columns)
                for c in carried:
                    k = names.index(c)
                    filled = pc.fill_null_forward(columns[k])
                    if last.get(c) is not None:
                        filled = pc.fill_null(filled, last[c])
                    last[c] = filled[-1] if filled[-1].is_valid else None
                    columns[k] = filled
                yield pa.record_batch([*columns, pa.array(range(n, n + part.num_rows), pa.int64())], names=[*names, "n"])
                n += part.num_rows

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("n", T.LongType())]))


def summed(rows: DataFrame, carried: list[str] = [], edges: int = 0) -> DataFrame:  # noqa: B006
    """(path, block, count, the last value of ``carried``, edges): one row for each split.

    ``edges`` lists the first and the last so many lines with their places.
    """
    names = rows.columns
    kinds = {f.name: f.dataType for f in rows.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, count, last, head, tail = None, 0, {}, [], []

        def out() -> pa.RecordBatch:
            lists = [{"n": k, "text": t} for k, t in sorted(dict(head + tail).items())]
            columns = [pa.array([split[0]], pa.string()), pa.array([split[1]], pa.int64()), pa.array([count], pa.int64())]
            columns += [pa.array([last.get(c)], pa_types[c]) for c in carried]
            return pa.record_batch([*columns, pa.array([lists], pa.list_(pa.struct([("n", pa.int64()), ("text", pa.string())])))], names=["path", "block", "count", *carried, "edges"])

        pa_types = {}
        for batch in batches:
            pa_types = {c: batch.schema.field(names.index(c)).type for c in carried}
            for here, part in runs(batch):
                if here != split:
                    if split is not None:
                        yield out()
                    split, count, last, head, tail = here, 0, {}, [], []
                for c in carried:
                    known = part.column(names.index(c)).drop_null()
                    last[c] = known[-1].as_py() if len(known) else last.get(c)
                if edges:
                    text, n = part.column(names.index("text")), part.num_rows
                    if count < edges:
                        head += [(count + k, text[k].as_py()) for k in range(min(edges - count, n))]
                    tail = (tail + [(count + k, text[k].as_py()) for k in range(max(0, n - edges), n)])[-edges:]
                count += part.num_rows
        if split is not None:
            yield out()

    own = [T.StructField(c, kinds[c]) for c in carried]
    edge = T.ArrayType(T.StructType([T.StructField("n", T.LongType()), T.StructField("text", T.StringType())]))
    return rows.mapInArrow(run, T.StructType([rows.schema["path"], rows.schema["block"], T.StructField("count", T.LongType()), *own, T.StructField("edges", edge)]))


def is_small(rows: DataFrame) -> bool:
    """Whether the files of ``rows`` have few enough splits to broadcast a row for each."""
    parts = rows._jdf.queryExecution().toRdd().getNumPartitions()
    return parts + len(rows.inputFiles()) <= BROADCAST_SPLITS


def placed(rows: DataFrame, carried: list[str] = [], edges: int = 0) -> tuple[DataFrame, DataFrame]:  # noqa: B006
    """(lines, splits) of ``rows`` (path, block, ...).

    ``line`` numbers the lines of a file from 0, and the ``carried`` columns
    hold their last value before or at each line of the file. Lines of a split
    stay in order. ``splits`` has path, block, count, ``before`` (the lines of
    earlier splits) and ``edges``.
    """
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = summed(rows, carried, edges)
    sums = sums.withColumns({"before": F.coalesce(F.sum("count").over(earlier), F.lit(0)), **{f"_{c}": F.last(c, ignorenulls=True).over(earlier) for c in carried}})
    small = sums.select("path", "block", "before", *(f"_{c}" for c in carried))
    own = numbered(rows, carried)
    if is_small(rows):
        both = own.join(F.broadcast(small), ["path", "block"], "left")
    else:
        both = own.join(small.hint("shuffle_merge"), ["path", "block"], "left").repartition("path", "block").sortWithinPartitions("path", "block", "n")
    known = F.when(F.col("before").isNull(), F.raise_error(F.lit("the splits of a file changed while it was read"))).otherwise(F.col("before"))
    out = both.withColumns({"line": known + F.col("n"), **{c: F.coalesce(c, f"_{c}") for c in carried}})
    return out.drop("before", *(f"_{c}" for c in carried)), sums.select("path", "block", "count", "before", "edges")
