"""Helpers that several text operators share.

* ``materialize`` cuts lineage through a table in the cluster's shared folder.
* ``flat`` / ``pieces`` turn Arrow string columns into flat byte arrays in
  pieces of bounded size, so that a task's memory follows the piece and the
  longest text, never the partition.
* ``PrefixHash`` hashes any short byte range in constant time; ``word_hashes``
  hashes words of any length.
* ``connected`` labels graph components with joins only.
"""

from __future__ import annotations

import atexit
import gc
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE_BYTES = 1 << 20
#: Edges up to which one task, which holds them in 16 bytes each, finishes a graph.
SMALL_GRAPH = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a default of one machine only where Spark runs on one (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "/tmp/checkpoints/tessella"
    return found.rstrip("/")


def _drop(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone at exit; the folder is scratch space
        pass


def materialize(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Lost executors then cost a re-read and not a re-run of what came before.
    The table goes when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tessella-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_drop, spark, path)
    if keep is not None:
        keep.append(path)
    return spark.read.schema(df.schema).parquet(path)


def tidy(spark: SparkSession) -> None:
    """Let the shuffle files of finished steps go now.

    Spark removes them once the driver's garbage is collected, which may be
    long after the next large step has filled the disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables of ``materialize`` that nothing reads any more."""
    for path in paths:
        _drop(spark, path)
    paths.clear()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]]
    return data, at - at[0]


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``limit`` bytes of ``text`` each."""
    n = batch.num_rows
    if not n:
        return
    column = batch.column(batch.schema.get_field_index(text))
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    lo = 0
    while lo < n:
        start = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, start + limit, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SALTS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n + 1 powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) <= n:
        size = 1 << int(n).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size + 1, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


class PrefixHash:
    """64-bit hashes of arbitrary ranges of one byte array.

    A polynomial modulo 2**64: fit for ranges of at most some hundred bytes.
    For longer ones there are pairs of regular texts that it cannot tell apart.
    """

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_SALTS[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def windows(self, size: int) -> np.ndarray:
        """Of every range of that many bytes."""
        return mix((self.sums[size:] - self.sums[:-size]) * self.down[: len(self.sums) - size])


#: Words of more bytes are hashed one by one with a cryptographic digest.
LONG_WORD = 64


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, eight bytes at a time, all words together."""
    size = ends - starts
    h = mix(size.astype(np.uint64) * _BASE + np.uint64(1))
    if not len(h):
        return h
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, np.dtype("<u8"), padded, strides=(1,))
    long = size > LONG_WORD
    at = np.flatnonzero(~long & (size > 0))
    done = 0
    while len(at):
        left = np.minimum(size[at] - done, 8).astype(np.uint64)
        chunk = eight[starts[at] + done] & (~np.uint64(0) >> (np.uint64(8) - left) * np.uint64(8))
        h[at] = mix((h[at] ^ chunk) * _BASE)
        done += 8
        at = at[size[at] > done]
    raw = memoryview(data)
    for k in np.flatnonzero(long).tolist():
        h[k] = int.from_bytes(hashlib.blake2b(raw[starts[k] : ends[k]], digest_size=8).digest(), "little")
    return h


def word_bounds(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of ``inside`` bytes, and their text's index."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    on = inside[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = on.copy()
    first[1:] &= ~on[:-1] | edge[1:n]
    last = on.copy()
    last[:-1] &= ~on[1:] | edge[1:n]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Space and the five ASCII controls from tab to carriage return.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, least node of each one's component), without the least nodes themselves."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[: len(a)], inverse[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _local_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A star for each component of a task's edges, joined in pieces of bounded size."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def out() -> tuple[np.ndarray, np.ndarray]:
        return _stars(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))

    for batch in batches:
        held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
        size += batch.num_rows
        if size > 2 * SMALL_GRAPH:
            a, b = out()
            yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])
            held, size = [], 0
    if size:
        a, b = out()
        yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that reaches a lesser one, root the least.

    Tasks first reduce their own edges to stars. A table of at most SMALL_GRAPH
    edges is finished by one task. Beyond that, two steps alternate until
    nothing changes or the table is small: every node links its larger
    neighbours to its least neighbour, then its smaller ones. The number of
    rounds grows with the logarithm of the longest path. Each group is only
    ever reduced by ``min``, so hot nodes aggregate map-side.
    """
    spark = edges.sparkSession
    now: list[str] = []
    e = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a is not null and b is not null and a <> b")
    e = e.mapInArrow(_local_roots, "a long, b long")
    e = materialize(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), now)
    before, size = None, e.count()
    while True:
        if size <= SMALL_GRAPH:
            return e.coalesce(1).mapInArrow(_local_roots, "a long, b long").toDF("node", "root")
        both = e.union(e.select("b", "a").toDF("a", "b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = e.join(least, e.b == least.n).select(e.a, F.col("m").alias("b"))
        # e.a > e.b: the larger end of each edge goes to the least neighbour of the smaller end
        small_min = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_min.withColumnRenamed("a", "n"), large.a == F.col("n"))
        step = small.select(F.col("a"), F.col("m").alias("b")).union(small.select(F.col("b").alias("a"), F.col("m").alias("b")))
        last, now = now, []
        e = materialize(step.where("a <> b").distinct(), now)
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        release(spark, last)
        if before == (state.n, state.h):
            break
        before, size = (state.n, state.h), state.n
    return e.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
