"""Near duplicates by SimHash, compared in vertical bit planes.

A fingerprint has a bit set where over half of a text's shingle hashes have
it. Fingerprints that differ in at most ``RADIUS`` of 64 bits agree on one of
every four blocks of bits, so those that share a block meet in a bucket. There
they are compared bit-sliced: 64 fingerprints fill a word of each of 64 bit
planes, one operation updates the distances of all of them to a query, and
carry-save adders keep the distances as vertical counters. Words in which all
distances exceed the radius are abandoned before the remaining planes.

Equal fingerprints are one point. With more points the bits are cut into more
blocks, of which all but three must agree, so that an ordinary bucket does not
outgrow ``CHUNK``. In a bucket that does, points one bit apart are joined
first, by grouping on the fingerprint without that bit; chunks that lie within
one component are then not compared with each other. A group of copies, which
is dense, costs its length and not its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.shared import _stars, connected, materialize, pieces, release

BITS, RADIUS, WORDS, SEED = 64, 3, 3, 42
#: Points of a tile of small buckets, and of a chunk of a large one.
TILE, CHUNK = 1024, 4096
#: Words of bit planes that one operation works on.
SPAN = 8192
#: Planes after which words are looked at for the first time, and again each time.
LOOK = 8
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Shingles whose bits are counted at once, and links that a tile holds.
COUNTED, HELD = 1 << 17, 1 << 20


def _digests(text: bytes) -> list[bytes]:
    words = text.lower().split()
    if len(words) < WORDS:
        return [xxhash.xxh64_digest(b" ".join(words), SEED)] if words else []
    joined, of = b" ".join(words), xxhash.xxh64_digest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    return [of(joined[a:b], SEED) for a, b in zip(starts[: 1 - WORDS].tolist(), ends[WORDS - 1 :].tolist(), strict=True)]


def fingerprint_texts(texts: list[bytes | None]) -> np.ndarray:
    """Signed 64-bit fingerprints."""
    set_, total = np.zeros((len(texts), BITS), np.int64), np.zeros(len(texts), np.int64)
    held: list[bytes] = []
    owners: list[int] = []
    for k, t in enumerate(texts):
        found = _digests(t or b"")
        total[k] = len(found)
        for lo in range(0, len(found), COUNTED):
            held += found[lo : lo + COUNTED]
            owners += [k] * min(COUNTED, len(found) - lo)
            if len(held) >= COUNTED:
                _count(held, owners, set_)
                held, owners = [], []
    _count(held, owners, set_)
    return np.packbits(2 * set_ > total[:, None], axis=1).view(">i8")[:, 0].astype(np.int64)


def _count(held: list[bytes], owners: list[int], set_: np.ndarray) -> None:
    if held:
        bits = np.unpackbits(np.frombuffer(b"".join(held), np.uint8).reshape(-1, 8), axis=1)
        of = np.array(owners)
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        set_[of[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, point) of every row, point the fingerprint as a signed number; one pass, no shuffle.

    Null, empty and blank texts have the fingerprint zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                points = fingerprint_texts(piece.column(1).cast(pa.binary()).to_pylist())
                yield pa.record_batch([piece.column(0), pa.array(points)], names=["key", "point"])

    source = docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text"))
    return source.mapInArrow(run, "key long, point long")


def planes_of(points: np.ndarray) -> np.ndarray:
    """Bit planes (64, words): lane k of plane p is bit p of point k."""
    words = -(-len(points) // 64)
    bits = np.zeros((words * 64, BITS), np.uint8)
    bits[: len(points)] = np.unpackbits(points.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def _add(low: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save: (low + a + b) modulo 2, and the carry."""
    half = low ^ a
    return half ^ b, (low & a) | (half & b)


def close(queries: np.ndarray, lanes: np.ndarray, itself: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (in queries, in lanes) of points within the radius; for ``itself`` only those with the first before the second."""
    if not len(queries) or not len(lanes):
        return
    planes = planes_of(lanes)
    share = np.bitwise_count(planes).sum(axis=1)
    order = np.argsort(np.abs(share.astype(np.int64) * 2 - len(lanes)), kind="stable")  # what divides the lanes best comes first
    planes = planes[order]
    masks = np.where((queries[None, :].astype(np.uint64) >> order[:, None].astype(np.uint64)) & np.uint64(1) == 1, ALL, np.uint64(0))
    step = max(1, SPAN // planes.shape[1])
    for lo in range(0, len(queries), step):
        skip = lo // 64 if itself else 0
        p, m = planes[:, None, skip:], masks[:, lo : lo + step, None]
        shape = (m.shape[1], p.shape[2])
        live = None
        ones = twos = over = np.zeros(shape, np.uint64)
        for k in range(0, BITS, 4):
            if live is None:
                d = [p[k + i] ^ m[k + i] for i in range(4)]
            else:
                q, w = live
                d = [p[k + i, 0, w] ^ m[k + i, q, 0] for i in range(4)]
            ones, first = _add(ones, d[0], d[1])
            ones, second = _add(ones, d[2], d[3])
            twos, fours = _add(twos, first, second)
            over = over | fours
            if (k + 4) % LOOK == 0:
                open_ = np.flatnonzero(over.ravel() != ALL)
                if not len(open_):
                    break
                if 2 * len(open_) < over.size:
                    live = (open_ // shape[1], open_ % shape[1]) if live is None else (live[0][open_], live[1][open_])
                    ones, twos, over = (x.ravel()[open_] for x in (ones, twos, over))
        else:
            near = np.flatnonzero(np.unpackbits((~over).ravel().view(np.uint8), bitorder="little"))
            word, lane = near // 64, near % 64
            q, w = (word // shape[1], word % shape[1]) if live is None else (live[0][word], live[1][word])
            q, j = q + lo, (w + skip) * 64 + lane
            good = (j < len(lanes)) & ((q < j) if itself else True)
            yield q[good], j[good]


class _Links:
    """Links of a tile, reduced to a star for each component."""

    def __init__(self) -> None:
        self.a, self.b, self.size = [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.a.append(a)
            self.b.append(b)
            self.size += len(a)
            if self.size > HELD:
                self._reduce()

    def _reduce(self) -> None:
        a, b = _stars(np.concatenate(self.a), np.concatenate(self.b))
        self.a, self.b, self.size = [a], [b], 0

    def batch(self) -> pa.RecordBatch:
        if self.a:
            self._reduce()
        none = np.zeros(0, np.int64)
        return pa.record_batch([pa.array(self.a[0] if self.a else none), pa.array(self.b[0] if self.b else none)], names=["a", "b"])


def _compare(queries: np.ndarray, lanes: np.ndarray | None) -> pa.RecordBatch:
    links, itself = _Links(), lanes is None
    lanes = queries if lanes is None else lanes
    for q, j in close(queries, lanes, itself):
        links.add(queries[q], lanes[j])
    return links.batch()


def _runs(batches: Iterator[pa.RecordBatch], columns: int, least: int) -> Iterator[list[np.ndarray]]:
    """Rows sorted by their first ``columns`` columns, cut between groups once ``least`` rows are there."""
    held: list[np.ndarray] = []
    for batch in batches:
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held = now if not held else [np.concatenate(x) for x in zip(held, now, strict=True)]
        while len(held[0]) >= least:
            new = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in held[:columns]])) + 1
            cut = new[new >= least]
            if not len(cut):
                break
            yield [c[: cut[0]] for c in held]
            held = [c[cut[0] :] for c in held]
    if held and len(held[0]):
        yield held


def _small_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, _, points in _runs(batches, 2, TILE):
        yield _compare(np.unique(points), None)


def _large_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, side, points in _runs(batches, 1, 1):
        yield _compare(points[side == 0], points[side == 1] if (side == 1).any() else None)


def tables_of(points: int) -> list[int]:
    """Masks of the tables: the bits on which points of a bucket agree.

    Bits are cut into the fewest blocks for which even all points, evenly
    spread, leave ``CHUNK`` or fewer to a bucket; all choices of all but
    RADIUS blocks make a table each. Any number of blocks finds every link.
    """
    blocks = RADIUS + 1
    while points >> (BITS * (blocks - RADIUS) // blocks) > CHUNK and blocks < 8:
        blocks += 1
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    masks = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    return [sum(x) for x in combinations(masks, blocks - RADIUS)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(points: DataFrame) -> DataFrame:
    """(a, b) pairs of linked points that connect all that the radius links. ``points``: one column, no repeats."""
    point, scratch = F.col("point"), []
    masks = tables_of(points.count())
    keys = F.explode(F.array(*(F.struct(F.lit(k).alias("t"), point.bitwiseAND(F.lit(_signed(m))).alias("k")) for k, m in enumerate(masks))))
    keyed = points.select("point", keys.alias("x")).select("x.t", "x.k", "point")
    big = materialize(keyed.groupBy("t", "k").agg(F.count("*").alias("n")).where(F.col("n") > CHUNK), scratch)
    small = keyed.join(big.hint("shuffle_merge"), ["t", "k"], "left_anti").repartition("t", "k").sortWithinPartitions("t", "k")
    found = materialize(small.select("t", "k", "point").mapInArrow(_small_tiles, "a long, b long"))
    if not big.limit(1).count():
        return found
    rows = materialize(keyed.join(big.select("t", "k").hint("shuffle_merge"), ["t", "k"]), scratch)
    without = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), point.bitwiseAND(F.lit(_signed(((1 << 64) - 1) ^ (1 << i)))).alias("rest")) for i in range(BITS))))
    twins = rows.select("point").distinct().select("point", without.alias("x")).groupBy("x").agg(F.min("point").alias("a"), F.max("point").alias("b"))
    twins = materialize(twins.where("a <> b").select("a", "b"))
    roots = connected(twins).toDF("point", "root")
    member = materialize(rows.join(roots, "point", "left").select("t", "k", "point", F.coalesce("root", "point").alias("root")), scratch)
    sizes = member.groupBy("t", "k", "root").agg(F.count("*").alias("n"))
    rest = sizes.where(F.col("n") <= CHUNK).groupBy("t", "k").agg(F.sum("n").alias("rest"))
    parts = lambda n: F.ceil(F.col(n) / F.lit(CHUNK))
    own = F.col("n") > CHUNK
    of = F.struct(own.alias("own"), F.when(own, F.col("root")).otherwise(F.lit(0)).alias("r"), F.pmod(F.xxhash64(F.when(own, F.col("point")).otherwise(F.col("root"))), F.when(own, parts("n")).otherwise(parts("rest"))).alias("c"))
    member = materialize(member.join(sizes, ["t", "k", "root"]).join(rest, ["t", "k"], "left").select("t", "k", "point", of.alias("part")), scratch)
    chunks = member.select("t", "k", "part").distinct()
    pairs = chunks.withColumnRenamed("part", "x").join(chunks.withColumnRenamed("part", "y"), ["t", "k"]).where("x <= y and not (x.own and y.own and x.r = y.r)")
    pairs = materialize(pairs.withColumn("p", F.monotonically_increasing_id()), scratch)
    sides = pairs.select("t", "k", F.col("x").alias("part"), "p", F.lit(0).alias("side")).union(pairs.where("x <> y").select("t", "k", F.col("y").alias("part"), "p", F.lit(1).alias("side")))
    tiles = member.join(sides, ["t", "k", "part"]).select("p", "side", "point").repartition("p").sortWithinPartitions("p")
    more = materialize(tiles.mapInArrow(_large_tiles, "a long, b long"))
    release(points.sparkSession, scratch)
    return found.union(twins).union(more)


def components(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, fingerprint (16 hexadecimal digits) and component_id of every row.

    Texts whose fingerprints differ in at most RADIUS bits are linked, texts
    without words (fingerprint zero) like any other; component_id is the least
    key reachable by links. Keys are whole numbers; a row with a null key has
    a fingerprint, no component, and links nothing. Rows that share a key are
    nodes of their own and give a row each. Other columns are not read.
    """
    rows = materialize(fingerprints(docs, text, key))
    least = materialize(rows.where("key is not null").groupBy("point").agg(F.min("key").alias("first")))
    roots = connected(links(least.select("point"))).toDF("point", "root")
    by_point = least.join(roots, "point", "left").select("point", "first", F.coalesce("root", "point").alias("root"))
    by_root = by_point.groupBy("root").agg(F.min("first").alias("component_id"))
    final = materialize(by_point.join(by_root, "root").select("point", "component_id"))
    out = rows.join(final.hint("shuffle_merge"), "point", "left")
    return out.select(F.col("key").alias(key), F.lower(F.lpad(F.hex("point"), 16, "0")).alias("fingerprint"), F.when(F.col("key").isNotNull(), F.col("component_id")).alias("component_id"))
