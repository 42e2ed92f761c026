"""Similarity join of documents on sets of word shingles, exact at a Jaccard threshold.

1.  Every text becomes a sorted set of 64-bit shingle hashes. Texts with equal
    sets form one class, known by a 64-bit digest, or by a second one where
    different sets share the first; from here on, classes stand for their
    documents.
2.  Prefix filter: two similar sets share several of their first shingles in
    any fixed order; how many follows from the length of the prefix. Shingles
    that many documents hold come last in the order. Each class posts its
    prefix, and a class too few of whose posts another class has is done.
3.  Of the rest, classes that share a posted shingle and whose sizes fit are
    candidates. A short list of postings gives all its pairs. A long one first gives a chain
    and a star, which join a group of near copies in linear work.
4.  Hashed bitmaps, as wide as the band of set sizes asks for, bound each
    pair's overlap from above by bit counts. The rest is decided by
    intersecting the sorted sets: first one pair for each class, then those
    whose ends are still in different components. Pairs that share a class
    meet at it, so a set travels once for a star of pairs.
5.  Long lists whose members did not all end up in one component are gathered
    by the component that most of their members are in, so that a pair meets
    once and not for each shingle that it shares. Each gathering is compared
    tile by tile within bands of set sizes, members of different components only. So no link between
    components is lost, and a group of n near copies costs no n**2 pairs.

Components come from joins; links and documents never meet on the driver.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.shared import LOWER, NOT_SPACE, connected, flat, free_name, materialize, mix, pieces, release, tidy, word_bounds, word_hashes

#: From flat texts and their offsets to sorted sets of 64-bit numbers in one array, and each text's offsets in it.
Sets = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
WORDS = 5
SHORT_LIST = 12
#: Shingles by which prefixes are longer than needed for one common shingle, in percent of the set.
LEAD_PERCENT = 8
#: Shingles of a task that are counted together, and how often one must occur there to be reported.
RUN, OFTEN = 1 << 20, 4
#: Share of documents from which a shingle counts as frequent. At most mean set size / COMMON are.
COMMON = 0.001
LIST_ROWS = 1 << 16
#: Documents with one shingle from which several tasks share its list.
HOT_ROWS = 1 << 13
#: Members that one part of a star compares with its hub.
STAR = 256
#: Numbers that stand for several sets and are known to all tasks; among 10**11 sets some 300 are expected.
CLASHES = 1 << 20
#: Passes over the texts in which shingles are posted; more take less disk at a time and more work.
PASSES = 2
TILE, TILE_SHINGLES = 4096, 4_000_000
FILTER_BITS = 23
#: Bits of a bitmap for each shingle: enough that hardly any differing shingle hides behind another's bit.
BITS_EACH = 8
#: The same for the maps that travel with candidate pairs, of which most differ widely.
BITS_OF_PAIRS = 2
REMEMBERED = 200_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingle hashes of all texts in one array, and each text's offsets in it.

    A text of fewer than ``k`` words has one shingle, all its words; a text
    without words has none.
    """
    n = len(offsets) - 1
    low = LOWER[data]
    starts, ends, owner = word_bounds(low, offsets, NOT_SPACE)
    h = word_hashes(low, starts, ends)
    counts = np.bincount(owner, minlength=n)
    first = np.append(0, np.cumsum(counts))
    sets = np.zeros(0, np.uint64)
    of = np.zeros(0, np.int64)
    if len(h) >= k:
        sets = np.full(len(h) - k + 1, k, np.uint64)
        for i in range(k):
            sets = sets * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i]
        whole = owner[: len(sets)] == owner[k - 1 :]
        sets, of = mix(sets[whole]), owner[: len(sets)][whole]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        one = counts[short].astype(np.uint64)
        for i in range(k - 1):
            has = counts[short] > i
            word = h[np.minimum(first[short] + i, len(h) - 1)]
            one = np.where(has, one * np.uint64(0x9E3779B97F4A7C15) + word, one)
        sets, of = np.concatenate([sets, mix(one)]), np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        sets, of = sets[order], of[order]
    at = np.append(0, np.cumsum(np.bincount(of, minlength=n)))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        sets[a:b].sort()
    if len(sets):
        keep = np.append(True, (sets[1:] != sets[:-1]) | (of[1:] != of[:-1]))
        sets, of = sets[keep], of[keep]
    return sets, np.append(0, np.cumsum(np.bincount(of, minlength=n)))


def _digests(sets: np.ndarray, at: np.ndarray, seed: int = 0) -> np.ndarray:
    """One number for each set; equal sets, equal numbers."""
    salt = mix(np.array([seed + 1], np.uint64) * np.uint64(0x5851F42D4C957F2D))
    sums = np.append(np.uint64(0), np.cumsum(mix(sets ^ salt), dtype=np.uint64))
    return mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)).view(np.int64)


def _first_pass(seed: int, sets_of: Sets):
    """(kind, a, b, n, d, row): 0 with key, class, size, second digest and tag of a text;
    1 with a shingle and its count in a run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        names = ["kind", "a", "b", "n", "d", "row"]

        def frequent() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= OFTEN
            values, counts = values[often].view(np.int64), counts[often]
            none = pa.nulls(len(values), pa.int64())
            return pa.record_batch([pa.array(np.ones(len(values), np.int32)), none, pa.array(values), pa.array(counts.astype(np.int64)), none, none], names=names)

        for batch in batches:
            for piece in pieces(batch, "text"):
                sets, at = sets_of(*flat(piece.column(1)))
                n = np.diff(at)
                yield pa.record_batch([pa.array(np.zeros(len(n), np.int32)), piece.column(0), pa.array(_digests(sets, at, seed)), pa.array(n.astype(np.int64)), pa.array(_digests(sets, at, ~seed & 0xFFFF)), piece.column(2)], names=names)
                held.append(sets)
                if sum(map(len, held)) >= RUN:
                    yield frequent()
                    held = []
        if held:
            yield frequent()

    return run


class _Seen:
    """Classes that a task has met of late."""

    def __init__(self) -> None:
        self.new: set[int] = set()
        self.old: set[int] = set()

    def add(self, c: int) -> bool:
        if c in self.new or c in self.old:
            return False
        self.new.add(c)
        if len(self.new) > REMEMBERED:
            self.old, self.new = self.new, set()
        return True


def lead(n: int) -> int:
    """Shingles that the prefixes of two similar sets, the smaller one of size n, have in common at least."""
    return 1 + n * LEAD_PERCENT // 100


def _prefixes(sets: np.ndarray, at: np.ndarray, heavy: np.ndarray, num: int, den: int) -> list[np.ndarray]:
    """The prefix of each set in the order: other shingles before frequent ones, then by hash."""
    if len(heavy):
        where = np.searchsorted(heavy, sets)
        where[where == len(heavy)] = 0
        late = heavy[where] == sets
    else:
        late = np.zeros(len(sets), bool)
    count = np.append(0, np.cumsum(late))
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        n = b - a
        size = n - -(-n * num // den) + lead(n) if n else 0
        if count[a] == count[b]:
            out.append(sets[a : a + size])
        else:
            own, flag = sets[a:b], late[a:b]
            out.append(np.concatenate([own[~flag][:size], own[flag][: max(0, size - int((~flag).sum()))]]))
    return out


def bitmap_words(n: int, bits: int = BITS_EACH) -> int:
    """Width of the bitmaps of a band of set sizes, in 64-bit words."""
    return 1 << max(0, min(10, (bits * n // 64).bit_length()))


def bitmap(own: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(words, np.uint64)
    bit = mix(own) & np.uint64(64 * words - 1)
    np.bitwise_or.at(out, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out


def narrower(maps: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps folded to fewer words; the hash bits nest, so folding equals building them narrow."""
    while maps.shape[1] > words:
        half = maps.shape[1] // 2
        maps = maps[:, :half] | maps[:, half:]
    return maps


def _by_list(work, divided: np.ndarray):
    """Calls work(h, n, c, torn) with whole lists of rows sorted by h, n, c.

    ``torn`` marks the shingles whose lists come in parts: very long ones, and
    those that several tasks share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: tuple[np.ndarray, ...] | None = None
        torn = divided
        for batch in batches:
            new = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if rest is not None:
                new = tuple(np.concatenate(z) for z in zip(rest, new, strict=True))
            if not len(new[0]):
                continue
            # the last list may go on in the next batch
            cut = int(np.searchsorted(new[0], new[0][-1]))
            if len(new[0]) - cut > LIST_ROWS:
                cut, torn = len(new[0]), np.union1d(torn, new[0][-1:])
            if cut:
                yield from work(*(z[:cut] for z in new), torn)
            rest = tuple(z[cut:] for z in new)
        if rest is not None and len(rest[0]):
            yield from work(*rest, torn)

    return run


def _distinct(h: np.ndarray, n: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
    """Without the copies of a row that come from tasks that met the same class."""
    keep = np.append(True, (h[1:] != h[:-1]) | (c[1:] != c[:-1]))
    return h[keep], n[keep], c[keep]


def _repeated(h: np.ndarray, n: np.ndarray, c: np.ndarray, torn: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The posts of shingles that two classes or more have posted."""
    h, n, c = _distinct(h, n, c)
    same = h[1:] == h[:-1]
    keep = np.append(same, False) | np.append(False, same)
    keep |= np.isin(h, torn)
    yield pa.record_batch([pa.array(h[keep]), pa.array(n[keep]), pa.array(c[keep])], names=["h", "n", "c"])


def _pairs_of_lists(num: int, den: int, divided: np.ndarray):
    """Candidates of sorted posting lists: see step 3. Also long lists, for step 5."""

    def fits(small: np.ndarray, large: np.ndarray) -> np.ndarray:
        return small * den >= large * num

    told: set[int] = set()

    def work(h: np.ndarray, n: np.ndarray, c: np.ndarray, torn: np.ndarray) -> Iterator[pa.RecordBatch]:
        h, n, c = _distinct(h, n, c)
        starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        sizes = np.diff(np.append(starts, len(h)))
        a, b = [], []
        parted = np.isin(h[starts], torn)
        long = (sizes > SHORT_LIST) | parted
        short = ~np.repeat(long, sizes)
        for step in range(1, SHORT_LIST):
            at = np.flatnonzero((h[step:] == h[:-step]) & short[step:]) if len(h) > step else np.zeros(0, np.int64)
            at = at[fits(n[at], n[at + step])]
            a.append(c[at])
            b.append(c[at + step])
        lists = []
        for s, size, part in zip(starts[long].tolist(), sizes[long].tolist(), parted[long].tolist(), strict=True):
            own, count = c[s : s + size], n[s : s + size]
            digest = hash(np.sort(own).tobytes())
            if digest in told and not part:
                continue
            told.add(digest)
            if len(told) > REMEMBERED:
                told.clear()
            lists.append(slice(s, s + size))
            # a star around each band's first member, and a chain
            hub, i = [], 0
            while i < size:
                j = max(i + 1, int(np.searchsorted(count * num, count[i] * den, side="right")))
                hub.append((i, j))
                i = j
            for i, j in hub:
                a.append(np.repeat(own[i], j - i - 1))
                b.append(own[i + 1 : j])
            near = np.flatnonzero(fits(count[:-1], count[1:]))
            a.append(own[near])
            b.append(own[near + 1])
        x, y = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (a, b))
        both = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0) if len(x) else np.zeros((0, 2), np.int64)
        both = both[both[:, 0] != both[:, 1]]
        yield pa.record_batch([pa.nulls(len(both), pa.int64()), pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1]))], names=["h", "a", "b"])
        for part in lists:
            yield pa.record_batch([pa.array(h[part]), pa.array(c[part]), pa.array(n[part])], names=["h", "a", "b"])

    return _by_list(work, divided)


def _bound(num: int, den: int):
    """Keeps the pairs whose bit counts allow the threshold. Rows: a, b, na, ma, nb, mb."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, na, nb = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 4))
            ma, mb = batch.column(3).to_pylist(), batch.column(5).to_pylist()
            keep = np.zeros(len(a), bool)
            words = np.array([min(len(x), len(y)) // 8 for x, y in zip(ma, mb, strict=True)])
            for w in np.unique(words):
                at = np.flatnonzero(words == w)
                left = np.concatenate([narrower(np.frombuffer(ma[k], np.uint64)[None], w) for k in at])
                right = np.concatenate([narrower(np.frombuffer(mb[k], np.uint64)[None], w) for k in at])
                keep[at] = _possible(na[at], left, nb[at], right, num, den)
            yield pa.record_batch([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    return run


def _possible(na: np.ndarray, ma: np.ndarray, nb: np.ndarray, mb: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether the overlap's upper bound reaches the threshold.

    Each bit that only one map has stands for a shingle that the other set lacks.
    """
    most = np.minimum(na - np.bitwise_count(ma & ~mb).sum(axis=-1, dtype=np.int64), nb - np.bitwise_count(mb & ~ma).sum(axis=-1, dtype=np.int64))
    return den * most >= num * (na + nb - most)


def _linked(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """Whether two sorted sets intersect enough."""
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return den * common >= num * (len(x) + len(y) - common)


def _exact(num: int, den: int):
    """Keeps the pairs whose sets intersect enough.

    Rows, sorted by hub, part and role: hub, part, role, c, s. The hub's own row has role 0 and comes first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, None
        for batch in batches:
            a, b = [], []
            for x, role, c, s in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), batch.column(4), strict=True):
                if role == 0:
                    hub, own = x, np.frombuffer(s.as_buffer(), np.uint64).copy()
                elif x == hub and _linked(own, np.frombuffer(s.as_buffer(), np.uint64), num, den):
                    a.append(x)
                    b.append(c)
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _stars(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) as (hub, part, c): the class in more pairs is the hub, divided into parts of about STAR."""
    ends = pairs.select("a").union(pairs.select("b")).groupBy("a").agg(F.count("*").alias("d"))
    d = pairs.join(ends, "a").join(ends.toDF("b", "e"), "b")
    left = (F.col("d") > F.col("e")) | ((F.col("d") == F.col("e")) & (F.col("a") < F.col("b")))
    most = F.ceil(F.greatest("d", "e") / STAR)
    c = F.when(left, F.col("b")).otherwise(F.col("a"))
    return d.select(F.when(left, F.col("a")).otherwise(F.col("b")).alias("hub"), F.pmod(F.xxhash64(c), most).cast("int").alias("part"), c.alias("c"))


def _best(pairs: DataFrame) -> DataFrame:
    """For each class the pair with the most wanted other class: a forest, of fewer pairs than classes."""
    ends = pairs.select("a").union(pairs.select("b")).groupBy("a").agg(F.count("*").alias("d"))
    d = pairs.join(ends, "a").join(ends.toDF("b", "e"), "b")
    both = d.select("a", F.struct("e", "b").alias("o")).union(d.select("b", F.struct("d", "a").alias("o")))
    best = both.groupBy("a").agg(F.max("o").alias("o")).select("a", F.expr("o.b").alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _tiles(num: int, den: int):
    """Candidates of different components in tiles of gathered lists.

    Rows, sorted by group and tile pair: g, x, y, p, q, side, n, c, root, m.
    Rows of side 0 meet those of side 1, or one another where all have side 0.
    """

    def compare(group: list[tuple]) -> Iterator[pa.RecordBatch]:
        group.sort(key=lambda r: r[6])
        side, n, c, root = (np.array([r[i] for r in group], np.int64) for i in (5, 6, 7, 8))
        two = group[0][1] != group[0][2] or group[0][3] != group[0][4]
        # blocks hold bitmaps of one width, which grows with the set sizes
        wide = np.array([len(r[9]) // 8 for r in group])
        cuts = np.flatnonzero(np.append(True, wide[1:] != wide[:-1])).tolist()
        blocks = [(i, min(i + 512, z)) for s, z in zip(cuts, [*cuts[1:], len(group)], strict=True) for i in range(s, z, 512)]
        maps = [np.concatenate([np.frombuffer(r[9], np.uint64)[None] for r in group[i:z]]) for i, z in blocks]
        for k, (i, last) in enumerate(blocks):
            w = int(wide[i])
            to = int(np.searchsorted(n * num, n[last - 1] * den, side="right"))
            for other, (j, end) in zip(maps[k:], blocks[k:], strict=True):
                if j >= to:
                    break
                wanted = root[i:last, None] != root[None, j:end]
                wanted &= np.arange(i, last)[:, None] < np.arange(j, end)[None]
                wanted &= n[i:last, None] * den >= n[None, j:end] * num
                if two:
                    wanted &= side[i:last, None] != side[None, j:end]
                x, y = np.nonzero(wanted)
                if not len(x):
                    continue
                right = narrower(other, w)
                step = max(1, (1 << 21) // w)
                for s in range(0, len(x), step):
                    xs, ys = x[s : s + step], y[s : s + step]
                    ok = _possible(n[i + xs], maps[k][xs], n[j + ys], right[ys], num, den)
                    a, b = c[i + xs[ok]], c[j + ys[ok]]
                    yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if group and group[0][:5] != row[:5]:
                    yield from compare(group)
                    group = []
                group.append(row)
        if group:
            yield from compare(group)

    return run


def _tiled(gathered: DataFrame, num: int, den: int) -> DataFrame:
    """Rows g, n, c, root of gathered lists, dealt to tile pairs for ``_tiles``.

    A group within one tile stays whole. A larger one is cut into bands of set
    sizes, as wide as similar sizes can differ, and each band into tiles; a
    tile meets those of its own band and of the next.
    """
    whole = gathered.groupBy("g").agg(F.ceil(F.greatest(F.count("*") / TILE, F.sum("n") / TILE_SHINGLES)).cast("int").alias("k"))
    rows = gathered.join(whole, "g")
    one = rows.where("k = 1").select("g", *[F.lit(0).alias(z) for z in ("x", "y", "p", "q", "side")], "n", "c", "root")
    # sizes of similar sets are in one band or in neighbours; the margin covers rounding
    band = F.floor(F.log("n") / float(np.log(den / num) * (1 + 1e-9))).cast("int")
    many = rows.where("k > 1").drop("k").withColumn("x", band)
    tiles = many.groupBy("g", "x").agg(F.ceil(F.greatest(F.count("*") / TILE, F.sum("n") / TILE_SHINGLES)).cast("int").alias("k"))
    many = many.join(tiles, ["g", "x"]).withColumn("t", F.pmod(F.xxhash64("c"), F.col("k")).cast("int"))
    for step, name in ((1, "after"), (-1, "before")):
        many = many.join(tiles.select("g", (F.col("x") - step).alias("x"), F.col("k").alias(name)), ["g", "x"], "left")
    own = many.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    own = own.select("g", "x", F.col("x").alias("y"), F.least("t", "o").alias("p"), F.greatest("t", "o").alias("q"), (F.col("t") > F.col("o")).cast("int").alias("side"), "n", "c", "root")
    up = many.where("after is not null").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("after") - 1)))
    up = up.select("g", "x", (F.col("x") + 1).alias("y"), F.col("t").alias("p"), F.col("o").alias("q"), F.lit(0).alias("side"), "n", "c", "root")
    down = many.where("before is not null").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("before") - 1)))
    down = down.select("g", (F.col("x") - 1).alias("x"), F.col("x").alias("y"), F.col("o").alias("p"), F.col("t").alias("q"), F.lit(1).alias("side"), "n", "c", "root")
    return one.union(own).union(up).union(down)


def _classes(docs: DataFrame, text: str, key: str, num: int, den: int, same_key: bool, sets_of: Sets) -> tuple[DataFrame, DataFrame]:
    """(key, class, n, row) of every row, row a hash of its text; and (class, component_id, first)
    with the least key of the class's component and the least (key, row) of it.

    ``same_key`` links the classes of rows that share a key.
    """
    spark = docs.sparkSession
    early: list[str] = []
    scratch: list[str] = []
    source = docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("row"))
    for seed in itertools.count():
        first = materialize(source.mapInArrow(_first_pass(seed, sets_of), "kind int, a long, b long, n long, d long, row long"))
        rows = first.where("kind = 0").select(F.col("a").alias("key"), F.col("b").alias("class"), "n", "d", "row")
        shared_names = rows.groupBy("class").agg((F.min("d") != F.max("d")).alias("clash")).where("clash").select("class")
        clashing = shared_names.limit(CLASHES + 1).toArrow().column(0).to_numpy()
        if not len(clashing):
            break
        # sets with one number go by their second digest; other numbers are drawn only if that clashes as well
        several = F.broadcast(spark.createDataFrame(pa.table({"class": clashing})).withColumn("several", F.lit(True)))
        both = rows.join(several, "class", "left").withColumn("name", F.when(F.col("several"), F.col("d")).otherwise(F.col("class")))
        twice = both.groupBy("name").agg(((F.min("d") != F.max("d")) | (F.min("class") != F.max("class"))).alias("clash")).where("clash").limit(1)
        if len(clashing) <= CLASHES and not twice.count():
            rows = both.select("key", F.col("name").alias("class"), "n", "d", "row")
            break

    def names(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The class of each set: its first digest, or its second where different sets share the first."""
        classes = _digests(sets, at, seed)
        hit = np.isin(classes, clashing)
        if hit.any():
            classes[hit] = _digests(sets, at, ~seed & 0xFFFF)[hit]
        return classes

    total = rows.count()
    frequent = first.where("kind = 1").groupBy("b").agg(F.sum("n").alias("n")).where(F.col("n") >= max(50, COMMON * total)).toArrow()
    common, count = (frequent.column(i).to_numpy() for i in (0, 1))
    heavy = spark.sparkContext.broadcast(np.sort(common.view(np.uint64)))
    # lists of very common shingles are shared by several tasks
    order = np.argsort(common[count > HOT_ROWS])
    hot, shares = common[count > HOT_ROWS][order], -(-count[count > HOT_ROWS][order] // HOT_ROWS)

    def part(h: np.ndarray, c: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), np.int32)
        if len(hot) and len(h):
            where = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
            at = np.flatnonzero(hot[where] == h)
            out[at] = (mix(c[at].view(np.uint64)) % shares[where[at]].astype(np.uint64)).astype(np.int32)
        return out

    def post(share: int):
        """The posts of the shingles whose hash falls to one of PASSES shares."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = _Seen()
            for batch in batches:
                for piece in pieces(batch, "text"):
                    sets, at = sets_of(*flat(piece.column(0)))
                    classes, n = names(sets, at), np.diff(at)
                    new = [k for k, c in enumerate(classes.tolist()) if n[k] and seen.add(c)]
                    lead = _prefixes(sets, at, heavy.value, num, den)
                    sizes = [len(lead[k]) for k in new]
                    h = np.concatenate([lead[k] for k in new]) if new else np.zeros(0, np.uint64)
                    mine = h % np.uint64(PASSES) == share
                    h, c, size = h[mine].view(np.int64), np.repeat(classes[new], sizes)[mine], np.repeat(n[new], sizes)[mine]
                    yield pa.record_batch([pa.array(h), pa.array(size.astype(np.int64)), pa.array(c), pa.array(part(h, c))], names=["h", "n", "c", "p"])

        return run

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, n, c = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            yield pa.record_batch([*batch.columns[:3], pa.array(part(h, c))], names=["h", "n", "c", "p"])

    def by_shingle(some: DataFrame) -> DataFrame:
        return some.repartition("h", "p").drop("p").sortWithinPartitions("h", "n", "c")

    keyed = source.where("key is not null").select("text")
    posted = []
    for share in range(PASSES):
        # each pass reads the texts again, so that the shuffle of one is gone before the next
        posted.append(materialize(by_shingle(keyed.mapInArrow(post(share), "h long, n long, c long, p int")).mapInArrow(_by_list(_repeated, hot), "h long, n long, c long"), early))
        tidy(spark)
    posts = reduce(DataFrame.union, posted)
    least_size = F.ceil(F.col("n") * num / den)
    shared = F.count("*").over(Window.partitionBy("c"))
    lively = posts.withColumn("shared", shared).where(F.col("shared") >= 1 + F.floor(least_size * LEAD_PERCENT / 100))
    listed = lively.select("h", "n", "c").mapInArrow(again, "h long, n long, c long, p int")
    candidates = materialize(by_shingle(listed).mapInArrow(_pairs_of_lists(num, den, hot), "h long, a long, b long"), scratch)
    pairs = materialize(candidates.where("h is null").select("a", "b").distinct(), scratch)
    release(spark, early)
    del lively, listed
    tidy(spark)
    lists = candidates.where("h is not null").select("h", F.col("a").alias("c"), F.col("b").alias("n"))
    wanted = pairs.select("a").union(pairs.select("b")).union(lists.select("c")).distinct()
    maybe = spark.sparkContext.broadcast(_filter(wanted))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in batches:
            for piece in pieces(batch, "text"):
                sets, at = sets_of(*flat(piece.column(0)))
                classes = names(sets, at)
                hit = _in_filter(maybe.value, classes)
                some = [k for k, c in enumerate(classes.tolist()) if hit[k] and at[k + 1] > at[k] and seen.add(c)]
                own = [sets[at[k] : at[k + 1]] for k in some]
                yield pa.record_batch([pa.array(classes[some]), pa.array([x.tobytes() for x in own], pa.binary())], names=["c", "s"])

    described = materialize(keyed.mapInArrow(describe, "c long, s binary").groupBy("c").agg(F.first("s").alias("s")), scratch)
    tidy(spark)

    def mapped(bits: int) -> DataFrame:
        """(c, n, m): the bitmaps of the described sets."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch, "s"):
                    own = [np.frombuffer(x.as_buffer(), np.uint64) for x in piece.column(1)]
                    yield pa.record_batch([piece.column(0), pa.array([len(x) for x in own], pa.int64()), pa.array([bitmap(x, bitmap_words(len(x), bits)).tobytes() for x in own], pa.binary())], names=["c", "n", "m"])

        return described.mapInArrow(run, "c long, n long, m binary")

    def bounded(some: DataFrame, bits: int) -> DataFrame:
        maps = mapped(bits)
        x = some.join(maps.toDF("a", "na", "va"), "a").join(maps.toDF("b", "nb", "vb"), "b").select("a", "b", "na", "va", "nb", "vb")
        kept = materialize(x.mapInArrow(_bound(num, den), "a long, b long"), scratch)
        del x
        tidy(spark)
        return kept

    def verified(left: DataFrame) -> DataFrame:
        star = materialize(_stars(left), scratch)
        both = star.select("hub", "part", F.lit(1).alias("role"), "c").union(star.select("hub", "part", F.lit(0).alias("role"), F.col("hub").alias("c")).distinct())
        y = both.join(described.select("c", "s"), "c").select("hub", "part", "role", "c", "s")
        found = materialize(y.repartition("hub", "part").sortWithinPartitions("hub", "part", "role").mapInArrow(_exact(num, den), "a long, b long"), scratch)
        del both, y
        tidy(spark)
        return found

    def between(some: DataFrame, links: DataFrame) -> DataFrame:
        """The pairs whose ends ``links`` leave in different components."""
        roots = materialize(connected(links), scratch)
        x = some.join(roots.toDF("a", "ra"), "a", "left").join(roots.toDF("b", "rb"), "b", "left")
        return x.where("coalesce(ra, a) <> coalesce(rb, b)").select("a", "b")

    def settled(some: DataFrame, links: DataFrame | None) -> DataFrame:
        """``links`` and enough links among ``some`` pairs to have the components of them all."""
        best = materialize(_best(some), scratch)
        found = verified(best)
        links = found if links is None else links.union(found)
        rest = between(some.join(best, ["a", "b"], "left_anti"), links)
        return links.union(verified(bounded(rest, BITS_EACH)))

    links = settled(bounded(pairs, BITS_OF_PAIRS), None)
    if lists.limit(1).count():
        roots = materialize(connected(links), scratch)
        member = lists.join(roots, lists.c == roots.node, "left").select("h", "c", "n", F.coalesce("root", "c").alias("root"))
        # lists of one component are done; the others go by the component that most of their members are in
        share = member.groupBy("h", "root").agg(F.count("*").alias("n"))
        mixed = share.groupBy("h").agg(F.max_by("root", F.struct("n", "root")).alias("g"), F.count("*").alias("roots")).where("roots > 1").select("h", "g")
        gathered = materialize(member.join(mixed, "h").select("g", "c", "n", "root").distinct(), scratch)
        dealt = _tiled(gathered, num, den).join(mapped(BITS_EACH).select("c", "m"), "c").select("g", "x", "y", "p", "q", "side", "n", "c", "root", "m")
        tiles = dealt.repartition("g", "x", "y", "p", "q").sortWithinPartitions("g", "x", "y", "p", "q")
        more = materialize(tiles.mapInArrow(_tiles(num, den), "a long, b long").distinct(), scratch)
        links = settled(more, links)
    if same_key:
        twice = rows.where("n > 0").groupBy("key").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a <> b")
        links = links.union(rows.join(twice.select("key", "a"), "key").where("n > 0").select("a", F.col("class").alias("b")))
    roots = connected(links)
    least = rows.where("n > 0 and key is not null").groupBy("class").agg(F.min(F.struct("key", "row")).alias("first"))
    by_class = least.join(roots, least["class"] == roots.node, "left").select("class", F.coalesce("root", "class").alias("root"), "first")
    by_root = by_class.groupBy("root").agg(F.min("first").alias("first"))
    final = materialize(by_class.select("class", "root").join(by_root, "root").select("class", F.col("first.key").alias("component_id"), "first"))
    release(spark, scratch)
    return rows.select("key", "class", "n", "row"), final


def components(docs: DataFrame, text: str = "text", key: str = "doc_id", num: int = 75, den: int = 100, sets_of: Sets = shingle_sets) -> DataFrame:
    """(key, n_shingles, component_id) of every row.

    ``sets_of`` turns flat texts into their sets; shingles of words unless it
    is given. Rows are linked if num / den or more of their shingles are common to both;
    component_id is the least key reachable by links. A text without words has
    no shingles and stands alone. Keys are whole numbers; rows that share a
    key are one node. Rows with a null key keep a null component and link to
    nothing. Repeated rows give a row each.
    """
    rows, final = _classes(docs, text, key, num, den, True, sets_of)
    out = rows.join(final.select("class", "component_id").hint("shuffle_merge"), "class", "left")
    own = F.when(F.col("n") > 0, F.coalesce("component_id", "key")).otherwise(F.col("key"))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("key").isNotNull(), own).alias("component_id"))


def representatives(docs: DataFrame, text: str = "text", key: str = "doc_id", num: int = 75, den: int = 100) -> DataFrame:
    """One row of each component of ``docs``, that of its least key, with all its columns.

    Rows without words or with a null key all stay. Rows that share a key and
    differ in text are judged by their texts: both stay unless these are
    linked. Of rows with one key and one text, one stays.
    """
    rows, final = _classes(docs, text, key, num, den, False, shingle_sets)
    found = rows.where("n > 0 and key is not null").join(final.select("class", "first"), "class")
    gone = found.where(~F.struct("key", "row").eqNullSafe(F.col("first"))).select(F.col("key").alias("__gone"), F.col("row").alias("__row")).distinct()
    kept = docs.join(gone, (docs[key].cast("long") == gone["__gone"]) & (F.xxhash64(docs[text]) == gone["__row"]), "left_anti")
    twice = docs.where(docs[key].isNotNull()).groupBy(docs[key]).agg(F.count("*").alias("rows")).where("rows > 1").limit(1).count()
    if not twice:
        return kept
    own = free_name(docs, "__row")
    tagged = kept.withColumn(own, F.xxhash64(kept[text]))
    one = tagged.where(F.col(key).isNotNull()).dropDuplicates([key, own])
    return one.unionByName(tagged.where(F.col(key).isNull())).drop(own)


def _slots(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix(values.view(np.uint64))
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64), (h & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)


def _filter(classes: DataFrame) -> np.ndarray:
    """A Bloom filter of 2**FILTER_BITS bits, whatever the number of classes.

    A full one lets every class through, which costs work and no result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            for s in _slots(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)):
                bits[s] = True
        words = np.packbits(bits, bitorder="little").view(np.int64)
        some = np.flatnonzero(words)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(words[some])], names=["w", "bits"])

    table = classes.mapInArrow(run, "w int, bits long").groupBy("w").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[table.column("w").to_numpy()] = table.column("bits").to_numpy()
    return out.view(np.uint64)


def _in_filter(words: np.ndarray, classes: np.ndarray) -> np.ndarray:
    hit = np.ones(len(classes), bool)
    for s in _slots(classes):
        hit &= (words[s >> 6] >> (s & 63).astype(np.uint64)) & np.uint64(1) == 1
    return hit
