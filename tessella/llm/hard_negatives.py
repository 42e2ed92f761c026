"""Hard negatives by a dual-tree search.

Anchors and candidates each form a binary tree, split by label first and then
at the median of the widest component. A node knows its centre and radius, so
the inner products of two nodes lie in an interval around that of the centres.
A pair of nodes is dropped, and with it a whole group of anchors, if the
interval lies below everything that its anchors still look for, or beside their
bands of scores, or if the labels rule it out. Pairs of leaves are scored
exactly.

Candidates never move: every task builds trees over the rows it reads, in
chunks, and gives the best few of each anchor. Anchors, the stated query set,
come in blocks of ``BLOCK_BYTES`` at most, each broadcast to all tasks; any
number of blocks gives the same rows. A bounded sample of the candidates, searched
first, gives each anchor a score below which nothing need be looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.shared import materialize

SCALE = 256
#: Scaled components beyond this take its value, so that scores fit 64 bits.
LIMIT = 1 << 26
BLOCK_BYTES = 16 << 20
#: Candidates of one tree, by rows and by bytes; points of a leaf; pairs of nodes looked at together.
CHUNK_ROWS, CHUNK_BYTES = 1 << 14, 32 << 20
ANCHOR_LEAF, LEAF = 128, 1024
PAIRS = 4096
#: Rows of the sample.
SAMPLE = 4096
#: Found rows held before they are cut to the best of each group; beyond that, as many as the last cut left.
HELD = 1 << 13
#: Scores below these bounds are whole numbers in single and in double precision, whatever the order of their sums.
SINGLE, DOUBLE = 1 << 24, 1 << 53
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class Tree:
    """A binary tree over rows, in an order in which every node is a range."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, x: np.ndarray, leaf: int) -> None:
        order = np.argsort(labels, kind="stable")
        labels, points = labels[order], x.astype(np.float64)
        nodes: list[tuple[int, int, int, int]] = []  # start, end, first child (second is next), 0 for a leaf
        nodes.append((0, len(order), 0, 0))
        k = 0
        while k < len(nodes):
            lo, hi, _, _ = nodes[k]
            if hi - lo > leaf:
                part = order[lo:hi]
                if labels[lo] != labels[hi - 1]:
                    middle = labels[(lo + hi) // 2]
                    ends = [lo + int(np.searchsorted(labels[lo:hi], middle, side)) for side in ("left", "right")]
                    cut = min((e for e in ends if lo < e < hi), key=lambda e: abs(2 * e - lo - hi))
                else:
                    cut = (lo + hi) // 2
                    if x.shape[1]:
                        widest = points[part]
                        order[lo:hi] = part[np.argpartition(widest[:, widest.var(axis=0).argmax()], cut - lo)]
                nodes[k] = (lo, hi, len(nodes), 0)
                nodes += [(lo, cut, 0, 0), (cut, hi, 0, 0)]
            k += 1
        table = np.array(nodes)
        self.start, self.end, self.child = table[:, 0], table[:, 1], table[:, 2]
        self.ids, self.rows, self.labels, self.order = ids[order], rows[order], labels, order
        self.x, points = x[order], points[order]
        self.points, self.single = points, points.astype(np.float32)
        self.longest = np.sqrt((points**2).sum(axis=1).max(initial=0))
        self.centre = np.stack([points[lo:hi].mean(axis=0) if hi > lo else np.zeros(x.shape[1]) for lo, hi, _, _ in nodes])
        self.radius = np.array([np.sqrt(((points[lo:hi] - c) ** 2).sum(axis=1).max(initial=0)) for (lo, hi, _, _), c in zip(nodes, self.centre, strict=True)])
        self.norm = np.sqrt((self.centre**2).sum(axis=1))
        self.first_label = np.array([labels[lo] if hi > lo else 0 for lo, hi, _, _ in nodes])
        self.last_label = np.array([labels[hi - 1] if hi > lo else 0 for lo, hi, _, _ in nodes])

    def over_nodes(self, of: np.ufunc, values: np.ndarray) -> np.ndarray:
        """``of`` over the rows of every node; ``values`` has a row for each row of the tree."""
        return np.array([of.reduce(values[lo:hi], axis=None) for lo, hi in zip(self.start, self.end, strict=True)])


def interval(a: Tree, i: np.ndarray, c: Tree, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner products between the rows of nodes i and of nodes j."""
    middle = np.einsum("ij,ij->i", a.centre[i], c.centre[j])
    width = a.radius[i] * c.norm[j] + c.radius[j] * a.norm[i] + a.radius[i] * c.radius[j]
    width += 1 + 1e-9 * (a.norm[i] + a.radius[i]) * (c.norm[j] + c.radius[j])
    return middle - width, middle + width


def exact(a: Tree, s: slice, c: Tree, t: slice) -> np.ndarray:
    """Whole inner products of two ranges of rows, in the narrowest type that holds every partial sum."""
    most = 1.001 * a.longest * c.longest  # no part of a sum exceeds the product of the lengths
    if most < SINGLE:
        return a.single[s] @ c.single[t].T
    if most < DOUBLE:
        return a.points[s] @ c.points[t].T
    return np.einsum("ij,kj->ik", a.x[s], c.x[t])


def _as(bounds: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Bounds that compare with ``score`` as they are; beyond all scores of its type it doesn't matter how far."""
    if score.dtype == np.int64:
        return bounds
    most = SINGLE if score.dtype == np.float32 else DOUBLE
    return np.clip(bounds, -most, most).astype(score.dtype)


class Best:
    """The first ``k`` rows of every group by falling score, then rising id."""

    def __init__(self, floors: np.ndarray, k: int) -> None:
        self.k, self.least = k, floors.copy()  # scores below ``least`` cannot be among the first k
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = self.kept = self.cuts = 0

    def add(self, *columns: np.ndarray) -> None:
        """Group, score, id and row of each find. A cut sorts all that is held, so it waits until as much is new."""
        self.parts.append(columns)
        self.size += len(columns[0])
        if self.size - self.kept > max(HELD, self.kept):
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        none = np.zeros(0, np.int64)
        group, score, ids, rows = (np.concatenate(x) for x in zip(*self.parts, strict=True)) if self.parts else (none,) * 4
        order = np.lexsort((rows, ids, -score, group))
        group, score, ids, rows = group[order], score[order], ids[order], rows[order]
        first = np.append(True, group[1:] != group[:-1])[: len(group)]
        place = np.arange(len(group)) - np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
        last = place == self.k - 1
        self.least[group[last]] = np.maximum(self.least[group[last]], score[last])
        keep = place < self.k
        self.parts = [(group[keep], score[keep], ids[keep], rows[keep])]
        self.size = self.kept = int(keep.sum())
        self.cuts += 1
        return self.parts[0]


def search(a: Tree, c: Tree, best: Best, same: bool, low: np.ndarray, high: np.ndarray) -> int:
    """Put into ``best`` the candidates that each anchor looks for; the number of pairs of leaves that were scored.

    ``low`` and ``high`` (anchor, band), in the order of the tree, bound the
    scores of each band; group anchor * bands + band. ``same`` asks for
    candidates of the anchor's label, other rows than itself; otherwise for
    candidates of other labels.
    """
    scored, cuts = 0, best.cuts
    floors = lambda: np.maximum(low, best.least.reshape(low.shape))
    low_node, high_node = a.over_nodes(np.minimum, floors()), a.over_nodes(np.maximum, high)
    stack = [(np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        i, j = stack.pop()
        if len(i) > PAIRS:
            stack.append((i[PAIRS:], j[PAIRS:]))
            i, j = i[:PAIRS], j[:PAIRS]
        down, up = interval(a, i, c, j)
        keep = (up >= low_node[i]) & (down <= high_node[i])
        if same:
            keep &= (a.first_label[i] <= c.last_label[j]) & (c.first_label[j] <= a.last_label[i])
        else:
            keep &= (a.first_label[i] != a.last_label[i]) | (c.first_label[j] != c.last_label[j]) | (a.first_label[i] != c.first_label[j])
        order = np.flatnonzero(keep)[np.argsort(-up[keep], kind="stable")]
        i, j = i[order], j[order]
        leaves = (a.child[i] == 0) & (c.child[j] == 0)
        bounds = zip(down[order][leaves].tolist(), up[order][leaves].tolist(), strict=True)
        for m, n, within in zip(i[leaves].tolist(), j[leaves].tolist(), bounds, strict=True):
            scored += _leaves(a, m, c, n, within, best, same, low, high)
        if best.cuts > cuts:
            low_node, cuts = a.over_nodes(np.minimum, floors()), best.cuts
        i, j = i[~leaves], j[~leaves]
        if len(i):
            # the side with more rows is divided
            of_c = (c.child[j] > 0) & ((a.child[i] == 0) | (c.end[j] - c.start[j] >= a.end[i] - a.start[i]))
            left, right = a.child[i], c.child[j]
            stack.append((np.concatenate([np.where(of_c, i, left), np.where(of_c, i, left + 1)]), np.concatenate([np.where(of_c, right, j), np.where(of_c, right + 1, j)])))
    return scored


def _leaves(a: Tree, m: int, c: Tree, n: int, within: tuple[float, float], best: Best, same: bool, low: np.ndarray, high: np.ndarray) -> int:
    s, t = slice(a.start[m], a.end[m]), slice(c.start[n], c.end[n])
    floor, ceiling = np.maximum(low[s], best.least.reshape(low.shape)[s]), high[s]
    if not ((floor <= within[1]) & (ceiling >= within[0])).any():
        return 0
    score = exact(a, s, c, t)
    # one look for all bands finds the scores that any of them could take, mostly a few
    near = score >= _as(floor.min(axis=1), score)[:, None]
    if np.count_nonzero(near) > near.size // 16:
        near &= score <= _as(ceiling.max(axis=1), score)[:, None]
    if a.first_label[m] != a.last_label[m] or c.first_label[n] != c.last_label[n] or (a.first_label[m] == c.first_label[n]) != same:
        near &= (a.labels[s, None] == c.labels[None, t]) == same
    x, y = np.divmod(np.flatnonzero(near), near.shape[1])
    value, bands = score[x, y].astype(np.int64), low.shape[1]
    for band in range(bands):
        fits = (value >= floor[x, band]) & (value <= ceiling[x, band])
        if same:
            fits &= a.rows[s][x] != c.rows[t][y]
        if fits.any():
            best.add(*_ahead(best.k, (x[fits] + s.start) * bands + band, value[fits], c.ids[t][y[fits]], c.rows[t][y[fits]]))
    return 1


def _ahead(k: int, group: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Finds of one pair of leaves, of rising groups, without those that k others of their group precede, if they are many."""
    if len(group) > 4 * k * (1 + group[-1] - group[0]):
        order = np.lexsort((rows, ids, -score, group))
        first = np.append(True, group[1:] != group[:-1])
        place = np.arange(len(group)) - np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
        keep = order[place < k]
        return group[keep], score[keep], ids[keep], rows[keep]
    return group, score, ids, rows


def prepared(vectors: DataFrame, relabelled: Column, vector: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """(row, id, label, x) of the rows that take part, components scaled to whole numbers."""
    kind = vectors.schema[vector].dataType.elementType.simpleString()
    infinite = F.lit("Infinity").cast("double")
    finite = F.forall(F.col(vector), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < infinite)) if kind in ("float", "double") else F.forall(F.col(vector), lambda v: v.isNotNull())
    scaled = F.transform(F.col(vector), lambda v: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(F.greatest(F.lit(-2.0 * LIMIT), F.least(F.lit(2.0 * LIMIT), v.cast("double") * SCALE))))).cast("int"))
    kept = vectors.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite)
    return kept.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), relabelled.cast("long").alias("label"), scaled.alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column; short ones are filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(column.value_lengths(), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    window = Window.partitionBy(*by).orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _searched(candidates: DataFrame, width: int, anchors, low: np.ndarray, high: np.ndarray, floors: np.ndarray, k: int, same: bool) -> DataFrame:
    """(g, score, id, row): the first k candidates of every group, over all tasks."""
    shared = candidates.sparkSession.sparkContext.broadcast((anchors, low, high, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, low, high, floors = shared.value
        a = Tree(*columns, ANCHOR_LEAF)
        bands = low.shape[1]
        groups = (a.order[:, None] * bands + np.arange(bands)).ravel()  # of the tree's order
        best = Best(floors[groups], k)
        low, high = low[a.order], high[a.order]
        held: list[pa.RecordBatch] = []
        rows = 0
        most = max(1, min(CHUNK_ROWS, CHUNK_BYTES // (16 * max(1, width))))

        def look() -> None:
            table = pa.Table.from_batches(held)
            ids = [table.column(n).to_numpy() for n in (1, 0, 2)]
            search(a, Tree(*ids, _matrix(table.column(3), width), LEAF), best, same, low, high)

        for batch in batches:
            for lo in range(0, batch.num_rows, most):
                part = batch.slice(lo, most)
                if rows and rows + part.num_rows > most:
                    look()
                    held, rows = [], 0
                held.append(part)
                rows += part.num_rows
        if rows:
            look()
        group, score, ids, row = best.cut()
        yield pa.record_batch([pa.array(x) for x in (groups[group] if len(group) else group, score, ids, row)], names=["g", "score", "id", "row"])

    return _first(candidates.mapInArrow(run, "g long, score long, id long, row long"), ["g"], k)


def _floors(candidates: DataFrame, share: float, groups: int, k: int, *args) -> np.ndarray:
    """For each group, the k-th score among a sample: a lower bound of the k-th among all."""
    sample = candidates.where(F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < int(share * (1 << 20)))
    out = np.full(groups, LEAST)
    if share < 1:
        got = _searched(sample, *args).where(F.col("rank") == k).toArrow()
        out[got.column("g").to_numpy()] = got.column("score").to_numpy()
    return out


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` (row, id, label, x) come from ``prepared``. A score is the inner
    product of two rows' whole numbers; higher scores come first, then lesser
    ids. An anchor's positives are its first other rows of its label; for each,
    the first ``negatives`` rows of other labels whose hundredfold score lies
    between ``low`` and ``high`` times the positive's. A negative positive
    score leaves no such row; a positive score of zero takes scores of zero.

    Rows with a null id, label or vector, or with a component that is null or
    not finite, take no part; scaled components beyond LIMIT take its value. Vectors that are shorter than the longest count as
    filled with zeros. Rows that share an id are rows of their own, so
    repeated anchors give their rows again.
    """
    spark = rows.sparkSession
    rows = materialize(rows)
    seen = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width"), F.count(F.when(is_anchor, 1)).alias("anchors")).first()
    width, share = max(1, seen.width or 0), min(1.0, SAMPLE / max(1, seen.n))
    blocks = max(1, -(-seen.anchors * width * 16 // BLOCK_BYTES))
    chosen = rows.where(is_anchor).withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    found = []
    for block in range(blocks):
        table = chosen.where(F.col("block") == block).toArrow()
        n = table.num_rows
        if not n:
            continue
        ids, row, labels = (table.column(c).to_numpy() for c in ("id", "row", "label"))
        anchors = (ids, row, labels, _matrix(table.column("x"), width))
        every = (np.full((n, 1), LEAST), np.full((n, 1), MOST))
        floors = _floors(rows, share, n, positives, width, anchors, *every, np.full(n, LEAST), positives, True)
        near = _searched(rows, width, anchors, *every, floors, positives, True).toArrow()
        g, place = near.column("g").to_numpy(), near.column("rank").to_numpy() - 1
        score, of = np.zeros((n, positives), np.int64), np.zeros((n, positives), np.int64)
        has = np.zeros((n, positives), bool)
        score[g, place], of[g, place], has[g, place] = near.column("score").to_numpy(), near.column("id").to_numpy(), True
        bottom = np.where(has, -(-low * score // 100), MOST)
        top = np.where(has, high * score // 100, LEAST)
        groups = n * positives
        floors = _floors(rows, share, groups, negatives, width, anchors, bottom, top, np.full(groups, LEAST), negatives, False)
        far = _searched(rows, width, anchors, bottom, top, floors, negatives, False)
        names = pa.table({"g": np.arange(groups), "anchor_id": np.repeat(ids, positives), "positive_id": of.ravel(), "positive_score": score.ravel()})
        found.append(materialize(far.join(spark.createDataFrame(names), "g").select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))))
    if not found:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return reduce(DataFrame.union, found)
