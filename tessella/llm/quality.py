"""A quality classifier on document statistics.

Random Fourier features approximate a Gaussian kernel over standardised
statistics of a text. Tasks sum the normal equations of their labelled rows;
the driver adds the sums, whose size is the number of features squared, and
solves for ridge scores. Isotonic regression over a fixed number of score
bins turns them into probabilities.

The texts are read once: statistics of all documents are written as a table,
and fitting and scoring read that.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.shared import LOWER, NOT_SPACE, PrefixHash, flat, materialize, pieces, word_bounds

FEATURES = 320
RIDGE = 0.01
WIDTH = 12.0
BINS = 4096
#: Labelled rows that the fit uses at most; beyond it, a share by hash of the key.
MAX_FIT_ROWS = 400_000
FIT_TASKS = 16


def _class(*codes: int | range) -> np.ndarray:
    table = np.zeros(256, bool)
    for c in codes:
        table[c if isinstance(c, int) else np.array(c)] = True
    return table


UPPER, LOW, DIGIT = _class(range(65, 91)), _class(range(97, 123)), _class(range(48, 58))
CLASSES = {
    "upper": UPPER,
    "lower": LOW,
    "digit": DIGIT,
    "space": _class(32),
    "line": _class(10),
    "high": _class(range(128, 256)),
    "stop": _class(46, 63),
    "bang": _class(33),
    "comma": _class(44, 59, 58),
    "bar": _class(124),
    "symbol": _class(35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 92, 94, 95, 96, 126),
    "bracket": _class(40, 41, 91, 93, 123, 125, 34, 39),
    "control": _class(range(9), range(11, 32), 127),
}
NAMES = ["log_bytes", "log_words", *CLASSES, "word_mean", "word_dev", "word_max", "distinct_words", "distinct_pairs", "top_word", "distinct_lines", "line_mean", "short_line", "upper_words", "plain_words", "upper_share"]


def _per_text(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=n)


def _distinct(h: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of different hashes of each text, and the count of its commonest one."""
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))) if len(h) else np.zeros(0, np.int64)
    runs = np.diff(np.append(first, len(h)))
    top = np.zeros(n)
    np.maximum.at(top, owner[first], runs)
    return np.bincount(owner[first], minlength=n), top


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """An array (text, statistic) for flat UTF-8 bytes; an empty text has zeros."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    whole = np.maximum(size, 1)
    shares = {}
    for name, table in CLASSES.items():
        sums = np.append(0, np.cumsum(table[data], dtype=np.int64))
        shares[name] = (sums[offsets[1:]] - sums[offsets[:-1]]) / whole
    hashes = PrefixHash(LOWER[data])
    starts, ends, owner = word_bounds(data, offsets, NOT_SPACE)
    words = np.bincount(owner, minlength=n).astype(float)
    some = np.maximum(words, 1)
    length = (ends - starts).astype(float)
    mean = _per_text(length, owner, n) / some
    dev = np.sqrt(np.maximum(0, _per_text(length**2, owner, n) / some - mean**2))
    longest = np.zeros(n)
    np.maximum.at(longest, owner, length)
    h = hashes.of(starts, ends)
    distinct, top = _distinct(h, owner, n)
    same = owner[1:] == owner[:-1]
    pairs, _ = _distinct((h[:-1] * np.uint64(3) + h[1:])[same], owner[1:][same], n)
    upper = np.append(0, np.cumsum(UPPER[data], dtype=np.int64))
    low = np.append(0, np.cumsum((LOW | CLASSES["high"])[data], dtype=np.int64))
    ups = upper[ends] - upper[starts]
    plain = low[ends] - low[starts] + ups
    shout = (ups >= 2) & (ups * 2 > length)
    line_start, line_end, line_owner = word_bounds(data, offsets, ~CLASSES["line"])
    lines = np.maximum(np.bincount(line_owner, minlength=n), 1).astype(float)
    line_distinct, _ = _distinct(hashes.of(line_start, line_end), line_owner, n)
    short = _per_text((line_end - line_start < 25).astype(float), line_owner, n) / lines
    columns = [
        np.log1p(size), np.log1p(words), *shares.values(), mean, dev, np.log1p(longest),
        distinct / some, pairs / np.maximum(words - 1, 1), top / some, line_distinct / lines,
        np.log1p(size / lines), short, _per_text(shout.astype(float), owner, n) / some,
        _per_text((plain == length).astype(float), owner, n) / some,
        shares["upper"] / np.maximum(shares["upper"] + shares["lower"], 1e-9),
    ]
    return np.column_stack(columns)


def measure(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, stats) of every row in one pass; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                stats = statistics(*flat(piece.column(1))).astype(np.float32)
                at = pa.array(np.arange(len(stats) + 1) * stats.shape[1], pa.int32())
                yield pa.record_batch([piece.column(0), pa.ListArray.from_arrays(at, pa.array(stats.ravel()))], names=["key", "stats"])

    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, stats array<float>").withColumnRenamed("key", key)


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    shift: np.ndarray
    beta: np.ndarray
    knots: np.ndarray
    values: np.ndarray


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), float).reshape(len(column), len(NAMES))


def _expand(m: Model, stats: np.ndarray) -> np.ndarray:
    z = np.clip((stats - m.mean) / m.scale, -8, 8)
    return np.column_stack([np.cos(z @ m.weights + m.shift) * np.sqrt(2 / FEATURES), np.ones(len(z))])


def _raw(m: Model, stats: np.ndarray) -> np.ndarray:
    return _expand(m, stats) @ m.beta


def _summed(rows: DataFrame, work, width: int) -> np.ndarray:
    """The sum over all tasks of the arrays that ``work`` makes of their batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += work(_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False).astype(float))
        yield pa.record_batch([pa.array([total.tobytes()])], names=["s"])

    out = np.zeros(width)
    for r in rows.mapInArrow(run, "s binary").toLocalIterator():
        out += np.frombuffer(bytes(r.s))
    return out


def pool(scores: np.ndarray, positive: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of positive / weight over rising scores: block centres and values."""
    blocks: list[list[float]] = []
    for s, p, w in zip(scores, positive, weight, strict=True):
        blocks.append([s * w, p, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            top = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], top, strict=True)]
    got = np.array(blocks)
    return got[:, 0] / got[:, 2], (got[:, 1] + 0.25) / (got[:, 2] + 0.5)


def fit(measured: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", seed: int = 7, max_rows: int = MAX_FIT_ROWS) -> Model | None:
    """The model for rows of ``measured`` with a label of 0 or 1; None if there is no such row.

    Rows with a null or other label teach nothing; repeated labels of a key
    count each. Beyond ``max_rows`` labelled rows, a share by hash is used.
    """
    marks = labels.where(labels[label].isin(0, 1)).select(labels[key].alias("key"), labels[label].cast("double").alias("y"))
    rows = measured.select(measured[key].alias("key"), "stats").join(marks, "key")
    n = marks.count()
    if n > max_rows:
        rows = rows.where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int((1 << 20) * max_rows / n))
    rows = materialize(rows.select("stats", "y").repartition(FIT_TASKS))
    k = len(NAMES)
    sums = _summed(rows, lambda x, y: np.concatenate([[len(y), y.sum()], x.sum(0), (x * x).sum(0)]), 2 + 2 * k)
    if not sums[0]:
        return None
    mean = sums[2 : 2 + k] / sums[0]
    scale = np.sqrt(np.maximum(sums[2 + k :] / sums[0] - mean**2, 1e-6))
    draw = np.random.default_rng(seed)
    m = Model(mean, scale, draw.normal(size=(k, FEATURES)) / WIDTH, draw.uniform(0, 2 * np.pi, FEATURES), np.zeros(0), np.zeros(0), np.zeros(0))
    d = FEATURES + 1
    # both labels weigh the same in the normal equations
    up, down = sums[0] / (2 * max(sums[1], 1)), sums[0] / (2 * max(sums[0] - sums[1], 1))

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        phi, w = _expand(m, x), np.where(y > 0, up, down)
        return np.concatenate([(phi.T @ (phi * w[:, None])).ravel(), phi.T @ (w * y)])

    got = _summed(rows, equations, d * d + d)
    m = m._replace(beta=np.linalg.solve(got[: d * d].reshape(d, d) + RIDGE * np.eye(d), got[d * d :]))

    def binned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = np.clip(((_raw(m, x) + 1) / 3 * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)])

    got = _summed(rows, binned, 2 * BINS)
    count, positive = got[:BINS], got[BINS:]
    some = np.flatnonzero(count)
    knots, values = pool((some + 0.5) / BINS * 3 - 1, positive[some], count[some])
    return m._replace(knots=knots, values=values)


def probability(m: Model, stats: np.ndarray) -> np.ndarray:
    """Calibrated scores: between block centres linear, beyond the outermost ones a gentle slope."""
    raw = _raw(m, stats)
    p = np.interp(raw, m.knots, m.values)
    # inside flat blocks the raw score still orders the texts
    return np.clip(p + 1e-4 * np.tanh(raw - 0.5), 0, 1)


def score(measured: DataFrame, model: Model | None, key: str = "doc_id") -> DataFrame:
    """(key, score) of every row; 0.5 if there was nothing to learn from."""
    shared = measured.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            stats = _matrix(batch.column(1))
            p = probability(m, stats) if m is not None and len(stats) else np.full(len(stats), 0.5)
            yield pa.record_batch([batch.column(0), pa.array(p)], names=["key", "score"])

    source = measured.select(measured[key].alias("key"), "stats")
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)


def keep(docs: DataFrame, model: Model | None, least: float, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores ``least`` or more, with all their columns.

    One pass without a shuffle. Without a model every row stays.
    """
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    place = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, names=[f"c{i}" for i in range(len(names))])
            for piece in pieces(batch, f"c{place}"):
                stats = statistics(*flat(piece.column(place))).astype(np.float32)
                yield piece.filter(pa.array(probability(shared.value, stats) >= least))

    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.mapInArrow(run, plain.schema).toDF(*names)
