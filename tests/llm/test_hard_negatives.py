import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.llm import hard_negatives as hn
from tessella.llm.queries import ORACLE_SQL, op13_hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """Every anchor against every row."""
    real = []
    for k, x, label in rows:
        if k is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        real.append((k, (label + 1) % 10 if k % 7 == 0 else label, [math.floor(256 * float(np.float32(c))) for c in x]))
    out = []
    for i, (k, label, x) in enumerate(real):
        if k % 100:
            continue
        scores = sorted((-sum(p * q for p, q in zip(x, y, strict=False)), m, j, other) for j, (m, other, y) in enumerate(real) if j != i)
        for ps, p, _, _ in [s for s in scores if s[3] == label][:5]:
            fits = [(m, -s) for s, m, _, other in scores if other != label and 30 * -ps <= 100 * -s <= 90 * -ps]
            out += [(k, p, r + 1, m, -ps, s) for r, (m, s) in enumerate(fits[:10])]
    return sorted(out)


def rows_of(seed, n, dims, labels=10):
    draw = random.Random(seed)
    common = [draw.gauss(0, 0.3) for _ in range(dims)]
    rows = [(k, common if draw.random() < 0.3 else [draw.choice([0.25, -0.5, draw.gauss(0, 0.4)]) for _ in range(dims)], draw.randrange(labels)) for k in range(n)]
    rows += [(700, None, 1), (800, rows[0][1], None), (None, rows[0][1], 1), (900, [0.1] * (dims - 1) + [None], 2), (1000, [float("nan")] * dims, 2), (1001, [float("inf")] + [0.0] * (dims - 1), 2), (1100, [0.0] * dims, 3), (1200, [], 4), (1300, [1.0], 5), (1400, [3e30, -3e30], 0)]
    return rows


def mined(spark, rows):
    df = spark.createDataFrame([(k, None if x is None else [None if c is None else float(c) for c in x], y) for k, x, y in rows], SCHEMA).repartition(3)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, hn.mine(hn.prepared(df, moved), F.col("id") % 100 == 0).collect()))


@pytest.mark.parametrize(("n", "small"), [(650, False), (450, True)])
def test_mined_rows_equal_brute_force(spark, monkeypatch, n, small):
    if small:
        for name, value in (("LEAF", 8), ("ANCHOR_LEAF", 2), ("CHUNK_ROWS", 50), ("PAIRS", 4), ("HELD", 30), ("SAMPLE", 100), ("BLOCK_BYTES", 800)):
            monkeypatch.setattr(hn, name, value)
    rows = rows_of(n, n, 12)[:-1]
    assert mined(spark, rows) == brute(rows)


def test_repeated_rows_and_saturated_components(spark):
    rows = [(100, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (101, [1.0, 1.0], 1), (102, [0.5, 1.0], 2), (103, [0.5, 1.0], 3), (103, [0.5, 1.0], 3)]
    assert mined(spark, rows) == brute(rows)
    got = mined(spark, [(100, [3e30, 0.0], 1), (101, [3e30, 0.0], 1), (102, [1e5, 0.0], 2)])
    assert got == [(100, 101, 1, 102, hn.LIMIT**2, 25_600_000 * hn.LIMIT)]


def test_no_rows_no_anchors_one_label(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert mined(spark, [(100, [1.0], 1), (2, [1.0], 1)]) == []


def test_node_intervals_hold_and_groups_are_pruned():
    draw = np.random.default_rng(3)
    centres = draw.normal(0, 300, (6, 16))
    x = np.floor(centres[draw.integers(0, 6, 4000)] + draw.normal(0, 5, (4000, 16))).astype(np.int64)
    at, labels = np.arange(4000), draw.integers(0, 3, 4000)
    a, c = hn.Tree(at[:300], at[:300], labels[:300], x[:300], 8), hn.Tree(at, at, labels, x, 16)
    for i in range(0, len(a.start), 7):
        for j in range(0, len(c.start), 31):
            lo, hi = hn.interval(a, np.array([i]), c, np.array([j]))
            s = hn.exact(a, slice(a.start[i], a.end[i]), c, slice(c.start[j], c.end[j]))
            assert lo[0] <= s.min() and s.max() <= hi[0]
    best = hn.Best(np.full(300, hn.LEAST), 5)
    scored = hn.search(a, c, best, True, np.full((300, 1), hn.LEAST), np.full((300, 1), hn.MOST))
    pairs = int((a.child == 0).sum()) * int((c.child == 0).sum())
    assert scored < pairs / 4


def test_query_equals_its_sql(spark):
    d = "/root/testdata/sf0.001"
    got = op13_hard_negatives(spark, d)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    want = con.sql(ORACLE_SQL["op13_hard_negatives"])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]


def test_cuts_sort_a_few_times_what_is_found():
    class Tallied(hn.Best):
        found = held = 0

        def add(self, *columns):
            self.found += len(columns[0])
            super().add(*columns)

        def cut(self):
            self.held += self.size
            return super().cut()

    draw = np.random.default_rng(4)
    x = np.floor(draw.normal(0, 30, (9000, 16))).astype(np.int64)
    at, labels = np.arange(9000), draw.integers(0, 3, 9000)
    a = hn.Tree(at[:1000], at[:1000], labels[:1000], x[:1000], 8)
    low, high = np.zeros((1000, 5), np.int64), np.arange(1, 6)[None, :] * np.full((1000, 1), 1500)
    best = Tallied(np.full(5000, hn.LEAST), 10)
    for lo in range(1000, 9000, 2000):
        hn.search(a, hn.Tree(*(y[lo : lo + 2000] for y in (at, at, labels, x)), 64), best, False, low, high)
    group, score, ids, _ = best.cut()
    assert best.held < 4 * best.found
    for k in range(0, 1000, 101):
        anchor = int(a.order[k])
        others = sorted((-int(x[anchor] @ x[m]), m) for m in range(1000, 9000) if labels[m] != labels[anchor])
        for band in range(5):
            mine = group == k * 5 + band
            assert list(zip(-score[mine], ids[mine], strict=True)) == [s for s in others if low[k, band] <= -s[0] <= high[k, band]][:10]


@pytest.mark.parametrize("most", [100, 4000, 1 << 23, 1 << 26])
def test_scores_are_exact_at_every_width(most):
    draw = np.random.default_rng(most)
    x = draw.integers(-most, most, (40, 9), endpoint=True)
    x[:20] = np.sign(x[:20]) * most
    tree = hn.Tree(np.arange(40), np.arange(40), np.zeros(40, np.int64), x, 64)
    score = hn.exact(tree, slice(0, 40), tree, slice(0, 40))
    want = np.array([[sum(int(p) * int(q) for p, q in zip(u, v, strict=True)) for v in x] for u in x])
    assert (score.astype(np.int64) == want).all()
    assert score.dtype == (np.float32 if most == 100 else np.float64 if most <= 1 << 23 else np.int64)
