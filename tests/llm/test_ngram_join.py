import random
import re

import pytest

from tessella.llm import ngram_join as nj
from tessella.llm import shared

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    sets = []
    for k, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER))
        sets.append((k, frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])))
    parent = {k: k for k, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is None or b is None or not x or not y:
                continue
            common = len(x & y)
            if 100 * common >= 75 * (len(x) + len(y) - common) and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return sorted(((k, len(x), None if k is None else find(k)) for k, x in sets), key=str)


def rows_of(seed):
    draw = random.Random(seed)
    word = lambda: draw.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(draw.randint(0, 30))
    rows = [(900, None), (901, ""), (902, "Hi there"), (903, "hi THERE"), (None, "hi there"), (904, "  \n")]
    k = 0
    for _ in range(4):
        doc = [word() for _ in range(draw.choice([12, 40, 80]))]
        for _ in range(25):
            d = list(doc)
            for _ in range(draw.randint(0, 3)):
                d[draw.randrange(len(d))] = word()
            if draw.random() < 0.3:
                d = d[: draw.randint(len(d) // 2, len(d))]
            k += 1
            rows.append((k, " ".join(d)))
    rows += [(5, rows[40][1]), *rows[10:14]]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_components_equal_brute_force_with_small_limits(spark, monkeypatch, seed):
    for name, value in (("SHORT_LIST", 3), ("LIST_ROWS", 16), ("TILE", 5), ("HOT_ROWS", 20), ("STAR", 4)):
        monkeypatch.setattr(nj, name, value)
    rows = rows_of(seed)
    got = nj.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_representatives_and_empty_table(spark):
    docs = spark.createDataFrame(rows_of(2), "doc_id long, text string").selectExpr("*", "doc_id as component_id", "1 as n")
    kept = nj.representatives(docs)
    # rows are nodes of their own: a key that two texts share is judged by text, equal rows count once
    rows = sorted({r for r in rows_of(2) if r[0] is not None}, key=lambda r: (r[0], r[1] or ""))
    parts = brute([(k, t) for k, (_, t) in enumerate(rows)])
    firsts = {}
    for k, _, c in parts:
        firsts[c] = min(firsts.get(c, rows[k][0]), rows[k][0])
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(firsts.values())
    assert kept.where("doc_id is null").count() == sum(k is None for k, _ in rows_of(2))
    assert kept.columns == docs.columns
    assert nj.components(docs.limit(0)).count() == 0


def test_regular_long_words_and_long_texts_are_told_apart(spark):
    """Thue-Morse words collide under any polynomial hash modulo a power of two."""
    bits = [bin(k).count("1") % 2 for k in range(2048)]
    rows = [(1, "".join("ab"[b] for b in bits)), (2, "".join("ba"[b] for b in bits))]
    rows += [(3, "".join("ab"[b] for b in bits[:1024])), (4, "".join("ba"[b] for b in bits[:1024]))]
    rows += [(5, " ".join("ab"[b] + str(k % 700) for k, b in enumerate(bits * 8))), (6, " ".join("ba"[b] + str(k % 700) for k, b in enumerate(bits * 8)))]
    rows += [(7, rows[4][1] + " more"), (8, "x" * 70), (9, "x" * 71), (10, "X" * 70)]
    got = nj.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_clashing_sets_draw_other_numbers(spark, monkeypatch):
    real = nj._digests
    monkeypatch.setattr(nj, "_digests", lambda sets, at, seed=0: real(sets, at, seed) & (0 if seed == 0 else -1))
    rows = rows_of(3)
    got = nj.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


@pytest.mark.parametrize("small", [0, 10_000])
def test_connected(spark, monkeypatch, small):
    monkeypatch.setattr(shared, "SMALL_GRAPH", small)
    draw = random.Random(7)
    edges = [(draw.randint(0, 60), draw.randint(0, 60)) for _ in range(40)] + [(k, k + 1) for k in range(100, 130)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if find(a) != find(b):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.root for r in shared.connected(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    assert got == {n: find(n) for n in parent if find(n) != n}
