import random
import re

import numpy as np
import pytest
import xxhash

from tessella.llm import simhash as sh

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def least_reachable(points):
    """component of each place of a list of fingerprints: the least place reachable."""
    x = np.array(points, np.uint64)
    root = np.arange(len(x))
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 3
    while True:
        new = np.array([root[n].min() for n in near], dtype=np.int64) if len(x) else root
        if np.array_equal(new, root):
            return root.tolist()
        root = new


def brute(rows):
    at = [(k, fingerprint(t)) for k, t in rows]
    real = sorted((x for x in at if x[0] is not None))
    root = least_reachable([f for _, f in real])
    out = [(k, f"{f:016x}", real[r][0]) for (k, f), r in zip(real, root, strict=True)]
    return sorted(out + [(None, f"{f:016x}", None) for k, f in at if k is None], key=str)


def rows_of(seed):
    draw = random.Random(seed)
    word = lambda: draw.choice("alpha Beta gamma DELTA eps zeta Éta theta".split()) + str(draw.randint(0, 60))
    rows = [(900, None), (901, ""), (902, "Hi there"), (903, "hi \t THERE\n"), (None, "hi there"), (904, " \x0b\x0c\r\n"), (905, "one"), (906, "x " * 5000), (None, None)]
    for k in range(120):
        if k % 12 == 0:
            doc = [word() for _ in range(draw.choice([2, 30, 120, 400]))]
        d = list(doc)
        for _ in range(draw.randint(0, 2)):
            d[draw.randrange(len(d))] = word()
        rows.append((k, draw.choice([" ", "  ", "\n"]).join(d)))
    rows += [(5, rows[60][1]), *rows[20:24]]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("tile", "chunk"), [(sh.TILE, sh.CHUNK), (8, 4)])
def test_components_equal_brute_force(spark, monkeypatch, tile, chunk):
    monkeypatch.setattr(sh, "TILE", tile)
    monkeypatch.setattr(sh, "CHUNK", chunk)
    monkeypatch.setattr(sh, "COUNTED", 1 << 17 if chunk > 4 else 16)
    rows = rows_of(chunk)
    got = sh.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def crowd(seed, n):
    """Points around a few centres, a dense one among them."""
    draw = random.Random(seed)
    centres = [draw.getrandbits(64) for _ in range(12)]
    out = {0, 1 << 63, (1 << 64) - 1}
    while len(out) < n:
        p = draw.choice(centres) if draw.random() < 0.4 else centres[0]
        for _ in range(draw.randint(0, 7)):
            p ^= 1 << draw.randrange(14 if draw.random() < 0.5 else 64)
        out.add(p)
    return sorted(out)


@pytest.mark.parametrize(("n", "chunk"), [(700, 4096), (700, 40), (400, 7)])
def test_links_connect_what_the_radius_links(spark, monkeypatch, n, chunk):
    monkeypatch.setattr(sh, "CHUNK", chunk)
    monkeypatch.setattr(sh, "TILE", 64)
    monkeypatch.setattr(sh, "HELD", 50)
    points = crowd(n + chunk, n)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    found = sh.links(spark.createDataFrame([(p,) for p in signed], "point long").repartition(3)).collect()
    place = {p: k for k, p in enumerate(signed)}
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        x, y = top(place[a]), top(place[b])
        root[max(x, y)] = min(x, y)
    assert [top(k) for k in range(n)] == least_reachable(points)


@pytest.mark.parametrize("itself", [True, False])
def test_planes_find_the_same_pairs_as_bit_counts(itself):
    x = np.array(crowd(5, 500), np.uint64).view(np.int64)
    y = x if itself else np.array(crowd(6, 90)[:70] + crowd(5, 500)[::9], np.uint64).view(np.int64)
    got = sorted((int(a), int(b)) for q, j in sh.close(x, y, itself) for a, b in zip(q, j, strict=True))
    near = np.bitwise_count(x.view(np.uint64)[:, None] ^ y.view(np.uint64)[None, :]) <= 3
    assert got == [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(near, 1) if itself else near), strict=True)]


def test_tables_cover_every_pattern_of_three_bits():
    for points in (10, 1 << 30, 1 << 40):
        masks = sh.tables_of(points)
        draw = random.Random(points)
        for _ in range(200):
            x = sum(1 << b for b in draw.sample(range(64), 3))
            assert any(x & m == 0 for m in masks)
    assert len(sh.tables_of(1 << 20)) == 4 and len(sh.tables_of(1 << 36)) == 10


def test_empty_table_and_clashing_columns(spark):
    assert sh.components(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rows = spark.createDataFrame([(7, "a b c d", 1, 2), (3, "A  b c d", 1, 2)], "doc_id long, text string, point int, root int")
    assert sorted(tuple(r) for r in sh.components(rows).collect()) == brute([(7, "a b c d"), (3, "A  b c d")])
