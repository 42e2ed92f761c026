import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tessella.llm import suffix_dedup as sd


def brute(rows, length=sd.LENGTH):
    first = {}
    for key, raw in sorted(((k, (t or "").encode()) for k, t in rows if k is not None), key=lambda x: x[0]):
        for i in range(len(raw) - length + 1):
            first.setdefault(raw[i : i + length], key)
    out = []
    for key, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        if key is not None:
            for i in range(len(raw) - length + 1):
                if first[raw[i : i + length]] < key:
                    gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(raw)))
        out.append((key, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("letters", [1, 2, 5])
def test_suffix_array(letters):
    draw = random.Random(letters)
    for _ in range(300):
        t = [draw.randint(1, letters) for _ in range(draw.randint(0, 60))] + [0]
        assert sd.suffix_array(np.array(t)).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("bucket", [1, sd.BUCKET])
def test_induced_at_every_level(monkeypatch, bucket):
    """Copies with changes give several levels of names; both forms of induction give the one order."""
    monkeypatch.setattr(sd, "BUCKET", bucket)
    draw = random.Random(8)
    base = [draw.randint(1, 90) for _ in range(400)]
    t = []
    for _ in range(20):
        part = list(base)
        for _ in range(5):
            part[draw.randrange(len(part))] = draw.randint(1, 70_000)
        t += part
    t.append(0)
    assert sd.suffix_array(np.array(t)).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def test_long_runs():
    t = [3] * 3000 + [2] * 50 + [3] * 2999 + [0]
    assert sd.suffix_array(np.array(t)).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def test_earliest():
    draw = random.Random(4)
    for _ in range(100):
        parts = [bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 30))) for _ in range(draw.randint(1, 8))]
        keys = np.array([draw.randint(0, 9) for _ in parts])
        least = {}
        for p, k in zip(parts, keys):
            for i in range(len(p) - 3):
                least[p[i : i + 4]] = min(least.get(p[i : i + 4], 99), k)
        for p, got in zip(parts, sd.earliest(parts, keys, 4)):
            assert got.tolist() == [least[p[i : i + 4]] for i in range(max(0, len(p) - 3))]


@pytest.mark.parametrize("limit", [1, 300, sd.SHARD_BYTES])
def test_shards_hold_whole_groups(monkeypatch, limit):
    """Wherever batches and shards end, a group is decided as one."""
    monkeypatch.setattr(sd, "SHARD_BYTES", limit)
    draw = random.Random(6)
    rows = []
    for h in range(30):
        base = bytes(draw.choice(b"abc") for _ in range(80))
        for c in range(draw.randint(1, 6)):
            begin = draw.randint(0, 10)
            rows.append((h, c, draw.randint(0, 9), base[begin : begin + draw.randint(50, 70)]))
    want = []
    for h, c, own, s in rows:
        hold = [min(k for g, _, k, x in rows if g == h and s[i : i + 50] in x) for i in range(len(s) - 49)]
        want += [(h, c, i) for i, k in enumerate(hold) if k < own]
    for step in (1, 7, 1000):
        batches = [pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows[i : i + step]), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["h", "c", "least", "s"]) for i in range(0, len(rows), step)]
        got = [(h, c, off + i) for b in sd._shards(iter(batches)) for h, c, off, n in zip(*(x.to_pylist() for x in b.columns)) for i in range(n)]
        assert sorted(got) == sorted(want) and want


def test_against_brute_force(spark):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdé") for _ in range(draw.randint(1, 5)))
    base = [" ".join(word() for _ in range(40)) for _ in range(5)]
    rows = [(5, None), (6, ""), (7, "short"), (None, base[0]), (1, base[0]), (1, base[0]), (1, base[1]), (2, base[0][10:90] + base[1][:80]), (3, "a" * 300), (4, "a" * 200 + "b"), (4, "a" * 60), (9, base[2] + base[3]), (8, base[3][3:] + base[2]), (10, base[2][:49]), (11, base[2][5:55]), (12, base[2][5:54])]
    for k in range(13, 40):
        x = list(" ".join(draw.choice(base) for _ in range(2)))
        for _ in range(4):
            x[draw.randrange(len(x))] = draw.choice("xyz")
        rows.append((k, "".join(x)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as h", "'k' as key").repartition(3)
    got = sorted((tuple(r) for r in sd.dedup(docs).collect()), key=str)
    assert got == brute(rows)
    assert sd.dedup(docs.limit(0)).count() == 0


def test_large_groups_are_split(spark, monkeypatch):
    draw = random.Random(7)
    letters = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    line = letters(70)
    near = line[:33] + "é" + line[34:]
    rows = [(k // 2, letters(draw.randint(0, 40)) + draw.choice([line, line, near]) + letters(draw.randint(0, 40))) for k in range(240)]
    rows += [(500 + k, rows[k][1][draw.randint(0, 9) :] + rows[-k][1]) for k in range(1, 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    limit, seen, split = 2000, [], []
    monkeypatch.setattr(sd, "SHARD_BYTES", limit)
    materialize = sd.materialize

    def watched(df, keep=None):
        out = materialize(df, keep)
        if out.columns == ["h", "c", "off", "count"]:
            seen.append(out)
        return out

    monkeypatch.setattr(sd, "materialize", watched)
    work = sd.split_runs
    monkeypatch.setattr(sd, "split_runs", lambda rows: split.append(rows.groupBy("h").count().count()) or work(rows))
    got = sorted((tuple(r) for r in sd.dedup(docs).collect()), key=str)
    assert got == brute(rows)
    assert split and split[0] > 0 and all(x.count() for x in seen)


def test_thousands_of_texts_under_one_key_lose_only_their_own_bytes(spark):
    """9,000 different texts share a key; every third has a passage that a lesser key's text has."""
    passage = "".join(random.Random(5).choice("abcdefghij") for _ in range(60))
    rows = [(7, f"{k:06d} {'x' * (k % 5)}{passage if k % 3 == 0 else ''}") for k in range(9000)] + [(1, passage)]
    got = sd.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sum(r.n_removed > 0 for r in got) == 3000 and {r.n_removed for r in got} == {0, 60}
    assert len(got) == 9001
