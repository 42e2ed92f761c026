import hashlib
import random
import re

import numpy as np
import pytest

from tessella.llm import fingerprints as fp
from tessella.llm import langid, pii, quality

EN = "the of and house river stone walking gently bright morning window letter".split()
DE = "der die und haus fluss stein gehend sanft heller morgen fenster brief".split()


def corpus(spark, n=160):
    draw = random.Random(5)
    rows = [(k, " ".join(draw.choice((EN, DE)[k % 2]) for _ in range(draw.randint(3, 60))), ("en", "de")[k % 2]) for k in range(n)]
    rows += [(n, None, "en"), (n + 1, "", "de"), (n + 2, "12 34 !", None), (n + 3, "straße", None), (n + 3, "straße", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as score", "'x' as key")


def test_language_on_held_out_texts(spark):
    docs = corpus(spark)
    learned = langid.learn(docs.where("doc_id % 4 <> 2"))
    got = {r.doc_id: r for r in langid.predict(docs, learned).collect()}
    assert all(got[k].lang_pred == ("en", "de")[k % 2] and 0 <= got[k].score <= 1 for k in range(160))
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in (160, 161, 162))
    none = langid.learn(docs.where("lang is null"))
    assert {r.lang_pred for r in langid.predict(docs, none).collect()} == {"und"}
    assert langid.predict(docs.limit(0), learned).count() == 0


def test_language_filter_grows_with_its_entries(spark, monkeypatch):
    monkeypatch.setattr(langid, "SLOT_BITS", 6)
    docs = corpus(spark)
    learned = langid.learn(docs.where("doc_id % 4 <> 2"))
    assert 0 < learned.false_positive.max() <= langid.FILL**2
    rows = docs.where("doc_id < 160 and doc_id % 4 = 2").collect()
    assert langid.judge(learned, [r.text for r in rows])[0] == [r.lang for r in rows]


def test_more_languages_than_a_block_holds(spark):
    draw = random.Random(11)
    text = lambda k: " ".join("".join(chr(0x4E00 + 40 * k + draw.randrange(6)) for _ in range(4)) for _ in range(60))
    rows = [(r * 150 + k, text(k), f"l{k:03}") for k in range(150) for r in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = langid.learn(docs.where("doc_id < 150"), least=1)
    assert len(learned.languages) == 150
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, learned).collect()}
    assert got == {k: lang for k, _, lang in rows}


def test_quality_separates_and_calibrates(spark):
    draw = random.Random(6)
    rows, marks = [], []
    for k in range(400):
        good = k % 3 > 0
        words = [draw.choice(EN) + ("" if good else draw.choice(["$$$", "&&&", "%%%"])) for _ in range(draw.randint(20, 120))]
        rows.append((k, " ".join(words)))
        marks.append((k, int(good)))
    rows += [(900, None), (901, ""), (902, "x" * 200_000)]
    marks += [(5, None), (77777, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0.5 as y", "'s' as stats")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    measured = quality.measure(docs)
    model = quality.fit(measured, labels.where("doc_id % 4 <> 2"))
    got = {r.doc_id: r.score for r in quality.score(measured, model).collect()}
    held = [k for k in range(400) if k % 4 == 2]
    assert all((got[k] >= 0.7) == (k % 3 > 0) for k in held)
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 403
    kept = quality.keep(docs, model, 0.7)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, s in got.items() if s >= 0.7}
    assert quality.fit(measured, labels.limit(0)) is None
    assert {r.score for r in quality.score(measured, None).collect()} == {0.5}


def test_isotonic_blocks_rise():
    draw = np.random.default_rng(1)
    _, values = quality.pool(np.arange(50.0), draw.integers(0, 5, 50).astype(float), np.full(50, 5.0))
    assert (np.diff(values) >= 0).all()


def test_base_spans_equal_the_patterns():
    kinds = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]

    def fits(kind, text):
        digits = re.sub("[^0-9]", "", text)
        return [True, kind != 1 or all(int(p) <= 255 for p in text.split(".")), 14 <= len(digits) <= 19 and pii.luhn(digits), 10 <= len(digits) <= 15][kind]

    draw = random.Random(8)
    for _ in range(3000):
        t = "".join(draw.choice("1234567890..@@--  ++()abc%_,é\n") for _ in range(draw.randint(0, 40)))
        want = sorted((m.start(), k, m.end()) for k, p in enumerate(kinds) for m in p.finditer(t) if fits(k, m.group()))
        assert pii.base_spans(t) == [(pii.KINDS[k], s, e) for s, k, e in want]


def test_random_field_on_unseen_sentences_and_masking(spark):
    table = pii.labelled_table(150, 99)
    found = pii.find(pii.train(), [t for t, _ in table])
    hits = sum(len(set(a) & set(s)) for (_, s), (_, a) in zip(table, found))
    assert hits >= 0.95 * sum(len(s) for _, s in table)
    assert sum(len(set(a) - set(s)) for (_, s), (_, a) in zip(table, found)) <= 0.05 * hits
    rows = [(1, None), (2, ""), (3, "mail ab.c@d.example.com or +1 (555) 555-1234 now"), (3, "nothing here"), (4, "7" * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' as spans")
    got = pii.detect(docs).collect()
    assert len(got) == 5 and sum(r.n_email + r.n_phone for r in got) == 2
    assert {r.base_sha256 for r in got if r.doc_id in (1, 2)} == {hashlib.sha256(b"").hexdigest()}
    masked = {r.text for r in pii.redact(docs).collect()}
    assert "mail <EMAIL> or <PHONE> now" in masked and None in masked
    assert pii.detect(docs.limit(0)).count() == 0


def test_viterbi_equals_exhaustive_search():
    import itertools

    draw = np.random.default_rng(2)
    labels = len(pii.LABELS)
    field = pii.Field(np.zeros((1, labels)), draw.normal(size=(labels, labels)))
    windows = [draw.normal(size=(n, labels)) for n in (1, 3, 2, 3)]
    for w, path in zip(windows, pii.viterbi(field, windows)):
        best = max(itertools.product(range(labels), repeat=len(w)), key=lambda p: sum(w[i, x] for i, x in enumerate(p)) + sum(field.moves[a, b] for a, b in zip(p, p[1:])))
        assert tuple(path.tolist()) == best


@pytest.mark.parametrize("parts", [1, 5])
def test_edited_texts_and_neighbours(spark, parts):
    draw = random.Random(9)
    rows = [(k * 7, " ".join(draw.choice(EN + DE) for _ in range(draw.randint(0, 50)))) for k in range(40)]
    rows += [(1000, None), (1001, ""), (1002, "é" * 9), (1003, "!!!"), (1004, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as part", "false as tail").repartition(3)
    got = {r.doc_id: r for r in fp.compare_edits(docs, parts=parts).collect()}
    assert len(got) == len(rows)
    ordered = [(k, t or "") for k, t in sorted(rows)]
    for i, (k, t) in enumerate(ordered):
        cut = len(t) // 4
        edited = t[: len(t) - cut] + ordered[(i + 1) % len(ordered)][1][:cut]
        assert got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[k].n_chars == len(t)
        assert got[k].fingerprint == fp.as_text(fp.signatures([t])[0])
        # likenesses by plain sets, read back from the fingerprints
        of = lambda s: {s[j : j + 8] for j in range(0, len(s), 8)}
        for near, other in ((got[k].near_edited, got[k].edited_fingerprint), (got[k].near_next, got[ordered[(i + 1) % len(ordered)][0]].fingerprint)):
            a, b = of(got[k].fingerprint), of(other)
            assert near == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        assert got[k].edited_fingerprint == fp.as_text(fp.signatures([edited])[0])
    assert got[0].fingerprint == got[1004].fingerprint and got[1001].fingerprint == ""
    assert fp.compare_edits(docs.limit(0)).count() == 0


def plain_signatures(text):
    """Signatures by their definition, word by word, as tuples."""
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode())
    anchors = {a.encode() for a in fp.ANCHORS}
    out, behind = set(), None
    for i, w in enumerate(words):
        if w in anchors:
            behind = i
            chain = [x for x in words[i + 1 :] if x not in anchors][: fp.CHAIN]
            if len(chain) == fp.CHAIN:
                out.add(("spot", w, *chain))
        elif behind is None or i - behind > fp.SPARSE:
            out.add(("word", *(words[i + k] if i + k < len(words) else b"" for k in range(fp.CHAIN + 1))))
    return out or ({("whole", text)} if text else set())


def test_signatures_follow_their_definition():
    draw = random.Random(3)
    texts = [None, "", "!!", "The", "the river"] + [" ".join(draw.choice(EN + DE) for _ in range(draw.randint(1, 40))) for _ in range(60)]
    assert [len(s) for s in fp.signatures(texts)] == [len(plain_signatures(t)) for t in texts]


def test_near_duplicates_equal_brute_force(spark):
    draw = random.Random(4)
    rows = [(0, None), (1, ""), (2, "!!"), (3, "!!")]
    for _ in range(6):
        base = [draw.choice(EN + DE) + str(draw.randint(0, 9)) * draw.randint(0, 1) for _ in range(60)]
        for _ in range(8):
            words = list(base)
            for _ in range(draw.randint(0, 6)):
                words[draw.randrange(60)] = draw.choice(EN)
            rows.append((len(rows), " ".join(words)))
    sets = {k: plain_signatures(t) for k, t in rows}
    root = {k: k for k in sets}

    def find(k):
        return k if root[k] == k else find(root[k])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "'x' as class").repartition(3)
    got = {r.doc_id: (r.n_signatures, r.component_id) for r in fp.near_duplicates(docs).collect()}
    assert got == {k: (len(s), find(k)) for k, s in sets.items()}
    assert fp.near_duplicates(docs.limit(0)).count() == 0
