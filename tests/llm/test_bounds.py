"""What is broadcast or planned does not grow with the table, and stays right where a bound takes effect."""

import hashlib
import random
from collections import Counter

import numpy as np

from tessella.llm import decontaminate, fingerprints, langid


def test_a_window_that_very_many_items_hold(spark):
    passage = " ".join(f"word{k}" for k in range(10))
    items = [(f"i{k:05d}", passage) for k in range(3000)] + [("short", "word3 word4"), ("other", "nothing of it")]
    docs = [(1, f"so {passage} it is"), (2, "clean text"), (None, f"x {passage}"), (3, "word3 word4"), (1, f"so {passage} it is")]
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")).collect()
    sha = lambda names: hashlib.sha256(",".join(names).encode()).hexdigest()
    every = [f"i{k:05d}" for k in range(3000)] + ["short"]
    want = [(1, 13, 10, 3001, sha(every), True)] * 2 + [(2, 2, 0, 0, sha([]), False), (3, 2, 2, 1, sha(["short"]), True), (None, 11, 10, 3001, sha(every), True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_the_plan_of_neighbours_does_not_grow_with_the_parts(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(600)], "doc_id long, text string")
    sizes = [len(fingerprints.with_next(docs, parts)._jdf.queryExecution().optimizedPlan().toString()) for parts in (5, 400)]
    assert abs(sizes[1] - sizes[0]) < 100
    rows = sorted(fingerprints.with_next(docs, 400).collect(), key=lambda r: (r.part, r.tail, r.key))
    follows = {a.key: b.key for a, b in zip(rows, rows[1:]) if a.part == b.part}
    assert follows == {k: (k + 1) % 600 for k in range(600)}


def words_of(lang, seed, n):
    draw = random.Random(f"{lang}{seed}")
    parts = {"aa": "ka lo mi ru te".split(), "bb": "sch ung ein cht ver".split(), "cc": "ция про ста ние".split()}[lang]
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) for _ in range(n))


def exact(texts, learned, share=0.2, least=3):
    """The language with the most n-grams in its exact set, or None where two are close."""
    counts = {}
    for lang, t in learned:
        counts.setdefault(lang, Counter()).update(langid.grams([t])[0].tolist())
    totals = {k: sum(c.values()) for k, c in counts.items()}
    rate = lambda k, g: counts[k][g] / totals[k]
    sets = {k: {g for g, n in c.items() if n >= min(least, -(-totals[k] // langid.PER_LEAST)) and rate(k, g) >= share * max(rate(x, g) for x in counts)} for k, c in counts.items()}
    out = []
    for t in texts:
        got = sorted(((sum(g in s for g in langid.grams([t])[0].tolist()), k) for k, s in sets.items()), reverse=True)
        out.append(got[0][1] if got[0][0] > got[1][0] + 5 else None)
    return out


def test_languages_equal_exact_sets(spark):
    learned = [(lang, words_of(lang, k, 30)) for lang in ("aa", "bb", "cc") for k in range(20)]
    mixed = [words_of("aa", 90 + k, 6) + " " + words_of("bb", 90 + k, 30 - k) for k in range(25)]
    texts = [words_of(lang, 100 + k, 12) for lang in ("aa", "bb", "cc") for k in range(20)] + mixed
    f = langid.learn(spark.createDataFrame(learned, "lang string, text string"))
    names, score = langid.judge(f, texts)
    want = exact(texts, learned)
    assert sum(w is not None for w in want) > 70 and all(w in (None, n) for w, n in zip(want, names)) and ((0 <= score) & (score <= 1)).all()


def test_a_bounded_sample_and_a_language_of_one_short_text(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_FIT_ROWS", 30)
    learned = [("aa", words_of("aa", k, 20)) for k in range(400)] + [("cc", "ста про ние ция"), (None, "x"), ("bb", None)]
    f = langid.learn(spark.createDataFrame(learned, "lang string, text string").repartition(3))
    assert f.languages == ["aa", "cc"]
    names, _ = langid.judge(f, [words_of("aa", 999, 9), "про ста ние", "", None, "!?"])
    assert names == ["aa", "cc", "und", "und", "und"]


def test_ties_and_very_long_texts(spark):
    f = langid.learn(spark.createDataFrame([("bb", "same words here")] * 2 + [("aa", "same words here")] * 2, "lang string, text string"))
    names, score = langid.judge(f, ["same words here", "same words " * 200_000, "zzzz qqqq"])
    assert names == ["aa", "aa", "aa"] and np.allclose(score[:2], 0.5, atol=0.05) and score[2] < 0.01
