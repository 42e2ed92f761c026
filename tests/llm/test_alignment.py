import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tessella.llm import alignment
from tessella.llm.bpe import byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(rows):
    """Both libraries over whole texts, groups by sets of byte places."""
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = byte_letters()
    done, counts = [], Counter()
    for key, text in rows:
        a, b, links, listed = [], [], [], ""
        if text:
            a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            raw_a = [bytes(letters[c] for c in t.id_to_token(i)) for i in a]
            raw_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
                a, b = [], []
        if a:
            ends = []
            for raw in (raw_a, raw_b):
                at, places = 0, []
                for x in raw:
                    at += len(x)
                    places.append(at)
                ends.append(places)
            out, i, j = [], 0, 0
            for e in sorted(set(ends[0]) & set(ends[1])):
                k, m = ends[0].index(e) + 1, ends[1].index(e) + 1
                out.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
                links.append((a[k - 1], b[m - 1]))
                i, j = k, m
            listed = hashlib.sha256(";".join(out).encode()).hexdigest()
        counts.update(links)
        done.append((key, len(a), len(b), links, listed))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return sorted((k, a, b, len(x), len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x), h) for k, a, b, x, h in done)


def texts(seed):
    draw = random.Random(seed)
    words = "the The cat cats don't we'll été naïve 12 3,000 x<|endoftext|> <s> </s> <0x41> 日本語 ½ 😀 ▁ \x00 ﬁ can’t Übermaß foo_bar 'tis \xa0 \x1c é 　".split(" ")
    seps = [" ", " ", " ", " ", "  ", "\n", " \n", "\n ", "\t", "   ", "\r\n", "", "\xa0"]
    return ["".join(draw.choice(words) + draw.choice(seps) for _ in range(draw.randint(1, 40))) for _ in range(60)]


@pytest.mark.parametrize("head", [5, 1 << 20])
def test_groups_equal_the_libraries(spark, monkeypatch, head):
    monkeypatch.setattr(alignment, "HEAD", head)
    rows = [(k, t) for k, t in enumerate(texts(1))]
    rows += [(900, None), (901, ""), (902, " "), (903, "  lead and trail  "), (904, "a" * 700 + " b " + "ab" * 500), (905, "the cat " * 3000), (3, "twice"), (3, "twice"), (906, "\n"), (907, "▁")]
    got = alignment.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), A, B).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_cache_that_is_emptied_gives_the_same(monkeypatch):
    with open(B, "rb") as f:
        proto = f.read()
    make = lambda: alignment.Aligner(alignment.plain(alignment.Vocabulary(A)), proto)
    every, whole = texts(2), make()
    monkeypatch.setattr(alignment, "CACHE_SEGMENTS", 10)
    monkeypatch.setattr(alignment, "LONG_SEGMENT", 4)
    small = make()
    for t in every:
        x, y = whole.align([t]), small.align([t])
        assert x[0].tolist() == y[0].tolist() and x[1] == y[1] and x[2].tolist() == y[2].tolist()


def test_labels_and_spans():
    labels = alignment.label_string(6, np.array([1, 3, 6]), np.array([3, 5, 6]))
    assert labels == b"\x01\x00\x03\x00\x02\x03"
    assert [m.group() for m in alignment.SPAN.finditer(labels)] == [b"\x01\x00\x03", b"\x00\x02\x03"]


def test_empty_table_clashing_columns_and_null_keys(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.groups(none, A, B).collect() == []
    rows = spark.createDataFrame([(None, "a b", 1, 2), (1, None, 1, 2), (1, "a b", 3, 4)], "doc_id long, text string, row int, pairs int")
    got = sorted(map(tuple, alignment.groups(rows, A, B).collect()), key=str)
    want = brute([(1, "a b")])[0][-1]
    assert [r[:7] for r in got] == [(1, 0, 0, 0, 0, 0, 0), (1, 2, 2, 2, 2, 2, 4), (None, 2, 2, 2, 2, 2, 4)] and {r[7] for r in got} == {"", want}
