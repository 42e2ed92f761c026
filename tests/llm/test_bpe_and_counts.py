import random
import time

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from tessella.llm import bpe, token_counts  # noqa: E402

PATH = P.path("byte_bpe_50k.json")
PARTS = ["a", "the", " ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "é", "ß", "23", "!", "aaaa", "\x1c", "\x85", "漢字", "😀", "<|endoftext|>", "<|endo", "$$$", " of", "²", "------", "\u0301"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(PATH)


def texts(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 24))) for _ in range(n)]


def test_ids_and_decoded_text_equal_the_library(library, vocabulary):
    encoder, decoder = bpe.Encoder(vocabulary), bpe.Decoder(vocabulary)
    for t in texts(400, 1):
        want = library.encode(t, add_special_tokens=False).ids
        ids, at = encoder.encode([t])
        assert ids.tolist() == want and at.tolist() == [0, len(want)]
        assert decoder.decode(ids).decode("utf-8", "replace") == library.decode(want, skip_special_tokens=False)


def test_counts_of_every_prefix_equal_the_library(library, vocabulary):
    counter = token_counts.PrefixCounter(vocabulary)
    for t in texts(120, 2):
        want = [len(library.encode(t[:k], add_special_tokens=False).ids) for k in range(len(t) + 1)]
        assert counter.prefixes(t).tolist() == want
        assert counter.totals([t]) == [want[-1]]


def test_long_words(library, vocabulary):
    word = "".join(random.Random(3).choice("ab") for _ in range(5000))
    n = len(library.encode(word).ids)
    assert token_counts.PrefixCounter(vocabulary).totals([word, "x"]) == [n, 1]
    assert len(bpe.Encoder(vocabulary).encode([word])[0]) == n


def test_tables(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, "Hello world", "z"), (3, "Hello world", "z"), (None, "again again", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    got = bpe.round_trip(docs, PATH).collect()
    assert len(got) == 5 and all(r.exact or r.doc_id == 1 for r in got)
    assert sorted(r.n_tokens for r in got) == [0, 0, 2, 2, 2]
    counted = token_counts.count_tokens(docs, PATH).collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in counted) == [(0, 0), (0, 0), (11, 2), (11, 2), (11, 2)]
    assert bpe.round_trip(docs.limit(0), PATH).count() == 0
    back = bpe.decode(bpe.encode(docs, PATH), PATH).where("doc_id = 3").first()
    assert back.text == "Hello world"
    kept = token_counts.within_budget(token_counts.prefix_counts(docs, PATH), 1).where("doc_id = 3").first()
    assert np.array(kept.counts)[kept.keep_chars] <= 1 < np.array(kept.counts)[-1]


@pytest.mark.parametrize("limit", [0, 3, 512])
def test_long_words_take_the_same_merges(library, vocabulary, monkeypatch, limit):
    monkeypatch.setattr(bpe, "LONG_WORD", limit)
    encoder, draw = bpe.Encoder(vocabulary), random.Random(4)
    long = ["".join(draw.choice(letters) for _ in range(3000)) for letters in ("ab", "a", "etaoinshr", "漢字é", "aAeEtT")]
    every = texts(100, 5) + ["x " + w + "!" for w in long] + long
    ids, at = encoder.encode(every)
    for k, t in enumerate(every):
        assert ids[at[k] : at[k + 1]].tolist() == library.encode(t, add_special_tokens=False).ids


def test_a_word_of_a_million_letters_takes_seconds(library, vocabulary):
    word = "".join(random.Random(6).choice("etaoinshrdlu") for _ in range(1_000_000))
    start = time.process_time()
    ids, _ = bpe.Encoder(vocabulary).encode([word])
    assert time.process_time() - start < 60
    assert ids.tolist() == library.encode(word, add_special_tokens=False).ids
