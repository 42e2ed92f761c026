"""Exact token counts of every prefix of a text.

Inside a word, the encoding of each byte prefix ends in exactly one token.
A dynamic program finds it from the shorter prefixes: a token may end the
prefix if it is what merging would make next to the last token of the rest.
Its count is the rest's count plus one. With the counts of all prefixes
stored, the size of any truncation and the longest prefix within a budget
are lookups; nothing is encoded again.

Words of equal length advance together in numpy; a few very long words take
the same steps one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.bpe import Vocabulary, _texts, find_words, split_words
from tessella.llm.shared import _SALTS, mix, pieces, powers

LONG_WORD = 96
SPACE = regex.compile(r"\p{White_Space}+")
CACHE_WORDS = 600_000


class PrefixCounter:
    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        n = v.size
        # a token made by a merge splits into its two parts; others into themselves
        self.first, self.second = np.arange(n), np.arange(n)
        self.first[v.made_by_rank[::-1]] = v.left[::-1]
        self.second[v.made_by_rank[::-1]] = v.right[::-1]
        self.rank = np.full(n, -1, np.int64)
        self.rank[v.made_by_rank[::-1]] = np.arange(len(v.made_by_rank))[::-1]
        made = [i for i in range(n) if v.bytes_of[i] and i not in set(v.special.values())]
        self.lengths = sorted({len(v.bytes_of[i]) for i in made}, reverse=True)
        up, _ = powers(256)
        hashes = np.array([int(mix((_SALTS[np.frombuffer(v.bytes_of[i], np.uint8)] * up[: len(v.bytes_of[i])]).sum(dtype=np.uint64, keepdims=True))[0]) for i in made], np.uint64)
        order = np.argsort(hashes)
        hashes, ids = hashes[order], np.array(made)[order]
        sizes = np.array([len(v.bytes_of[i]) for i in ids])
        self.tokens = {k: (hashes[sizes == k], ids[sizes == k]) for k in self.lengths}
        self.by_bytes = {v.bytes_of[i]: i for i in made}
        self.known: dict[str, bytes | np.ndarray] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def _merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.v.size + b
        at = np.searchsorted(self.v.keys, keys)
        at[at == len(self.v.keys)] = 0
        return np.where(self.v.keys[at] == keys, self.v.ranks[at], len(self.v.keys) + 1)

    def adjacent(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves a and b as they are when they stand side by side.

        The merges that built both tokens are undone from the latest on. If at
        any time the two symbols at the border could have merged before the
        merge undone last, the border would not have lasted.
        """
        good = np.ones(len(a), bool)
        at = np.arange(len(a))
        limit = np.full(len(a), len(self.v.keys) + 1, np.int64)
        # of two equal ranks the left-hand merge comes first
        left, right = a.copy(), b.copy()
        while len(at):
            lost = self._merge_rank(left, right) < limit
            good[at[lost]] = False
            ra, rb = self.rank[left], self.rank[right]
            over = lost | ((ra < 0) & (rb < 0))
            undo_left = ra > rb
            limit = np.where(undo_left, ra, rb + 1)
            left, right = np.where(undo_left, self.second[left], left), np.where(undo_left, right, self.first[right])
            stay = ~over
            at, left, right, limit = at[stay], left[stay], right[stay], limit[stay]
        return good

    def _batch(self, words: list[bytes]) -> np.ndarray:
        """Counts of all prefixes of words that are sorted by falling length: an array (word, prefix)."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        most = int(sizes[0])
        data = np.frombuffer(b"".join(w.ljust(most, b"\0") for w in words), np.uint8).reshape(len(words), most)
        up, down = powers(256)
        sums = np.zeros((most + 1, len(words)), np.uint64)
        np.cumsum((_SALTS[data] * up[:most]).T, axis=0, out=sums[1:])
        last = np.full((most + 1, len(words)), -1, np.int64)
        count = np.zeros((most + 1, len(words)), np.uint8)
        for end in range(1, most + 1):
            open_ = np.arange(np.searchsorted(-sizes, -end, side="right"))
            for k in self.lengths:
                if k > end or not len(open_):
                    continue
                start = end - k
                h = mix((sums[end, open_] - sums[start, open_]) * down[start])
                hashes, ids = self.tokens[k]
                at = np.searchsorted(hashes, h)
                at[at == len(hashes)] = 0
                found = np.flatnonzero(hashes[at] == h)
                if not len(found):
                    continue
                token, word = ids[at[found]], open_[found]
                if start:
                    fits = self.adjacent(last[start, word], token)
                    found, token, word = found[fits], token[fits], word[fits]
                last[end, word] = token
                count[end, word] = count[start, word] + 1
                left = np.ones(len(open_), bool)
                left[found] = False
                open_ = open_[left]
        return count.T

    def _single(self, word: bytes) -> np.ndarray:
        last, count = [-1] * (len(word) + 1), np.zeros(len(word) + 1, np.int32)
        for end in range(1, len(word) + 1):
            for k in self.lengths:
                token = self.by_bytes.get(word[end - k : end]) if k <= end else None
                if token is None:
                    continue
                if end > k:
                    pair = (last[end - k], token)
                    if pair not in self.pairs:
                        if len(self.pairs) > CACHE_WORDS:
                            self.pairs.clear()
                        self.pairs[pair] = bool(self.adjacent(np.array([pair[0]]), np.array([pair[1]]))[0])
                    if not self.pairs[pair]:
                        continue
                last[end], count[end] = token, count[end - k] + 1
                break
        return count

    def learn(self, words: set[str]) -> None:
        """Store the prefix counts of the words that the cache lacks."""
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        fresh = sorted(((w.encode(), w) for w in words - self.known.keys()), key=lambda x: -len(x[0]))
        at = 0
        for b, w in fresh:
            if len(b) <= LONG_WORD:
                break
            self.known[w] = self._single(b)
            at += 1
        while at < len(fresh):
            # words of much the same length together, so that little is padded
            least, to = max(0, len(fresh[at][0]) * 2 // 3), at
            while to < len(fresh) and len(fresh[to][0]) >= least and to < at + 20_000:
                to += 1
            counts = self._batch([b for b, _ in fresh[at:to]])
            rows, width = counts.tobytes(), counts.shape[1]
            self.known.update((w, rows[k * width : k * width + len(b) + 1]) for k, (b, w) in enumerate(fresh[at:to]))
            at = to

    def totals(self, texts: list[str]) -> list[int]:
        """The count of each whole text: the last entries of its words' tables."""
        words, counts = split_words(self.v, texts)
        distinct = set(words)
        self.learn(distinct.difference(self.v.special))
        whole = {w: 1 if w in self.v.special else int(self.known[w][-1]) for w in distinct}
        sums = np.append(0, np.cumsum(np.fromiter(map(whole.__getitem__, words), np.int64, len(words))))
        return np.diff(sums[np.append(0, np.cumsum(counts))]).tolist()

    def prefixes(self, text: str) -> np.ndarray:
        """Token counts of text[:0], text[:1], ... text[:len(text)]."""
        out = np.zeros(len(text) + 1, np.int32)
        at = done = 0
        for part, special in self.v.pieces_of(text):
            done = self._part(part, out, at, done)
            at += len(part)
            if special >= 0:
                content = next(c for c, i in self.v.special.items() if i == special)
                # cut inside the special string, its beginning is ordinary text
                for k in range(1, len(content)):
                    out[at + k] = self.totals([part + content[:k]])[0] + out[at - len(part)]
                at, done = at + len(content), done + 1
                out[at] = done
        return out

    def _part(self, part: str, out: np.ndarray, at: int, done: int) -> int:
        words = find_words(part)
        spaces = []
        for k, w in enumerate(words[:-1]):
            if SPACE.fullmatch(w) and SPACE.match(words[k + 1]):
                spaces.append(w + words[k + 1][0])
        self.learn({*words, *spaces, *(c for w in words if w[:1] == "'" and len(w) == 3 for c in (w[:1], w[1:2]))})
        before = ""
        for w in words:
            counts = self.known[w]
            counts = np.frombuffer(counts, np.uint8).astype(np.int32) if isinstance(counts, bytes) else counts
            ends = np.cumsum([len(c.encode()) for c in w]) if not w.isascii() else np.arange(1, len(w) + 1)
            out[at + 1 : at + len(w) + 1] = done + counts[ends]
            if w[:1] == "'" and len(w) == 3 and w[1].isalpha():
                out[at + 2] = done + 2  # a cut contraction is no longer one word
            if SPACE.fullmatch(before) and SPACE.match(w):
                # cut after its white space, the run is one word
                out[at + 1] = done - int(self.known[before][-1]) + int(self.known[before + w[0]][-1])
            before, at, done = w, at + len(w), done + int(counts[-1])
        return done


def count_tokens(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_bytes and n_tokens of every whole text; one pass, no shuffle.

    Null text counts as empty: no bytes, no tokens. Repeated rows give a row
    each; other columns are not read.
    """
    return _run(docs, path, text, key, "n_bytes long, n_tokens long", lambda c, t: [c.totals(t)], lambda rows: [pa.array(rows[0], pa.int64())], True)


def prefix_counts(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key and counts, whose k-th entry (from 0) is the token count of the first k characters.

    Counts need not grow with k: a longer prefix can merge into fewer tokens.
    """
    return _run(docs, path, text, key, "counts array<int>", lambda c, t: [[c.prefixes(x) for x in t]], lambda rows: [pa.array(rows[0], pa.list_(pa.int32()))], False)


def _run(docs: DataFrame, path: str, text: str, key: str, columns: str, work, arrays, with_bytes: bool) -> DataFrame:
    tables = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))
    names = ["key", *(c.split(" ")[0] for c in columns.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(tables.value)
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = _texts(piece, "text")
                size = [pa.array([len(t.encode()) for t in texts], pa.int64())] if with_bytes else []
                yield pa.record_batch([piece.column(0), *size, *arrays(work(counter, texts))], names=names)

    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, {columns}").withColumnRenamed("key", key)


def within_budget(counted: DataFrame, budget: int, counts: str = "counts") -> DataFrame:
    """Adds keep_chars: the longest prefix of at most ``budget`` tokens, from the stored counts."""
    places = F.expr(f"filter(transform({counts}, (c, k) -> if(c <= {int(budget)}, k, -1)), k -> k >= 0)")
    return counted.withColumn("keep_chars", F.array_max(places))
