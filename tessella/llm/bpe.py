"""Byte-level BPE: encoding and decoding in batched numpy merge rounds.

The symbols of many distinct words lie in one flat array. A round forms the
key of every adjacent pair, finds its rank by binary search over the sorted
keys of all merges, takes the lowest rank of each word and merges that pair
wherever it stands in the word. Words without a mergeable pair leave the
array. Very long words, few in any text, take the same merges from a queue. A
task keeps the words that it has met in a cache of bounded size, so
repeated words cost one lookup.

The vocabulary file is a parameter; the driver reads it once and broadcasts
its tables, whose size is the vocabulary's.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tessella.llm.shared import pieces

#: The pattern that splits a text into words before merging.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: The same split, spelled out for texts within Latin-1, which takes half the time.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
LATIN_WORDS = re.compile(f" ?[{_L}]+|'(?:[stmd]|re|ve|ll)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
CACHE_WORDS = 600_000
#: Words of more bytes are merged one by one, in time that hardly outgrows their length.
LONG_WORD = 512


def byte_letters() -> dict[str, int]:
    """The letter by which vocabulary files of this kind write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in set(plain)):
        letters[chr(256 + k)] = b
    return letters


class Vocabulary:
    """Tables of a byte-level BPE vocabulary in ``tokenizers`` JSON form."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, letters = file["model"], byte_letters()
        ids = model["vocab"]
        self.size = 1 + max([*ids.values(), *(t["id"] for t in file.get("added_tokens", []))])
        self.bytes_of: list[bytes] = [b""] * self.size
        for token, i in ids.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        for content, i in self.special.items():
            self.bytes_of[i] = content.encode()
        self.byte_ids = np.zeros(256, np.int64)
        for c, b in letters.items():
            self.byte_ids[b] = ids[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.left, self.right = left, right
        self.made_by_rank = made
        self._pairs: dict[int, int] | None = None

    def pairs(self) -> dict[int, int]:
        """Rank by pair key, made when the first long word comes."""
        if self._pairs is None:
            self._pairs = dict(zip(self.keys.tolist(), self.ranks.tolist(), strict=True))
        return self._pairs

    def pieces_of(self, text: str) -> Iterator[tuple[str, int]]:
        """(ordinary text, special id after it); -1 at the end."""
        if not self.special or not any(s in text for s in self.special):
            yield text, -1
            return
        pattern = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        at = 0
        for m in pattern.finditer(text):
            yield text[at : m.start()], self.special[m.group()]
            at = m.end()
        yield text[at:], -1


def merge_words(v: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words in one flat array, and each word's offsets in it."""
    long = [k for k, w in enumerate(words) if len(w) > LONG_WORD]
    if not long:
        return _merge_rounds(v, words)
    ids, at = _merge_rounds(v, [b"" if len(w) > LONG_WORD else w for w in words])
    sizes, parts, done = np.diff(at), [], 0
    for k in long:
        own = _merge_long(v, words[k])
        sizes[k] = len(own)
        parts += [ids[done : at[k]], own]
        done = at[k]
    return np.concatenate([*parts, ids[done:]]), np.append(0, np.cumsum(sizes))


def _merge_long(v: Vocabulary, word: bytes) -> np.ndarray:
    """Token ids of one long word: a queue of pairs by rank and place, as rounds would pass over the whole word again and again."""
    pairs = v.pairs()
    symbols = v.byte_ids[np.frombuffer(word, np.uint8)].tolist()
    n, size = len(symbols), v.size
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [pairs[key] << 40 | i for i, key in enumerate(a * size + b for a, b in zip(symbols, symbols[1:])) if key in pairs]
    heapq.heapify(queue)
    made, place = v.made_by_rank.tolist(), (1 << 40) - 1
    while queue:
        entry = heapq.heappop(queue)
        rank, i = entry >> 40, entry & place
        j = after[i]
        # the pair may be gone, or another one may stand in its place
        if symbols[i] < 0 or j >= n or pairs.get(symbols[i] * size + symbols[j]) != rank:
            continue
        symbols[i], symbols[j] = made[rank], -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            key = symbols[i] * size + symbols[k]
            if key in pairs:
                heapq.heappush(queue, pairs[key] << 40 | i)
        h = before[i]
        if h >= 0:
            key = symbols[h] * size + symbols[i]
            if key in pairs:
                heapq.heappush(queue, pairs[key] << 40 | h)
    return np.array([s for s in symbols if s >= 0], np.int64)


def _merge_rounds(v: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    symbols = v.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), sizes)
    done_ids: list[np.ndarray] = []
    done_owner: list[np.ndarray] = []
    none = len(v.keys)
    while len(symbols):
        keys = symbols[:-1] * v.size + symbols[1:]
        at = np.searchsorted(v.keys, keys)
        at[at == none] = 0
        hit = (v.keys[at] == keys) & (owner[:-1] == owner[1:])
        rank = np.append(np.where(hit, v.ranks[at], none), none)
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        lengths = np.diff(np.append(starts, len(owner)))
        lowest = np.minimum.reduceat(rank, starts)
        active = np.repeat(lowest < none, lengths)
        if not active.all():
            done_ids.append(symbols[~active])
            done_owner.append(owner[~active])
            rank, symbols, owner = rank[active], symbols[active], owner[active]
            if not len(symbols):
                break
            keep = lowest < none
            lowest, lengths = lowest[keep], lengths[keep]
        merge = rank == np.repeat(lowest, lengths)
        # in a run such as a a a, every second pair from the left is merged
        run = np.flatnonzero(merge & ~np.append(False, merge[:-1]))
        place = np.arange(len(merge))
        since = place - run[np.maximum(np.cumsum(np.append(False, merge[:-1]) < merge) - 1, 0)] if len(run) else place
        merge &= since % 2 == 0
        symbols = symbols.copy()
        symbols[merge] = v.made_by_rank[rank[merge]]
        keep = ~np.append(False, merge[:-1])
        symbols, owner = symbols[keep], owner[keep]
    if not done_ids:
        return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
    ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(words))
    return ids[order], np.append(0, np.cumsum(counts))


def find_words(text: str) -> list[str]:
    """The words of a text without special strings."""
    try:
        text.isascii() or text.encode("latin-1")
    except UnicodeEncodeError:
        return WORDS.findall(text)
    return LATIN_WORDS.findall(text)


def split_words(v: Vocabulary, texts: list[str]) -> tuple[list[str], list[int]]:
    """The words of all texts in order, and how many each text has.

    A special string stands in the list as a word of its own.
    """
    words: list[str] = []
    counts = []
    for t in texts:
        before = len(words)
        for part, special in v.pieces_of(t):
            words += find_words(part)
            if special >= 0:
                words.append(v.bytes_of[special].decode())
        counts.append(len(words) - before)
    return words, counts


def gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """data[start : start + size] of every row, one after the other."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return data[:0]
    return data[np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)]


class Encoder:
    """Encodes texts; remembers the ids of up to ``CACHE_WORDS`` words.

    ``places`` gives a word's row in ``starts`` and ``sizes``, which point
    into the flat array ``ids``.
    """

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self._reset()

    def _reset(self) -> None:
        self.places = {s: k for k, s in enumerate(self.v.special)}
        self.ids = np.array(list(self.v.special.values()), np.int32)
        self.sizes = np.ones(len(self.places), np.int64)
        self.starts = np.arange(len(self.places))

    def learn(self, words: list[str]) -> None:
        if len(self.places) > CACHE_WORDS:
            self._reset()
        fresh = list(set(words).difference(self.places))
        if not fresh:
            return
        ids, at = merge_words(self.v, [w.encode() for w in fresh])
        self.places.update(zip(fresh, range(len(self.places), len(self.places) + len(fresh)), strict=True))
        self.starts = np.concatenate([self.starts, at[:-1] + len(self.ids)])
        self.sizes = np.concatenate([self.sizes, np.diff(at)])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one flat array, and each text's offsets in it."""
        words, counts = split_words(self.v, texts)
        self.learn(words)
        rows = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        sizes = self.sizes[rows]
        ends = np.append(0, np.cumsum(sizes))
        return gather(self.ids, self.starts[rows], sizes), ends[np.append(0, np.cumsum(counts))]


class Decoder:
    """Token bytes gathered for whole id arrays at a time."""

    def __init__(self, v: Vocabulary) -> None:
        self.data = np.frombuffer(b"".join(v.bytes_of), np.uint8)
        self.sizes = np.fromiter(map(len, v.bytes_of), np.int64, v.size)
        self.starts = np.append(0, np.cumsum(self.sizes))[:-1]

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.data, self.starts[ids], self.sizes[ids]).tobytes()


def _texts(piece: pa.RecordBatch, column: str) -> list[str]:
    return [t or "" for t in piece.column(piece.schema.get_field_index(column)).to_pylist()]


def encode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids) for every row. Null text counts as empty and gives no ids.

    Repeated rows and keys give a row each; other columns are not read.
    """
    tables = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tables.value)
        for batch in batches:
            for piece in pieces(batch, "text"):
                ids, at = encoder.encode(_texts(piece, "text"))
                yield pa.record_batch([piece.column(0), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))], names=["key", "ids"])

    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(rows: DataFrame, path: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """(key, text) from an array column of ids; null ids give null text.

    Bytes that are not valid UTF-8 become the replacement character.
    """
    tables = rows.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(tables.value)
        for batch in batches:
            got = [None if x is None else decoder.decode(np.asarray(x, np.int64)).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(got, pa.string())], names=["key", "text"])

    source = rows.select(rows[key].alias("key"), rows[ids].alias("ids"))
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)


def round_trip(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encodes and decodes every text: key, n_tokens, ids_sha256, decoded_sha256, exact.

    One pass without a shuffle. Empty and null texts have no tokens; their
    digests are those of the empty string. ``exact`` says that the decoded
    bytes are the text's. Repeated rows give a row each.
    """
    tables = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = tables.value
        encoder, decoder = Encoder(v), Decoder(v)
        decimal = [str(i).encode() for i in range(v.size)]
        sha = hashlib.sha256
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = _texts(piece, "text")
                n, of_ids, of_text, exact = [], [], [], []
                flat_ids, at = encoder.encode(texts)
                for t, lo, hi in zip(texts, at[:-1].tolist(), at[1:].tolist(), strict=True):
                    ids = flat_ids[lo:hi]
                    n.append(len(ids))
                    of_ids.append(sha(b",".join(map(decimal.__getitem__, ids.tolist()))).hexdigest())
                    back = decoder.decode(ids).decode("utf-8", "replace")
                    of_text.append(sha(back.encode()).hexdigest())
                    exact.append(back == t)
                yield pa.record_batch([piece.column(0), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_text), pa.array(exact)], names=["key", "n_tokens", "ids_sha256", "decoded_sha256", "exact"])

    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, exact boolean").withColumnRenamed("key", key)
