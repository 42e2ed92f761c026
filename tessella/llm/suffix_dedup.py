"""Exact removal of byte passages that an earlier document already has.

Every byte that a passage of ``length`` bytes covers is removed if the same
passage starts in a document with a smaller key.

Which passages can be equal is settled by content: each passage belongs to
the least hash among its k-mers, and neighbouring passages with the same least
k-mer form one stretch of text. Equal passages have the same least k-mer, so
the stretches that share one, from whatever documents, form a group.

* Stretches that are equal as a whole need no sorting: all but those of the
  smallest key go.
* Groups with different stretches, at the edges of copied text, are decided
  by suffix arrays. Whole groups fill a shard; its suffixes are classified as
  smaller or larger than their successor, the leftmost-smaller substrings are
  sorted and named, their order is found recursively, and the rest is induced
  from it in linear passes. Common prefixes, computed in text order, split the
  array into classes of equal passages, each with its smallest key.
* A group that a shard could not hold is split exactly: its passages are dealt
  by their own hash, and the smallest key of each is taken map-side.

Induction is written for arrays. Where buckets are large, the suffixes of one
bucket are worked off together, round by round, in the order in which a scan
would meet them. The names of substrings have an alphabet that grows with the
shard, so that buckets hold few suffixes: there all buckets are induced together, by
the runs that lead from a suffix to the one that it is induced from.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.shared import PrefixHash, flat, materialize, mix, pieces, release

LENGTH = 50
KMER = 20
SHARD_BYTES = 1 << 20
FILTER_BITS = (20, 28)
REMEMBERED = 200_000
#: Text whose passages are listed at once, with 40 bytes for each.
PASSAGE_BYTES = 1 << 17
#: Passages of a stretch: at most so many neighbours can share their least k-mer.
MOST = LENGTH - KMER + 1

# ---------------------------------------------------------------- suffix arrays


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it; the last counts as such."""
    n = len(t)
    differs = np.append(t[:-1] != t[1:], True)
    # the next place where neighbours differ decides
    place = np.where(differs, np.arange(n), n)
    place = np.minimum.accumulate(place[::-1])[::-1]
    after = np.minimum(place + 1, n - 1)
    smaller = t[place] < t[after]
    smaller[place == n - 1] = True
    return smaller


def _hand_out(queues: dict[int, list[np.ndarray]], symbols: np.ndarray, suffixes: np.ndarray) -> None:
    """Append each suffix to its symbol's queue, in order."""
    # numpy sorts numbers of 16 bits by radix
    order = np.argsort(symbols.astype(np.uint16), kind="stable")
    symbols, suffixes = symbols[order], suffixes[order]
    cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    for part, at in zip(np.split(suffixes, cuts), np.append(0, cuts), strict=True):
        if len(part):
            queues.setdefault(int(symbols[at]), []).append(part)


def _induce(t: np.ndarray, smaller: np.ndarray, seeds: dict[int, np.ndarray], symbols: list[int]) -> np.ndarray:
    """The order of all suffixes that follows from the order of the seeds in their buckets."""
    none = np.zeros(0, np.int64)
    large: dict[int, np.ndarray] = {}
    queues: dict[int, list[np.ndarray]] = {}
    for c in symbols:
        done = []
        front = np.concatenate(queues.pop(c)) if c in queues else none
        while len(front):
            done.append(front)
            before = front[front > 0] - 1
            before = before[~smaller[before]]
            same = t[before] == c
            _hand_out(queues, t[before[~same]], before[~same])
            front = before[same]
        large[c] = np.concatenate(done) if done else none
        if c in seeds:
            before = seeds[c][seeds[c] > 0] - 1
            before = before[~smaller[before]]
            _hand_out(queues, t[before], before)
    out = []
    queues = {}
    last = len(t) - 1
    for c in reversed(symbols):
        done = [np.array([last])] if c == t[last] else []
        front = np.concatenate([*(done if done else []), *queues.pop(c, [])]) if done or c in queues else none
        done = []
        while len(front):
            done.append(front)
            before = front[front > 0] - 1
            before = before[smaller[before]]
            same = t[before] == c
            _hand_out(queues, t[before[~same]], before[~same])
            front = before[same]
        before = large[c][::-1]
        before = before[before > 0] - 1
        before = before[smaller[before]]
        _hand_out(queues, t[before], before)
        small = np.concatenate(done)[::-1] if done else none
        out.append(np.concatenate([large[c], small]))
    return np.concatenate(out[::-1])


def _dense(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the rank of each number among the different ones, the order of the numbers)."""
    order = np.argsort(key)
    inorder = key[order]
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(np.append(0, inorder[1:] != inorder[:-1]))
    return out, order


def _runs_of_kind(t: np.ndarray, smaller: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank of each suffix's run, place of the run's end).

    A run is the symbols from a suffix to the next one of the other kind. At
    one symbol, larger suffixes come before smaller ones, so of two runs that
    agree until one ends, the kinds there decide.
    """
    n = len(t)
    place = np.arange(n)
    last = np.where(np.append(smaller[1:] != smaller[:-1], True), place, n)
    end = np.minimum(np.minimum.accumulate(last[::-1])[::-1] + 1, n - 1)
    code = 2 * t + smaller
    width = int(code.max() + 1).bit_length()
    have = max(1, 62 // width)
    padded = np.append(code + 1, np.zeros(have, np.int64))
    left = end - place
    key = code + 1
    for k in range(1, have):
        key = (key << width) + np.where(k <= left, padded[k : k + n], 0)
    rank, order = _dense(key)
    longest = int(left.max()) + 1
    while have < longest:
        # runs longer than the symbols ranked so far go on with the rank of their rest, or with their end's symbol
        floor = np.zeros(int(code.max()) + 1, np.int64)
        floor[code[order[::-1]]] = rank[order[::-1]]
        there = np.minimum(place + have, n - 1)
        rest = np.where(have < left, rank[there] + 1, np.where(have == left, floor[code[there]] + 1, 0))
        rank, order = _dense(rank * (n + 1) + rest)
        have *= 2
    return rank, end


def _by_runs(t: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffix array where buckets hold few suffixes each: all buckets are induced together.

    A larger suffix stands by its run down to a leftmost-smaller one and that
    one's place; a smaller suffix by its run up to a larger one and that one's.
    """
    n = len(t)
    rank, end = _runs_of_kind(t, smaller)
    names, order = _dense(rank[lms] * (n + 1) + rank[end[lms]])
    if names.max() < len(lms) - 1:
        order = suffix_array(names)
    place = np.zeros(n, np.int64)
    place[lms[order]] = np.arange(len(lms))
    large, small = np.flatnonzero(~smaller), np.flatnonzero(smaller)
    large = large[np.argsort(rank[large] * (n + 1) + place[end[large]])]
    place[large] = np.arange(len(large))
    small = small[np.argsort(rank[small] * (n + 1) + place[end[small]])]
    # in a bucket, larger suffixes come first
    counts = np.bincount(2 * t + smaller)
    kinds = np.repeat(np.arange(len(counts)) & 1, counts)
    out = np.empty(n, np.int64)
    out[kinds == 0], out[kinds == 1] = large, small
    return out


#: Suffixes for each symbol from which buckets are worked off one after the other.
BUCKET = 256


def suffix_array(t: np.ndarray) -> np.ndarray:
    """The suffix array of ``t``, whose last symbol must be its only least one."""
    if len(t) < 2:
        return np.arange(len(t))
    symbols = np.flatnonzero(np.bincount(t)).tolist()
    smaller = _types(t)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(symbols) * BUCKET > len(t) or symbols[-1] >= 1 << 16:
        return _by_runs(t, smaller, lms)

    def seeds(order: np.ndarray) -> dict[int, np.ndarray]:
        queues: dict[int, list[np.ndarray]] = {}
        _hand_out(queues, t[order], order)
        return {c: np.concatenate(q) for c, q in queues.items()}

    if len(lms) < 2:
        return _induce(t, smaller, seeds(lms), symbols)
    # any order of the seeds sorts the substrings between them
    rough = _induce(t, smaller, seeds(lms), symbols)
    leading = np.zeros(len(t), bool)
    leading[lms] = True
    rough = rough[leading[rough]]
    # equal neighbours get one name: substrings end with the next leading position
    number = np.zeros(len(t), np.int64)
    number[lms] = np.arange(len(lms))
    ends = np.minimum(np.append(lms[1:], len(t) - 1) + 1, len(t))
    k = number[rough]
    size = ends[k] - rough
    # neighbours of one length are compared symbol by symbol
    equal = size[:-1] == size[1:]
    pair = np.flatnonzero(equal)
    if len(pair):
        begin = np.cumsum(size[pair]) - size[pair]
        step = np.arange(int(size[pair].sum())) - np.repeat(begin, size[pair])
        same = t[np.repeat(rough[pair], size[pair]) + step] == t[np.repeat(rough[pair + 1], size[pair]) + step]
        equal[pair] = np.logical_and.reduceat(same, begin)
    names = np.zeros(len(lms), np.int64)
    names[k] = np.append(0, np.cumsum(~equal))
    order = np.argsort(names) if names.max() == len(lms) - 1 else suffix_array(names)
    return _induce(t, smaller, seeds(lms[order]), symbols)


def permuted_prefixes(t: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each suffix in text order, the prefix that it shares with its predecessor in ``sa``, up to ``most``.

    Symbols are less than 512.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    # seven symbols of nine bits to a word; a pair leaves at the first word that differs
    each = 64 // 9
    padded = np.concatenate([t.astype(np.uint64), np.zeros(most + 2 * each, np.uint64)])
    words = np.zeros(n + most + each, np.uint64)
    for k in range(each):
        words |= padded[k : k + len(words)] << np.uint64(9 * k)
    out = np.zeros(n, np.int64)
    at = np.flatnonzero(before >= 0)
    for k in range(0, most, each):
        x = words[at + k] ^ words[before[at] + k]
        differs = x != 0
        x = x[differs]
        low = np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        out[at[differs]] = k + low // 9
        at = at[~differs]
    out[at] = most
    # a suffix that ends within the prefix differs at the unique last symbol
    return np.minimum(out, most)


def least_keys(data: np.ndarray, sizes: np.ndarray, keys: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, place in it, smallest key among parts that hold the passage) of every passage of parts that follow each other in ``data``."""
    t = np.full(len(data) + len(sizes) + 1, 1, np.int64)
    starts = np.append(0, np.cumsum(sizes + 1))[:-1]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(data)) + owner
    t[place] = data.astype(np.int64) + 2
    t[-1] = 0
    sa = suffix_array(t)
    shared = permuted_prefixes(t, sa, length)[sa]
    own = np.full(len(t), np.iinfo(np.int64).max)
    own[place] = keys[owner]
    first = np.flatnonzero(shared < length)
    least = np.minimum.reduceat(own[sa], first)
    answer = np.empty(len(t), np.int64)
    answer[sa] = np.repeat(least, np.diff(np.append(first, len(t))))
    count = np.maximum(0, sizes - length + 1)
    part = np.repeat(np.arange(len(sizes)), count)
    off = np.arange(len(part)) - np.repeat(np.cumsum(count) - count, count)
    return part, off, answer[starts[part] + off]


def earliest(parts: list[bytes], keys: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each passage start of each part, the smallest key among parts that hold the passage."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    part, _, least = least_keys(np.frombuffer(b"".join(parts), np.uint8), sizes, keys, length)
    return np.split(least, np.cumsum(np.bincount(part, minlength=len(parts)))[:-1]) if parts else []


# ---------------------------------------------------------------- stretches


def stretches(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, k: int = KMER) -> tuple[np.ndarray, ...]:
    """(text, first, passages, group, content) of every stretch, first counted in ``data``.

    ``group`` is the hash of the least k-mer of its passages, ``content`` that
    of all its bytes.
    """
    none = np.zeros(0, np.int64)
    n, w = len(data), length - k + 1
    if n < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    hashes = PrefixHash(data)
    h = hashes.windows(k)
    bits = np.uint64(max(20, int(n).bit_length()))
    # the place in the low bits lets the leftmost of equal k-mers win
    key = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)
    least, have = key, 1
    while have * 2 <= w:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < w:
        least = np.minimum(least[: len(least) - (w - have)], least[w - have :])
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(at)]
    whole = np.flatnonzero(np.arange(length, length + len(at)) <= np.repeat(offsets[1:], np.diff(offsets))[: len(at)])
    if not len(whole):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    at, text = at[whole], text[whole]
    new = np.append(True, (at[1:] != at[:-1]) | (text[1:] != text[:-1]))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(whole)))
    begin = whole[first]
    return text[first], begin, count, h[at[first]], hashes.of(begin, begin + count + length - 1) ^ mix(count.astype(np.uint64))


def _tags(piece: pa.RecordBatch, text: np.ndarray) -> list[np.ndarray]:
    """The tag of the row of each text, if rows have one: a column of its own."""
    return [piece.column(2).to_numpy(zero_copy_only=False)[text]] if piece.num_columns > 2 else []


def _tagged(columns: list[str], tags: list) -> list[str]:
    return [*columns, "tag"] if tags else columns


#: Beside the number of passages: a smaller key has the same stretch, whatever the other tasks hold.
GONE = 128


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows h, c, key, at (and tag) of every stretch.

    Of equal stretches in one piece of the table, those of larger keys are
    sure to go. They need not meet their group: they are marked and dealt by
    their own place, so that a passage that very many documents share sends
    its group few rows from each task.
    """
    for batch in batches:
        for piece in pieces(batch, "text"):
            data, offsets = flat(piece.column(1))
            text, first, count, group, content = stretches(data, offsets)
            key = piece.column(0).to_numpy(zero_copy_only=False)[text].astype(np.int64)
            at = ((first - offsets[text]) << 8) | count
            tags = _tags(piece, text)
            h, c = group.view(np.int64), content.view(np.int64)
            order = np.argsort(c, kind="stable")
            run = np.append(True, (c[order][1:] != c[order][:-1]) | (h[order][1:] != h[order][:-1])) if len(order) else np.zeros(0, bool)
            starts = np.flatnonzero(run)
            if len(starts) < len(order):
                least = np.minimum.reduceat(key[order], starts)
                gone = order[key[order] > np.repeat(least, np.diff(np.append(starts, len(order))))]
                at[gone] |= GONE
                h[gone] = mix(key[gone].view(np.uint64) ^ mix(at[gone].view(np.uint64))).view(np.int64)
            yield pa.record_batch([pa.array(x) for x in (h, c, key, at, *tags)], names=_tagged(["h", "c", "key", "at"], tags))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by h, c, key, at. Gives removals (key, a, b, and the row's tag), from a to b, h null;
    and for groups with several contents (h, key = c, a = smallest key, b null)."""
    last_h = last_c = last_key = None
    first: tuple | None = None
    several = False
    for batch in batches:
        h, c, key, at, *tags = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
        names = _tagged(["h", "key", "a", "b"], tags)
        sure = at & GONE != 0
        if sure.any():
            start = at[sure] >> 8
            yield pa.record_batch([pa.nulls(len(start), pa.int64()), *(pa.array(x) for x in (key[sure], start, start + (at[sure] & (GONE - 1)) + LENGTH - 1, *(t[sure] for t in tags)))], names=names)
            h, c, key, at, *tags = (x[~sure] for x in (h, c, key, at, *tags))
        n = len(h)
        if not n:
            continue
        new_h = np.append(h[0] != last_h, h[1:] != h[:-1])
        new_c = new_h | np.append(c[0] != last_c, c[1:] != c[:-1])
        runs = np.flatnonzero(new_c)
        # smallest key of each run; the run that goes on from the last batch has its own
        least = np.zeros(n, np.int64)
        if not new_c[0]:
            least[: runs[0] if len(runs) else n] = last_key
        if len(runs):
            sizes = np.diff(np.append(runs, n))
            least[runs[0] :] = np.repeat(key[runs], sizes)
        gone = np.flatnonzero(key > least)
        start, count = at[gone] >> 8, at[gone] & 255
        yield pa.record_batch([pa.nulls(len(gone), pa.int64()), *(pa.array(x) for x in (key[gone], start, start + count + LENGTH - 1, *(t[gone] for t in tags)))], names=names)
        # groups with more than one run of contents
        h_of, c_of, k_of, is_new = h[runs], c[runs], key[runs], new_h[runs]
        if len(runs):
            begin = np.flatnonzero(is_new)
            open_ = int(begin[0]) if len(begin) else len(runs)
            rows = []
            if open_:  # runs that belong to the group left open
                if not several and first is not None:
                    rows.append(first)
                several = True
                rows += list(zip(h_of[:open_].tolist(), c_of[:open_].tolist(), k_of[:open_].tolist(), strict=True))
            sizes = np.diff(np.append(begin, len(runs)))
            many = np.repeat(sizes > 1, sizes)
            tail = slice(int(begin[0]), None) if len(begin) else slice(0, 0)
            hh, cc, kk = h_of[tail][many], c_of[tail][many], k_of[tail][many]
            if len(begin):
                several = bool(sizes[-1] > 1)
                g = int(begin[-1])
                first = (int(h_of[g]), int(c_of[g]), int(k_of[g]))
            more = np.array(rows, np.int64).reshape(-1, 3)
            hh, cc, kk = np.append(more[:, 0], hh), np.append(more[:, 1], cc), np.append(more[:, 2], kk)
            yield pa.record_batch([pa.array(hh), pa.array(cc), pa.array(kk), *[pa.nulls(len(hh), pa.int64())] * (1 + len(tags))], names=names)
        last_h, last_c, last_key = h[-1], c[-1], int(least[-1])


def _slots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix(h.view(np.uint64))
    return (x >> np.uint64(64 - bits)).astype(np.int64), (x & np.uint64((1 << bits) - 1)).astype(np.int64)


def _filter(groups: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of 2**bits bits over the column h; at most 2**bits / 8 bytes reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(1 << (bits - 6), np.int64)
        for batch in batches:
            for s in _slots(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), bits):
                np.bitwise_or.at(words, s >> 6, np.left_shift(np.int64(1), s & 63))
        some = np.flatnonzero(words)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(words[some])], names=["w", "bits"])

    table = groups.mapInArrow(run, "w int, bits long").groupBy("w").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[table.column("w").to_numpy()] = table.column("bits").to_numpy()
    return out


def _passes(words: np.ndarray, bits: int, h: np.ndarray) -> np.ndarray:
    hit = np.ones(len(h), bool)
    for s in _slots(h, bits):
        hit &= (words[s >> 6] >> (s & 63)) & 1 == 1
    return hit


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by h: h, c, least, s. Gives h, c, from, count of each run of a stretch's passages that smaller keys hold."""

    def work(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        h, c, own = (np.concatenate([r.column(i).to_numpy(zero_copy_only=False) for r in rows]) for i in range(3))
        sizes = np.concatenate([pc.binary_length(r.column(3)).to_numpy(zero_copy_only=False) for r in rows]).astype(np.int64)
        data = np.frombuffer(b"".join(x for r in rows for x in r.column(3).to_pylist()), np.uint8)
        part, off, least = least_keys(data, sizes, own)
        cut = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | (part[1:] != part[:-1]))) if len(part) else part
        count = np.diff(np.append(cut, len(part)))
        # later rows of the same content are gone as a whole
        earlier = least[cut] < own[part[cut]]
        cut, count = cut[earlier], count[earlier]
        return pa.record_batch([pa.array(x) for x in (h[part[cut]], c[part[cut]], off[cut], count)], names=["h", "c", "off", "count"])

    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch.column(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(pc.binary_length(batch.column(3)).to_numpy(zero_copy_only=False).astype(np.int64))
        new = np.flatnonzero(np.append(h[0] != last, h[1:] != h[:-1]))
        low = done = 0
        while True:
            # the first group that begins when the shard is full
            full = np.searchsorted(np.append(0, ends), SHARD_BYTES - size + done, side="right")
            k = np.searchsorted(new, max(int(full), low + (not held)))
            if k == len(new):
                break
            high = int(new[k])
            held.append(batch.slice(low, high - low))
            yield work(held)
            held, size, low = [], 0, high
            done = int(ends[high - 1]) if high else 0
        held.append(batch.slice(low))
        size += int(ends[-1]) - done
        last = h[-1]
    if held:
        yield work(held)


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows h, c, least, s. Gives h, passage's hash, c, place in the stretch, least of every passage."""
    for batch in batches:
        for piece in pieces(batch, "s", PASSAGE_BYTES):
            sizes = pc.binary_length(piece.column(3)).to_numpy(zero_copy_only=False).astype(np.int64)
            data = np.frombuffer(b"".join(piece.column(3).to_pylist()), np.uint8)
            count = np.maximum(0, sizes - LENGTH + 1)
            row = np.repeat(np.arange(len(sizes)), count)
            off = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = (np.cumsum(sizes) - sizes)[row] + off
            p = PrefixHash(data).of(start, start + LENGTH).view(np.int64)
            h, c, least = (piece.column(i).to_numpy(zero_copy_only=False)[row] for i in range(3))
            yield pa.record_batch([pa.array(x) for x in (h, p, c, off, least)], names=["h", "p", "c", "off", "least"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows h, c, mask, a bit for each place. Gives h, c, from, count of each run of bits."""
    for batch in batches:
        h, c, mask = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        on = np.zeros((len(mask), MOST + 2), np.int8)
        on[:, 1:-1] = (mask[:, None] >> np.arange(MOST)) & 1
        edge = np.diff(on, axis=1)
        row, start = np.nonzero(edge == 1)
        end = np.nonzero(edge == -1)[1]
        yield pa.record_batch([pa.array(x) for x in (h[row], c[row], start, end - start)], names=["h", "c", "off", "count"])


def split_runs(rows: DataFrame) -> DataFrame:
    """What ``_shards`` gives, for rows (h, c, least, s) of groups of any size.

    Passages meet by group and hash, so a group spreads over all tasks. A
    passage that many contents hold is one row of ``first`` for each task
    before the shuffle; its rows on the other side of the join can be divided.
    """
    passages = rows.select("h", "c", "least", "s").mapInArrow(_passages, "h long, p long, c long, off long, least long")
    first = passages.groupBy("h", "p").agg(F.min("least").alias("first"))
    gone = passages.join(first, ["h", "p"]).where("first < least")
    masks = gone.groupBy("h", "c").agg(F.bit_or(F.expr("shiftleft(1L, cast(off as int))")).alias("mask"))
    return masks.mapInArrow(_runs, "h long, c long, off long, count long")


def removals(docs: DataFrame) -> DataFrame:
    """(key, a, b, and tag): byte ranges to remove, unmerged. ``docs`` has key (long), text and, if keys repeat, a tag for each text."""
    scratch: list[str] = []
    own = docs.columns[2:]
    tag = "".join(f", {c} long" for c in own)
    source = docs.where("key is not null")
    posted = source.mapInArrow(_post, f"h long, c long, key long, at long{tag}")
    swept = materialize(posted.repartition("h").sortWithinPartitions("h", "c", "key", "at").mapInArrow(_sweep, f"h long, key long, a long, b long{tag}"))
    whole = swept.where("h is null").select("key", "a", "b", *own)
    contents = swept.where("h is not null").select("h", F.col("key").alias("c"), F.col("a").alias("least"))
    sizes = materialize(contents.groupBy("h").agg(F.count("*").alias("contents")), scratch)
    # no content is longer than that
    large = sizes.where(F.col("contents") * (MOST + LENGTH - 1) > SHARD_BYTES).select("h")
    n = sizes.count()
    bits = min(FILTER_BITS[1], max(FILTER_BITS[0], (10 * n).bit_length()))
    words = docs.sparkSession.sparkContext.broadcast(_filter(sizes.select("h"), bits))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[tuple[int, int]] = set()
        for batch in batches:
            for piece in pieces(batch, "text"):
                data, offsets = flat(piece.column(1))
                text, first, count, group, content = stretches(data, offsets)
                h, c = group.view(np.int64), content.view(np.int64)
                at = np.flatnonzero(_passes(words.value, bits, h))
                if len(told) > REMEMBERED:
                    told.clear()
                raw = data.tobytes()
                s = []
                begin, end = first[at], first[at] + count[at] + LENGTH - 1
                for pair, a, b in zip(zip(h[at].tolist(), c[at].tolist(), strict=True), begin.tolist(), end.tolist(), strict=True):
                    if pair in told:
                        s.append(None)
                    else:
                        told.add(pair)
                        s.append(raw[a:b])
                keys = piece.column(0).to_numpy(zero_copy_only=False)
                tags = _tags(piece, text[at])
                yield pa.record_batch([pa.array(h[at]), pa.array(c[at]), pa.array(keys[text[at]].astype(np.int64)), pa.array((first - offsets[text])[at]), pa.array(s, pa.binary()), *map(pa.array, tags)], names=_tagged(["h", "c", "key", "start", "s"], tags))

    fetched = materialize(source.mapInArrow(fetch, f"h long, c long, key long, start long, s binary{tag}"), scratch)
    bytes_of = fetched.where("s is not null").groupBy("h", "c").agg(F.first("s").alias("s"))
    shard_rows = contents.join(bytes_of, ["h", "c"]).select("h", "c", "least", "s")
    several = large.limit(1).count() > 0
    if several:
        shard_rows = materialize(shard_rows.join(large.withColumn("large", F.lit(True)), "h", "left"), scratch)
    small = shard_rows.where("large is null").drop("large") if several else shard_rows
    small = small.repartition("h").sortWithinPartitions("h", "c")
    # only what an earlier content explains matters to later keys
    runs = materialize(small.mapInArrow(_shards, "h long, c long, off long, count long"), scratch)
    if several:
        runs = runs.union(materialize(split_runs(shard_rows.where("large")), scratch))
    edges = fetched.select("h", "c", "key", "start", *own).join(runs, ["h", "c"])
    edges = edges.select("key", (F.col("start") + F.col("off")).alias("a"), (F.col("start") + F.col("off") + F.col("count") + LENGTH - 1).alias("b"), *own)
    return whole.union(edges)


def dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", with_text: bool = False) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes left) of every row.

    Texts are UTF-8 bytes; null counts as empty. Keys are whole numbers; a
    null key is compared with nothing and loses nothing. Rows that share a key
    are of one age: neither removes from the other.
    """
    source = docs.select(docs[key].cast("long").alias("key"), F.coalesce(docs[text], F.lit("")).alias("text"))
    twice = source.where("key is not null").groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").limit(1).count()
    # where keys repeat, a 64-bit hash of the text tells their rows apart; rows with one key and one text lose the same
    row = ["key", "tag"] if twice else ["key"]
    source = source.withColumn("tag", F.xxhash64("text")) if twice else source
    spans = removals(source).groupBy(*row).agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    joined = source.join(spans, row, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, t, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                raw = t.encode()
                merged: list[list[int]] = []
                if s.is_valid and len(s.values):
                    a, b = (np.asarray(x) for x in (s.values.field(0), s.values.field(1)))
                    order = np.argsort(a, kind="stable")
                    a, b = a[order], np.maximum.accumulate(b[order])
                    cut = np.flatnonzero(np.append(True, a[1:] > b[:-1]))
                    merged = [[x, y] for x, y in zip(a[cut].tolist(), b[np.append(cut[1:] - 1, len(b) - 1)].tolist(), strict=True)]
                kept, last = [], 0
                for x, y in merged:
                    kept.append(raw[last:x])
                    last = y
                left = b"".join([*kept, raw[last:]])
                rows.append((k, len(raw), len(raw) - len(left), len(merged), hashlib.sha256(left).hexdigest(), left if with_text else None))
            columns = [list(x) for x in zip(*rows, strict=True)] if rows else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.record_batch([pa.array(x, y) for x, y in zip(columns, kinds, strict=True)], names=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = joined.select("key", "text", "spans").mapInArrow(run, "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    out = out.withColumnRenamed("key", key)
    return out if with_text else out.drop("kept")
