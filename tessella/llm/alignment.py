"""Token groups on which two tokenizers agree, and how often they pair ids.

Tokenizer A is a byte-level BPE vocabulary, B a piece model. Both run over a
space and the text. Every byte carries a label: no token ends there, one of A,
one of B, or one of both. A regular expression scans the labels for the spans
up to each "both"; the labels in a span say how many tokens of either side
form the group, and the span's last two tokens are linked.

A text is cut where a space follows something other than white space. No word
of A and no piece of B crosses such a place, so a segment's groups are the
same wherever it stands: a task aligns each distinct segment once and keeps
it in a cache of bounded size.

Links are counted over the whole corpus by one aggregation that combines
map-side. The most frequent id pairs, at most ``HEAD`` of them, are broadcast
and looked up in place; all others meet their counts in a join, so neither a
frequent pair nor the number of pairs weighs on one task.
"""

from __future__ import annotations

import copy
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.bpe import Encoder, Vocabulary, _texts, gather
from tessella.llm.shared import materialize, pieces

NONE, A_END, B_END, BOTH = 0, 1, 2, 3
#: One group: whatever ends before the next place where both end, and that place.
SPAN = re.compile(rb"[^\x03]*\x03", re.DOTALL)
CUT = re.compile(r"(?<=\S) ")
ODD_SPACE = re.compile(r"^ |\s ")
#: Entries of the cache of a task, and the longest segment that it keeps.
CACHE_SEGMENTS = 400_000
LONG_SEGMENT = 400
#: Id pairs whose counts are broadcast, at most.
HEAD = 1 << 20


class PieceModel:
    """Encodes with a piece model and knows the bytes of its pieces."""

    def __init__(self, proto: bytes) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.size = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(self.size)]
        #: No piece goes on with a space after something else, so texts can be cut there.
        self.cuts = "▁" in names and not any(re.search("[^▁]▁", n) for n in names)
        self.space = [self.model.piece_to_id("▁")]
        bytes_of = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.data = np.frombuffer(b"".join(bytes_of), np.uint8)
        self.sizes = np.fromiter(map(len, bytes_of), np.int64, self.size)
        self.starts = np.append(0, np.cumsum(self.sizes))[:-1]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a space and each text in one flat array, and each text's offsets in it."""
        found = [ids or self.space for ids in self.model.encode(texts, out_type=int, num_threads=1)]
        ends = np.append(0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found))))
        return np.fromiter((i for ids in found for i in ids), np.int64, int(ends[-1])), ends


def plain(v: Vocabulary) -> Vocabulary:
    """The vocabulary without special tokens: their strings are ordinary text."""
    v = copy.copy(v)
    v.special = {}
    return v


def label_string(size: int, a_ends: np.ndarray, b_ends: np.ndarray) -> bytes:
    """A label for each byte; ends are places after a token's last byte."""
    labels = np.zeros(size, np.uint8)
    labels[a_ends - 1] |= A_END
    labels[b_ends - 1] |= B_END
    return labels.tobytes()


class Aligner:
    """Aligns texts; remembers the groups of up to ``CACHE_SEGMENTS`` segments."""

    def __init__(self, v: Vocabulary, proto: bytes) -> None:
        self.v, self.a, self.b = v, Encoder(v), PieceModel(proto)
        self.a_sizes = np.fromiter(map(len, v.bytes_of), np.int64, v.size)
        self._reset()

    def _reset(self) -> None:
        self.places: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.numbers = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups, 1 if the bytes differ
        self.links, self.starts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def segments(self, text: str) -> list[str]:
        """The segments of a space and the text, each without its first space."""
        if not self.b.cuts:
            return [text]
        return CUT.split(text) if ODD_SPACE.search(text) else text.split(" ")

    def _align(self, fresh: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Group texts, numbers and links of segments that the cache lacks."""
        whole = [" " + s for s in fresh]
        raw = [s.encode() for s in whole]
        data = np.frombuffer(b"".join(raw), np.uint8)
        at = np.append(0, np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw))))
        a_ids, a_at = self.a.encode(whole)
        b_ids, b_at = self.b.encode(fresh)
        a_ends, b_sizes = np.cumsum(self.a_sizes[a_ids]), self.b.sizes[b_ids]
        b_bytes = gather(self.b.data, self.b.starts[b_ids], b_sizes)
        b_bounds = np.append(0, np.cumsum(b_sizes))[b_at]
        same = np.diff(b_bounds) == np.diff(at)
        if len(b_bytes) == len(data) and same.all() and np.array_equal(b_bytes, data):
            bad = ~same
        else:
            bad = np.array([not ok or not np.array_equal(b_bytes[b_bounds[k] : b_bounds[k + 1]], data[at[k] : at[k + 1]]) for k, ok in enumerate(same)], bool)
        # a segment whose bytes differ shows one group at its end and counts for nothing
        b_shift = np.repeat(at[:-1] - b_bounds[:-1], np.diff(b_at))
        usable = ~np.repeat(bad, np.diff(b_at))
        b_ends = (np.cumsum(b_sizes) + b_shift)[usable]
        labels = label_string(len(data), a_ends, np.append(b_ends, at[1:][bad]))
        a_text, b_text = list(map(str, a_ids.tolist())), list(map(str, b_ids[usable].tolist()))
        texts, numbers, links = [], np.zeros((len(fresh), 4), np.int64), []
        numbers[:, 0], numbers[:, 1], numbers[:, 3] = np.diff(a_at), np.diff(b_at), bad
        i = j = segment = 0
        parts: list[str] = []
        a_list, b_list, size_b = a_ids.tolist(), b_ids[usable].tolist(), self.b.size
        ends, wrong = at[1:].tolist(), bad.tolist()
        for m in SPAN.finditer(labels):
            label = m.group()
            na = 1 + label.count(b"\x01")
            if wrong[segment]:
                nb = 0
            else:
                nb = 1 + label.count(b"\x02")
                parts.append(",".join(a_text[i : i + na]) + "|" + ",".join(b_text[j : j + nb]))
                links.append(a_list[i + na - 1] * size_b + b_list[j + nb - 1])
            i, j = i + na, j + nb
            if m.end() == ends[segment]:
                texts.append(";".join(parts).encode())
                numbers[segment, 2] = len(parts)
                parts, segment = [], segment + 1
        return texts, numbers, np.array(links, np.int64)

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """(numbers, digests, links, owners): links of all texts in one array, each with its text's index."""
        words: list[str] = []
        counts = []
        for t in texts:
            found = self.segments(t) if t else []
            words += found
            counts.append(len(found))
        if len(self.places) > CACHE_SEGMENTS:
            self._reset()
        fresh = list(dict.fromkeys(w for w in words if w not in self.places))
        keep = len(self.places)
        if fresh:
            fresh.sort(key=len)
            groups, numbers, links = self._align(fresh)
            self.places.update(zip(fresh, range(keep, keep + len(fresh)), strict=True))
            self.groups += groups
            self.starts = np.append(self.starts, len(self.links) + np.cumsum(numbers[:, 2]) - numbers[:, 2])
            self.numbers = np.concatenate([self.numbers, numbers])
            self.links = np.concatenate([self.links, links])
        rows = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        bounds = np.append(0, np.cumsum(counts))
        sums = np.diff(np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(self.numbers[rows], axis=0)])[bounds], axis=0)
        good = sums[:, 3] == 0
        listed, digests = rows.tolist(), []
        for k, lo in enumerate(bounds[:-1].tolist()):
            hi = int(bounds[k + 1])
            digests.append(hashlib.sha256(b";".join(map(self.groups.__getitem__, listed[lo:hi]))).hexdigest() if hi > lo and good[k] else "")
        used = np.repeat(good, counts)
        sizes = self.numbers[rows[used], 2]
        links = gather(self.links, self.starts[rows[used]], sizes)
        owners = np.repeat(np.repeat(np.arange(len(texts)), counts)[used], sizes)
        if fresh and len(fresh[-1]) > LONG_SEGMENT:
            self._forget(keep, fresh)
        return np.where(good[:, None], sums[:, :3], 0), digests, links, owners

    def _forget(self, keep: int, fresh: list[str]) -> None:
        """Long segments, the last of the fresh ones, leave the cache."""
        long = [w for w in fresh if len(w) > LONG_SEGMENT]
        for w in long:
            del self.places[w]
        left = keep + len(fresh) - len(long)
        del self.groups[left:]
        self.links = self.links[: self.starts[left]]
        self.numbers, self.starts = self.numbers[:left], self.starts[:left]


def aligned(docs: DataFrame, a_path: str, b_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(row, key, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every text, without a shuffle.

    ``pairs`` holds the text's different links as a_id * (size of B) + b_id,
    ``times`` how often each occurs.
    """
    context = docs.sparkSession.sparkContext
    with open(b_path, "rb") as f:
        tables = context.broadcast((plain(Vocabulary(a_path)), f.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*tables.value)
        most = aligner.v.size * aligner.b.size
        for batch in batches:
            for piece in pieces(batch, "text"):
                numbers, digests, links, owners = aligner.align(_texts(piece, "text"))
                found, times = np.unique(owners * most + links, return_counts=True)
                at = np.searchsorted(found // most, np.arange(piece.num_rows + 1))
                n = [pa.array(numbers[:, k]) for k in (0, 1, 2)]
                lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x, kind)) for x, kind in ((found % most, pa.int64()), (times, pa.int32()))]
                yield pa.record_batch([piece.column(0), piece.column(1), *n, n[2], pa.array(digests, pa.string()), *lists], names=NAMES)

    source = docs.select(F.monotonically_increasing_id().alias("row"), docs[key].alias("key"), docs[text].alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"row long, key {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>")


NAMES = ["row", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]


def link_counts(found: DataFrame, b_size: int) -> DataFrame:
    """(pair, n, best) of every linked id pair of the corpus; best if no id of A has more links with this id of B."""
    each = found.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("x.pairs", "x.times")
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n"))
    counts = materialize(counts.withColumn("b", F.col("pair") % b_size))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return materialize(counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def _head(counts: DataFrame) -> DataFrame:
    """The counts of at least a power of two that is large enough to leave ``HEAD`` rows or fewer."""
    sizes = {int(r.level): r.rows for r in counts.groupBy(F.floor(F.log2("n")).alias("level")).agg(F.count("*").alias("rows")).collect()}  # 64 rows at most
    level, total = 64, 0
    for k in range(63, -1, -1):
        total += sizes.get(k, 0)
        if total > HEAD:
            break
        level = k
    return counts.where(F.floor(F.log2("n")) >= level)


def groups(docs: DataFrame, a_path: str, b_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    Both tokenizers treat special strings as plain text. A text that is null
    or empty, or whose tokens of A or B do not give back its bytes, has no
    tokens: zeros and an empty digest, and it adds nothing to the counts.
    ``n_best`` counts the links whose id pair is the most frequent one of its
    id of B in the corpus, ties included; ``count_sum`` sums the corpus counts
    over the links. Repeated rows and keys count and give a row each; keys
    may be null; other columns are not read.
    """
    with open(b_path, "rb") as f:
        b_size = PieceModel(f.read()).size
    found = materialize(aligned(docs, a_path, b_path, text, key))
    counts = link_counts(found, b_size)
    head = _head(counts).toArrow()
    order = np.argsort(head.column("pair").to_numpy())
    top = docs.sparkSession.sparkContext.broadcast(tuple(head.column(c).to_numpy()[order] for c in ("pair", "n", "best")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = top.value
        for batch in batches:
            lists = batch.column(7)
            at = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
            links, times = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (7, 8))
            place = np.minimum(np.searchsorted(pair, links), max(0, len(pair) - 1))
            hit = pair[place] == links if len(pair) else np.zeros(len(links), bool)
            sums = []
            for of in (best.astype(np.int64), n):
                value = np.where(hit, of[place] * times, 0) if len(pair) else np.zeros(len(links), np.int64)
                sums.append(pa.array(np.diff(np.append(0, np.cumsum(value))[at])))
            left = pa.array(np.append(0, np.cumsum(~hit))[at], pa.int32())
            rest = [pa.ListArray.from_arrays(left, pa.array(x[~hit], kind)) for x, kind in ((links, pa.int64()), (times, pa.int32()))]
            yield pa.record_batch([*(batch.column(k) for k in range(7)), *sums, *rest], names=[*NAMES[:7], "n_best", "count_sum", "pairs", "times"])

    kind = found.schema["key"].dataType.simpleString()
    scored = materialize(found.mapInArrow(run, f"row long, key {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, pairs array<long>, times array<int>"))
    rare = scored.where(F.size("pairs") > 0).select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    rare = rare.select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("t")).join(counts, "pair")
    more = rare.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("t")).otherwise(0)).alias("more_best"), F.sum(F.col("t") * F.col("n")).alias("more_sum"))
    out = scored.drop("pairs", "times").join(more, "row", "left")
    both = [(F.col(c) + F.coalesce(m, F.lit(0))).alias(c) for c, m in (("n_best", "more_best"), ("count_sum", "more_sum"))]
    return out.select(F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", *both, "groups_sha256")
