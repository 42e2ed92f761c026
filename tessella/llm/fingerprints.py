"""Document fingerprints from spot signatures.

Every occurrence of a common word is a spot. The spot and the chain of the
next content words form one signature; text between articles' boilerplate has
few common words and so few spots. A fingerprint is the sorted set of a
text's signatures, and its likeness to another is their Jaccard coefficient.

Near copies in a whole table (``near_duplicates``) are found by the exact set
join: sets in bands of similar length, candidates by the signatures in their
prefixes, overlaps bounded by bitmaps before any set is compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm import ngram_join
from tessella.llm.shared import LOWER, PrefixHash, mix, pieces, word_bounds

#: Common words of four languages, at which signatures start.
ANCHORS = """
a an and are as at be been but by can did do for from had has have he her his i if in into is it its more not of on or
she so than that the their them then there they this to was we were what when which who will with would you
aber als am auch auf aus bei bin bis das dass dem den der des die ein eine einem einen einer er es für hat ich ihr im
ist mit nach nicht noch nur oder sich sie sind so über um und uns von vor war wenn wie wir zu zum zur
au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas pour plus que
qui sa se ses son sont sur un une vous
al como con cuando de del desde el ella ellos en entre era es esta este fue ha hay la las le les lo los más me muy no
o para pero por que se ser si sin sobre su sus también un una y ya
""".split()
CHAIN = 2
#: Beyond so many words after the last spot, every word takes a spot's place.
SPARSE = 10
WORD = np.zeros(256, bool)
for _codes in (range(48, 58), range(65, 91), range(97, 123), range(128, 256)):
    WORD[np.array(_codes)] = True


def _hash_words(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(r) for r in raw])
    return PrefixHash(data).of(ends - np.array([len(r) for r in raw]), ends)


_ANCHOR_HASHES = np.unique(_hash_words(sorted(set(ANCHORS))))


def signatures(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted set of 32-bit signatures of each text; see ``signature_sets``."""
    raw = [(t or "").encode() for t in texts]
    offsets = np.append(0, np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw))))
    low, bounds = signature_sets(np.frombuffer(b"".join(raw), np.uint8), offsets)
    low = low.astype(np.uint32)
    return [low[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def signature_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted 32-bit signatures of flat texts in one array, and each text's offsets in it.

    Where a text has no spot yet, or none among its last SPARSE words, every
    word takes a spot's place. A text without signatures otherwise has its
    whole as one; null and empty texts have none. Equal texts have equal sets.
    """
    n, sizes, plain = len(offsets) - 1, np.diff(offsets), data
    data = LOWER[data]
    starts, ends, owner = word_bounds(data, offsets, WORD)
    h = PrefixHash(data).of(starts, ends)
    at = np.searchsorted(_ANCHOR_HASHES, h)
    at[at == len(_ANCHOR_HASHES)] = 0
    anchor = _ANCHOR_HASHES[at] == h
    content, spots = np.flatnonzero(~anchor), np.flatnonzero(anchor)
    nth = np.searchsorted(content, spots)
    fits = nth + CHAIN <= len(content)
    spots, nth = spots[fits], nth[fits]
    fits = owner[content[nth + CHAIN - 1]] == owner[spots]
    spots, nth = spots[fits], nth[fits]
    sig = h[spots]
    for k in range(CHAIN):
        sig = sig * np.uint64(0x9E3779B97F4A7C15) + h[content[nth + k]]
    sig, of = mix(sig), owner[spots]
    words = np.zeros(0, np.int64)
    if len(h):
        # far behind the last spot of its text, a word stands in for one
        place = np.arange(len(h))
        first = np.searchsorted(owner, owner)
        behind = np.maximum.accumulate(np.where(anchor, place, -1))
        words = np.flatnonzero(~anchor & ((behind < first) | (place - behind > SPARSE)))
        more = h[words]
        for k in range(1, CHAIN + 1):
            after = np.minimum(words + k, len(h) - 1)
            more = more * np.uint64(0x9E3779B97F4A7C15) + np.where((words + k < len(h)) & (owner[after] == owner[words]), h[after], np.uint64(0))
        sig, of = np.concatenate([sig, mix(more)]), np.concatenate([of, owner[words]])
    whole = np.flatnonzero((sizes > 0) & (np.bincount(of, minlength=n) == 0))
    if len(whole):
        rest = np.array([int.from_bytes(hashlib.blake2b(plain[offsets[k] : offsets[k + 1]].tobytes(), digest_size=8).digest(), "big") for k in whole], np.uint64)
        sig, of = np.concatenate([sig, rest]), np.concatenate([of, whole])
    low = (sig >> np.uint64(32)).astype(np.uint32)
    key = (of.astype(np.uint64) << np.uint64(32)) | low
    key = np.unique(key)
    bounds = np.searchsorted(key, np.arange(n + 1, dtype=np.uint64) << np.uint64(32))
    return key & np.uint64((1 << 32) - 1), bounds


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard coefficient of two sorted sets; 1 if both are empty.

    If the sizes alone rule out ``least``, the answer is 0 without a comparison.
    """
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < least * large:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def as_text(signature: np.ndarray) -> str:
    """The fingerprint as lowercase hex, eight digits a signature, in rising order."""
    return signature.astype(">u4").tobytes().hex()


def fingerprint(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fingerprint) of every row; one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                got = [as_text(s) for s in signatures(piece.column(1).to_pylist())]
                yield pa.record_batch([piece.column(0), pa.array(got, pa.string())], names=["key", "fingerprint"])

    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, fingerprint string").withColumnRenamed("key", key)


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", num: int = 75, den: int = 100) -> DataFrame:
    """(key, n_signatures, component_id) of every row.

    Rows are linked if num / den or more of their signatures are common to
    both; component_id is the least key reachable by links. Null and empty
    texts have no signatures and stand alone; null keys keep a null component.
    Rows that share a key are one node; repeated rows give a row each.
    """
    return ngram_join.components(docs, text, key, num, den, signature_sets).withColumnRenamed("n_shingles", "n_signatures")


def with_next(docs: DataFrame, parts: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(part, tail, key, text): the texts in parts of consecutive keys, in order.

    Each part ends with a copy of the next part's first row, marked as tail,
    so that every row's successor stands behind it in its own part; the last
    part's tail is the first row of all. Texts are shuffled once. Null keys
    come first. Parts hold about equally many rows however keys are spread.
    """
    low = -(1 << 63)
    source = docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text")).withColumn("k", F.coalesce("key", F.lit(low)))
    shares = [i / parts for i in range(1, parts)]
    found = source.agg(F.percentile_approx("k", shares, 20 * parts).alias("q")).first().q if shares else []
    bounds = np.unique(np.array(found or [], np.int64))
    part_of = F.pandas_udf(lambda k: pd.Series(np.searchsorted(bounds, k.to_numpy(), side="right").astype(np.int32)), "int")
    firsts = {r.part: r.first for r in source.select("k", part_of("k").alias("part")).groupBy("part").agg(F.min("k").alias("first")).collect()}
    order = sorted(firsts)
    # the first row of each part is the tail of the part before it; both arrays go with the function, not into the plan
    begin = np.array([firsts[p] for p in order], np.int64)
    before = np.array([order[i - 1] for i in range(len(order))], np.int32)

    def tails(k: pd.Series) -> pd.Series:
        at = np.minimum(np.searchsorted(begin, k.to_numpy()), max(0, len(begin) - 1))
        return pd.Series(np.where(begin[at] == k.to_numpy(), before[at], -1).astype(np.int32) if len(begin) else np.full(len(k), -1, np.int32))

    rows = source.withColumns({"p": part_of("k"), "t": F.pandas_udf(tails, "int")("k")})
    own, tail = F.struct(F.col("p").alias("part"), F.lit(False).alias("tail")), F.struct(F.col("t").alias("part"), F.lit(True).alias("tail"))
    rows = rows.withColumn("at", F.explode(F.when(F.col("t") >= 0, F.array(own, tail)).otherwise(F.array(own)))).select("at.part", "at.tail", "key", "k", "text")
    return rows.repartition("part").sortWithinPartitions("part", "tail", "k", "text").drop("k")


def compare_edits(docs: DataFrame, text: str = "text", key: str = "doc_id", parts: int | None = None) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likenesses.

    The edited text has its last quarter of code points replaced by the start
    of the next document's. Gives key, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next. A lone document follows
    itself. Repeated keys count as documents of their own, in order of text.
    Keys are whole numbers.
    """
    spark = docs.sparkSession
    parts = parts or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def finish(rows: list[tuple]) -> pa.RecordBatch:
        """All rows but the last, which is there as the successor."""
        texts = [t for _, _, t in rows]
        edited = []
        for k, t in enumerate(texts[:-1]):
            if rows[k][0] is None:  # a tail: only a successor
                edited.append("")
                continue
            cut = len(t) // 4
            edited.append(t[: len(t) - cut] + texts[k + 1][:cut])
        own = signatures(texts)
        new = signatures(edited)
        at = [k for k in range(len(edited)) if rows[k][0] is not None]
        columns = [
            pa.array([rows[k][1] for k in at], pa.int64()),
            pa.array([len(texts[k]) for k in at], pa.int64()),
            pa.array([hashlib.sha256(edited[k].encode()).hexdigest() for k in at]),
            pa.array([as_text(own[k]) for k in at]),
            pa.array([as_text(new[k]) for k in at]),
            pa.array([likeness(own[k], new[k]) for k in at], pa.float64()),
            pa.array([likeness(own[k], own[k + 1]) for k in at], pa.float64()),
        ]
        return pa.record_batch(columns, names=["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for part, tail, k, t in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                held.append((None if tail else part, k, t or ""))
                size += len(held[-1][2])
                if size > 1 << 19 and len(held) > 1:
                    yield finish(held)
                    held, size = held[-1:], len(held[-1][2])
        if len(held) > 1:
            yield finish(held)

    columns = "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs, parts, text, key).mapInArrow(run, columns).withColumnRenamed("key", key)
