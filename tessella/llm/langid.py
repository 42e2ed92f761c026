"""Language identification with n-gram filters that answer for all languages at once.

A slot of the filter holds one bit for each language, so that two lookups
return the set of languages that contain an n-gram. A text's n-grams are
counted for each language; the counts, less what the filter's false positives
would give by chance, decide.

Learning counts character n-grams of each language over all its texts. An
n-gram enters a language's filter if it is at least ``share`` as frequent
there as in the language where it is most frequent. The filter is sized from
the counted entries: languages with similar numbers of entries share a block
of slots, which is at least 2**SLOT_BITS and doubles until no language sets more
than FILL of its bits. The blocks and a row for each language are all that
reaches the driver.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.shared import materialize, mix, pieces, release

ORDERS = (3, 4)
SLOT_BITS = 20
#: The most of a language's bits that may be set; false positives are the square of it.
FILL = 0.4
#: Languages of one block: bits of a slot.
BLOCK = 64
FLUSH = 1 << 20
UNDETERMINED = "und"
#: Rows from which a language is learned, at most; of more, a share by hash of the text.
MAX_FIT_ROWS = 200_000
#: Occurrences of n-grams for each that an entry needs, up to ``least``: a language with little text is learned from single ones.
PER_LEAST = 1000


class Block(NamedTuple):
    """Slots of up to BLOCK languages, one bit each; ``members`` are their places in the filter's languages."""

    members: list[int]
    bits: int
    slots: np.ndarray


class LanguageFilter(NamedTuple):
    languages: list[str]
    blocks: list[Block]
    false_positive: np.ndarray


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, text's index, letters of each text) of all n-grams, in text order.

    Texts are lower-cased; every run of other characters than letters counts
    as one space, and so does either end of a text.
    """
    padded = [f" {(t or '').lower()} " for t in texts]
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    points = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), sizes)
    letter = _letters()[points]
    count = np.bincount(owner[letter], minlength=len(texts))
    keep = letter.copy()
    keep[1:] |= letter[:-1] | (owner[1:] != owner[:-1])
    keep[:1] = True
    points, owner = np.where(letter, points, 32)[keep].astype(np.uint64), owner[keep]
    hashes, owners = [], []
    for n in ORDERS:
        if len(points) < n:
            continue
        h = np.full(len(points) - n + 1, n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + points[k : len(points) - n + 1 + k]
        whole = owner[: len(h)] == owner[n - 1 :]
        hashes.append(mix(h[whole]))
        owners.append(owner[: len(h)][whole])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), count
    return np.concatenate(hashes), np.concatenate(owners), count


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of a task's texts, summed up to FLUSH entries at a time."""
    names: dict[str, int] = {}
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def out(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lang, gram, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((gram, lang))
        lang, gram, n = lang[order], gram[order], n[order]
        first = np.flatnonzero(np.append(True, (gram[1:] != gram[:-1]) | (lang[1:] != lang[:-1])))
        return lang[first], gram[first], np.add.reduceat(n, first)

    def rows(part: tuple) -> pa.RecordBatch:
        known = np.array(list(names), object)
        return pa.record_batch([pa.array(known[part[0]], pa.string()), pa.array(part[1].view(np.int64)), pa.array(part[2])], names=["lang", "gram", "n"])

    for batch in batches:
        for piece in pieces(batch, "text"):
            langs = piece.column(1).to_pylist()
            hashes, owner, _ = grams(piece.column(0).to_pylist())
            of = np.fromiter((names.setdefault(x, len(names)) for x in langs), np.int64, len(langs))
            for k in np.unique(of):
                gram, n = np.unique(hashes[of[owner] == k], return_counts=True)
                held.append((np.full(len(gram), k), gram, n.astype(np.int64)))
            if sum(len(x[1]) for x in held) > FLUSH:
                held = [out(held)]
                if len(held[0][1]) > FLUSH // 2:
                    yield rows(held[0])
                    held = []
    if held:
        yield rows(out(held))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", share: float = 0.2, least: int = 3) -> LanguageFilter:
    """The filter of all rows whose text and language are there.

    Rows lacking either teach nothing. Every language is learned, from at most
    about MAX_FIT_ROWS rows each, so that its entries do not grow with the
    table. Without any labelled row the filter has none.
    """
    rows = docs.where(docs[text].isNotNull() & docs[lang].isNotNull()).select(docs[text].alias("text"), docs[lang].cast("string").alias("lang"))
    known = rows.groupBy("lang").agg(F.count("*").alias("docs")).orderBy(F.desc("docs"), "lang").collect()
    if not known:
        return LanguageFilter([], [], np.zeros(0))
    spark, held = docs.sparkSession, []
    if large := [(r.lang, int(MAX_FIT_ROWS / r.docs * (1 << 20))) for r in known if r.docs > MAX_FIT_ROWS]:
        shares = F.broadcast(spark.createDataFrame(large, "lang string, share int"))
        rows = rows.join(shares, "lang", "left").where(F.col("share").isNull() | (F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.col("share"))).select("text", "lang")
    counts = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = materialize(counts, held)
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = [r.lang for r in known if totals.get(r.lang)]
    if not languages:
        release(spark, held)
        return LanguageFilter([], [], np.zeros(0))
    of = spark.createDataFrame([(x, k, float(totals[x])) for k, x in enumerate(languages)], "lang string, k int, total double")
    rates = counts.join(F.broadcast(of), "lang").select("gram", F.struct("k", "n", (F.col("n") / F.col("total")).alias("rate"), F.least(F.lit(least), F.ceil(F.col("total") / PER_LEAST)).alias("least")).alias("x"))
    # a gram's row holds its frequency in all languages that have it
    by_gram = rates.groupBy("gram").agg(F.collect_list("x").alias("xs"), F.max("x.rate").alias("most"))
    entries = by_gram.select("gram", "most", F.explode("xs").alias("x")).where((F.col("x.n") >= F.col("x.least")) & (F.col("x.rate") >= share * F.col("most")))
    entries = materialize(entries.select("gram", F.col("x.k").alias("k")), held)
    size = dict.fromkeys(range(len(languages)), 0) | {r.k: r.n for r in entries.groupBy("k").agg(F.count("*").alias("n")).collect()}
    order = sorted(size, key=lambda k: (-size[k], k))
    blocks, full = [], np.zeros(len(languages))
    for at in range(0, len(order), BLOCK):
        members = order[at : at + BLOCK]
        bits = slot_bits(size[members[0]])
        while True:
            slots = _slots(spark, entries, members, bits)
            part = np.array([((slots >> np.uint64(j)) & np.uint64(1)).mean() for j in range(len(members))])
            if part.max() <= FILL:
                break
            bits += 1
        blocks.append(Block(members, bits, slots))
        full[members] = part
    release(spark, held)
    return LanguageFilter(languages, blocks, full**2)


def slot_bits(entries: int) -> int:
    """The least size, as a power of two, at which so many entries of two slots are expected to set up to FILL of the bits."""
    return max(SLOT_BITS, math.ceil(math.log2(max(1.0, 2 * entries / -math.log1p(-FILL)))))


def _slots(spark: SparkSession, entries: DataFrame, members: list[int], bits: int) -> np.ndarray:
    """The slots of 2**bits that the entries (gram, k) of some languages set, language j of ``members`` in bit j."""
    of = spark.createDataFrame([(k, 1 << j if j < 63 else -(1 << 63)) for j, k in enumerate(members)], "k int, mask long")
    low = (1 << bits) - 1
    both = F.array(F.col("gram").bitwiseAND(low), F.shiftright("gram", bits).bitwiseAND(low))
    rows = entries.join(F.broadcast(of), "k").select("mask", F.explode(both).alias("slot"))
    table = rows.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    filled = np.zeros(1 << bits, np.uint64)
    filled[table.column("slot").to_numpy()] = table.column("mask").to_numpy().view(np.uint64)
    return filled


def judge(f: LanguageFilter, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The language of each text and its share of all corrected counts."""
    hashes, owner, letters = grams(texts)
    total = np.bincount(owner, minlength=len(texts))
    # only the best so far and the sum are held, however many languages there are
    best, most, whole = np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.zeros(len(texts))
    for block in f.blocks:
        low = np.uint64((1 << block.bits) - 1)
        found = block.slots[(hashes & low).astype(np.int64)] & block.slots[((hashes >> np.uint64(block.bits)) & low).astype(np.int64)]
        for j, k in enumerate(block.members):
            got = np.bincount(owner[(found >> np.uint64(j)) & np.uint64(1) == 1], minlength=len(texts))
            count = np.maximum(0, (got - total * f.false_positive[k]) / (1 - f.false_positive[k]))
            better = (count > most) | ((count == most) & (k < best))
            best, most = np.where(better, k, best), np.maximum(count, most)
            whole += count
    score = most / np.maximum(whole, 1e-9)
    none = (letters == 0) | (not f.languages)
    names = [UNDETERMINED if n else f.languages[b] for n, b in zip(none, best, strict=True)]
    return names, np.where(none, 0.0, np.clip(score, 0, 1))


def predict(docs: DataFrame, learned: LanguageFilter, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score) of every row; one pass, no shuffle.

    Null text and text without a letter give ``und`` and score 0, as does
    everything if nothing was learned. A text none of whose n-grams is known
    gets the most frequent language and score 0. Ties go to the language with
    more learned texts, then by name. Repeated rows give a row each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                names, score = judge(shared.value, piece.column(1).to_pylist())
                yield pa.record_batch([piece.column(0), pa.array(names, pa.string()), pa.array(score)], names=["key", "lang_pred", "score"])

    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)
