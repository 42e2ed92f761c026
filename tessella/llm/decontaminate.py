"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A benchmark item gives one window for every run of its words as long as the
window size; a shorter item is one window. A window occurs in a document if
all of its shingles do, at the right distances. So it suffices to look up the
window's rarest shingle: shingles are ordered by how rare their words are, and
the first in that order is the window's prefix. Any order is correct; the
benchmark's own word counts give one without a pass over the documents. A
match of the prefix fixes where the window would start; the bounds of the
document cut the impossible ones, and the words themselves are compared for
the rest.

The documents are never shuffled: they stream past blocks of windows of
bounded size, one pass for each block, and positions, look-up and comparison
are one stage. What is shuffled are one short row for each document and the
verified hits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.shared import free_name, materialize

WINDOW = 10
SHINGLE = 3
#: Estimated bytes of windows that one pass holds in each executor.
BLOCK_BYTES = 16 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else; plain ASCII takes the fast way."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    return F.regexp_extract_all(lowered(text), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))


def _shingle(array: str, at: str, width: int) -> Column:
    return F.xxhash64(*[F.expr(f"get({array}, {at} + {k})") for k in range(width)])


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """(item, win, width, n): every different window of every item."""
    rows = benchmark.select(benchmark[item].cast("string").alias("item"), words(benchmark[text]).alias("w")).where("size(w) > 0")
    rows = rows.withColumn("n", F.least(F.size("w"), F.lit(size))).withColumn("at", F.explode(F.sequence(F.lit(0), F.expr("size(w) - n"))))
    each = rows.select("item", F.expr("slice(w, at + 1, n)").alias("win")).distinct()
    return each.select("item", "win", F.least(F.size("win"), F.lit(SHINGLE)).alias("width"), F.size("win").alias("n"))


def window_id() -> Column:
    """A window's name: 128 bits of the digest of its words, the same wherever it is computed."""
    return F.substring(F.sha2(F.concat_ws(" ", "win"), 256), 1, 32)


def prefixes(wins: DataFrame) -> DataFrame:
    """Each window with the hash and the offset of its rarest shingle."""
    seen = wins.select(F.explode("win").alias("word")).groupBy("word").agg(F.count("*").alias("times"))
    parts = wins.withColumn("off", F.explode(F.sequence(F.lit(0), F.expr("n - width"))))
    words_of = parts.select("win", "off", F.explode(F.expr("slice(win, off + 1, width)")).alias("word")).join(seen, "word")
    rarity = words_of.groupBy("win", "off").agg(F.sum(F.log("times")).alias("common"))
    first = rarity.groupBy("win").agg(F.min_by("off", F.struct("common", "off")).alias("off"))
    return wins.join(first, "win")


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(key, row, n_words, start, n, win_id) for docs with key, row and w.

    One row with a null start for each document and, beside it, one for each
    occurrence of a window, ``items`` being those of ``windows``. A window is
    broadcast by its words and number alone, however many items have it.
    """
    wins = materialize(prefixes(items.select("win", "width", "n").distinct()).withColumn("win_id", window_id()))
    weight = F.expr("octet_length(concat_ws(' ', win)) + 24 * size(win) + 200")
    sizes = wins.groupBy("width").agg(F.sum(weight).alias("bytes")).collect()
    # place -1 stands for the document itself
    places = docs.select("key", "row", "w", F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("at"))
    found = None
    for width, total in sorted((r.width, r.bytes) for r in sizes):
        blocks = max(1, math.ceil(total / BLOCK_BYTES))
        some = wins.where(F.col("width") == width).withColumn("block", F.pmod(F.xxhash64("win"), F.lit(blocks)))
        stream = places.select("key", "row", "w", "at", _shingle("w", "at", width).alias("sh"))
        for block in range(blocks):
            prefix = some.where(F.col("block") == block).select("win", "n", "win_id", "off", _shingle("win", "off", width).alias("psh"))
            inside = F.expr("at >= off and at - off + n <= size(w)")
            same = F.expr("slice(w, at - off + 1, n) = win")
            # the first pass also gives the documents' own rows
            kind = "left" if found is None else "inner"
            got = stream.join(F.broadcast(prefix), (F.col("sh") == F.col("psh")) & inside & same, kind)
            got = got.where("at = -1 or psh is not null").select("key", "row", F.expr("size(w)").alias("n_words"), F.expr("if(psh is null, null, at - off)").alias("start"), "n", "win_id")
            found = got if found is None else found.unionByName(got)
    if found is None:
        found = docs.select("key", "row", F.size("w").alias("n_words"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("n"), F.lit(None).cast("string").alias("win_id"))
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """key, n_words, n_hit, n_items, items_sha256 and contaminated of every row.

    A word is hit if an occurrence of a window covers it. Null text has no
    words. Repeated rows give a row each; rows that share a key but not the
    text are judged apart. Null keys are kept. An empty benchmark hits nothing.
    """
    source = docs.select(docs[key].alias("key"), F.xxhash64(docs[text]).alias("row"), words(docs[text]).alias("w"))
    items = windows(benchmark, item, item_text)
    found = materialize(hits(source, items))
    span = F.when(F.col("start").isNotNull(), F.struct("start", (F.col("start") + F.col("n")).alias("end")))
    by_doc = found.groupBy("key", "row").agg(F.max("n_words").cast("long").alias("n_words"), F.count(F.when(F.col("start").isNull(), 1)).cast("int").alias("rows"), F.array_sort(F.collect_set(span)).alias("spans"))
    met = found.where("start is not null").select("key", "row", "win_id").distinct().join(items.select("item", window_id().alias("win_id")), "win_id")
    listed = met.groupBy("key", "row").agg(F.array_sort(F.collect_set("item")).alias("items")).select(F.col("key").alias("_key"), F.col("row").alias("_row"), "items")
    by_doc = by_doc.join(listed, F.col("key").eqNullSafe(F.col("_key")) & F.col("row").eqNullSafe(F.col("_row")), "left")
    by_doc = by_doc.withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    covered = F.expr("aggregate(spans, struct(0L as n, 0 as last), (a, s) -> struct(a.n + cast(greatest(0, s.end - greatest(a.last, s.start)) as bigint) as n, greatest(a.last, s.end) as last), a -> a.n)")
    judged = by_doc.select(F.col("key").alias(key), "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), F.explode(F.array_repeat(F.lit(1), F.col("rows"))).alias("_"))
    return judged.select(key, "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs, with all their columns."""
    own = free_name(docs, "__row")
    tagged = docs.withColumn(own, F.xxhash64(docs[text]))
    source = tagged.select(F.col(key).alias("key"), F.col(own).alias("row"), words(F.col(text)).alias("w"))
    found = hits(source, windows(benchmark, item, item_text))
    hit = materialize(found.where("start is not null").select("key", "row").distinct())
    # an equal hash of the text beside the key tells rows that share a key apart
    return tagged.join(hit, tagged[key].eqNullSafe(hit["key"]) & (tagged[own] == hit["row"]), "left_anti").select(*docs.columns)
