"""One query for each operator of this folder, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import alignment, bpe, decontaminate, fingerprints, hard_negatives, langid, ngram_join, pii, quality, simhash, suffix_dedup, token_counts, url_filter
from tessella.llm.shared import materialize


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(_documents(spark, sf_dir))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_documents(spark, sf_dir), vocabulary_path())


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(_documents(spark, sf_dir), vocabulary_path())
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(_documents(spark, sf_dir))


#: The rules of the URL query.
URL_RULES = [
    url_filter.Rule("com", "/", "allow"),
    url_filter.Rule("example.com", "/en/", "block"),
    url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"),
    url_filter.Rule("net", "/fr/", "block"),
]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(_documents(spark, sf_dir))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edits(_documents(spark, sf_dir))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    learned = langid.learn(docs.where(~held_out()))
    return langid.predict(docs, learned).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = materialize(quality.measure(_documents(spark, sf_dir)))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(measured, labels.where(~held_out()))
    scored = quality.score(measured, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(_documents(spark, sf_dir))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.groups(_documents(spark, sf_dir), vocabulary_path(), vocabulary_path("piece_bpe_32k.model"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh vector are moved on by one, as mislabelled rows are what the search must bear."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.prepared(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), moved)
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_bpe": op2_bpe,
    "op3_token_counts": op3_token_counts,
    "op4_ngram_join": op4_ngram_join,
    "op5_url_filter": op5_url_filter,
    "op6_pii": op6_pii,
    "op7_fingerprints": op7_fingerprints,
    "op8_language": op8_language,
    "op9_decontamination": op9_decontamination,
    "op10_quality": op10_quality,
    "op11_simhash": op11_simhash,
    "op12_alignment": op12_alignment,
    "op13_hard_negatives": op13_hard_negatives,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS_9 = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORDS_4 = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

ORACLE_SQL: dict[str, str] = {
    "op1_suffix_dedup": """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, CAST(len(h) / 2 AS BIGINT) - 49)) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS first FROM p GROUP BY s HAVING count(*) > 1),
r AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM p JOIN f USING (s) WHERE first < doc_id),
g AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM r),
x AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY doc_id, k),
y AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS last FROM x),
z AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS n, max(b) AS tail, string_agg(substr(h, 2 * last + 1, 2 * (a - last)), '' ORDER BY a) AS kept FROM y JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
 sha256(unhex(CASE WHEN gone IS NULL THEN h ELSE kept || substr(h, 2 * tail + 1) END)) AS kept_sha256 FROM d LEFT JOIN z USING (doc_id)""",
    "op4_ngram_join": f"""WITH RECURSIVE d AS (SELECT doc_id, {_WORDS_4} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * c >= 75 * (na.n + nb.n - c)),
t(a, b) AS (SELECT a, b FROM l UNION SELECT t.a, l.b FROM t JOIN l ON t.b = l.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce((SELECT min(b) FROM t WHERE t.a = d.doc_id), d.doc_id)) AS component_id FROM d LEFT JOIN n USING (doc_id)""",
    "op9_decontamination": f"""WITH d AS (SELECT doc_id, {_WORDS_9} AS w FROM documents), i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS_9} AS w FROM benchmark),
b AS (SELECT DISTINCT item, n, array_to_string(w[k:k + n - 1], ' ') AS win FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k FROM i WHERE len(w) > 0)),
p AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM b))),
h AS (SELECT doc_id, k, n, item FROM p JOIN b USING (n, win)),
c AS (SELECT doc_id, count(DISTINCT x) AS hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS x FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(DISTINCT item) AS items, string_agg(DISTINCT item, ',' ORDER BY item) AS listed FROM h GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256, hit IS NOT NULL AS contaminated FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)""",
    "op13_hard_negatives": """WITH v AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
 FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, CAST(list_sum(list_transform(list_zip(a.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
 FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT * FROM n WHERE rank <= 10""",
}
