"""A corpus pipeline: from raw documents to checked token counts.

Stages, in order: low quality goes, one document of each near-duplicate group
stays, documents with benchmark passages go, personal data is masked, and the
texts are encoded and decoded. Each stage reads what the one before it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import bpe, decontaminate, ngram_join, pii, quality
from tessella.llm.queries import held_out, vocabulary_path
from tessella.llm.shared import materialize

LEAST_QUALITY = 0.7


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated quality is LEAST_QUALITY or more; all stay if nothing is labelled."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(materialize(quality.measure(docs)), labels.where(~held_out()))
    return quality.keep(docs, model, LEAST_QUALITY)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group; of rows that share a doc_id, one."""
    return ngram_join.representatives(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data replaced by its kind; n_chars follows the text."""
    masked = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of each document's ids and of what they decode to."""
    return bpe.round_trip(docs, vocabulary_path())


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("personal_data", mask_personal_data),
    ("tokens", encode),
]

#: The classifier, the random field and the merge rounds have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
