"""Sinks: validated catalogs, ledgers, sequence files, canonical documents."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators.integrity import require_valid


def publish(spark: SparkSession, tables: dict[str, DataFrame], path: str) -> None:
    """Validate all tables, write them beside ``path`` and swap the folder in.

    A violated rule or a failed step leaves an earlier catalog as it was. For
    a moment there is none; ``versions.publish`` has no such moment.
    """
    require_valid(tables)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    staged, old = (jvm.org.apache.hadoop.fs.Path(f"{path}._{kind}_{uuid.uuid4().hex}") for kind in ("staging", "old"))
    try:
        for name, rows in tables.items():
            parts = [c for c in ("sample_id", "run_id") if c in rows.columns and len(rows.columns) > 2]
            writer = rows.write
            (writer.partitionBy(*parts) if parts else writer).parquet(f"{staged.toString()}/{name}")
        had = fs.exists(target)
        if had and not fs.rename(target, old):
            raise OSError(f"cannot move the earlier catalog: {path}")
        if not fs.rename(staged, target):
            if had and not fs.rename(old, target):
                raise OSError(f"the earlier catalog is now at {old.toString()}")
            raise OSError(f"cannot put the new catalog in place: {path}")
        fs.delete(old, True)
    finally:
        fs.delete(staged, True)


def write_table(rows: DataFrame, path: str, columns: list[str]) -> None:
    """Tab-separated text with a header, columns in the given order."""
    rows.select(*columns).write.csv(path, sep="\t", header=True, emptyValue="", quote='"', escape='"')


def write_fasta(records: DataFrame, path: str, width: int = 60, by: list[str] = []) -> None:  # noqa: B006
    """Records (name, sequence) as FASTA text with lines of ``width`` letters, in folders by ``by``."""
    wrapped = F.regexp_replace("sequence", f"(.{{{width}}})(?=.)", "$1\n")
    rows = records.select(*by, F.concat(F.lit(">"), F.col("name"), F.lit("\n"), wrapped).alias("value"))
    (rows.write.partitionBy(*by) if by else rows.write).text(path)


def canonical(documents: DataFrame, column: str = "document") -> DataFrame:
    """Adds the canonical text of a JSON column (sorted keys, compact, no NaN) and its digest."""
    names = documents.columns
    place = names.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [json.dumps(json.loads(t), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False) for t in batch.column(place).to_pylist()]
            digests = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array(digests, pa.string())], names=[*names, "canonical", "sha256"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    return documents.mapInArrow(run, f"{schema}, canonical string, sha256 string")
