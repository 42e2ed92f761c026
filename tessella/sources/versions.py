"""Catalogs published by a pointer: every version has a folder of its own, and a small file names the current one.

Pointer files are numbered and never changed, so no step needs a rename, which
is not atomic everywhere. A pointer counts once it holds its version and the
digest of it; half a file does not, and readers keep to the one before.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from tessella.operators.integrity import require_valid

POINTERS, VERSIONS = "_pointers", "versions"
WHOLE = ["catalog_metadata", "samples", "runs", "read_stats", "assemblies", "stages"]


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *parts]))
    return at().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _line(version: str) -> str:
    return f"{version} {hashlib.sha256(version.encode()).hexdigest()}\n"


def pointers(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of all whole pointers, the newest first."""
    fs, at = _files(spark, path)
    if not fs.exists(at(POINTERS)):
        return []
    numbers = sorted((int(s.getPath().getName()) for s in fs.listStatus(at(POINTERS)) if s.getPath().getName().isdigit()), reverse=True)
    found = []
    for number in numbers:
        stream = fs.open(at(POINTERS, f"{number:012d}"))
        try:
            text = bytes(stream.readNBytes(1000)).decode("utf-8", "replace")
        finally:
            stream.close()
        if text == _line(text.split(" ")[0]):
            found.append((number, text.split(" ")[0]))
    return found


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the current version; null if none was published."""
    found = pointers(spark, path)
    return f"{path.rstrip('/')}/{VERSIONS}/{found[0][1]}" if found else None


def read(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of the current version. They stay what they are when another version is published."""
    folder = current(spark, path)
    if folder is None:
        raise FileNotFoundError(f"nothing is published: {path}")
    fs, at = _files(spark, folder)
    names = sorted(s.getPath().getName() for s in fs.listStatus(at()) if s.isDirectory())
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def _point(spark: SparkSession, path: str, number: int, version: str) -> None:
    """Write a pointer; fails if another publisher took the number."""
    fs, at = _files(spark, path)
    stream = fs.create(at(POINTERS, f"{number:012d}"), False)
    try:
        stream.write(bytearray(_line(version).encode()))
    finally:
        stream.close()


def publish(spark: SparkSession, tables: dict[str, DataFrame], path: str, keep: int = 2) -> str:
    """Validate all tables, write them as a new version, then point to it; gives the version's folder.

    Readers see the old version or the new one, never none: before the
    pointer is whole the old one holds. If a rule is broken, a write fails, or
    another publisher was faster, the old version stays and the new folder
    goes. The newest ``keep`` versions are kept, for those who still read them.
    """
    require_valid(tables)
    fs, at = _files(spark, path)
    numbers = [int(s.getPath().getName()) for s in fs.listStatus(at(POINTERS)) if s.getPath().getName().isdigit()] if fs.exists(at(POINTERS)) else []
    version = uuid.uuid4().hex
    try:
        for name, rows in tables.items():
            # tables with few rows for each run are not cut into a folder for each
            cut = name not in WHOLE and {"sample_id", "run_id"} <= set(rows.columns)
            (rows.write.partitionBy("sample_id", "run_id") if cut else rows.write).parquet(at(VERSIONS, version, name).toString())
        _point(spark, path, max(numbers, default=0) + 1, version)
    except BaseException:
        if version not in (v for _, v in pointers(spark, path)):
            fs.delete(at(VERSIONS, version), True)
        raise
    for number, old in pointers(spark, path)[max(1, keep) :]:
        fs.delete(at(POINTERS, f"{number:012d}"), False)
        fs.delete(at(VERSIONS, old), True)
    return at(VERSIONS, version).toString()
