"""Files of any size with their digests, listings of declared outputs, and tables parsed from verified bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.sources import scratch
from tessella.sources.splits import runs

MARK = b"\xef\xbb\xbf"
#: Lines of a batch; with the readers' own bound on bytes, what a task holds of a file at once.
BATCH_LINES = 1000


def _files(spark: SparkSession):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    return path, lambda p: path(p).getFileSystem(conf)


class _File:
    """The digest of a file that comes line by line.

    A reader takes the line breaks away, and a byte order mark at the start;
    the file's size tells at the end whether there was either.
    """

    def __init__(self, path: str, size: int) -> None:
        self.path, self.size = path, size
        self.plain, self.marked = hashlib.sha256(), hashlib.sha256(MARK)
        self.bytes, self.any = 0, False

    def add(self, lines: list[bytes]) -> None:
        data = (b"\n" if self.any else b"") + b"\n".join(lines)
        self.any = True
        self.bytes += len(data)
        self.plain.update(data)
        self.marked.update(data)

    def digest(self) -> str:
        rest = self.size - self.bytes
        if rest not in (0, 1, len(MARK), len(MARK) + 1):
            raise ValueError(f"{self.path} has {self.size} bytes, of which {self.bytes} were read")
        of = self.marked if rest >= len(MARK) else self.plain
        if rest in (1, len(MARK) + 1):
            of.update(b"\n")
        return of.hexdigest()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each file; its lines follow one another."""
    now: _File | None = None

    def out(f: _File) -> pa.RecordBatch:
        return pa.record_batch([pa.array([f.path]), pa.array([f.size]), pa.array([f.digest()])], names=["path", "size_bytes", "sha256"])

    for batch in batches:
        for (path, _), part in runs(batch):
            if now is None or now.path != path:
                if now is not None:
                    yield out(now)
                now = _File(path, part.column(1)[0].as_py())
            now.add(pc.cast(part.column(2), pa.binary()).to_pylist())
    if now is not None:
        yield out(now)


def digests(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, size_bytes, sha256) of every file below the paths, whatever its size; names that begin with ``.`` or ``_`` are not read.

    A file is read as one split, since a digest needs its bytes in order, and
    streams through its task in batches; different files are different tasks.
    Only a stretch without line breaks must fit in memory. The result is a
    table in the shared folder.
    """
    whole = spark.newSession()
    for k, v in {"spark.sql.files.maxPartitionBytes": str(1 << 60), "spark.sql.files.openCostInBytes": str(1 << 60), "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_LINES)}.items():
        whole.conf.set(k, v)
    lines = whole.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(paths)
    rows = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size_bytes"), F.col("value").cast("binary").alias("value"))
    out = scratch.folder(spark)
    rows.mapInArrow(_hashed, "path string, size_bytes long, sha256 string").write.parquet(out)
    found = spark.read.schema("path string, size_bytes long, sha256 string").parquet(out)
    # files without lines: nothing, or a byte order mark alone
    every = spark.createDataFrame([(f,) for f in lines.inputFiles()], "path string")
    silent = every.join(found.select(_bare("path").alias("_path")), _bare("path") == F.col("_path"), "left_anti").collect()
    path, fs = _files(spark)
    jvm, rest = spark.sparkContext._jvm, []
    for row in silent:
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row.path))
        size = fs(row.path).getFileStatus(at).getLen()
        if size not in (0, len(MARK)):
            raise ValueError(f"{row.path} has {size} bytes, of which none were read")
        rest.append((at.toString(), size, hashlib.sha256(MARK[:size]).hexdigest()))
    return found.union(spark.createDataFrame(rest, found.schema)) if rest else found


def outputs(spark: SparkSession, stage: str, root: str, declared: dict[str, str], kinds: dict[str, str]) -> DataFrame:
    """(artifact_id, kind, path, sha256, size_bytes, producer_stage_id) of every file of a stage's declared outputs.

    ``declared`` names outputs by paths below ``root``: folders with all that
    lies in them, or files, which bring their alignment index along. An output
    that is not there raises. Labels without a kind are ``other``.
    """
    path, at_ = _files(spark)
    fs = at_(root)
    base = fs.makeQualified(path(root)).toString().rstrip("/")
    label, wanted = F.lit(None).cast("string"), []
    plain = F.regexp_replace("path", "^[a-z0-9]+:/+", "/")
    for name, relative in sorted(declared.items()):
        at = f"{base}/{relative}".rstrip("/")
        if not fs.exists(path(at)):
            raise FileNotFoundError(f"missing {stage} output: {at}")
        own = "/" + at.split(":", 1)[-1].lstrip("/")
        folder = fs.getFileStatus(path(at)).isDirectory()
        wanted += [at] if folder or not fs.exists(path(f"{at}.bai")) else [at, f"{at}.bai"]
        label = F.when(plain.startswith(own + "/") if folder else plain.isin(own, f"{own}.bai"), F.lit(name)).otherwise(label)
    relative = F.substring(plain, len("/" + base.split(":", 1)[-1].lstrip("/")) + 2, 1 << 30)
    kind = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair]), label) if kinds else F.lit(None), F.lit("other"))
    rows = digests(spark, sorted(set(wanted)))
    identity = F.concat_ws(".", F.lit(stage), label, F.substring(F.sha2(relative, 256), 1, 12))
    return rows.select(identity.alias("artifact_id"), kind.alias("kind"), "path", "sha256", "size_bytes", F.lit(stage).alias("producer_stage_id"))


def changed(spark: SparkSession, receipts: DataFrame, paths: str | list[str]) -> DataFrame:
    """Receipts (path, sha256, size_bytes) that the files of today do not bear out, with the reason."""
    now = digests(spark, paths).select(_bare("path").alias("_path"), F.col("sha256").alias("_sha256"), F.col("size_bytes").alias("_size"))
    both = receipts.join(now, _bare("path") == F.col("_path"), "left")
    why = F.when(F.col("_path").isNull(), F.lit("missing")).when(F.col("_size") != F.col("size_bytes"), F.lit("size")).when(F.col("_sha256") != F.col("sha256"), F.lit("digest"))
    return both.select(*receipts.columns, why.alias("reason")).where("reason is not null")


def _bare(c: str) -> Column:
    return F.regexp_replace(c, "^[a-z0-9]+:/+", "/")


def contents(spark: SparkSession, paths: list[str], receipts: DataFrame) -> DataFrame:
    """Receipts with ``content``, the bytes of their file, null where there is none.

    For tables that fit in a cell. Bytes whose digest is not the registered
    one raise, so whatever is parsed from ``content`` was verified.
    """
    path, fs = _files(spark)
    there = [p for p in paths if fs(p).exists(path(p))]
    files = spark.read.format("binaryFile").load(there).select(_bare("path").alias("_path"), "content") if there else spark.createDataFrame([], "_path string, content binary")
    both = receipts.join(files, _bare("path") == F.col("_path"), "left").drop("_path")
    wrong = F.col("content").isNotNull() & (F.sha2("content", 256) != F.col("sha256"))
    return both.withColumn("content", F.when(wrong, F.raise_error(F.concat(F.lit("the digest of a file changed: "), F.col("path")))).otherwise(F.col("content")))


def parsed(files: DataFrame, columns: int = 200) -> DataFrame:
    """A row for each line below the header of ``content``: ordinal, and ``cells``, a map from column to text.

    Each file goes by its own header. A cell that a short row lacks is null;
    rows with more cells than their header, and headers of more than
    ``columns`` names, raise. Blank lines do not count.
    """
    text = F.regexp_replace(F.col("content").cast("string"), "\r\n", "\n")
    lines = files.withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: x != "")).where(F.size("_lines") > 0)
    schema = ", ".join(f"c{k} string" for k in range(columns + 1))
    cells = lambda line: F.array(*[F.from_csv(line, schema, {"sep": "\t", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "\u0001"})[f"c{k}"] for k in range(columns + 1)])
    head = F.split(F.get("_lines", F.lit(0)), "\t")
    checked = F.when(F.size(head) > columns, F.raise_error(F.lit(f"more than {columns} columns"))).otherwise(head)
    rows = lines.withColumn("_names", checked).select(*files.columns, "_names", F.posexplode("_lines").alias("ordinal", "_line")).where("ordinal > 0")
    simple = F.split("_line", "\t")
    split = F.when(F.contains("_line", F.lit('"')), F.filter(cells(F.col("_line")), lambda x: x.isNotNull())).otherwise(simple)
    rows = rows.withColumn("_cells", split)
    rows = rows.withColumn("_cells", F.when(F.size("_cells") > F.size("_names"), F.raise_error(F.concat(F.lit("more cells than columns: "), F.col("_line")))).otherwise(F.col("_cells")))
    pairs = F.map_from_arrays("_names", F.transform("_names", lambda _, k: F.get("_cells", k)))
    return rows.select(*[c for c in files.columns if c != "content"], "ordinal", pairs.alias("cells"))
