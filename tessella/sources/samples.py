"""Sample sheets: one row for each sample, paths resolved beside the sheet, and what must be refused."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators.keys import duplicates
from tessella.operators.schema_rules import field_violations
from tessella.sources.tables import read_table

#: The columns of a sheet, those that hold paths, and the rules of their values.
COLUMNS = ["sample_id", "platform", "reads", "assembly", "rna_reads", "rna_platform", "protein_reference", "protein_lineage", "genetic_code", "softmasked", "basecaller", "basecaller_model", "library_prep"]
REQUIRED = ["sample_id", "platform", "reads"]
PATHS = ["reads", "assembly", "rna_reads", "protein_reference", "softmasked"]
UNSAFE = "[\r\n\u0000'\"`$]"
SCHEMA = {
    "required": REQUIRED,
    "properties": {
        "sample_id": {"type": "string", "pattern": "^[A-Za-z0-9][A-Za-z0-9_.-]{0,79}$"}, "platform": {"type": "string", "enum": ["ONT", "PACBIO_HIFI"]}, "rna_platform": {"type": "string", "enum": ["ONT_CDNA", "ONT_DIRECT", "PACBIO_ISOSEQ", "ILLUMINA"]},
        "protein_lineage": {"type": "string", "pattern": "^[A-Za-z0-9][A-Za-z0-9_.:; /-]*$"}, "genetic_code": {"type": "string", "pattern": "^(auto|[1-6]|9|1[0-6]|2[1-5])$"},
    },
}


def read(spark: SparkSession, path: str) -> DataFrame:
    """The sheet with all its columns, empty cells null, the code ``auto`` where none is given, and paths made absolute beside the sheet.

    Raises for a column that a sheet does not have or lacks a required one.
    """
    rows = read_table(spark, path, REQUIRED)
    if strange := [c for c in rows.columns if c not in COLUMNS]:
        raise ValueError(f"unsupported columns {', '.join(strange)}: {path}")
    base = path.rsplit("/", 1)[0] if "/" in path else "."
    cell = lambda c: F.nullif(F.col(c), F.lit("")) if c in rows.columns else F.lit(None).cast("string")
    at = lambda c: F.when(c.rlike("^([a-z0-9]+:)?/"), c).otherwise(F.concat(F.lit(f"{base}/"), c))
    code = F.coalesce(cell("genetic_code"), F.lit("auto"))
    return rows.select(*[(at(cell(c)) if c in PATHS else code if c == "genetic_code" else cell(c)).alias(c) for c in COLUMNS])


def problems(samples: DataFrame) -> DataFrame:
    """(sample_id, detail): values out of their rules, unsafe paths, evidence without its other half, and samples that come twice."""
    fields = field_violations(samples, SCHEMA, ["sample_id"]).select("sample_id", F.concat_ws(": ", "field", "rule").alias("detail"))
    bad = lambda when, text: samples.where(F.coalesce(when, F.lit(False))).select("sample_id", F.lit(text).alias("detail"))
    lone = lambda a, b: F.col(a).isNull() != F.col(b).isNull()
    unsafe = reduce(Column.__or__, [F.coalesce(F.col(c).rlike(UNSAFE), F.lit(False)) for c in PATHS])
    called = F.col("basecaller").isNotNull() | F.col("basecaller_model").isNotNull()
    parts = [
        fields, bad(unsafe, "unsafe path"), bad(lone("rna_reads", "rna_platform"), "RNA reads and platform belong together"), bad(F.col("rna_reads") == F.col("reads"), "RNA reads are the DNA reads"),
        bad(lone("protein_reference", "protein_lineage"), "protein reference and lineage belong together"), bad(F.col("softmasked").isNotNull() & F.col("assembly").isNull(), "a masked assembly needs its assembly"), bad((F.col("platform") != "ONT") & called, "basecaller of another platform"),
        duplicates(samples, ["sample_id"]).select("sample_id", F.lit("repeated sample").alias("detail")),
    ]
    return reduce(DataFrame.union, parts)


def missing_files(samples: DataFrame) -> list[str]:
    """Paths that are no file or an empty one. The sheet is as long as the run has samples; each path is looked up once."""
    spark = samples.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    named = samples.select(F.explode(F.array_compact(F.array(*PATHS))).alias("path")).distinct()
    lost = []
    for row in named.toLocalIterator():
        at = jvm.org.apache.hadoop.fs.Path(row.path)
        fs = at.getFileSystem(conf)
        if not fs.exists(at) or fs.getFileStatus(at).isDirectory() or fs.getFileStatus(at).getLen() == 0:
            lost.append(row.path)
    return sorted(lost)
