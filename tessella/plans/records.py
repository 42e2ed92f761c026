"""Record files (reads, alignments, features) shaped from the test tables, written, read back and queried."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import measures
from tessella.plans.domain import table
from tessella.sources import alignments, reads, scratch, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

LETTERS = "abcdefghijklmnopqrstuvwxyz"
BASES = "".join("ACGT"[k % 4] for k in range(26))
#: The least quality of a letter, by the remainder of the document's id.
LEAST = [2, 8, 12, 25]
QUALITY = [[least + k % 10 for k in range(26)] for least in LEAST]


def query(sql: str) -> Callable:
    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return keep


# ---------------------------------------------------------------- reads


def documents_as_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The letters of every document as a read whose qualities follow from them, through a FASTQ file."""
    letters = F.lower(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", ""))
    quality = F.translate(letters, LETTERS, "".join(chr(reads.ZERO + q) for q in QUALITY[-1]))
    for k, table_ in enumerate(QUALITY[:-1]):
        quality = F.when(F.pmod("doc_id", F.lit(4)) == k, F.translate(letters, LETTERS, "".join(chr(reads.ZERO + q) for q in table_))).otherwise(quality)
    header = F.concat_ws(" ", F.col("doc_id"), F.coalesce("lang", F.lit("none")))
    path = scratch.folder(spark)
    reads.write_fastq(table(spark, sf_dir, "documents").select(header.alias("header"), F.translate(letters, LETTERS, BASES).alias("sequence"), quality.alias("quality")), path)
    return reads.measured(reads.fastq(spark, path))


_CASES = " ".join(f"WHEN {k} THEN " + " + ".join(f"(length(w) - length(replace(w, '{c}', ''))) * {reads.errors(q)}" for c, q in zip(LETTERS, qs, strict=True)) for k, qs in enumerate(QUALITY))
_GC = "".join(c for c, b in zip(LETTERS, BASES, strict=True) if b in "GC")
READS = f"""r AS (SELECT doc_id, lang, w, CAST(length(w) AS BIGINT) AS length, CAST(length(regexp_replace(w, '[^{_GC}]', '', 'g')) AS BIGINT) AS gc, CAST(CASE doc_id % 4 {_CASES} END AS BIGINT) AS error_sum
 FROM (SELECT doc_id, coalesce(lang, 'none') AS lang, lower(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) AS w FROM documents))"""
KEPT = f"length >= 1000 AND error_sum <= length * {reads.errors(10)}"


@query(f"WITH {READS} SELECT CAST(doc_id AS VARCHAR) AS name, length, error_sum, CASE WHEN length > 0 THEN round(-10 * log10(error_sum / (length * 1e12)), 6) END AS mean_quality, ({KEPT}) AS kept FROM r")
def read_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents_as_reads(spark, sf_dir)
    kept = reads.kept(rows, "ont").select("name", F.lit(True).alias("kept"))
    return rows.select("name", "length", "error_sum", reads.mean_quality().alias("mean_quality")).join(kept, "name", "left").na.fill(False, ["kept"])


@query(f"""WITH {READS}, s AS (SELECT 'raw' AS side, * FROM r UNION ALL SELECT 'kept', * FROM r WHERE {KEPT}),
 u AS (SELECT side, lang, length, sum(length) OVER (PARTITION BY side, lang ORDER BY length DESC ROWS UNBOUNDED PRECEDING) AS upto, sum(length) OVER (PARTITION BY side, lang) AS total FROM s),
 n AS (SELECT side, lang, max(length) AS n50_bp FROM u WHERE upto >= (total + 1) // 2 GROUP BY ALL)
SELECT side, lang, count(*) AS num_seqs, CAST(sum(length) AS BIGINT) AS sum_len, min(length) AS min_len, max(length) AS max_len, CAST(sum(gc) AS BIGINT) AS gc_bp, any_value(n50_bp) AS n50_bp, CAST(sum(error_sum) AS BIGINT) AS error_sum FROM s LEFT JOIN n USING (side, lang) GROUP BY side, lang""")
def read_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents_as_reads(spark, sf_dir).withColumn("lang", F.substring_index("header", " ", -1))
    sides = F.when(reads.is_kept("ont"), F.array(F.lit("raw"), F.lit("kept"))).otherwise(F.array(F.lit("raw")))
    both = rows.select("*", F.explode(sides).alias("side"))
    return reads.statistics(both, ["side", "lang"])


@query(f"WITH {READS} SELECT lang, count(*) AS total_reads, CAST(sum(length) AS BIGINT) AS total_bases, count(*) FILTER ({KEPT}) AS retained_reads, CAST(sum(length) FILTER ({KEPT}) AS BIGINT) AS retained_bases, count(*) - count(*) FILTER ({KEPT}) AS rejected_reads, CAST(sum(length) - sum(length) FILTER ({KEPT}) AS BIGINT) AS rejected_bases FROM r GROUP BY lang HAVING count(*) FILTER ({KEPT}) > 0")
def filtered_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents_as_reads(spark, sf_dir).withColumn("lang", F.substring_index("header", " ", -1))
    sums = lambda r: reads.statistics(r, ["lang"]).select("lang", "num_seqs", "sum_len")
    return measures.conserved_reads(sums(rows), sums(reads.kept(rows, "ont")), ["lang"])


# ---------------------------------------------------------------- alignments

FLAGS = [0, 16, 256, 4, 2048, 1024]


def lines_as_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as alignment records of four CIGAR forms, through a SAM file."""
    text = lambda c: F.col(c).cast("string")
    q, d, n = F.col("l_quantity").cast("long").cast("string"), (F.round(F.col("l_discount") * 100).cast("int") + 1).cast("string"), text("l_linenumber")
    forms = [F.concat(q, F.lit("M")), F.concat(q, F.lit("M"), d, F.lit("N"), n, F.lit("M")), F.concat(F.lit("2S"), q, F.lit("M3I"), d, F.lit("D"), n, F.lit("M1H")), F.concat(n, F.lit("M"), d, F.lit("N"), q, F.lit("M90N5M"))]
    cigar = F.get(F.array(*forms), F.pmod("l_suppkey", F.lit(4)).cast("int"))
    flag = F.get(F.array(*map(F.lit, FLAGS)), F.pmod("l_partkey", F.lit(6)).cast("int")).cast("string")
    line = F.concat_ws("\t", F.concat_ws(".", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", q, d), flag, F.concat(F.lit("c"), F.pmod("l_suppkey", F.lit(50))), text("l_partkey"), q, cigar, F.lit("*"), F.lit("0"), F.lit("0"), F.lit("*"), F.lit("*"))
    path = scratch.folder(spark)
    table(spark, sf_dir, "lineitem").select(line.alias("value")).write.text(path)
    return alignments.sam(spark, path).drop("path", "sequence", "quality")


ALIGNED = """l AS (SELECT concat_ws('.', l_orderkey, l_linenumber, l_suppkey, l_partkey, CAST(l_quantity AS BIGINT), CAST(round(l_discount * 100) AS BIGINT) + 1) AS qname, [0, 16, 256, 4, 2048, 1024][l_partkey % 6 + 1] AS flag, 'c' || l_suppkey % 50 AS contig, l_partkey AS s, CAST(l_quantity AS BIGINT) AS q, CAST(round(l_discount * 100) AS BIGINT) + 1 AS d, CAST(l_linenumber AS BIGINT) AS n, l_suppkey % 4 AS form FROM lineitem),
 b AS (SELECT * FROM (SELECT *, unnest(CASE form WHEN 0 THEN [{'a': s, 'z': s + q - 1, 'gap': ''}] WHEN 1 THEN [{'a': s, 'z': s + q - 1, 'gap': ''}, {'a': s + q + d, 'z': s + q + d + n - 1, 'gap': 'N'}] WHEN 2 THEN [{'a': s, 'z': s + q - 1, 'gap': ''}, {'a': s + q + d, 'z': s + q + d + n - 1, 'gap': 'D'}]
 ELSE [{'a': s, 'z': s + n - 1, 'gap': ''}, {'a': s + n + d, 'z': s + n + d + q - 1, 'gap': 'N'}, {'a': s + n + d + q + 90, 'z': s + n + d + q + 94, 'gap': 'N'}] END, recursive := true) FROM l WHERE flag NOT IN (256, 4, 2048) AND q >= 20))"""


@query(f"""WITH {ALIGNED}, e AS (SELECT qname, contig, s, max(z) AS "end" FROM b GROUP BY ALL), i AS (SELECT 'b' || s_suppkey % 20 AS bin_id, 'c' || s_suppkey % 50 AS contig, s_suppkey * 3 AS lo, s_suppkey * 3 + 400 AS hi FROM supplier)
SELECT DISTINCT bin_id, qname, contig, s AS start, "end", a AS block_start, z AS block_end FROM e JOIN i USING (contig) JOIN (SELECT qname, a, z FROM b WHERE form IN (1, 3)) USING (qname) WHERE s <= hi AND "end" >= lo + 1""")
def spliced_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary spliced records of every bin's intervals, one row for each exon."""
    rows = alignments.primary(lines_as_alignments(spark, sf_dir))
    spliced = alignments.with_end(rows.where(alignments.is_spliced(F.col("cigar"))))
    at = F.col("s_suppkey").cast("long") * 3
    beds = table(spark, sf_dir, "supplier").select(F.concat(F.lit("b"), F.pmod("s_suppkey", F.lit(20))).alias("bin_id"), F.concat(F.lit("c"), F.pmod("s_suppkey", F.lit(50))).alias("contig"), at.alias("from"), (at + 400).alias("to"))
    found = alignments.selected(spliced, beds).withColumn("x", F.explode(alignments.exons(F.col("cigar"), F.col("start"))))
    return found.select("bin_id", "qname", "contig", "start", "end", F.col("x.start").alias("block_start"), F.col("x.end").alias("block_end"))


@query(f"""WITH {ALIGNED}, k AS (SELECT DISTINCT 'c' || s_suppkey % 50 AS contig FROM supplier), n AS (SELECT contig, count(*) AS numreads FROM l WHERE flag NOT IN (256, 4, 2048) AND q >= 20 GROUP BY contig),
 w AS (SELECT contig, a, z, max(z) OVER (PARTITION BY contig ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM b),
 c AS (SELECT contig, sum(z - a + 1) AS bp, sum(greatest(0, z - greatest(coalesce(before, 0), a - 1))) AS cov FROM w GROUP BY contig)
SELECT contig, CAST(50000 AS BIGINT) AS length_bp, coalesce(numreads, 0) AS numreads, CAST(coalesce(cov, 0) AS BIGINT) AS covbases, 100 * CAST(coalesce(cov, 0) AS DOUBLE) / 50000 AS coverage, CAST(coalesce(bp, 0) AS DOUBLE) / 50000 AS meandepth FROM k LEFT JOIN n USING (contig) LEFT JOIN c USING (contig)""")
def alignment_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads, covered bases and mean depth of every contig; deletions and introns are not covered."""
    rows = alignments.primary(lines_as_alignments(spark, sf_dir))
    contigs = table(spark, sf_dir, "supplier").select(F.concat(F.lit("c"), F.pmod("s_suppkey", F.lit(50))).alias("contig"), F.lit(50_000).cast("long").alias("length_bp")).distinct()
    return measures.record_coverage(contigs, rows.select("contig", alignments.aligned_blocks(F.col("cigar"), F.col("start")).alias("blocks")), ["contig"])


# ---------------------------------------------------------------- features

#: Orders whose lines make one feature file, and where its sequences begin.
FILE_ORDERS, FASTA_FROM = 4000, 3900


def lines_as_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as features, in files of some thousand orders with model comments and a sequence part."""
    key = F.col("l_orderkey")
    feature = F.when(F.col("l_linestatus") == "F", F.lit("CDS")).otherwise(F.lit("gene"))
    strand = F.when(F.col("l_returnflag") == "A", F.lit("+")).when(F.col("l_returnflag") == "R", F.lit("-")).otherwise(F.lit("."))
    phase = F.when(F.col("l_linestatus") == "F", (F.col("l_partkey") % 3).cast("string")).otherwise(F.lit("."))
    row = F.concat_ws("\t", F.concat(F.lit("c"), F.col("l_suppkey")), F.lit("caller"), feature, F.col("l_partkey") + 1, F.col("l_partkey") + 1 + F.col("l_quantity").cast("long"), F.lit("."), strand, phase, F.concat(F.lit("ID="), key, F.lit("_"), F.col("l_linenumber"), F.lit(";note=a%2Cb")))
    comment = F.when(key % 7 == 0, F.lit("# Model Data: version=x")).when(key % 3 == 0, F.concat(F.lit("# Model Data: version=x;transl_table="), (key % 25 + 1), F.lit(";x=y")))
    mark = F.when(key % FILE_ORDERS >= FASTA_FROM, F.lit("##FASTA"))
    lines = table(spark, sf_dir, "lineitem").select(F.floor(key / FILE_ORDERS).alias("file"), key.alias("k"), F.col("l_linenumber").alias("n"), F.array_compact(F.array(F.when(F.col("l_linenumber") == 1, comment), mark, row)).alias("value"))
    path = scratch.folder(spark)
    placed = lines.select("file", "k", "n", F.posexplode("value").alias("p", "value")).repartition("file").sortWithinPartitions("file", "k", "n", "p")
    placed.select("file", "value").write.partitionBy("file").text(path)
    return tables.gff(spark, path)


FEATURES = f"""f AS (SELECT l_orderkey // {FILE_ORDERS} AS file, l_orderkey AS k, l_linenumber AS n, CASE WHEN l_linestatus = 'F' THEN 'CDS' ELSE 'gene' END AS feature, l_partkey + 1 AS start, l_partkey + 1 + CAST(l_quantity AS BIGINT) AS "end", CASE l_returnflag WHEN 'A' THEN '+' WHEN 'R' THEN '-' ELSE 'unknown' END AS strand,
 CASE WHEN l_linestatus = 'F' THEN CAST(l_partkey % 3 AS INTEGER) END AS phase, CASE WHEN l_linenumber <> 1 THEN NULL WHEN l_orderkey % 7 = 0 THEN -1 WHEN l_orderkey % 3 = 0 THEN l_orderkey % 25 + 1 END AS code FROM lineitem),
 g AS (SELECT *, last_value(code IGNORE NULLS) OVER (PARTITION BY file ORDER BY k, n ROWS UNBOUNDED PRECEDING) AS model FROM f)"""


@query(f"""WITH {FEATURES} SELECT CAST(file AS VARCHAR) AS file, k || '_' || n AS id, feature, start, "end", strand, phase, CAST(nullif(model, -1) AS INTEGER) AS transl_table FROM g WHERE k % {FILE_ORDERS} < {FASTA_FROM}""")
def feature_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines_as_features(spark, sf_dir)
    return rows.select(_file(), F.element_at("attributes", F.lit("ID")).alias("id"), "feature", "start", "end", "strand", "phase", "transl_table")


@query(f"WITH {FEATURES} SELECT CAST(file AS VARCHAR) AS file, feature, count(*) AS n FROM g WHERE k % {FILE_ORDERS} < {FASTA_FROM} GROUP BY ALL")
def feature_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.feature_counts(lines_as_features(spark, sf_dir)).select(_file(), "feature", "n")


def _file() -> Column:
    return F.regexp_extract("path", "file=([0-9]+)", 1).alias("file")
