"""Evidence-shaped views over the test tables, and the same views as SQL text for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLASSES = {"A": "prokaryote", "N": "eukaryote", "R": "organelle"}
STATES = {"F": "ok", "O": "ok", "P": "filtered"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as contigs: bin_id, contig_id, length_bp, contig_class, is_virus, gc_bp, reads."""
    li = table(spark, sf_dir, "lineitem")
    kind = F.coalesce(*[F.when(F.col("l_returnflag") == k, F.lit(v)) for k, v in CLASSES.items()], F.lit("unclassified"))
    quantity = F.col("l_quantity").cast("long")
    return li.select(
        F.col("l_orderkey").alias("bin_id"), F.concat_ws(".", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("contig_id"),
        (quantity * 1000).alias("length_bp"), kind.alias("contig_class"), ((F.col("l_linestatus") == "F") & (F.col("l_discount") >= 0.05)).alias("is_virus"),
        (quantity * F.round(F.col("l_tax") * 1000).cast("long")).alias("gc_bp"), F.col("l_partkey").alias("reads"), F.col("l_linenumber").cast("long").alias("ordinal"),
        F.col("l_suppkey").alias("suppkey"), F.col("l_linestatus").alias("linestatus"), F.col("l_returnflag").alias("returnflag"), F.round(F.col("l_discount") * 100).cast("int").alias("discount"),
    )


CONTIGS = """contigs AS (SELECT l_orderkey AS bin_id, concat_ws('.', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS contig_id,
 CAST(l_quantity AS BIGINT) * 1000 AS length_bp,
 CASE l_returnflag WHEN 'A' THEN 'prokaryote' WHEN 'N' THEN 'eukaryote' WHEN 'R' THEN 'organelle' ELSE 'unclassified' END AS contig_class,
 (l_linestatus = 'F' AND l_discount >= 0.05) AS is_virus, CAST(l_quantity AS BIGINT) * CAST(round(l_tax * 1000) AS BIGINT) AS gc_bp,
 l_partkey AS reads, CAST(l_linenumber AS BIGINT) AS ordinal, l_suppkey AS suppkey, l_linestatus AS linestatus, l_returnflag AS returnflag,
 CAST(round(l_discount * 100) AS INTEGER) AS discount FROM lineitem)"""


def bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("bin_id"))


BINS = "bins AS (SELECT o_orderkey AS bin_id FROM orders)"

MAJORITIES = ["d_BAC;p_x", "d_EUK;p_y", "d_NCLDV;c_z", "nd", "d_MITO", "d_EUK-pEVE", "d_ARC", ""]
QUICK = ["d__Bacteria;p__a", "d__Eukaryota;p__b", "sk__Archaea", "d__Viruses;x", ""]


def routing_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The seven evidence tables, derived from orders and line items."""
    o, c = table(spark, sf_dir, "orders"), contigs(spark, sf_dir)
    key = F.col("o_orderkey").alias("bin_id")
    pick = lambda names, k: F.get(F.array(*[F.lit(n) for n in names]), F.pmod(k, F.lit(len(names))).cast("int"))
    status = F.coalesce(*[F.when(F.col("o_orderstatus") == k, F.lit(v)) for k, v in STATES.items()], F.lit("error"))
    locus = (F.col("discount") == 7) & (F.col("linestatus") == "O")
    called = F.when(F.col("discount") == 9, F.concat("contig_id", F.lit("|provirus_1_9"))).otherwise(F.col("contig_id"))
    return {
        "bins": o.select(key),
        "contigs": c,
        "lineage": o.select(key, status.alias("status"), F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" k__"), F.col("o_orderpriority"))).otherwise(" ").alias("lineage"), F.pmod(F.col("o_orderkey"), F.lit(10)).cast("int").alias("markers")),
        "majority": o.select(key, pick(MAJORITIES, F.col("o_custkey")).alias("majority"), F.concat(F.lit("m"), F.col("o_custkey") % 4).alias("majority_confidence")),
        "quick": o.select(key, pick(QUICK, F.col("o_orderkey") + F.col("o_custkey")).alias("quick_lineage"), F.concat(F.lit("c"), F.col("o_custkey") % 3).alias("quick_confidence")),
        "loci": c.where(locus).select("bin_id", F.struct("ordinal", "contig_id").alias("ordinal"), F.concat(F.lit("l"), F.col("ordinal"), F.lit("@"), F.col("contig_id")).alias("item"), F.struct(F.concat(F.lit("l"), F.col("ordinal")).alias("name"), F.col("contig_id").alias("contig_name"), F.concat(F.lit("k__"), F.col("returnflag")).alias("taxonomy"), F.lit("Eukaryota").alias("taxonomy_domain"), F.lit("").alias("reference_taxonomy"), F.lit("").alias("blast_candidate_taxonomy")).alias("record")),
        "viruses": c.where(F.col("is_virus")).select("bin_id", F.struct("ordinal", "contig_id").alias("ordinal"), called.alias("item"), F.struct(called.alias("seq_name"), F.concat(F.lit("0."), F.col("discount")).alias("virus_score"), F.concat(F.lit("Viruses;"), F.col("returnflag")).alias("taxonomy")).alias("record")),
        "completeness": o.select(key, F.when(F.pmod(F.col("o_custkey"), F.lit(7)) != 0, F.pmod(F.col("o_custkey"), F.lit(300)) / 10.0).alias("completeness"), (F.pmod(F.col("o_orderkey"), F.lit(64)) / 32.0).alias("contamination")),
    }
