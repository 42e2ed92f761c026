"""Queries over the evidence-shaped views, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.functions import text
from tessella.operators import collect, cover, keys, measures, parse, routing
from tessella.plans import catalog, native_tables, outputs, records, report, violations
from tessella.plans.domain import BINS, CONTIGS, bins, contigs, routing_inputs, table
from tessella.sources.scratch import stable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


# ---------------------------------------------------------------- routing


FACTS = f"""WITH {CONTIGS}, comp AS (SELECT bin_id, CAST(sum(length_bp) AS BIGINT) AS bin_bp,
 CAST(sum(CASE WHEN contig_class = 'eukaryote' THEN length_bp ELSE 0 END) AS BIGINT) AS euk_bp, CAST(sum(CASE WHEN contig_class = 'prokaryote' THEN length_bp ELSE 0 END) AS BIGINT) AS prok_bp,
 CAST(sum(CASE WHEN contig_class = 'organelle' THEN length_bp ELSE 0 END) AS BIGINT) AS org_bp, CAST(sum(CASE WHEN is_virus THEN length_bp ELSE 0 END) AS BIGINT) AS viral_bp,
 CAST(sum(CASE WHEN contig_class = 'unclassified' THEN length_bp ELSE 0 END) AS BIGINT) AS uncl_bp, CAST(sum(CASE WHEN contains(contig_id, '_duplicated-yes') THEN length_bp ELSE 0 END) AS BIGINT) AS dup_bp FROM contigs GROUP BY bin_id),
loci AS (SELECT bin_id, list('SSU:l' || ordinal || '@' || contig_id ORDER BY ordinal, contig_id) AS ssu FROM contigs WHERE discount = 7 AND linestatus = 'O' GROUP BY bin_id),
loci_json AS (SELECT bin_id, to_json(list(struct_pack(name := 'l' || ordinal, contig_name := contig_id, taxonomy := 'k__' || returnflag, taxonomy_domain := 'Eukaryota', reference_taxonomy := '', blast_candidate_taxonomy := '') ORDER BY ordinal, contig_id)) AS j FROM contigs WHERE discount = 7 AND linestatus = 'O' GROUP BY bin_id),
vir_json AS (SELECT bin_id, to_json(list(struct_pack(seq_name := CASE WHEN discount = 9 THEN contig_id || '|provirus_1_9' ELSE contig_id END, virus_score := '0.' || discount, taxonomy := 'Viruses;' || returnflag) ORDER BY ordinal, contig_id)) AS j FROM contigs WHERE is_virus GROUP BY bin_id),
vir AS (SELECT bin_id, list('geNomad:' || contig_id ORDER BY ordinal, contig_id) AS calls FROM contigs WHERE is_virus AND discount <> 9 GROUP BY bin_id),
f AS (SELECT o.o_orderkey AS bin_id, CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'ok' WHEN 'P' THEN 'filtered' ELSE 'error' END AS status,
 CASE WHEN o_orderstatus = 'F' THEN ' k__' || o_orderpriority ELSE ' ' END AS lineage, o_orderkey % 10 AS markers,
 (['d_BAC;p_x','d_EUK;p_y','d_NCLDV;c_z','nd','d_MITO','d_EUK-pEVE','d_ARC',''])[o_custkey % 8 + 1] AS majority,
 (['d__Bacteria;p__a','d__Eukaryota;p__b','sk__Archaea','d__Viruses;x',''])[(o_orderkey + o_custkey) % 5 + 1] AS quick_lineage,
 CASE WHEN o_custkey % 7 <> 0 THEN (o_custkey % 300) / 10.0::DOUBLE END AS completeness, (o_orderkey % 64) / 32.0::DOUBLE AS contamination,
 coalesce(bin_bp, 0) AS bin_bp, coalesce(euk_bp, 0) AS euk_bp, coalesce(prok_bp, 0) AS prok_bp, coalesce(org_bp, 0) AS org_bp, coalesce(viral_bp, 0) AS viral_bp, coalesce(uncl_bp, 0) AS uncl_bp, coalesce(dup_bp, 0) AS dup_bp, o_custkey,
 coalesce(ssu, []) AS ssu, coalesce(calls, []) AS calls
 FROM orders o LEFT JOIN comp c ON o.o_orderkey = c.bin_id LEFT JOIN loci l ON o.o_orderkey = l.bin_id LEFT JOIN vir v ON o.o_orderkey = v.bin_id),
g AS (SELECT *, CASE split_part(majority, ';', 1) WHEN 'd_BAC' THEN 'prokaryotic' WHEN 'd_ARC' THEN 'prokaryotic' WHEN 'd_EUK' THEN 'eukaryotic' WHEN 'd_NCLDV' THEN 'viral' WHEN 'd_MITO' THEN 'organelle' WHEN 'd_EUK-pEVE' THEN 'ambiguous' ELSE '' END AS gv,
 CASE split_part(quick_lineage, ';', 1) WHEN 'd__Bacteria' THEN 'prokaryotic' WHEN 'sk__Archaea' THEN 'prokaryotic' WHEN 'd__Eukaryota' THEN 'eukaryotic' ELSE '' END AS quick, split_part(quick_lineage, ';', 1) AS qd,
 CASE WHEN bin_bp > 0 THEN euk_bp::DOUBLE / bin_bp ELSE 0 END AS es, CASE WHEN bin_bp > 0 THEN prok_bp::DOUBLE / bin_bp ELSE 0 END AS ps,
 CASE WHEN bin_bp > 0 THEN org_bp::DOUBLE / bin_bp ELSE 0 END AS os, CASE WHEN bin_bp > 0 THEN viral_bp::DOUBLE / bin_bp ELSE 0 END AS vs FROM f),
h AS (SELECT *, (status = 'ok' AND trim(lineage) <> '') AS resolved, (status = 'ok' AND trim(lineage) = '' AND markers < 5 AND gv = 'eukaryotic') AS fallback, len(ssu) > 0 AS has_ssu,
 es + os >= 0.5 AS te, ps >= 0.8 AS tp, (os >= 0.5 AND bin_bp <= 2000000 AND gv <> 'prokaryotic') AS torg, coalesce(completeness >= 10, false) AS ckm, (gv = 'viral' OR vs >= 0.5) AS viral FROM g),
i AS (SELECT *, list_filter([CASE WHEN resolved THEN 'CheckEUK' END, CASE WHEN gv = 'eukaryotic' THEN 'GVClass' END, CASE WHEN has_ssu THEN 'a physically linked eukaryotic 18S locus' END, CASE WHEN te THEN 'Tiara' END], lambda x: x IS NOT NULL) AS lines FROM h),
j AS (SELECT *, (len(lines) >= 2 OR fallback) AS euk, (tp AND ckm AND NOT has_ssu) AS tcp, (resolved OR gv = 'eukaryotic' OR has_ssu) AS other, (gv = 'organelle' OR torg) AS organelle FROM i),
k AS (SELECT *, (gv = 'prokaryotic' OR tcp) AS prok FROM j),
r AS (SELECT *, CASE WHEN gv = 'ambiguous' THEN 'unresolved' WHEN organelle THEN 'unresolved' WHEN tcp AND viral THEN 'unresolved' WHEN tcp THEN 'prokaryotic'
 WHEN euk AND (viral OR gv = 'prokaryotic' OR tp) THEN 'unresolved' WHEN euk THEN 'eukaryotic' WHEN viral AND (prok OR other) THEN 'unresolved' WHEN viral THEN 'viral' WHEN gv = 'prokaryotic' THEN 'prokaryotic' ELSE 'unresolved' END AS route,
 CASE WHEN gv = 'ambiguous' THEN 'conflicting' WHEN organelle AND (euk OR viral) THEN 'conflicting' WHEN organelle THEN 'unresolved' WHEN tcp AND viral THEN 'conflicting' WHEN tcp THEN 'bacterial_archaeal_candidate'
 WHEN euk AND (viral OR gv = 'prokaryotic' OR tp) THEN 'conflicting' WHEN euk THEN 'eukaryotic_candidate' WHEN viral AND (prok OR other) THEN 'conflicting' WHEN viral THEN 'viral_candidate' WHEN gv = 'prokaryotic' THEN 'bacterial_archaeal_candidate' ELSE 'unresolved' END AS candidate_class FROM k)
"""


@query(FACTS + """SELECT bin_id, route, candidate_class, array_to_string(list_filter([
 CASE WHEN gv = 'organelle' THEN 'GVClass:' || majority END, CASE WHEN torg THEN 'Tiara:' || printf('%.4f', os) END,
 CASE WHEN euk AND route <> 'prokaryotic' AND resolved THEN 'CheckEUK:' || lineage END, CASE WHEN euk AND route <> 'prokaryotic' AND gv = 'eukaryotic' THEN 'GVClass:' || majority END,
 CASE WHEN euk AND route <> 'prokaryotic' AND len(ssu) > 0 THEN array_to_string(ssu, ' ~ ') END, CASE WHEN euk AND route <> 'prokaryotic' AND te THEN 'Tiara:' || printf('%.4f', es + os) END,
 CASE WHEN gv = 'prokaryotic' THEN 'GVClass:' || majority END, CASE WHEN gv = 'prokaryotic' AND quick = 'prokaryotic' THEN 'QuickClade:' || quick_lineage END,
 CASE WHEN tcp THEN 'Tiara:' || printf('%.4f', ps) END, CASE WHEN tcp THEN 'CheckM2:' || printf('%.2f', completeness) || '/' || printf('%.2f', contamination) END,
 CASE WHEN gv = 'viral' THEN 'GVClass:' || majority END, CASE WHEN vs >= 0.5 AND len(calls) > 0 THEN array_to_string(calls, ' ~ ') END], lambda x: x IS NOT NULL), ' ~ ') AS supporting,
 array_to_string(list_filter([CASE WHEN qd <> '' AND quick = '' THEN 'QuickClade-unresolved:' || quick_lineage END, CASE WHEN euk AND quick = 'prokaryotic' THEN 'QuickClade:' || quick_lineage END,
 CASE WHEN viral AND prok THEN 'prokaryotic evidence conflicts with viral evidence' END, CASE WHEN viral AND other THEN 'eukaryotic evidence conflicts with viral evidence' END,
 CASE WHEN euk AND gv = 'prokaryotic' THEN 'GVClass:' || majority END, CASE WHEN euk AND tp AND NOT tcp THEN 'Tiara:' || printf('%.4f', ps) END, CASE WHEN gv = 'ambiguous' THEN 'GVClass:' || majority END,
 CASE WHEN organelle AND (euk OR viral) THEN 'organelle evidence conflicts with supported routing evidence' END, CASE WHEN tcp AND resolved THEN 'CheckEUK:' || lineage END, CASE WHEN tcp AND gv = 'eukaryotic' THEN 'GVClass:' || majority END,
 CASE WHEN vs > 0 AND vs < 0.5 THEN 'geNomad-minority:' || printf('%.4f', vs) END], lambda x: x IS NOT NULL), ' ~ ') AS conflicting,
 CASE WHEN resolved THEN trim(lineage) WHEN euk AND fallback AND route = 'eukaryotic' THEN majority ELSE '' END AS taxonomy FROM r""")
def route_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = routing.bin_facts(**routing_inputs(spark, sf_dir), keys=["bin_id"])
    return routing.route(facts).select("bin_id", "route", "candidate_class", F.array_join("supporting", " ~ ").alias("supporting"), F.array_join("conflicting", " ~ ").alias("conflicting"), "taxonomy")


LEDGER_LISTS = [
    """list_filter([
 CASE WHEN gv = 'organelle' THEN 'GVClass:' || majority END, CASE WHEN torg THEN 'Tiara:' || printf('%.4f', os) END,
 CASE WHEN euk AND route <> 'prokaryotic' AND resolved THEN 'CheckEUK:' || lineage END, CASE WHEN euk AND route <> 'prokaryotic' AND gv = 'eukaryotic' THEN 'GVClass:' || majority END,
 NULL], lambda x: x IS NOT NULL) || CASE WHEN euk AND route <> 'prokaryotic' THEN ssu ELSE [] END || list_filter([ CASE WHEN euk AND route <> 'prokaryotic' AND te THEN 'Tiara:' || printf('%.4f', es + os) END,
 CASE WHEN gv = 'prokaryotic' THEN 'GVClass:' || majority END, CASE WHEN gv = 'prokaryotic' AND quick = 'prokaryotic' THEN 'QuickClade:' || quick_lineage END,
 CASE WHEN tcp THEN 'Tiara:' || printf('%.4f', ps) END, CASE WHEN tcp THEN 'CheckM2:' || printf('%.2f', completeness) || '/' || printf('%.2f', contamination) END,
 CASE WHEN gv = 'viral' THEN 'GVClass:' || majority END, NULL], lambda x: x IS NOT NULL) || CASE WHEN vs >= 0.5 THEN calls ELSE [] END""",
    """list_filter([CASE WHEN qd <> '' AND quick = '' THEN 'QuickClade-unresolved:' || quick_lineage END, CASE WHEN euk AND quick = 'prokaryotic' THEN 'QuickClade:' || quick_lineage END,
 CASE WHEN viral AND prok THEN 'prokaryotic evidence conflicts with viral evidence' END, CASE WHEN viral AND other THEN 'eukaryotic evidence conflicts with viral evidence' END,
 CASE WHEN euk AND gv = 'prokaryotic' THEN 'GVClass:' || majority END, CASE WHEN euk AND tp AND NOT tcp THEN 'Tiara:' || printf('%.4f', ps) END, CASE WHEN gv = 'ambiguous' THEN 'GVClass:' || majority END,
 CASE WHEN organelle AND (euk OR viral) THEN 'organelle evidence conflicts with supported routing evidence' END, CASE WHEN tcp AND resolved THEN 'CheckEUK:' || lineage END, CASE WHEN tcp AND gv = 'eukaryotic' THEN 'GVClass:' || majority END,
 CASE WHEN vs > 0 AND vs < 0.5 THEN 'geNomad-minority:' || printf('%.4f', vs) END], lambda x: x IS NOT NULL)""",
]


@query(FACTS + f""", q AS (SELECT *, CASE WHEN gv = 'ambiguous' THEN 'GVClass reports an ambiguous eukaryote-virus class' WHEN organelle AND gv = 'organelle' THEN 'GVClass reports an organelle class without a gene-calling route'
 WHEN organelle THEN 'Tiara classifies most of the bin as organelle sequence without a gene-calling route' WHEN tcp AND viral THEN 'supported evidence conflicts across routes'
 WHEN tcp AND gv = 'prokaryotic' THEN 'GVClass supports a prokaryotic route without a supported eukaryotic or viral conflict' WHEN tcp THEN 'Tiara and CheckM2 support a prokaryotic route'
 WHEN euk AND (viral OR gv = 'prokaryotic' OR tp) THEN 'supported evidence conflicts across routes' WHEN euk AND fallback THEN 'GVClass supports a eukaryotic route; CheckEUK has too few markers to name a lineage'
 WHEN euk THEN lines[1] || ' and ' || lines[2] || ' support a eukaryotic route' WHEN viral AND (prok OR other) THEN 'supported evidence conflicts across routes'
 WHEN viral THEN 'GVClass or linked whole-contig geNomad evidence supports a viral route' WHEN gv = 'prokaryotic' THEN 'GVClass supports a prokaryotic route without a supported eukaryotic or viral conflict'
 WHEN len(lines) > 0 THEN 'eukaryotic evidence does not meet the combined support rule' ELSE 'no supported routing evidence' END AS reason FROM r)
SELECT 's1' AS sample_id, 'r1' AS run_id, CAST(bin_id AS VARCHAR) AS bin_id, route, candidate_class, reason, status AS checkeuk_status, lineage AS checkeuk_lineage,
 CASE WHEN resolved THEN trim(lineage) WHEN euk AND fallback AND route = 'eukaryotic' THEN majority ELSE '' END AS taxonomy,
 CASE WHEN resolved THEN 'checkeuk' WHEN euk AND fallback AND route = 'eukaryotic' THEN 'gvclass_fallback' ELSE '' END AS taxonomy_source,
 qd AS quickclade_domain, quick_lineage AS quickclade_lineage, 'c' || (o_custkey % 3) AS quickclade_confidence, split_part(majority, ';', 1) AS gvclass_domain,
 majority AS gvclass_taxonomy_majority, 'm' || (o_custkey % 4) AS gvclass_taxonomy_confidence, coalesce(CAST(lj.j AS VARCHAR), '[]') AS linked_eukaryotic_ssu, coalesce(CAST(vj.j AS VARCHAR), '[]') AS linked_genomad_viruses,
 CAST(to_json({LEDGER_LISTS[0]}) AS VARCHAR) AS supporting_evidence, CAST(to_json({LEDGER_LISTS[1]}) AS VARCHAR) AS conflicting_evidence, CAST(bin_bp AS VARCHAR) AS bin_bp,
 printf('%.4f', es) AS tiara_eukaryote_fraction, printf('%.4f', ps) AS tiara_prokaryote_fraction, printf('%.4f', os) AS tiara_organelle_fraction,
 printf('%.4f', CASE WHEN bin_bp > 0 THEN uncl_bp::DOUBLE / bin_bp ELSE 0 END) AS tiara_unclassified_fraction, printf('%.4f', vs) AS viral_contig_fraction,
 coalesce(printf('%.2f', completeness), '') AS checkm2_completeness, CASE WHEN completeness IS NULL THEN '' ELSE printf('%.2f', contamination) END AS checkm2_contamination,
 printf('%.4f', CASE WHEN bin_bp > 0 THEN dup_bp::DOUBLE / bin_bp ELSE 0 END) AS duplicated_contig_fraction FROM q LEFT JOIN loci_json lj USING (bin_id) LEFT JOIN vir_json vj USING (bin_id)""")
def evidence_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = routing_inputs(spark, sf_dir)
    facts = routing.bin_facts(**given, keys=["bin_id"])
    return routing.ledger(routing.route(facts), given["loci"], given["viruses"], ["bin_id"]).withColumns({"sample_id": F.lit("s1"), "run_id": F.lit("r1")}).select(*routing.LEDGER)


@query(f"""WITH {CONTIGS} SELECT bin_id, CAST(sum(length_bp) AS BIGINT) AS bin_bp, CAST(sum(CASE WHEN contig_class = 'eukaryote' THEN length_bp ELSE 0 END) AS BIGINT) AS euk_bp,
 CAST(sum(CASE WHEN contig_class = 'prokaryote' THEN length_bp ELSE 0 END) AS BIGINT) AS prok_bp, CAST(sum(CASE WHEN contig_class = 'organelle' THEN length_bp ELSE 0 END) AS BIGINT) AS org_bp,
 CAST(sum(CASE WHEN contig_class = 'unclassified' THEN length_bp ELSE 0 END) AS BIGINT) AS uncl_bp, CAST(sum(CASE WHEN is_virus THEN length_bp ELSE 0 END) AS BIGINT) AS viral_bp, CAST(sum(CASE WHEN contains(contig_id, '_duplicated-yes') THEN length_bp ELSE 0 END) AS BIGINT) AS dup_bp FROM contigs GROUP BY bin_id""")
def bin_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.composition(contigs(spark, sf_dir), ["bin_id"])


# ---------------------------------------------------------------- measures


@query(f"""WITH {CONTIGS}, w AS (SELECT bin_id, length_bp, sum(length_bp) OVER (PARTITION BY bin_id ORDER BY length_bp DESC, contig_id ROWS UNBOUNDED PRECEDING) AS upto, sum(length_bp) OVER (PARTITION BY bin_id) AS total FROM contigs)
SELECT bin_id, CAST(max(length_bp) AS BIGINT) AS n50_bp FROM w WHERE upto >= (total + 1) // 2 GROUP BY bin_id""")
def n50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.n50(contigs(spark, sf_dir), ["bin_id"])


@query(f"WITH {CONTIGS} SELECT bin_id, count(*) AS contig_count, CAST(sum(length_bp) AS BIGINT) AS assembly_length_bp, CAST(max(length_bp) AS BIGINT) AS longest_bp FROM contigs GROUP BY bin_id")
def assembly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.totals(contigs(spark, sf_dir), ["bin_id"])


@query(f"WITH {CONTIGS} SELECT bin_id, CAST(sum(gc_bp) AS DOUBLE) / sum(length_bp) AS gc_fraction FROM contigs GROUP BY bin_id")
def gc_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.gc_fraction(contigs(spark, sf_dir), ["bin_id"])


@query(f"""WITH {CONTIGS}, {BINS}, w AS (SELECT bin_id, length_bp, sum(length_bp) OVER (PARTITION BY bin_id ORDER BY length_bp DESC, contig_id ROWS UNBOUNDED PRECEDING) AS upto, sum(length_bp) OVER (PARTITION BY bin_id) AS total FROM contigs),
n AS (SELECT bin_id, max(length_bp) AS n50_bp FROM w WHERE upto >= (total + 1) // 2 GROUP BY bin_id), t AS (SELECT bin_id, count(*) AS c, sum(length_bp) AS s, max(length_bp) AS m FROM contigs GROUP BY bin_id)
SELECT b.bin_id, coalesce(c, 0) AS contig_count, CAST(coalesce(s, 0) AS BIGINT) AS assembly_length_bp, CAST(m AS BIGINT) AS longest_bp, CAST(n50_bp AS BIGINT) AS n50_bp FROM bins b LEFT JOIN t USING (bin_id) LEFT JOIN n USING (bin_id)""")
def assembly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.assembly_summary(bins(spark, sf_dir), contigs(spark, sf_dir), ["bin_id"])


@query(f"""WITH {CONTIGS}, {BINS}, d AS (SELECT o_orderkey AS bin_id, 1 + o_orderkey % 6 AS contig_count, 1000 * (o_custkey % 200) AS assembly_length_bp FROM orders), s AS (SELECT bin_id, count(*) AS n, sum(length_bp) AS bp FROM contigs GROUP BY bin_id)
SELECT bin_id, coalesce(n, 0) AS n, CAST(coalesce(bp, 0) AS BIGINT) AS bp, CASE WHEN coalesce(n, 0) = contig_count AND coalesce(bp, 0) = assembly_length_bp THEN 'complete' WHEN coalesce(n, 0) > contig_count OR coalesce(bp, 0) > assembly_length_bp THEN 'error' ELSE 'partial' END AS status
FROM d LEFT JOIN s USING (bin_id)""")
def inventory_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("bin_id"), (1 + F.col("o_orderkey") % 6).alias("contig_count"), (1000 * (F.col("o_custkey") % 200)).alias("assembly_length_bp"))
    return measures.inventory_status(declared, contigs(spark, sf_dir), ["bin_id"])


@query(f"""WITH {CONTIGS}, a AS (SELECT suppkey, CAST(sum(reads) AS BIGINT) AS aligned_reads, CAST(sum(CASE WHEN linestatus = 'F' THEN reads ELSE 0 END) AS BIGINT) AS binned_reads FROM contigs GROUP BY suppkey)
SELECT s_suppkey AS suppkey, CAST(3000000 AS BIGINT) AS total_reads, coalesce(aligned_reads, 0) AS aligned_reads, coalesce(binned_reads, 0) AS binned_reads, coalesce(aligned_reads - binned_reads, 0) AS unbinned_reads, 3000000 - coalesce(aligned_reads, 0) AS residual_reads,
 CASE WHEN 3000000 - coalesce(aligned_reads, 0) < 0 THEN 'error' ELSE 'available' END AS status FROM supplier LEFT JOIN a ON s_suppkey = suppkey""")
def mapping_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumn("contig_id", F.monotonically_increasing_id())
    rows = li.select(F.col("l_suppkey").alias("suppkey"), "contig_id", F.col("l_partkey").alias("reads"), F.col("l_orderkey").alias("bin_id"), "l_linestatus")
    rows = stable(rows)
    members = rows.where("l_linestatus = 'F'").select("suppkey", "contig_id", "bin_id")
    denominator = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("suppkey"), F.lit(3000000).cast("long").alias("total_reads"))
    _, whole = measures.mapping_block(members.select("suppkey", "bin_id").distinct(), members, rows.select("suppkey", "contig_id", "reads"), denominator, ["suppkey"])
    return whole.select("suppkey", "total_reads", "aligned_reads", "binned_reads", "unbinned_reads", "residual_reads", "status")


@query("""SELECT o_orderpriority AS sample_id, o_orderkey AS run_id, CAST(o_orderkey * 3 AS BIGINT) AS total_reads, CAST(o_custkey AS BIGINT) AS retained_reads, CAST(o_orderkey * 3 - o_custkey AS BIGINT) AS rejected_reads,
 CAST(o_orderkey * 300 AS BIGINT) AS total_bases, CAST(o_custkey * 70 AS BIGINT) AS retained_bases, CAST(o_orderkey * 300 - o_custkey * 70 AS BIGINT) AS rejected_bases FROM orders""")
def read_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    raw = o.select("o_orderpriority", "o_orderkey", (F.col("o_orderkey") * 3).alias("n"), (F.col("o_orderkey") * 300).alias("b"))
    kept = o.select("o_orderpriority", "o_orderkey", F.col("o_custkey").alias("n"), (F.col("o_custkey") * 70).alias("b"))
    return measures.conserved_reads(raw, kept, ["sample_id", "run_id"])


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), m AS (SELECT user_id, max(n) AS n FROM c GROUP BY user_id)
SELECT user_id, min(event_type) AS motif, CAST(n AS BIGINT) AS n FROM c JOIN m USING (user_id, n) GROUP BY user_id, n""")
def top_motif(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events").groupBy("user_id", F.col("event_type").alias("motif")).agg(F.count("*").alias("n"))
    return measures.top_motif(counts, ["user_id"])


@query("SELECT lang, CAST(sum(length(regexp_replace(text, '[^a-z]', '', 'g'))) AS BIGINT) AS masked_bp FROM documents GROUP BY lang")
def masked_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.masked_bases(table(spark, sf_dir, "documents"), ["lang"], "text")


@query("""WITH r AS (SELECT l_suppkey, '>' || l_partkey || chr(10) || upper(l_returnflag || lower(l_linestatus)) || chr(10) AS rec FROM lineitem) SELECT l_suppkey, sha256(string_agg(rec, '' ORDER BY rec)) AS digest FROM r GROUP BY l_suppkey""")
def sequence_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_partkey").cast("string").alias("name"), F.concat("l_returnflag", F.lower("l_linestatus")).alias("sequence"))
    return measures.sequence_digest(li, ["l_suppkey"])


@query("""WITH a AS (SELECT l_suppkey AS contig, l_partkey % 5000 + 1 AS s, l_partkey % 5000 + CAST(l_quantity AS BIGINT) AS e FROM lineitem), p AS (SELECT contig, unnest(range(s, e + 1)) AS x FROM a), c AS (SELECT contig, count(DISTINCT x) AS covbases FROM p GROUP BY contig)
SELECT contig, count(*) AS numreads, CAST(sum(e - s + 1) AS BIGINT) AS aligned_bp, CAST(any_value(covbases) AS BIGINT) AS covbases FROM a JOIN c USING (contig) GROUP BY contig""")
def covered_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("l_partkey") % 5000
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("contig"), (at + 1).alias("start"), (at + F.col("l_quantity").cast("long")).alias("end"))
    return measures.covered_bases(rows, ["contig"])


@query(FACTS + "SELECT candidate_class, count(*) AS bins FROM r GROUP BY candidate_class")
def bins_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = routing.bin_facts(**routing_inputs(spark, sf_dir), keys=["bin_id"])
    return report.bins_per_class({"bins": routing.route(facts)})


# ---------------------------------------------------------------- report tables

QUERIES |= catalog.QUERIES | native_tables.QUERIES | violations.QUERIES | records.QUERIES | outputs.QUERIES
ORACLE_SQL |= catalog.ORACLE_SQL | native_tables.ORACLE_SQL | violations.ORACLE_SQL | records.ORACLE_SQL | outputs.ORACLE_SQL


# ---------------------------------------------------------------- keys


@query("""WITH e AS (SELECT DISTINCT o_orderkey AS bin_id FROM orders), a AS (SELECT DISTINCT l_orderkey AS bin_id FROM lineitem) SELECT bin_id, 'missing' AS side FROM e WHERE bin_id NOT IN (SELECT bin_id FROM a) UNION ALL SELECT bin_id, 'unexpected' FROM a WHERE bin_id NOT IN (SELECT bin_id FROM e)""")
def coverage_missing_unexpected(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("bin_id"))
    return keys.coverage(expected, contigs(spark, sf_dir), ["bin_id"])


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 10)")
def dangling_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return keys.dangling(rows, table(spark, sf_dir, "part").where("p_size > 10"), {"l_partkey": "p_partkey"}).select("l_orderkey", "l_linenumber", "l_partkey")


@query('SELECT l_orderkey, l_linenumber, count(*) AS "rows" FROM lineitem GROUP BY ALL HAVING count(*) > 1')
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""WITH t AS (SELECT l_shipdate, CASE l_returnflag WHEN 'A' THEN 'bin' WHEN 'N' THEN 'contig' ELSE 'gene' END AS target_kind, CAST(l_partkey AS VARCHAR) AS target_id, l_linestatus AS scope FROM lineitem),
k AS (SELECT 'F' AS scope, 'bin' AS target_kind, CAST(s_suppkey AS VARCHAR) AS target_id FROM supplier UNION SELECT 'F', 'contig', CAST(c_custkey AS VARCHAR) FROM customer UNION SELECT 'F', 'gene', CAST(o_orderkey AS VARCHAR) FROM orders)
SELECT scope, target_kind, target_id, count(*) AS n FROM t WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.scope = t.scope AND k.target_kind = t.target_kind AND k.target_id = t.target_id) GROUP BY ALL""")
def target_polymorphic(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "A", F.lit("bin")).when(F.col("l_returnflag") == "N", F.lit("contig")).otherwise("gene")
    rows = table(spark, sf_dir, "lineitem").select(kind.alias("target_kind"), F.col("l_partkey").cast("string").alias("target_id"), F.col("l_linestatus").alias("scope"))
    of = lambda name: table(spark, sf_dir, name).withColumn("scope", F.lit("F"))
    kinds = {"bin": (of("supplier"), "s_suppkey"), "contig": (of("customer"), "c_custkey"), "gene": (of("orders"), "o_orderkey")}
    return keys.dangling_targets(rows, kinds, ["scope"]).groupBy("scope", "target_kind", "target_id").agg(F.count("*").alias("n"))


INTERVALS = "x AS (SELECT DISTINCT l_suppkey AS parent, l_partkey AS start, l_partkey + CAST(l_quantity AS BIGINT) AS \"end\", concat_ws('.', l_orderkey, l_linenumber, l_partkey) AS name FROM lineitem)"


def _intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_suppkey").alias("parent"), F.col("l_partkey").alias("start"), (F.col("l_partkey") + F.col("l_quantity").cast("long")).alias("end"), F.concat_ws(".", "l_orderkey", "l_linenumber", "l_partkey").alias("name")).distinct()


@query(f"""WITH {INTERVALS}, w AS (SELECT *, lag(name) OVER p AS before, lag("end") OVER p AS be FROM x WINDOW p AS (PARTITION BY parent ORDER BY start, "end", name)) SELECT parent, name, before FROM w WHERE be >= start""")
def overlap_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.overlaps(_intervals(spark, sf_dir), ["parent"])


@query("""WITH o AS (SELECT o_orderkey AS id, o_orderstatus AS strand, 100 AS s, 100 + o_custkey % 400 AS e FROM orders), i AS (SELECT l_orderkey AS id, l_linestatus AS strand, l_partkey % 300 AS s, l_partkey % 300 + CAST(l_quantity AS BIGINT) AS e, l_linenumber AS n FROM lineitem)
SELECT i.id AS id, i.strand AS strand, i.s AS start, i.e AS "end", n FROM i JOIN o USING (id) WHERE NOT (i.strand = o.strand AND i.s >= o.s AND i.e <= o.e)""")
def containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    outer = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit("c").alias("contig"), F.col("o_orderstatus").alias("strand"), F.lit(100).alias("start"), (100 + F.col("o_custkey") % 400).alias("end"))
    at = F.col("l_partkey") % 300
    inner = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.lit("c").alias("contig"), F.col("l_linestatus").alias("strand"), at.alias("start"), (at + F.col("l_quantity").cast("long")).alias("end"), F.col("l_linenumber").alias("n"))
    return keys.not_contained(inner, outer, "id").select("id", "strand", "start", "end", "n")


@query("""SELECT concat_ws('_', l_orderkey, l_linenumber, l_partkey) AS gene_id, 'p' || o_custkey AS parent_contig, 1000 + l_partkey % 500 - 1 AS start, 1000 + l_partkey % 500 + CAST(l_quantity AS BIGINT) - 1 AS "end", (1000 + l_partkey % 500 + CAST(l_quantity AS BIGINT) - 1 <= 1400) AS fits FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def gene_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("l_partkey") % 500
    genes = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("contig_id"), F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey").alias("gene_id"), at.alias("start"), (at + F.col("l_quantity").cast("long")).alias("end"))
    origins = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("contig_id"), F.concat(F.lit("p"), F.col("o_custkey")).alias("parent_contig"), F.lit(1000).alias("start"), F.lit(1400).alias("end"))
    return keys.lifted(genes, origins)


@query("""WITH c AS (SELECT l_orderkey AS t, CASE WHEN l_orderkey % 2 = 0 THEN '-' ELSE '+' END AS strand, l_partkey AS s, l_partkey + CAST(l_quantity AS BIGINT) AS e, CAST(l_partkey % 3 AS INTEGER) AS phase FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY CASE WHEN strand = '-' THEN -e ELSE s END, CASE WHEN strand = '-' THEN -s ELSE e END) AS n FROM c) SELECT t AS transcript, strand, phase FROM r WHERE n = 1""")
def first_cds_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    strand = F.when(F.col("l_orderkey") % 2 == 0, F.lit("-")).otherwise("+")
    cds = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("transcript"), strand.alias("strand"), F.col("l_partkey").alias("start"), (F.col("l_partkey") + F.col("l_quantity").cast("long")).alias("end"), (F.col("l_partkey") % 3).cast("int").alias("phase"))
    return keys.edge_phase(cds)


@query("SELECT event_id, user_id, last_value(CASE WHEN event_id % 3 = 0 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS code FROM events")
def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("code"))
    return keys.carried(rows, "code", "event_id", ["user_id"])


@query("""SELECT p_brand AS path, count(DISTINCT (p_type, p_size)) AS "values", string_agg(DISTINCT p_type || ':' || p_size, ',' ORDER BY p_type || ':' || p_size) AS assertions FROM part GROUP BY p_brand HAVING count(DISTINCT (p_type, p_size)) > 1""")
def path_identity_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("path"), F.struct("p_type", "p_size").alias("identity"), "p_type", "p_size")
    return keys.conflicts(rows, ["path"], "identity", F.concat("p_type", F.lit(":"), "p_size"))


@query("""SELECT c_custkey AS k, 'customer' AS kind, c_acctbal AS v FROM customer UNION ALL SELECT s_suppkey, 'supplier', s_acctbal FROM supplier UNION ALL SELECT p_partkey, 'part', NULL FROM part""")
def union_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.lit("customer").alias("kind"), F.col("c_acctbal").alias("v"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("v"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.lit("part").alias("kind"))
    return c.unionByName(s).unionByName(p, allowMissingColumns=True)


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT s_suppkey FROM supplier")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, sf_dir, "supplier").select("s_suppkey"))


@query("SELECT s_suppkey AS k FROM supplier INTERSECT SELECT o_custkey FROM orders")
def set_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")).intersect(table(spark, sf_dir, "orders").select("o_custkey"))


@query("SELECT l_linenumber AS n, l_returnflag AS f FROM lineitem EXCEPT ALL SELECT l_linenumber, CASE WHEN l_discount > 0.05 THEN l_returnflag ELSE 'N' END FROM lineitem")
def multiset_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_linenumber").alias("n"), F.col("l_returnflag").alias("f")).exceptAll(li.select("l_linenumber", F.when(F.col("l_discount") > 0.05, F.col("l_returnflag")).otherwise("N")))


@query('SELECT l_orderkey, l_linenumber, count(DISTINCT (l_partkey, l_suppkey)) AS versions FROM lineitem GROUP BY ALL HAVING count(DISTINCT (l_partkey, l_suppkey)) > 1')
def dedup_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.deduplicated(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ["l_orderkey", "l_linenumber"])[1]


# ---------------------------------------------------------------- parsing

LINEAGE = "lower(concat_ws(';', 'd__' || p_brand, ' p_' || p_type, 'q__x', 'c__', 'sg__' || p_size))"


@query(f"""WITH x AS (SELECT p_partkey, unnest(string_split({LINEAGE}, ';')) AS part, generate_subscripts(string_split({LINEAGE}, ';'), 1) - 1 AS place FROM part), y AS (SELECT p_partkey, place, regexp_extract(trim(part), '^([a-z]+)_{{1,2}}(.*)$', 1) AS pre, regexp_extract(trim(part), '^([a-z]+)_{{1,2}}(.*)$', 2) AS taxon_name FROM x)
SELECT p_partkey, CAST(place AS INTEGER) AS place, CASE pre WHEN 'd' THEN 'domain' WHEN 'p' THEN 'phylum' WHEN 'sg' THEN 'supergroup' ELSE pre END AS rank, trim(taxon_name) AS taxon_name FROM y WHERE pre <> '' AND trim(taxon_name) <> ''""")
def lineage_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.lower(F.concat_ws(";", F.concat(F.lit("d__"), "p_brand"), F.concat(F.lit(" p_"), "p_type"), F.lit("q__x"), F.lit("c__"), F.concat(F.lit("sg__"), F.col("p_size"))))
    return parse.lineage(table(spark, sf_dir, "part").select("p_partkey", cell.alias("lineage"))).select("p_partkey", "place", "rank", "taxon_name")


@query("""WITH v AS (SELECT p_partkey, string_split(CASE WHEN p_size > 5 THEN 'Viruses' ELSE 'Other' END || ';' || p_brand || ';;' || p_type, ';') AS l FROM part), x AS (SELECT p_partkey, l[1] AS root, unnest(l) AS taxon_name, generate_subscripts(l, 1) - 1 AS place FROM v)
SELECT p_partkey, CAST(place AS INTEGER) AS place, (['root','realm','kingdom','phylum','class'])[place + 1] AS rank, taxon_name FROM x WHERE root = 'Viruses' AND taxon_name <> ''""")
def virus_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = F.when(F.col("p_size") > 5, F.lit("Viruses")).otherwise("Other")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(";", root, "p_brand", F.lit(""), "p_type").alias("lineage"))
    return parse.virus_lineage(rows).select("p_partkey", "place", "rank", "taxon_name")


@query("""WITH x AS (SELECT p_partkey, 'go' AS database, unnest(list_distinct(string_split(p_brand || ',' || p_type || ',' || p_brand, ','))) AS accession FROM part UNION ALL SELECT p_partkey, 'ec', unnest(list_distinct(string_split(nullif(CASE WHEN p_size > 20 THEN '-' ELSE p_size || ',' || p_size END, '-'), ','))) FROM part) SELECT * FROM x WHERE accession <> ''""")
def terms_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(",", "p_brand", "p_type", "p_brand").alias("gos"), F.when(F.col("p_size") > 20, F.lit("-")).otherwise(F.concat_ws(",", size, size)).alias("ecs"))
    return parse.terms(rows, {"gos": "go", "ecs": "ec"})


@query("""SELECT p_partkey, p_brand AS accession, p_retailprice AS score FROM part UNION ALL SELECT p_partkey, 'IPR' || p_size, NULL FROM part WHERE p_size % 3 <> 0""")
def member_integrated_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.when(F.col("p_size") % 3 != 0, F.concat(F.lit("IPR"), F.col("p_size"))).otherwise("-")
    return parse.member_and_integrated(table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("member"), entry.alias("integrated"), F.col("p_retailprice").alias("score")))


@query("""SELECT p_partkey, 'ann:' || p_brand || ':' || sha256(concat_ws(chr(31), p_brand, 'g' || p_partkey, p_type, 'a' || p_size, coalesce(CASE WHEN p_size > 9 THEN CAST(p_size AS VARCHAR) END, 'None'), coalesce(CASE WHEN p_size > 9 THEN CAST(p_size + 5 AS VARCHAR) END, 'None'))) AS annotation_id FROM part""")
def annotation_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = F.col("p_size") > 9
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("source"), F.concat(F.lit("g"), "p_partkey").alias("gene_id"), F.col("p_type").alias("database_name"), F.concat(F.lit("a"), "p_size").alias("accession"), F.when(placed, F.col("p_size")).alias("start"), F.when(placed, F.col("p_size") + 5).alias("end"))
    return rows.select("p_partkey", collect.annotation_id().alias("annotation_id"))


@query("""WITH n AS (SELECT p_partkey, 'a/b/' || p_name || CASE p_size % 5 WHEN 0 THEN '.fasta' WHEN 1 THEN '.FA' WHEN 2 THEN '.fa.gz' WHEN 3 THEN '.faa' ELSE '.x.1' END AS p FROM part), b AS (SELECT p_partkey, split_part(p, '/', -1) AS s FROM n)
SELECT p_partkey, regexp_replace(s, '\\.(fasta|fna|fa)$', '') AS bin_name, regexp_replace(regexp_replace(regexp_replace(regexp_replace(s, '\\.gz$', ''), '\\.fasta$', ''), '\\.fna$', ''), '\\.fa$', '') AS path_name, regexp_replace(s, '\\.[^.]+$', '') AS stem,
 CASE WHEN regexp_full_match(s, '[A-Za-z0-9][A-Za-z0-9_.-]*') THEN s ELSE trim(regexp_replace(s, '[^A-Za-z0-9_.-]+', '_', 'g'), '_.-') || '-' || substr(sha256(s), 1, 10) END AS component FROM b""")
def normalized_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.get(F.array(*[F.lit(x) for x in (".fasta", ".FA", ".fa.gz", ".faa", ".x.1")]), (F.col("p_size") % 5).cast("int"))
    path = F.concat(F.lit("a/b/"), "p_name", end)
    return table(spark, sf_dir, "part").select("p_partkey", text.bin_name(path).alias("bin_name"), text.path_name(path).alias("path_name"), text.stem(path).alias("stem"), text.safe_component(text.base_name(path)).alias("component"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, (l_discount >= 0.05) AS passes_threshold, CASE WHEN l_discount >= 0.05 THEN l_returnflag END AS thresholded_class FROM lineitem WHERE (l_discount >= 0.05) <> (l_tax >= 0.03)")
def threshold_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    passes = F.col("l_discount") >= 0.05
    return table(spark, sf_dir, "lineitem").where(passes != (F.col("l_tax") >= 0.03)).select("l_orderkey", "l_linenumber", "l_partkey", passes.alias("passes_threshold"), F.when(passes, F.col("l_returnflag")).alias("thresholded_class"))


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'eukaryotic' WHEN o_orderstatus = 'P' THEN 'viral' WHEN c_mktsegment IS NULL OR c_mktsegment = 'BUILDING' THEN 'unclassified' WHEN o_totalprice < 100000 THEN 'incomplete' END AS reason FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def applicability_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    reason = parse.first_failing([(F.col("o_orderpriority") == "1-URGENT", "eukaryotic"), (F.col("o_orderstatus") == "P", "viral"), (F.col("c_mktsegment").isNull() | (F.col("c_mktsegment") == "BUILDING"), "unclassified"), (F.col("o_totalprice") < 100000, "incomplete")])
    return rows.select("o_orderkey", reason.alias("reason"))


@query("""WITH x AS (SELECT p_partkey, p_size || CASE WHEN p_size % 4 = 0 THEN ' of ' ELSE '/' END || (p_size + 3) AS cell FROM part) SELECT p_partkey, CASE WHEN regexp_full_match(cell, '[0-9]+/[0-9]+') THEN CAST(split_part(cell, '/', 1) AS BIGINT) END AS present, CASE WHEN regexp_full_match(cell, '[0-9]+/[0-9]+') THEN CAST(split_part(cell, '/', 2) AS BIGINT) END AS total FROM x""")
def marker_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.concat(F.col("p_size").cast("string"), F.when(F.col("p_size") % 4 == 0, F.lit(" of ")).otherwise("/"), (F.col("p_size") + 3).cast("string"))
    present, total = parse.marker_fraction(F.col("cell"))
    return table(spark, sf_dir, "part").select("p_partkey", cell.alias("cell")).select("p_partkey", present.alias("present"), total.alias("total"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (CAST(l_partkey AS BIGINT) & 2308) = 0 AND CAST(l_quantity AS BIGINT) >= 20")
def alignment_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("mapq", F.col("l_quantity").cast("long"))
    return parse.kept_alignments(rows, "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT doc_id, length(text) AS n FROM documents WHERE length(text) >= 1000 AND length(text) % 20 >= 10")
def read_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("length"), (F.length("text") % 20).cast("double").alias("mean_quality"))
    return parse.kept_reads(rows).select("doc_id", F.col("length").cast("long").alias("n"))


@query("""WITH x AS (SELECT o_custkey % 40 AS stage, o_orderpriority || ':' || o_orderkey || ':x' AS k FROM orders) SELECT stage, split_part(k, ':', 1) AS collection, substr(k, strpos(k, ':') + 1) AS record_id, CAST(row_number() OVER (PARTITION BY stage ORDER BY k) - 1 AS INTEGER) AS position FROM x""")
def expected_keys_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat("o_orderpriority", F.lit(":"), F.col("o_orderkey"), F.lit(":x"))
    keyed = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 40).alias("stage"), key.alias("k"))
    position = F.row_number().over(Window.partitionBy("stage").orderBy(F.asc_nulls_last("k"))) - 1
    rows = keyed.select("stage", position.alias("position"), F.split("k", ":", 2).alias("part"))
    return rows.select("stage", F.col("part")[0].alias("collection"), F.col("part")[1].alias("record_id"), "position")


# ---------------------------------------------------------------- outputs that must agree


def _bins_told(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parts as bins: those of a size divisible by five are left out, every other one of them without a warning."""
    p = table(spark, sf_dir, "part").select(F.concat(F.lit("b"), "p_partkey").alias("bin_id"), F.col("p_size").cast("long").alias("size"))
    lines = p.where("size % 10 = 0").select(F.concat(F.lit("[01] WARNING: Skipping protein file /p/"), "bin_id", F.lit(".faa as it was empty.")).alias("value"))
    return cover.omitted_bins(p, p.where("size % 5 <> 0"), p.selectExpr("bin_id", "size % 5 AS size_bytes"), cover.warned_bins(lines))


@query("SELECT 'b' || p_partkey AS bin_id FROM part WHERE p_size % 5 = 0")
def omitted_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bins_told(spark, sf_dir)[0]


@query("SELECT 'b' || p_partkey AS bin_id, 'evidence disagrees' AS detail FROM part WHERE p_size % 10 = 5")
def omitted_bin_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bins_told(spark, sf_dir)[1]


@query("SELECT c_name || ' ' || c_custkey AS name, o_orderpriority AS sequence FROM orders JOIN customer ON o_custkey = c_custkey")
def masked_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "orders").select(F.concat(F.lit("s"), "o_custkey").alias("name"), F.col("o_orderpriority").alias("sequence"))
    aliases = table(spark, sf_dir, "customer").select(F.concat(F.lit("s"), "c_custkey").alias("alias"), F.concat_ws(" ", "c_name", "c_custkey").alias("original"))
    return cover.restored(records, aliases)[0]


@query("SELECT l_suppkey AS contig_id, l_orderkey AS read, l_linenumber AS mate, s_nationkey AS bin_id FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal > 0")
def bin_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    alignments = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("contig_id"), F.col("l_orderkey").alias("read"), F.col("l_linenumber").alias("mate"))
    return cover.of_bins(alignments, table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("contig_id"), F.col("s_nationkey").alias("bin_id")))


@query("SELECT l_partkey AS contig_id, CASE WHEN count(DISTINCT l_suppkey) > 1 THEN 'several bins' ELSE 'repeated' END AS detail FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def contig_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover.contig_problems(table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("contig_id"), F.col("l_suppkey").alias("bin_id")))
