"""A whole catalog over the test tables, and the report's queries on it.

Every column is one expression that Spark and the oracle both understand, so
the tables are the same on both sides; the report itself is the one that
``report`` ships.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import collect
from tessella.plans import report

RUN = {"sample_id": "'s1'", "run_id": "'r1'"}
STAGE = {**RUN, "stage_id": "concat('st', l_suppkey)"}
ITEM = "concat_ws('.', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
TARGET = {"target_kind": "CASE WHEN l_returnflag = 'A' THEN 'bin' ELSE 'contig' END", "target_id": "concat('t', l_orderkey)"}

#: Catalog table: source table and the expression of each column.
TABLES: dict[str, tuple[str, dict[str, str]]] = {
    "catalog_metadata": ("region", {"schema_version": "concat('1.', r_regionkey)", "workflow_name": "lower(r_name)", "workflow_version": "'2'", "source_revision": "concat('x', r_regionkey)"}),
    "runs": ("nation", {"sample_id": "n_name", "run_id": "concat('r', n_nationkey)", "platform": "CASE WHEN n_regionkey = 1 THEN 'ont' ELSE 'pacbio' END", "rna_technology": "CASE WHEN n_regionkey = 2 THEN 'short' END", "basecaller": "'b'", "basecaller_model": "concat('m', n_regionkey)", "library_prep": "'l'"}),
    "read_stats": ("orders", {"sample_id": "concat('c', o_custkey)", "run_id": "'r1'", "record_id": "concat('k', o_orderkey)", "total_reads": "o_orderkey * 3 + 2000", "total_bases": "o_orderkey * 300 + 2000", "retained_reads": "o_orderkey % 1000", "retained_bases": "o_orderkey % 1000 * 70", "rejected_reads": "o_custkey % 100", "rejected_bases": "o_custkey % 100 * 70"}),
    "assemblies": ("orders", {"sample_id": "concat('c', o_custkey)", "run_id": "'r1'", "assembly_id": "concat('a', o_orderkey)", "assembly_length_bp": "o_orderkey % 100000 * 10", "contig_count": "o_orderkey % 6", "n50_bp": "o_orderkey % 900", "gc_fraction": "CAST(o_orderkey % 64 AS DOUBLE) / 64"}),
    "bins": ("orders", {**RUN, "bin_id": "concat('b', o_orderkey)", "assembly_id": "concat('a', o_custkey)", "candidate_class": "CASE WHEN o_orderstatus = 'F' THEN 'viral_candidate' WHEN o_orderstatus = 'O' THEN 'chaff' ELSE 'unresolved' END"}),
    "qc": ("lineitem", {**STAGE, "record_id": ITEM, **TARGET, "completeness_percent": "l_tax", "contamination_percent": "l_discount"}),
    "taxonomy": ("lineitem", {**STAGE, "record_id": ITEM, **TARGET, "rank": "l_linestatus", "taxon_name": "l_returnflag", "taxon_id": "concat('x', l_partkey % 9)", "score": "l_tax", "lineage_confidence": "l_discount"}),
    "ssu": ("lineitem", {**STAGE, "record_id": ITEM, "contig_id": "concat('c', l_orderkey)", "ssu_type": "CASE WHEN l_returnflag = 'A' THEN '18S' ELSE '16S' END", "start": "l_partkey + 1", "end": "l_partkey + CAST(l_quantity AS BIGINT)", "strand": "CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END", "hit_accession": "concat('h', l_partkey)", "taxon_name": "l_returnflag", "taxonomy_assignment_method": "'blast'", "reference_identifiers": "concat('i', l_suppkey)", "reference_source": "'r'", "reference_versions": "'3'", "reference_taxonomy": "concat('d;', l_linestatus)", "identity_percent": "l_quantity", "query_coverage_percent": "l_tax"}),
    "viruses": ("lineitem", {**STAGE, "record_id": ITEM, "contig_id": "concat('c', l_orderkey)", "start": "l_partkey + 1", "end": "l_partkey + CAST(l_quantity AS BIGINT)", "strand": "'unknown'", "score": "l_discount", "viral_taxon": "concat('v', l_linenumber)"}),
    "phenotypes": ("lineitem", {**STAGE, "record_id": ITEM, "bin_id": "concat('b', l_orderkey)", "raw_class": "l_returnflag", "raw_score": "l_discount", "threshold": "CAST(0.05 AS DOUBLE)", "passes_threshold": "l_discount >= 0.05", "thresholded_class": "CASE WHEN l_discount >= 0.05 THEN l_returnflag END", "is_applicable": "l_tax >= 0.03", "applicability_reason": "CASE WHEN l_tax < 0.03 THEN 'incomplete' END"}),
    "genes": ("lineitem", {**STAGE, "gene_id": ITEM, "bin_id": "CASE WHEN l_discount > 0.02 THEN concat('b', l_orderkey) END"}),
    "annotations": ("lineitem", {**STAGE, "gene_id": "concat_ws('-', l_orderkey, l_linenumber)", "database_name": "concat('db', l_linestatus)", "database_version": "concat('', year(l_shipdate))"}),
    "artifacts": ("part", {**RUN, "artifact_id": "concat('p', p_partkey)", "kind": "CASE WHEN p_size < 10 THEN 'protein_fasta' WHEN p_size < 20 THEN 'gene_annotation' ELSE 'report' END", "path": "concat('x/', p_name)", "sha256": "p_brand", "size_bytes": "p_size", "producer_stage_id": "concat('st', p_size)"}),
    "stages": ("supplier", {**RUN, "stage_id": "concat('st', s_suppkey)", "name": "lower(s_name)", "status": "CASE WHEN s_acctbal < 0 THEN 'pending' ELSE 'completed' END", "status_reason": "CASE WHEN s_acctbal < 0 THEN 'waiting' END", "tool_name": "CASE WHEN s_suppkey % 4 = 0 THEN 'braker_run' ELSE concat('tool', s_suppkey % 7) END", "tool_version": "concat('1.', s_suppkey % 3)", "database_name": "concat('db', s_nationkey)", "database_version": "'7'"}),
    "stage_inputs": ("lineitem", {**STAGE, "position": "l_partkey % 50"}),
    "stage_expected_keys": ("lineitem", {**STAGE, "collection": "l_returnflag", "record_id": "concat('k', l_orderkey)"}),
}


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Each catalog table as a projection of its source; unused columns never leave the scan."""
    return {name: spark.read.parquet(f"{sf_dir}/{source}.parquet").selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()]) for name, (source, columns) in TABLES.items()}


def _views(*names: str) -> str:
    made = []
    for name in names:
        source, columns = TABLES[name]
        made.append(f"{name}_v AS (SELECT {', '.join(f'{e} AS {chr(34)}{c}{chr(34)}' for c, e in columns.items())} FROM {source})")
    return "WITH " + ", ".join(made)


def _listed(columns: list[str], alias: str = "") -> str:
    return ", ".join(f'{alias}"{c}"' for c in columns)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _add(name: str, made: Callable[[dict[str, DataFrame]], DataFrame], sql: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: made(tables(spark, sf_dir))
    ORACLE_SQL[name] = sql


_ON = "USING (sample_id, run_id, stage_id)"
for _name, (_table, _columns, _) in report.PROJECTIONS.items():
    _add(f"report_{_name}", lambda t, name=_name: report.projection(t, name), f"{_views(_table)} SELECT {_listed(_columns)} FROM {_table}_v")
for _name, (_table, _own, _tool, _) in report.WITH_STAGE.items():
    _add(f"report_{_name}", lambda t, name=_name: report.with_stage(t, name), f"{_views(_table, 'stages')} SELECT {_listed(_own, 't.')}, {_listed(_tool, 's.')} FROM {_table}_v t JOIN stages_v s {_ON}")
_add("report_quality", report.quality, f"{_views('qc', 'stages')} SELECT t.*, s.tool_name, s.tool_version FROM qc_v t JOIN stages_v s {_ON}")
_add("report_feature_artifacts", report.feature_artifacts, f"{_views('artifacts')} SELECT {_listed(report.PROJECTIONS['artifacts'][1])} FROM artifacts_v WHERE kind IN ({', '.join(repr(k) for k in report.FEATURE_KINDS)})")
_add(
    "taxonomy_conflicts", report.same_rank_conflicts,
    f"""{_views('taxonomy', 'stages')} SELECT sample_id, run_id, target_kind, target_id, rank, count(DISTINCT taxon_name) AS taxon_labels, string_agg(DISTINCT tool_name || ': ' || taxon_name, ',' ORDER BY tool_name || ': ' || taxon_name) AS evidence
FROM taxonomy_v JOIN stages_v s {_ON} GROUP BY ALL HAVING count(DISTINCT taxon_name) > 1""",
)
_add("coding_model_counts", report.coding_models, f"{_views('genes', 'stages')} SELECT sample_id, run_id, bin_id, stage_id, name AS stage_name, status, status_reason, tool_name, tool_version, count(*) AS coding_models FROM genes_v JOIN stages_v {_ON} GROUP BY ALL")
_add("annotation_counts", report.annotation_hits, f"{_views('annotations')} SELECT sample_id, run_id, database_name, database_version, count(*) AS annotation_hits, count(DISTINCT gene_id) AS annotated_models FROM annotations_v GROUP BY ALL")
_add("braker_states", report.gene_caller_states, f"{_views('genes', 'stages')} SELECT s.sample_id, s.run_id, s.stage_id, name, status, status_reason, tool_name, tool_version, count(gene_id) AS cataloged_models FROM stages_v s LEFT JOIN genes_v g {_ON} WHERE lower(name) LIKE '%braker%' OR lower(tool_name) LIKE '%braker%' GROUP BY ALL")
_add(
    "stage_summary", report.stage_states,
    f"""{_views('stages', 'stage_inputs', 'stage_expected_keys')}, i AS (SELECT stage_id, count(DISTINCT position) AS n FROM stage_inputs_v GROUP BY stage_id), e AS (SELECT stage_id, count(DISTINCT (collection, record_id)) AS n FROM stage_expected_keys_v GROUP BY stage_id)
SELECT s.*, coalesce(i.n, 0) AS input_artifacts, coalesce(e.n, 0) AS expected_records FROM stages_v s LEFT JOIN i USING (stage_id) LEFT JOIN e USING (stage_id)""",
)
_add("record_counts", report.record_counts, " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS records FROM {source}" for n, (source, _) in TABLES.items() if n != "catalog_metadata"))
_add("read_outcomes_top30", report.read_outcomes, f"{_views('read_stats')} SELECT sample_id, run_id, CAST(sum(retained_reads) AS BIGINT) AS retained_reads, CAST(sum(rejected_reads) AS BIGINT) AS rejected_reads, CAST(sum(retained_reads + rejected_reads) AS BIGINT) AS total FROM read_stats_v GROUP BY ALL ORDER BY total DESC, sample_id, run_id LIMIT 30")
_add("assembly_bp_top30", report.assembly_lengths, f"{_views('assemblies')} SELECT sample_id, run_id, CAST(sum(assembly_length_bp) AS BIGINT) AS assembly_length_bp FROM assemblies_v GROUP BY ALL ORDER BY 3 DESC, 1, 2 LIMIT 30")
_add("report_bins_per_class", report.bins_per_class, f"{_views('bins')} SELECT candidate_class, count(*) AS bins FROM bins_v GROUP BY candidate_class")

# ---------------------------------------------------------------- stage results

_add(
    "expected_result_keys", lambda t: collect.expected_keys({n: t[n] for n in ("genes", "qc", "taxonomy")}).withColumn("expected_result_keys", F.array_join("expected_result_keys", "|")),
    f"{_views('genes', 'qc', 'taxonomy')}, k AS (SELECT sample_id, run_id, stage_id, 'genes:' || gene_id AS key FROM genes_v UNION SELECT sample_id, run_id, stage_id, 'qc:' || record_id FROM qc_v UNION SELECT sample_id, run_id, stage_id, 'taxonomy:' || record_id FROM taxonomy_v) SELECT sample_id, run_id, stage_id, string_agg(key, '|' ORDER BY key) AS expected_result_keys FROM k GROUP BY ALL",
)
_SET = ["st1", "st2", "checkv", "routing"]
_add(
    "skipped_stages", lambda t: collect.skipped_stages(t["stages"].sparkSession, t["stages"], _SET, "not asked for"),
    f"{_views('stages')} SELECT 's1' AS sample_id, 'r1' AS run_id, n AS stage_id, 'skipped' AS status, 'not asked for' AS status_reason FROM (SELECT unnest({_SET}) AS n) WHERE n NOT IN (SELECT stage_id FROM stages_v)",
)
_add(
    "bins_with_routes", lambda t: collect.with_routes(t["bins"], t["phenotypes"].groupBy("sample_id", "run_id", "bin_id").agg(F.max("raw_class").alias("candidate_class"))),
    f"{_views('bins', 'phenotypes')}, d AS (SELECT bin_id, max(raw_class) AS routed FROM phenotypes_v GROUP BY bin_id) SELECT sample_id, run_id, bin_id, assembly_id, CASE WHEN candidate_class = 'chaff' OR routed IS NULL THEN candidate_class ELSE routed END AS candidate_class FROM bins_v LEFT JOIN d USING (bin_id)",
)
_add(
    "child_cover", lambda t: collect.child_cover(t["genes"].where("bin_id is not null"), t["phenotypes"].where("is_applicable"), t["bins"]),
    f"{_views('bins', 'genes', 'phenotypes')}, c AS (SELECT DISTINCT bin_id, true AS c FROM genes_v WHERE bin_id IS NOT NULL), p AS (SELECT DISTINCT bin_id, true AS p FROM phenotypes_v WHERE is_applicable), b AS (SELECT DISTINCT bin_id, true AS b FROM bins_v), j AS (SELECT bin_id, coalesce(c, false) AS c, coalesce(p, false) AS p, coalesce(b, false) AS b FROM c FULL JOIN p USING (bin_id) FULL JOIN b USING (bin_id)) SELECT * FROM (SELECT bin_id, CASE WHEN c AND p THEN 'completed and pending' WHEN b AND NOT c AND NOT p THEN 'neither' WHEN NOT b THEN 'unknown' END AS detail FROM j) WHERE detail IS NOT NULL",
)
