"""The integrity rules over a faulty catalog shaped from the test tables.

The oracle states each rule on its own; its tables are the same expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessella.operators import integrity

RUN = {"sample_id": "'s1'", "run_id": "'r1'"}
BY_ITEM = {**RUN, "stage_id": "concat('st', l_suppkey)", "artifact_id": "concat('p', l_partkey)"}
BY_ORDER = {**RUN, "stage_id": "concat('st', o_custkey)", "artifact_id": "concat('p', o_custkey)"}
BY_CUSTOMER = {**RUN, "stage_id": "concat('st', c_custkey)", "artifact_id": "concat('p', c_custkey)"}
LINE = "concat_ws('.', l_orderkey, l_linenumber)"

TABLES: dict[str, tuple[str, dict[str, str]]] = {
    "samples": ("nation", {"sample_id": "CASE WHEN n_nationkey < 2 THEN 's1' ELSE n_name END", "genetic_code": "CAST(11 AS INT)"}),
    "runs": ("nation", {"sample_id": "CASE WHEN n_nationkey < 2 THEN 's1' WHEN n_regionkey = 1 THEN n_name ELSE concat('x', n_name) END", "run_id": "CASE WHEN n_nationkey < 2 THEN 'r1' ELSE 'r2' END", "platform": "CASE WHEN n_regionkey = 1 THEN 'ONT' ELSE 'HIFI' END", "basecaller": "CASE WHEN n_regionkey < 3 THEN 'b' END", "basecaller_model": "CAST(NULL AS STRING)"}),
    "stages": ("supplier", {"sample_id": "'s1'", "run_id": "CASE WHEN s_nationkey = 4 THEN 'r9' ELSE 'r1' END", "stage_id": "concat('st', CASE WHEN s_nationkey = 3 THEN 3 ELSE s_suppkey END)", "status": "CASE WHEN s_acctbal < 0 THEN 'pending' ELSE 'completed' END", "status_reason": "CASE WHEN s_suppkey % 3 = 0 THEN 'r' END", "tool_name": "CASE WHEN s_suppkey % 4 = 0 THEN 'CheckEUK' ELSE 'tool' END", "command": "CASE WHEN s_suppkey % 5 <> 0 THEN 'c' END", "database_name": "CASE WHEN s_suppkey % 2 = 0 THEN 'd' END", "database_version": "CASE WHEN s_suppkey % 3 = 0 THEN '1' END", "database_sha256": "CASE WHEN s_suppkey % 7 = 0 THEN 'x' END"}),
    "artifacts": ("part", {"sample_id": "'s1'", "run_id": "CASE WHEN p_size = 3 THEN 'r9' ELSE 'r1' END", "artifact_id": "concat('p', CASE WHEN p_size = 7 THEN 7 ELSE p_partkey END)", "kind": "CASE WHEN p_size % 3 = 0 THEN 'qc_report' WHEN p_size % 3 = 1 THEN 'assembly' ELSE 'gene_annotation' END", "path": "concat('x', p_brand)", "sha256": "p_type", "size_bytes": "p_size", "producer_stage_id": "concat('st', p_size)"}),
    "stage_inputs": ("lineitem", {**RUN, "stage_id": "concat('st', l_suppkey)", "position": "l_linenumber", "artifact_id": "concat('p', l_partkey)"}),
    "stage_expected_keys": ("lineitem", {**RUN, "stage_id": "concat('st', l_suppkey)", "collection": "CASE WHEN l_returnflag = 'A' THEN 'memberships' ELSE 'contigs' END", "record_id": f"concat('c', {LINE})"}),
    "read_stats": ("orders", {**BY_ORDER, "run_id": "CASE WHEN o_orderstatus = 'P' THEN 'r9' ELSE 'r1' END", "record_id": "concat('k', o_orderkey)", "total_reads": "o_orderkey", "retained_reads": "o_orderkey - o_custkey % 3", "rejected_reads": "o_custkey % 2", "total_bases": "o_orderkey", "retained_bases": "o_orderkey - o_custkey % 5", "rejected_bases": "o_custkey % 4"}),
    "assemblies": ("orders", {**BY_ORDER, "assembly_id": "concat('a', o_orderkey)", "assembly_length_bp": "o_orderkey % 300", "contig_count": "o_orderkey % 6", "n50_bp": "CASE WHEN o_custkey % 5 <> 0 THEN o_custkey % 600 END"}),
    "contigs": ("lineitem", {**BY_ITEM, "contig_id": f"concat('c', {LINE})", "assembly_id": "concat('a', l_orderkey + l_linenumber)", "length_bp": "CAST(l_quantity AS BIGINT) * 10", "mean_depth_x": "CASE WHEN l_tax > 0.04 THEN l_tax END", "coverage_artifact_id": "CASE WHEN l_discount > 0.03 THEN concat('p', l_partkey) END"}),
    "bins": ("orders", {**BY_ORDER, "bin_id": "concat('b', o_orderkey)", "assembly_id": "concat('a', o_custkey * 20)", "candidate_class": "CASE WHEN o_orderstatus = 'F' THEN 'bacterial_archaeal_candidate' ELSE 'chaff' END"}),
    "memberships": ("lineitem", {**BY_ITEM, "membership_id": f"concat('m', {LINE})", "bin_id": "concat('b', l_orderkey + l_linenumber % 2)", "contig_id": "concat('c', concat_ws('.', l_orderkey, l_linenumber + l_suppkey % 2))"}),
    "qc": ("customer", {**BY_CUSTOMER, "record_id": "concat('q', c_custkey)", "target_kind": "CASE WHEN c_nationkey % 2 = 0 THEN 'bin' ELSE 'assembly' END", "target_id": "concat(CASE WHEN c_nationkey % 4 < 2 THEN 'b' ELSE 'a' END, c_custkey)", "completeness_percent": "CASE WHEN c_nationkey % 3 = 0 THEN c_acctbal END", "completeness_basis": "CASE WHEN c_nationkey % 6 = 0 THEN 'm' END", "contamination_percent": "CASE WHEN c_nationkey % 5 = 0 THEN c_acctbal END", "contamination_basis": "CASE WHEN c_nationkey % 10 = 0 THEN 'm' END", "checkeuk_expected_markers_present": "CASE WHEN c_nationkey % 7 = 0 THEN c_nationkey END", "checkeuk_expected_markers_total": "CASE WHEN c_nationkey % 14 = 0 THEN 5 END"}),
    "taxonomy": ("customer", {**BY_CUSTOMER, "record_id": "concat('t', c_custkey)", "target_kind": "CASE WHEN c_nationkey % 2 = 0 THEN 'contig' ELSE 'assembly' END", "target_id": "concat('a', c_custkey)"}),
    "genes": ("lineitem", {**BY_ITEM, "gene_id": f"concat('g', {LINE})", "contig_id": "concat('c', concat_ws('.', l_orderkey, l_linenumber + l_suppkey % 2))", "bin_id": "CASE WHEN l_discount > 0.02 THEN concat('b', l_orderkey + l_suppkey % 2) END", "start": "l_partkey % 400", "end": "l_partkey % 300 + 90", "genetic_code": "CASE WHEN l_tax > 0.02 THEN 11 ELSE 4 END"}),
    "phenotypes": ("customer", {**BY_CUSTOMER, "record_id": "concat('h', c_custkey)", "bin_id": "concat('b', c_custkey * 30)", "raw_score": "c_acctbal", "threshold": "CAST(500 AS DOUBLE)", "passes_threshold": "c_nationkey > 10", "is_applicable": "c_nationkey % 2 = 0", "applicability_reason": "CASE WHEN c_nationkey % 3 = 0 THEN 'r' END"}),
    "annotations": ("lineitem", {**BY_ITEM, "annotation_id": f"concat('n', {LINE})", "gene_id": "concat('g', concat_ws('.', l_orderkey, l_linenumber + l_partkey % 2))", "start": "CASE WHEN l_tax > 0.01 THEN l_partkey % 50 END", "end": "CASE WHEN l_tax < 0.07 THEN l_suppkey % 50 END"}),
}


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{source}.parquet").selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()]) for name, (source, columns) in TABLES.items()}


_VIEWS = ", ".join(f"{name}_v AS (SELECT {', '.join(f'{e} AS {chr(34)}{c}{chr(34)}' for c, e in columns.items())} FROM {source})" for name, (source, columns) in TABLES.items())
_RESULTS = " UNION ALL ".join(f"SELECT '{n}' AS collection, {k} AS key, sample_id, run_id, stage_id, artifact_id FROM {n}_v" for n, k in integrity.RESULT_KEYS.items() if n in TABLES)
_KINDS = " ".join(f"WHEN '{n}' THEN '{k}'" for n, k in integrity.RESULT_KINDS.items())
_SEEN = """seen AS (SELECT assembly_id, count(*) AS n, sum(length_bp) AS bp, max(length_bp) AS longest FROM contigs_v GROUP BY assembly_id),
steps AS (SELECT assembly_id, length_bp, sum(length_bp) OVER (PARTITION BY assembly_id ORDER BY length_bp DESC ROWS UNBOUNDED PRECEDING) AS upto, sum(length_bp) OVER (PARTITION BY assembly_id) AS total FROM contigs_v),
halves AS (SELECT assembly_id, max(length_bp) AS seen_n50 FROM steps WHERE upto >= (total + 1) // 2 GROUP BY assembly_id),
sized AS (SELECT a.*, coalesce(n, 0) AS n, coalesce(bp, 0) AS bp, longest, seen_n50 FROM assemblies_v a LEFT JOIN seen USING (assembly_id) LEFT JOIN halves USING (assembly_id)),
targets AS (SELECT 'assembly' AS target_kind, assembly_id AS target_id FROM assemblies_v UNION SELECT 'contig', contig_id FROM contigs_v UNION SELECT 'bin', bin_id FROM bins_v UNION SELECT 'gene', gene_id FROM genes_v)"""


def _where(table: str, key: str, condition: str) -> tuple[str, str]:
    return key, f"{table} WHERE {condition}"


def _twice(table: str, keys: str, key: str) -> tuple[str, str]:
    return key, f"(SELECT sample_id, run_id, {keys} FROM {table} GROUP BY sample_id, run_id, {keys} HAVING count(*) > 1)"


def _lost(table: str, key: str, parent: str, on: dict[str, str], scope: bool = True) -> tuple[str, str]:
    pairs = {**({"sample_id": "sample_id", "run_id": "run_id"} if scope else {}), **on}
    some = " AND ".join(f"c.{a} IS NOT NULL" for a in pairs)
    return key, f"{table} c WHERE {some} AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {' AND '.join(f'p.{b} = c.{a}' for a, b in pairs.items())})"


_OPEN = "(SELECT run_id, stage_id FROM stages_v WHERE status <> 'completed')"
_DONE = "(SELECT run_id, stage_id FROM stages_v WHERE status = 'completed')"
#: rule: number, (key, rows), detail
RULES: dict[str, tuple[int, tuple[str, str], str]] = {
    "duplicate_sample": (1, ("sample_id", "(SELECT sample_id, NULL AS run_id FROM samples_v GROUP BY sample_id HAVING count(*) > 1)"), "duplicate sample"),
    "run_sample": (2, _lost("runs_v", "run_id", "samples_v", {"sample_id": "sample_id"}, False), "run without its sample"),
    "duplicate_run": (3, ("run_id", "(SELECT sample_id, run_id FROM runs_v GROUP BY ALL HAVING count(*) > 1)"), "duplicate run"),
    "basecaller": (4, _where("runs_v", "run_id", "platform <> 'ONT' AND basecaller IS NOT NULL"), "basecaller on another platform"),
    "duplicate_stage": (5, _twice("stages_v", "stage_id", "stage_id"), "duplicate stage"),
    "duplicate_artifact": (6, _twice("artifacts_v", "artifact_id", "artifact_id"), "duplicate artifact"),
    "artifact_run": (7, _lost("artifacts_v", "artifact_id", "runs_v", {}), "artifact without its run"),
    "path_identity": (8, ("path", "(SELECT path, min(sample_id) AS sample_id, NULL AS run_id FROM artifacts_v GROUP BY path HAVING count(DISTINCT (sha256, size_bytes)) > 1)"), "one path with several contents"),
    "producer": (9, _lost("artifacts_v", "artifact_id", "stages_v", {"producer_stage_id": "stage_id"}), "artifact without its producer stage"),
    "stage_run": (10, _lost("stages_v", "stage_id", "runs_v", {}), "stage without its run"),
    "database_version": (11, _where("stages_v", "stage_id", "(database_name IS NULL AND database_version IS NOT NULL) OR (database_name IS NOT NULL AND database_version IS NULL)"), "database name and version must appear together"),
    "database_checksum": (12, _where("stages_v", "stage_id", "database_sha256 IS NOT NULL AND database_name IS NULL"), "database checksum without a name"),
    "completed_reason": (13, _where("stages_v", "stage_id", "status = 'completed' AND status_reason IS NOT NULL"), "completed stage with a reason"),
    "completed_command": (14, _where("stages_v", "stage_id", "status = 'completed' AND command IS NULL"), "completed stage without a command"),
    "open_reason": (15, _where("stages_v", "stage_id", "status <> 'completed' AND status_reason IS NULL"), "stage that is not completed lacks a reason"),
    "repeated_input": (16, _twice("stage_inputs_v", "artifact_id, stage_id", "stage_id"), "stage repeats an input artifact"),
    "input_artifact": (17, _lost("stage_inputs_v", "stage_id", "artifacts_v", {"artifact_id": "artifact_id"}), "stage input without its artifact"),
    "own_output": (18, ("stage_id", "stage_inputs_v c WHERE EXISTS (SELECT 1 FROM artifacts_v p WHERE p.run_id = c.run_id AND p.artifact_id = c.artifact_id AND p.producer_stage_id = c.stage_id)"), "stage consumes its own output"),
    "duplicate_result": (19, _twice("results", "collection, key", "key"), "duplicate key of a result"),
    "result_run": (20, _lost("results", "key", "runs_v", {}), "result without its run"),
    "result_stage": (21, _lost("results", "key", "stages_v", {"stage_id": "stage_id"}), "result without its stage"),
    "result_artifact": (22, _lost("results", "key", "artifacts_v", {"artifact_id": "artifact_id"}), "result without its artifact"),
    "coverage_artifact": (23, _lost("contigs_v", "contig_id", "artifacts_v", {"coverage_artifact_id": "artifact_id"}), "coverage artifact is missing"),
    "result_status": (24, _where("results", "key", f"(run_id, stage_id) IN {_OPEN}"), "result of a stage that is not completed"),
    "result_producer": (25, ("key", "(SELECT r.*, producer_stage_id FROM results r JOIN artifacts_v USING (sample_id, run_id, artifact_id)) WHERE stage_id IS DISTINCT FROM producer_stage_id"), "result and artifact come from different stages"),
    "result_kind": (26, ("key", f"(SELECT r.*, kind FROM results r JOIN artifacts_v USING (sample_id, run_id, artifact_id)) WHERE kind <> CASE collection {_KINDS} END"), "artifact kind does not match its table"),
    "repeated_expected": (27, _twice("stage_expected_keys_v", "collection, record_id, stage_id", "stage_id"), "stage repeats an expected key"),
    "open_expected": (28, _where("stage_expected_keys_v", "record_id", f"(run_id, stage_id) IN {_OPEN}"), "stage that is not completed expects rows"),
    "expected_keys": (29, ("collection || ':' || key", f"((SELECT sample_id, run_id, stage_id, collection, record_id AS key FROM stage_expected_keys_v WHERE (run_id, stage_id) IN {_DONE} EXCEPT SELECT sample_id, run_id, stage_id, collection, key FROM results) UNION ALL (SELECT sample_id, run_id, stage_id, collection, key FROM results WHERE (run_id, stage_id) IN {_DONE} EXCEPT SELECT sample_id, run_id, stage_id, collection, record_id FROM stage_expected_keys_v))"), "expected and actual keys differ"),
    "read_sum": (30, _where("read_stats_v", "record_id", "retained_reads + rejected_reads <> total_reads"), "reads do not add up"),
    "base_sum": (31, _where("read_stats_v", "record_id", "retained_bases + rejected_bases <> total_bases"), "bases do not add up"),
    "contig_assembly": (32, _lost("contigs_v", "contig_id", "assemblies_v", {"assembly_id": "assembly_id"}), "contig without its assembly"),
    "depth_artifact": (33, _where("contigs_v", "contig_id", "mean_depth_x IS NOT NULL AND coverage_artifact_id IS NULL"), "depth without a coverage artifact"),
    "contig_count": (34, _where("sized", "assembly_id", "contig_count <> n"), "contig count differs from its rows"),
    "assembly_length": (35, _where("sized", "assembly_id", "assembly_length_bp <> bp"), "assembly length differs from its rows"),
    "n50_present": (36, _where("sized", "assembly_id", "n > 0 AND n50_bp IS NULL"), "assembly with contigs lacks its N50"),
    "n50_absent": (37, _where("sized", "assembly_id", "n = 0 AND n50_bp IS NOT NULL"), "empty assembly has an N50"),
    "n50_bound": (38, _where("sized", "assembly_id", "n50_bp > longest"), "N50 exceeds the longest contig"),
    "n50_value": (39, _where("sized", "assembly_id", "n > 0 AND n50_bp <> seen_n50"), "N50 differs from its rows"),
    "bin_assembly": (40, _lost("bins_v", "bin_id", "assemblies_v", {"assembly_id": "assembly_id"}), "bin without its assembly"),
    "member_bin": (41, _lost("memberships_v", "membership_id", "bins_v", {"bin_id": "bin_id"}), "membership without its bin"),
    "member_contig": (42, _lost("memberships_v", "membership_id", "contigs_v", {"contig_id": "contig_id"}), "membership without its contig"),
    "one_bin": (43, _twice("memberships_v", "contig_id", "contig_id"), "contig in more than one bin"),
    "qc_target": (44, _lost("qc_v", "record_id", "targets", {"target_kind": "target_kind", "target_id": "target_id"}, False), "measurement without its target"),
    "foreign_fields": (45, ("record_id", "(SELECT q.*, tool_name FROM qc_v q JOIN stages_v USING (sample_id, run_id, stage_id)) WHERE lower(tool_name) <> 'checkeuk' AND (checkeuk_expected_markers_present IS NOT NULL OR checkeuk_expected_markers_total IS NOT NULL)"), "fields of another tool"),
    "no_measurement": (46, _where("qc_v", "record_id", "coalesce(completeness_percent, contamination_percent, checkeuk_expected_markers_present, checkeuk_expected_markers_total) IS NULL"), "row without a measurement"),
    "completeness_basis": (47, _where("qc_v", "record_id", "completeness_percent IS NOT NULL AND completeness_basis IS NULL"), "completeness lacks its basis"),
    "contamination_basis": (48, _where("qc_v", "record_id", "contamination_percent IS NOT NULL AND contamination_basis IS NULL"), "contamination lacks its basis"),
    "marker_pair": (49, _where("qc_v", "record_id", "checkeuk_expected_markers_present IS NOT NULL AND checkeuk_expected_markers_total IS NULL"), "marker counts must appear together"),
    "marker_order": (50, _where("qc_v", "record_id", "checkeuk_expected_markers_present > checkeuk_expected_markers_total"), "more markers than expected"),
    "taxonomy_target": (51, _lost("taxonomy_v", "record_id", "targets", {"target_kind": "target_kind", "target_id": "target_id"}, False), "assertion without its target"),
    "feature_contig": (52, _lost("genes_v", "gene_id", "contigs_v", {"contig_id": "contig_id"}), "feature without its contig"),
    "feature_order": (53, _where("genes_v", "gene_id", '"start" > "end"'), "feature ends before it starts"),
    "feature_bounds": (54, ("gene_id", '(SELECT g.*, length_bp FROM genes_v g JOIN contigs_v USING (sample_id, run_id, contig_id)) WHERE "end" > length_bp'), "feature beyond its contig"),
    "gene_bin": (55, _lost("genes_v", "gene_id", "bins_v", {"bin_id": "bin_id"}), "gene without its bin"),
    "gene_member": (56, _lost("genes_v", "gene_id", "memberships_v", {"bin_id": "bin_id", "contig_id": "contig_id"}), "gene on a contig that is not in its bin"),
    "genetic_code": (57, ("gene_id", "(SELECT g.*, s.genetic_code AS own FROM genes_v g JOIN samples_v s USING (sample_id) WHERE bin_id IN (SELECT bin_id FROM bins_v WHERE candidate_class = 'bacterial_archaeal_candidate')) WHERE genetic_code <> own"), "gene code differs from the sample''s"),
    "phenotype_bin": (58, _lost("phenotypes_v", "record_id", "bins_v", {"bin_id": "bin_id"}), "phenotype without its bin"),
    "threshold": (59, _where("phenotypes_v", "record_id", "passes_threshold <> (raw_score >= threshold)"), "flag contradicts the threshold"),
    "applicability": (60, _where("phenotypes_v", "record_id", "NOT is_applicable AND applicability_reason IS NULL"), "not applicable without a reason"),
    "annotation_gene": (61, _lost("annotations_v", "annotation_id", "genes_v", {"gene_id": "gene_id"}), "annotation without its gene"),
    "paired_coordinates": (62, _where("annotations_v", "annotation_id", '("start" IS NULL AND "end" IS NOT NULL) OR ("start" IS NOT NULL AND "end" IS NULL)'), "coordinates must appear together"),
    "coordinate_order": (63, _where("annotations_v", "annotation_id", '"start" > "end"'), "annotation ends before it starts"),
}


def _sql(names: list[str]) -> str:
    parts = [f"SELECT '{n}' AS rule_id, {RULES[n][0]} AS rule_order, sample_id, CAST(run_id AS VARCHAR) AS run_id, {RULES[n][1][0]} AS key, '{RULES[n][2]}' AS detail FROM {RULES[n][1][1]}" for n in names]
    return f"WITH {_VIEWS}, results AS ({_RESULTS}), {_SEEN}\n" + "\nUNION ALL ".join(parts)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for _name, _low, _high in (("violations_of_stages", 1, 18), ("violations_of_results", 19, 29), ("violations_of_assemblies", 30, 43), ("violations_of_findings", 44, 63)):
    _names = [n for n, (number, *_) in RULES.items() if _low <= number <= _high]
    QUERIES[_name] = lambda spark, sf_dir, names=_names: integrity.violations(tables(spark, sf_dir), names)
    ORACLE_SQL[_name] = _sql(_names)
