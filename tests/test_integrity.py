"""One small valid catalog, and one change for each kind of rule."""

import pytest

from tessella.operators import integrity
from tessella.plans import report
from tessella.sources import sinks

SCHEMAS = {
    "samples": "sample_id string, description string, genetic_code int",
    "runs": "sample_id string, run_id string, platform string, rna_technology string, basecaller string, basecaller_model string, library_prep string",
    "stages": "sample_id string, run_id string, stage_id string, name string, status string, status_reason string, notes string, tool_name string, tool_version string, command string, database_name string, database_version string, database_sha256 string",
    "artifacts": "sample_id string, run_id string, artifact_id string, kind string, path string, sha256 string, size_bytes long, producer_stage_id string",
    "stage_inputs": "sample_id string, run_id string, stage_id string, position int, artifact_id string",
    "stage_expected_keys": "sample_id string, run_id string, stage_id string, collection string, record_id string",
    "read_stats": "sample_id string, run_id string, stage_id string, artifact_id string, record_id string, total_reads long, retained_reads long, rejected_reads long, total_bases long, retained_bases long, rejected_bases long",
    "assemblies": "sample_id string, run_id string, stage_id string, artifact_id string, assembly_id string, assembly_length_bp long, contig_count long, n50_bp long, gc_fraction double",
    "contigs": "sample_id string, run_id string, stage_id string, artifact_id string, contig_id string, assembly_id string, length_bp long, mean_depth_x double, coverage_artifact_id string",
    "bins": "sample_id string, run_id string, stage_id string, artifact_id string, bin_id string, assembly_id string, candidate_class string",
    "memberships": "sample_id string, run_id string, stage_id string, artifact_id string, membership_id string, bin_id string, contig_id string",
    "qc": "sample_id string, run_id string, stage_id string, artifact_id string, record_id string, target_kind string, target_id string, completeness_percent double, completeness_basis string, contamination_percent double, contamination_basis string, checkeuk_expected_markers_present long, checkeuk_expected_markers_total long",
    "taxonomy": "sample_id string, run_id string, stage_id string, artifact_id string, record_id string, target_kind string, target_id string, rank string, taxon_name string, taxon_id string, score double, lineage_confidence double",
    "genes": "sample_id string, run_id string, stage_id string, artifact_id string, gene_id string, contig_id string, bin_id string, start long, end long, strand string, genetic_code int",
    "phenotypes": "sample_id string, run_id string, stage_id string, artifact_id string, record_id string, bin_id string, raw_class string, raw_score double, threshold double, passes_threshold boolean, thresholded_class string, is_applicable boolean, applicability_reason string",
    "annotations": "sample_id string, run_id string, stage_id string, artifact_id string, annotation_id string, gene_id string, database_name string, database_version string, start long, end long",
}
STAGES = {"reads": ("read_stats", "qc_report", "r1"), "asm": ("assemblies", "assembly", "a1"), "bin": ("bins", "bin_fasta", "b1"), "qc": ("qc", "qc_report", "q1"), "tax": ("taxonomy", "taxonomy_report", "t1"), "gene": ("genes", "gene_annotation", "g1"), "phen": ("phenotypes", "phenotype_report", "p1"), "ann": ("annotations", "functional_annotation", "n1")}


def valid():
    s = ("s", "r")
    rows = {
        "samples": [("s", None, 11)],
        "runs": [(*s, "HIFI", None, None, None, None)],
        "stages": [(*s, st, st, "completed", None, None, "CheckEUK" if st == "qc" else "tool", "1", "run", None, None, None) for st in STAGES] + [(*s, "later", "braker", "pending", "waits", None, None, None, None, None, None, None)],
        "artifacts": [(*s, f"art_{st}", kind, f"/{st}", st, 1, st) for st, (_, kind, _) in STAGES.items()],
        "stage_inputs": [(*s, "bin", 0, "art_asm")],
        "stage_expected_keys": [(*s, st, c, k) for st, (c, _, k) in STAGES.items()] + [(*s, "asm", "contigs", "c1"), (*s, "asm", "contigs", "c2"), (*s, "bin", "memberships", "m1")],
        "read_stats": [(*s, "reads", "art_reads", "r1", 10, 7, 3, 100, 70, 30)],
        "assemblies": [(*s, "asm", "art_asm", "a1", 150, 2, 100, 0.5)],
        "contigs": [(*s, "asm", "art_asm", "c1", "a1", 100, None, None), (*s, "asm", "art_asm", "c2", "a1", 50, 2.0, "art_asm")],
        "bins": [(*s, "bin", "art_bin", "b1", "a1", "bacterial_archaeal_candidate")],
        "memberships": [(*s, "bin", "art_bin", "m1", "b1", "c1")],
        "qc": [(*s, "qc", "art_qc", "q1", "bin", "b1", 90.0, "markers", None, None, 4, 5)],
        "taxonomy": [(*s, "tax", "art_tax", "t1", "contig", "c1", "genus", "x", None, None, None)],
        "genes": [(*s, "gene", "art_gene", "g1", "c1", "b1", 1, 100, "+", 11)],
        "phenotypes": [(*s, "phen", "art_phen", "p1", "b1", "host", 0.8, 0.7, True, "host", True, None)],
        "annotations": [(*s, "ann", "art_ann", "n1", "g1", "db", "1", 5, 9)],
    }
    return rows


def tables(spark, rows):
    return {n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in rows.items()}


def change(table, k, **values):
    def apply(rows):
        names = [c.strip().split(" ")[0] for c in SCHEMAS[table].split(",")]
        rows[table][k] = tuple((dict(zip(names, rows[table][k])) | values)[n] for n in names)

    return apply


def copy(table, k=0):
    return lambda rows: rows[table].append(rows[table][k])


CASES = {
    "duplicate_sample": copy("samples"), "run_sample": change("runs", 0, sample_id="z"), "duplicate_run": copy("runs"), "basecaller": change("runs", 0, basecaller="b"), "duplicate_stage": copy("stages"),
    "duplicate_artifact": copy("artifacts"), "path_identity": change("artifacts", 0, path="/asm"), "producer": change("artifacts", 0, producer_stage_id="none"), "database_version": change("stages", 0, database_name="d"),
    "database_checksum": change("stages", 0, database_sha256="x"), "completed_reason": change("stages", 0, status_reason="x"), "completed_command": change("stages", 0, command=None), "open_reason": change("stages", -1, status_reason=None),
    "repeated_input": copy("stage_inputs"), "input_artifact": change("stage_inputs", 0, artifact_id="none"), "own_output": change("stage_inputs", 0, stage_id="asm"), "duplicate_result": copy("genes"), "result_stage": change("genes", 0, stage_id="none"),
    "result_artifact": change("genes", 0, artifact_id="none"), "coverage_artifact": change("contigs", 1, coverage_artifact_id="none"), "result_status": change("genes", 0, stage_id="later"), "result_producer": change("genes", 0, artifact_id="art_asm"),
    "result_kind": change("artifacts", 0, kind="assembly"), "repeated_expected": copy("stage_expected_keys"), "open_expected": change("stage_expected_keys", 0, stage_id="later"), "expected_keys": change("stage_expected_keys", 0, record_id="none"),
    "read_sum": change("read_stats", 0, rejected_reads=4), "base_sum": change("read_stats", 0, rejected_bases=4), "contig_assembly": change("contigs", 0, assembly_id="none"), "depth_artifact": change("contigs", 1, coverage_artifact_id=None),
    "contig_count": change("assemblies", 0, contig_count=3), "assembly_length": change("assemblies", 0, assembly_length_bp=151), "n50_present": change("assemblies", 0, n50_bp=None), "n50_bound": change("assemblies", 0, n50_bp=101), "n50_value": change("assemblies", 0, n50_bp=50),
    "bin_assembly": change("bins", 0, assembly_id="none"), "member_bin": change("memberships", 0, bin_id="none"), "member_contig": change("memberships", 0, contig_id="none"), "one_bin": copy("memberships"), "qc_target": change("qc", 0, target_id="none"),
    "foreign_fields": change("stages", 3, tool_name="other"), "no_measurement": change("qc", 0, completeness_percent=None, checkeuk_expected_markers_present=None, checkeuk_expected_markers_total=None), "completeness_basis": change("qc", 0, completeness_basis=None),
    "contamination_basis": change("qc", 0, contamination_percent=300.0), "marker_pair": change("qc", 0, checkeuk_expected_markers_total=None), "marker_order": change("qc", 0, checkeuk_expected_markers_present=6), "taxonomy_target": change("taxonomy", 0, target_kind="bin"),
    "feature_contig": change("genes", 0, contig_id="none"), "feature_order": change("genes", 0, start=101), "feature_bounds": change("genes", 0, end=101), "gene_bin": change("genes", 0, bin_id="none"), "gene_member": change("genes", 0, contig_id="c2"),
    "genetic_code": change("genes", 0, genetic_code=4), "phenotype_bin": change("phenotypes", 0, bin_id="none"), "threshold": change("phenotypes", 0, passes_threshold=False), "applicability": change("phenotypes", 0, is_applicable=False),
    "annotation_gene": change("annotations", 0, gene_id="none"), "paired_coordinates": change("annotations", 0, end=None), "coordinate_order": change("annotations", 0, start=10),
}


def test_valid_catalog_has_no_violation(spark):
    assert integrity.violations(tables(spark, valid())).count() == 0


@pytest.mark.parametrize("name", list(CASES))
def test_rule_finds_its_change(spark, name):
    rows = valid()
    CASES[name](rows)
    assert integrity.violations(tables(spark, rows), [name]).count() > 0


def test_publish_keeps_the_old_catalog_on_failure(spark, tmp_path):
    path = f"{tmp_path}/catalog"
    small = {n: r for n, r in valid().items() if n in ("samples", "runs")}
    sinks.publish(spark, tables(spark, small), path)
    broken = {"samples": small["samples"] * 2, "runs": small["runs"]}
    with pytest.raises(ValueError, match="duplicate sample"):
        sinks.publish(spark, tables(spark, broken), path)
    assert spark.read.parquet(f"{path}/samples").count() == 1
    sinks.publish(spark, tables(spark, small), path)
    assert spark.read.parquet(f"{path}/runs").count() == 1


def test_report_tables(spark):
    t = tables(spark, valid())
    states = {r.stage_id: (r.input_artifacts, r.expected_records) for r in report.stage_states(t).collect()}
    assert states["bin"] == (1, 2) and states["asm"] == (0, 3) and states["later"] == (0, 0)
    assert {r.table: r.records for r in report.record_counts(t).collect()}["contigs"] == 2
    assert report.with_stage(t, "taxonomy").first().tool_name == "tool"
    assert report.gene_caller_states(t).first().cataloged_models == 0
    assert report.coding_models(t).first().coding_models == 1
    assert report.read_outcomes(t).first().total == 10
    assert report.same_rank_conflicts(t).count() == 0
    assert report.feature_artifacts(t).count() == 2


SHARED = {"results": (range(20, 27), 4), "keys": ((19, 27, 29), 1), "assemblies": (range(34, 40), 1), "targets": ((44, 51), 1), "features": ((52, 54), 1), "genes": ((55, 57), 2)}


@pytest.mark.parametrize("group", list(SHARED))
def test_rules_of_one_kind_share_their_joins(spark, group):
    numbers, joins = SHARED[group]
    rows = valid()
    for copied in ("stages", "artifacts", "genes", "stage_expected_keys", "samples", "bins", "contigs"):
        copy(copied)(rows)
    for name, apply in CASES.items():
        if integrity.RULES[name][0] in numbers and name not in ("duplicate_result", "repeated_expected"):
            apply(rows)
    t = tables(spark, rows)
    names = [n for n, (number, *_) in integrity.RULES.items() if number in numbers]
    together = integrity.violations(t, names)
    assert sorted(map(tuple, together.collect()), key=str) == sorted((tuple(r) for n in names for r in integrity.violations(t, [n]).collect()), key=str)
    assert together._jdf.queryExecution().optimizedPlan().toString().count("Join ") <= joins


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def odd():
    """Repeated artifacts of several kinds, repeated stages of several states, nulls, keys under several stages, unknown collections."""
    rows, s = valid(), ("s", "r")
    for copied in ("stages", "artifacts", "genes", "genes", "stage_expected_keys", "contigs"):
        copy(copied)(rows)
    rows["artifacts"] += [(*s, "art_asm", "qc_report", "/x", "x", 2, "gene"), (*s, "art_asm", None, "/x", "x", 2, None), (*s, None, "assembly", "/x", "x", 2, "asm")]
    rows["stages"] += [(*s, "gene", "gene", "pending", "waits", None, None, None, None, None, None, None)]
    rows["contigs"] += [(*s, None, "art_asm", "c3", "a1", 1, None, "none"), (*s, "asm", None, "c4", "a1", 1, None, None), (*s, "none", "none", "c1", "a1", 1, None, "none"), ("s", None, "asm", "art_asm", "c5", "a1", 1, None, "none"), ("z", "r", "asm", "art_asm", "c6", "a1", 1, None, "art_asm")]
    rows["genes"] += [(*s, "later", "art_asm", "g1", "c1", "b1", 1, 100, "+", 11), (*s, "gene", "art_gene", None, "c1", "b1", 1, 100, "+", 11)]
    rows["stage_expected_keys"] += [(*s, "asm", "unknown", "u1"), (*s, "asm", "unknown", "u1"), (*s, "asm", None, "u2"), (*s, "later", "genes", "g1"), (*s, "later", "genes", "g2"), (*s, "later", "genes", "g2"), (*s, None, "genes", "g3")]
    return rows


@pytest.mark.parametrize("part_rows", [1 << 26, 9, 1])
def test_rules_over_results_find_the_same_part_by_part(spark, monkeypatch, part_rows):
    monkeypatch.setattr(integrity, "PART_ROWS", part_rows)
    t = tables(spark, odd())
    names = [n for n, (number, *_) in integrity.RULES.items() if 19 <= number <= 29]
    together = integrity.violations(t, names)
    alone = [tuple(r) for n in names for r in integrity.violations(t, [n]).collect()]
    assert sorted(map(tuple, together.collect()), key=str) == sorted(alone, key=str)
    assert {r[0] for r in alone} == set(names)
    # no shuffle of the results is left for the plan that gives the rows
    assert ("Exchange" in plan(together)) == (part_rows > 9)


def test_expected_keys_without_results(spark):
    t = {n: d for n, d in tables(spark, odd()).items() if n in ("samples", "runs", "stages", "stage_expected_keys")}
    names = ["repeated_expected", "open_expected"]
    assert sorted(map(tuple, integrity.violations(t, names).collect()), key=str) == sorted((tuple(r) for n in names for r in integrity.violations(t, [n]).collect()), key=str)
