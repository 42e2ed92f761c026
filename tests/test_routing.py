"""Decisions at and around every threshold."""

import pytest

from tessella.operators import routing

EMPTY = dict(status="filtered", lineage="", markers=9, majority="nd", quick_lineage="", euk_bp=0, prok_bp=0, org_bp=0, uncl_bp=1000, viral_bp=0, bin_bp=1000, ssu=[], virus_items=[], completeness=None, contamination=None)
CASES = [
    ({}, "unresolved", "unresolved", routing.NO_LINE),
    ({"majority": "d_EUK-pEVE;x"}, "unresolved", "conflicting", routing.AMBIGUOUS),
    ({"majority": "d_MITO"}, "unresolved", "unresolved", routing.ORGANELLE_MAJORITY),
    ({"majority": "d_MITO", "viral_bp": 500}, "unresolved", "conflicting", routing.ORGANELLE_MAJORITY),
    ({"org_bp": 500}, "unresolved", "unresolved", routing.ORGANELLE_SHARE),
    ({"org_bp": 1_000_000, "bin_bp": 2_000_000}, "unresolved", "unresolved", routing.ORGANELLE_SHARE),
    ({"org_bp": 1_000_001, "bin_bp": 2_000_001}, "unresolved", "unresolved", routing.ONE_LINE),
    ({"prok_bp": 800, "completeness": 10.0, "contamination": 0.0}, "prokaryotic", "bacterial_archaeal_candidate", routing.PROKARYOTIC_SHARE),
    ({"prok_bp": 800, "completeness": 9.9, "contamination": 0.0}, "unresolved", "unresolved", routing.NO_LINE),
    ({"prok_bp": 799, "completeness": 10.0, "contamination": 0.0}, "unresolved", "unresolved", routing.NO_LINE),
    ({"prok_bp": 800, "completeness": 10.0, "contamination": 0.0, "viral_bp": 500}, "unresolved", "conflicting", routing.CONFLICT),
    ({"status": "ok", "lineage": " k__x ", "majority": "d_EUK"}, "eukaryotic", "eukaryotic_candidate", "CheckEUK and GVClass support a eukaryotic route"),
    ({"status": "ok", "lineage": " ", "markers": 4, "majority": "d_EUK"}, "eukaryotic", "eukaryotic_candidate", routing.FALLBACK),
    ({"status": "ok", "lineage": "", "markers": 5, "majority": "d_EUK"}, "unresolved", "unresolved", routing.ONE_LINE),
    ({"ssu": ["a@c"], "euk_bp": 500}, "eukaryotic", "eukaryotic_candidate", routing.SSU_LINE + " and Tiara support a eukaryotic route"),
    ({"ssu": ["a@c"], "majority": "d_EUK", "viral_bp": 500}, "unresolved", "conflicting", routing.CONFLICT),
    ({"viral_bp": 500}, "viral", "viral_candidate", routing.VIRAL),
    ({"viral_bp": 499}, "unresolved", "unresolved", routing.NO_LINE),
    ({"majority": "d_NCLDV", "euk_bp": 600}, "viral", "viral_candidate", routing.VIRAL),
    ({"majority": "d_NCLDV", "ssu": ["a@c"]}, "unresolved", "conflicting", routing.CONFLICT),
    ({"majority": "d_BAC;p"}, "prokaryotic", "bacterial_archaeal_candidate", routing.PROKARYOTIC_MAJORITY),
    ({"majority": "d_BAC;p", "viral_bp": 600}, "unresolved", "conflicting", routing.CONFLICT),
    ({"bin_bp": 0, "uncl_bp": 0}, "unresolved", "unresolved", routing.NO_LINE),
]
SCHEMA = "bin_id int, status string, lineage string, markers int, majority string, quick_lineage string, euk_bp long, prok_bp long, org_bp long, uncl_bp long, viral_bp long, bin_bp long, ssu array<string>, virus_items array<string>, completeness double, contamination double"


@pytest.fixture(scope="module")
def decided(spark):
    names = [c.strip().split(" ")[0] for c in SCHEMA.split(",")]
    rows = [tuple(({"bin_id": k} | EMPTY | case)[n] for n in names) for k, (case, *_) in enumerate(CASES)]
    return {r.bin_id: r for r in routing.route(spark.createDataFrame(rows, SCHEMA)).collect()}


@pytest.mark.parametrize("k", range(len(CASES)))
def test_decision(decided, k):
    assert (decided[k].route, decided[k].candidate_class, decided[k].reason) == CASES[k][1:]


def test_evidence_in_order(decided):
    assert decided[7].supporting == ["Tiara:0.8000", "CheckM2:10.00/0.00"]
    assert decided[11].supporting == ["CheckEUK: k__x ", "GVClass:d_EUK"] and decided[11].taxonomy == "k__x"
    assert decided[14].supporting == ["SSU:a@c", "Tiara:0.5000"]
    assert decided[17].conflicting == ["geNomad-minority:0.4990"]
    assert decided[21].conflicting == ["prokaryotic evidence conflicts with viral evidence"]
    assert decided[12].taxonomy == "d_EUK" and decided[12].taxonomy_source == "gvclass_fallback"


def test_incomplete_or_unknown_inputs_are_refused(spark):
    one = lambda rows, schema: spark.createDataFrame(rows, schema)
    bins = one([("a",), ("b",)], "bin_id string")
    good = dict(lineage=one([("a", "ok"), ("b", "filtered")], "bin_id string, status string"), majority=one([("a", "d_BAC;x"), ("b", "nd")], "bin_id string, majority string"), quick=one([("a", "d__Bacteria;p"), ("b", "none")], "bin_id string, quick_lineage string"), completeness=one([("a", 1.0)], "bin_id string, completeness double"))
    routing.require_inputs(routing.input_problems(bins, **good, keys=["bin_id"]))
    bad = dict(lineage=one([("a", "odd")], "bin_id string, status string"), majority=one([("a", "d_X"), ("b", "nd"), ("b", "nd")], "bin_id string, majority string"), quick=one([("a", "d__;p"), ("b", ""), ("c", "")], "bin_id string, quick_lineage string"), completeness=one([("z", 1.0)], "bin_id string, completeness double"))
    problems = routing.input_problems(bins, **bad, keys=["bin_id"])
    assert sorted(tuple(r) for r in problems.collect()) == [
        ("completeness", "z", "unexpected"), ("lineage", "a", "unsupported status: odd"), ("lineage", "b", "missing"), ("majority", "a", "unsupported domain: d_X"),
        ("majority", "b", "repeated"), ("quick", "a", "malformed domain"), ("quick", "c", "unexpected"),
    ]
    with pytest.raises(ValueError, match="unsupported|missing|repeated|unexpected|malformed"):
        routing.require_inputs(problems)


def test_two_stage_classes(spark):
    rows = [("c1 x", "bacteria", "n/a"), ("c2", "organelle", "mitochondrion"), ("c3", "unknown", "plastid"), ("c4", "eukarya", ""), ("c4", "archaea", ""), (" ", "unknown", ""), ("c5", "alien", "")]
    calls, problems = routing.tiara_calls(spark.createDataFrame(rows, "sequence_id string, class_fst_stage string, class_snd_stage string"))
    assert {(r.contig_id, r.contig_class) for r in calls.where("contig_id in ('c1', 'c2', 'c3')").collect()} == {("c1", "prokaryote"), ("c2", "organelle"), ("c3", "organelle")}
    assert sorted(tuple(r) for r in problems.collect()) == [("", "empty name"), ("c4", "repeated"), ("c5", "unsupported class: alien")]
