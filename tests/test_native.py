import pytest

from tessella.operators import native


def table(spark, columns, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"`{c}` string" for c in columns))


def problems(p):
    return sorted((r.target, r.detail) for r in p.problems.collect())


def test_plain_quality_tables(spark):
    columns = ["Name", "Completeness", "Contamination", "Completeness_Model_Used"]
    good = native.checkm2(table(spark, columns, ("a/b.fa", "99.5", "214.81", "Neural")))
    row = native.accepted(good).rows["qc"].first()
    assert (row.record_id, row.target_id, row.completeness_percent, row.contamination_percent) == ("checkm2:qc:b", "b", 99.5, 214.81)
    bad = native.checkm2(table(spark, columns, ("x", "101", "0", "m"), ("y", "nan", "inf", " "), ("y.fna", "1", "1", "m")))
    assert {d for _, d in problems(bad)} == {"completeness", "contamination", "empty model", "repeated target"}
    with pytest.raises(ValueError, match="completeness"):
        native.accepted(bad)
    one = native.checkm1(table(spark, ["Bin Id", "Marker lineage", "Completeness", "Contamination"], ("b", "k__B (UID1)", "0", "300")))
    assert native.accepted(one).rows["qc"].first().contamination_percent == 300.0


def test_summary_and_detail(spark):
    columns = ["genome", "status", "completeness", "completeness_basis", "completeness_bom", "contamination", "lineage", "completeness_note", "pfam_status", "pfam_union_families", "pfam_observed_families", "pfam_completeness"]
    detail = table(spark, ["genome", "n_present_core", "n_present_expected", "n_expected"], ("a", "7", "3", "4"), ("b", "0", "0", "5"))
    ok = native.checkeuk(table(spark, columns, ("a", "ok", "75", "markers", "", "NA", "d__Eukaryota;p__X", "scored markers 3/4", "", "1085", "9", ""), ("b", "filtered", "", "", "", "", "", "too short", "", "", "", "")), detail)
    qc = native.accepted(ok).rows["qc"].first()
    assert (qc.checkeuk_expected_markers_present, qc.checkeuk_expected_markers_total, qc.contamination_percent) == (3, 4, None)
    assert [(r.rank, r.taxon_name) for r in ok.rows["taxonomy"].orderBy("rank").collect()] == [("domain", "Eukaryota"), ("phylum", "X")]
    assert ok.rows["notes"].first().note == "CheckEUK filtered b before scoring: too short."
    bad = native.checkeuk(table(spark, columns, ("a", "ok", "75", "", "", "", "", "markers 2/4", "", "9", "9", ""), ("c", "odd", "", "", "", "", "", "", "", "", "", "")), detail)
    assert {d for _, d in problems(bad)} >= {"completeness lacks its basis", "panel of another size", "summary and detail differ", "unsupported status", "summary and detail hold different targets"}


def test_applicability_takes_the_first_failing_check(spark):
    columns = ["taxon_oid", "completeness_UNI56", "classification", "confidence", "passes_confidence_threshold", "classification_thresholded"]
    rows = [(t, u, "host", "0.725", "True", "host") for t, u in (("e", "90"), ("v", "90"), ("q", "90"), ("n", "90"), ("l", "49.9"), ("g", "50"))]
    calls = spark.createDataFrame([("q", "d__Bacteria;p", "Domain questionable"), ("l", "d__Archaea;p", ""), ("g", "d__Bacteria;p", ""), ("e", "d__Bacteria;p", "")], "target string, classification string, warnings string")
    one = lambda t: spark.createDataFrame([(t,)], "target string")
    got = native.accepted(native.symclatron(table(spark, columns, *rows), one("e"), one("v"), calls))
    reasons = {r.bin_id: r.applicability_reason for r in got.rows["phenotypes"].collect()}
    assert reasons["g"] is None and reasons["l"].startswith("UNI56") and reasons["e"].startswith("CheckEUK") and reasons["v"].startswith("GVClass") and reasons["q"].startswith("GTDB-Tk flags") and reasons["n"].startswith("No GTDB-Tk")
    bad = native.symclatron(table(spark, columns, ("x", "1", "c", "0.7", "True", "c")), one("e"), one("v"), calls)
    assert problems(bad) == [("x", "flag contradicts the threshold")]


def test_busco_and_scores(spark):
    columns = ["Input_file", "Dataset", "Complete", "Single", "Duplicated", "Fragmented", "Missing", "n_markers"]
    got = native.accepted(native.busco(table(spark, columns, ("a.fa", "euk", "90", "", "3", "1", "9", "255"), ("b.fa", "No genes found", "", "", "", "", "", ""))))
    assert got.rows["qc"].count() == 1 and got.rows["qc"].first().completeness_basis == "BUSCO euk complete (n=255)"
    assert sorted(r.note for r in got.rows["notes"].collect()) == ["a: BUSCO fragmented 1%, missing 9%", "b: BUSCO No genes found"]
    assert problems(native.busco(table(spark, columns, ("b", "No genes found", "1", "", "", "", "", "")))) == [("b", "failure row with values")]
    quick = ["#QueryName", "lineage", "ConfLevel", "Confidence"]
    ranks = native.accepted(native.quickclade(table(spark, quick, ("a", "d__B;p__C", "phylum:0.5", "domain:0.9;p:0.5"))))
    assert {(r.rank, r.score) for r in ranks.rows["taxonomy"].collect()} == {("domain", 0.9), ("phylum", 0.5)}
    assert problems(native.quickclade(table(spark, quick, ("a", "d__B", "d:0.4", "domain:0.9")))) == [("a", "confidence fields disagree")]


def test_classifications(spark):
    got = native.accepted(native.gtdbtk(table(spark, ["user_genome", "classification"], ("a", "d__B;p__C"), ("b", "Unclassified Bacteria"))))
    assert {(r.target_id, r.rank, r.taxon_name) for r in got.rows["taxonomy"].collect()} == {("a", "domain", "B"), ("a", "phylum", "C"), ("b", "domain", "Unclassified Bacteria")}
    assert problems(native.gtdbtk(table(spark, ["user_genome", "classification"], ("a", "p__B;p__C")))) == [("a", "repeated rank")]


def test_loci_and_viruses(spark):
    columns = ["name", "model", "length", "coordinates", "strand", "contig_name", "blast_sseqid", "blast_pident", "taxonomy", "reference_identifiers", "reference_source", "reference_versions", "reference_taxonomy", "taxonomy_assignment_method", "blast_query_coverage"]
    locus = ("n", "RF01960", "10", "5-14", "-", "c1", "acc", "99", "Eukaryota", "", "", "", "", "m", "0.5")
    row = native.accepted(native.ssu(table(spark, columns, locus))).rows["ssu"].first()
    assert (row.record_id, row.ssu_type, row.strand, row.query_coverage_percent) == ("ssuextract:ssu:c1:5-14:RF01960", "rrna_18s", "minus", 50.0)
    assert ("n", "length disagrees with coordinates") in problems(native.ssu(table(spark, columns, (*locus[:2], "11", *locus[3:]))))
    names = ["seq_name", "length", "topology", "coordinates", "n_genes", "genetic_code", "virus_score", "fdr", "n_hallmarks", "marker_enrichment", "taxonomy"]
    contigs = spark.createDataFrame([("c1", 100), ("c2", 50)], "contig_id string, length_bp long")
    calls = native.accepted(native.genomad(table(spark, names, ("c1", "100", "Linear", "NA", "1", "11", "0.9", "NA", "0", "1.5", "Viruses;R;;P"), ("c2|provirus_3_12", "10", "Provirus", "3-12", "1", "11", "0.8", "0.1", "0", "-2", "Unclassified")), contigs))
    assert {r.record_id for r in calls.rows["viruses"].collect()} == {"genomad:virus:c1", "genomad:virus:c2:3-12"}
    assert {(r.rank, r.taxon_name) for r in calls.rows["taxonomy"].collect()} == {("root", "Viruses"), ("realm", "R"), ("phylum", "P")}
    found = native.genomad(table(spark, names, ("c2|provirus_3_60", "58", "Provirus", "3-60", "1", "11", "0.8", "0.1", "0", "0", "Viruses"), ("zz", "1", "Linear", "", "1", "11", "2", "", "0", "", "Viruses")), contigs)
    assert {d for _, d in problems(found)} >= {"coordinates beyond the contig", "unknown contig", "score"}
    heads = ["contig_id", "contig_length", "provirus", "proviral_length", "gene_count", "viral_genes", "host_genes", "checkv_quality", "miuvig_quality", "completeness", "completeness_method", "contamination", "kmer_freq", "warnings"]
    known = calls.rows["viruses"].select("target", "record_id")
    qc = native.accepted(native.checkv(table(spark, heads, ("c1", "100", "No", "NA", "3", "1", "1", "Low", "Genome", "NA", "NA", "0.0", "1.0", ""), ("c2|provirus_3_12", "10", "Yes", "9", "1", "0", "0", "Low", "Genome", "NA", "NA", "NA", "1.0", "")), known))
    assert [(r.record_id, r.contamination_percent) for r in qc.rows["qc"].collect()] == [("checkv:qc:genomad:virus:c1", 0.0)]
    assert ("c2|provirus_3_12", "target sets differ") in problems(native.checkv(table(spark, heads, ("c1", "100", "No", "NA", "3", "1", "1", "Low", "G", "NA", "NA", "0.0", "1", "")), known))
