import pytest
from pyspark.sql import functions as F

from tessella.operators import binning
from tessella.sources import samples


def frame(spark, rows, columns):
    return spark.createDataFrame(rows, columns)


def found(p):
    return {(r.target, r.detail) for r in p.problems.collect()}


def inputs(spark):
    contigs = binning.assembled(frame(spark, [("c1", "ACGT"), ("c2", "ggcc"), ("c3", "AT")], "name string, sequence string"))
    depths = frame(spark, [("c1", "1.5"), ("c2", "0"), ("c3", "2")], "`#rname` string, meandepth string")
    records = frame(spark, [("x/b.1.fa", "c1"), ("x/b2.fa", "c2")], "path string, name string")
    clades = frame(spark, [("y/b.1.fa", "d__B", "7"), ("y/b2.fa", "", "")], "`#QueryName` string, lineage string, R_TaxID string")
    return contigs, depths, records, clades


def test_contigs_bins_memberships_and_lineages(spark):
    contigs, depths, records, clades = inputs(spark)
    assert [tuple(r) for r in contigs.rows["contigs"].orderBy("contig_id").collect()] == [("c1", 4, 2, 0.5), ("c2", 4, 4, 1.0), ("c3", 2, 0, 0.0)]
    p = binning.binned(contigs.rows["contigs"], depths, records, clades)
    assert found(p) == set()
    assert {r.contig_id: r.mean_depth_x for r in p.rows["contigs"].collect()} == {"c1": 1.5, "c2": 0.0, "c3": 2.0}
    assert {r.bin_id: r.candidate_class for r in p.rows["bins"].collect()} == {"b.1": "unresolved", "b2": "unresolved"}
    assert {r.membership_id for r in p.rows["memberships"].collect()} == {"b.1:c1", "b2:c2"}
    assert {(r.record_id, r.rank, r.taxon_name, r.taxon_id) for r in p.rows["taxonomy"].collect()} == {("quickclade:b.1", "lineage", "d__B", "7"), ("quickclade:b2", "lineage", "", "")}


def test_what_binning_refuses(spark):
    contigs, depths, records, clades = inputs(spark)
    c = contigs.rows["contigs"]
    bad = depths.where("meandepth <> '2'").union(frame(spark, [("zz", "1"), ("c1", "-1")], depths.schema))
    assert {("c3", "coverage and contigs differ: missing"), ("zz", "coverage and contigs differ: unexpected"), ("c1", "repeated in coverage"), ("c1", "depth")} == found(binning.binned(c, bad, records, clades))
    more = records.union(frame(spark, [("x/b2.fa", "c1"), ("x/b3.fa", "c9")], records.schema))
    assert found(binning.binned(c, depths, more, clades)) == {("c1", "in more than one place"), ("c9", "member is no contig"), ("b3", "lineages and bins differ: missing")}
    assert found(binning.binned(c, depths, records, None)) == {("b.1", "no lineage"), ("b2", "no lineage")}
    assert found(binning.binned(c, depths, records.limit(0), None)) == set()
    assert found(binning.binned(c, depths, records, clades.union(clades.limit(1)))) == {("b.1", "repeated lineage")}
    assert found(binning.assembled(frame(spark, [("c", "A"), ("c", "C")], "name string, sequence string"))) == {("c", "repeated contig")}


def test_loci_and_viruses_reach_their_bin_by_the_contig(spark):
    bins = frame(spark, [("c1", "b1"), ("c2", "b2")], "contig_id string, bin_id string")
    columns = "ordinal int, name string, model string, contig_name string, taxonomy string, taxonomy_domain string, reference_taxonomy string, blast_candidate_taxonomy string"
    loci = frame(spark, [(0, "l0", "RF01960", "c1", "t", "Eukaryota", "", ""), (1, "l1", "RF01960", "c1", "t", "Unclassified", "Eukaryota;x", ""), (2, "l2", "RF01960", "c2", "t", "Unclassified", "", "Eukaryota"), (3, "l3", "RF00177", "c1", "t", "Eukaryota", "", ""), (4, "l4", "RF01960", "c1", "t", "Bacteria", "x", "y"), (5, "l5", "RF01960", "c9", "t", "Eukaryota", "", "")], columns)
    assert sorted((r.bin_id, r.ordinal, r.item, r.record["name"]) for r in binning.linked_loci(loci, bins).collect()) == [("b1", 0, "l0@c1", "l0"), ("b1", 1, "l1@c1", "l1"), ("b2", 2, "l2@c2", "l2")]
    old = loci.drop("reference_taxonomy", "blast_candidate_taxonomy")
    assert [r.item for r in binning.linked_loci(old, bins).collect()] == ["l0@c1"]
    viruses = frame(spark, [(0, "c1", "0.9", "V"), (1, "c2|provirus_3_9", "0.8", "V"), (2, "c3", "0.7", "V")], "ordinal int, seq_name string, virus_score string, taxonomy string")
    assert sorted((r.bin_id, r.item) for r in binning.linked_viruses(viruses, bins).collect()) == [("b1", "c1"), ("b2", "c2|provirus_3_9")]
    assert [r.x for r in binning.classifiable(spark.range(998, 1002).select(F.col("id").alias("length_bp"), F.col("id").alias("x"))).collect()] == [1000, 1001]


def test_quality_tools_by_name(spark):
    table = frame(spark, [("b1.fa", "90", "1", "x")], "`Bin Id` string, Completeness string, Contamination string, `Marker lineage` string")
    assert binning.quality(" CheckM1 ", table).rows["qc"].first().completeness_percent == 90.0
    for args, says in ((("other", table), "unsupported quality tool"), (("checkm1", table, table), "only for CheckEUK"), (("symclatron", table), "Symclatron"), (("checkm1", table, None, (table,)), "Symclatron"), (("CheckEUK", table), "needs its detail")):
        with pytest.raises(ValueError, match=says):
            binning.quality(*args)


def test_inputs_of_the_eukaryotic_caller(spark):
    arts = frame(spark, [("s", "r", a, p, st) for a, p, st in (("bin.e1", "b/e1.fa", "binning"), ("bin.p1", "b/p1.fa", "binning"), ("protein_reference", "p.faa", None), ("m1", "m/e1.masked.fa", "repeat_masking"), ("m2", "m/e10.masked.fa", "repeat_masking"), ("a1", "a/e1.bam", "rna_alignment"), ("x", "e1.x", "else"))], "sample_id string, run_id string, artifact_id string, path string, producer_stage_id string")
    bins = frame(spark, [("s", "r", "e1", "eukaryotic_candidate"), ("s", "r", "p1", "viral_candidate")], "sample_id string, run_id string, bin_id string, candidate_class string")
    assert binning.braker_inputs(arts, bins, False).first().ids == ["a1", "m1", "m2", "protein_reference"]
    assert binning.braker_inputs(arts, bins, True).first().ids == ["a1", "bin.e1", "m1", "m2", "protein_reference"]
    assert binning.braker_inputs(arts, bins, True, "e1").first().ids == ["a1", "bin.e1", "m1", "protein_reference"]
    assert binning.braker_inputs(arts, bins, False, "p1").first().ids == ["protein_reference"]


SHEET = "sample_id\tplatform\treads\tassembly\trna_reads\trna_platform\tgenetic_code\tbasecaller\tsoftmasked\n"


def test_sample_sheets(spark, tmp_path):
    p = tmp_path / "s.tsv"
    (tmp_path / "r.fq").write_text("x")
    (tmp_path / "empty.fq").write_text("")
    p.write_text(SHEET + "s1\tONT\tr.fq\t\t\t\t\tdorado\t\n" + "s2\tPACBIO_HIFI\t/abs/r.fq\ta.fa\tempty.fq\tILLUMINA\t11\t\tm.fa\n")
    rows = samples.read(spark, str(p))
    got = {r.sample_id: r for r in rows.collect()}
    assert got["s1"].reads == f"{tmp_path}/r.fq" and got["s1"].assembly is None and got["s1"].genetic_code == "auto" and got["s2"].reads == "/abs/r.fq" and got["s2"].library_prep is None
    assert samples.problems(rows).collect() == []
    assert samples.missing_files(rows) == sorted(["/abs/r.fq", f"{tmp_path}/a.fa", f"{tmp_path}/empty.fq", f"{tmp_path}/m.fa"])
    p.write_text(SHEET + "-s\tont\tr.fq\t\t\t\t7\t\t\n" + "a\tPACBIO_HIFI\tr$.fq\t\tx\t\t\tb\tm.fa\n" + "a\tONT\tr.fq\t\tr.fq\tILLUMINA\t\t\t\n")
    assert {(r.sample_id, r.detail) for r in samples.problems(samples.read(spark, str(p))).collect()} == {
        ("-s", "sample_id: pattern"), ("-s", "platform: enum"), ("-s", "genetic_code: pattern"), ("a", "unsafe path"), ("a", "RNA reads and platform belong together"), ("a", "basecaller of another platform"), ("a", "a masked assembly needs its assembly"), ("a", "RNA reads are the DNA reads"), ("a", "repeated sample"),
    }
    p.write_text("sample_id\tplatform\treads\tother\n")
    with pytest.raises(ValueError, match="unsupported columns other"):
        samples.read(spark, str(p))
    p.write_text("sample_id\tplatform\n")
    with pytest.raises(ValueError, match="missing columns reads"):
        samples.read(spark, str(p))


def test_executions_belong_to_the_catalog(spark):
    from tessella.plans import report

    t = {"catalog_metadata": frame(spark, [("rev",)], "source_revision string"), "runs": frame(spark, [("s", "r")], "sample_id string, run_id string")}
    runs = frame(spark, [("s", "r", "rev"), ("s", "x", "rev"), ("s", "r", "other")], "sample_id string, run_id string, original_source_revision string")
    assert sorted(map(tuple, report.identity_problems(t, runs).collect())) == [("s", "r", "source revision differs"), ("s", "x", "run is not in the catalog")]
    t["catalog_metadata"] = t["catalog_metadata"].union(t["catalog_metadata"])
    assert report.identity_problems(t, runs.limit(1)).count() == 1
