import hashlib
import json

from test_integrity import SCHEMAS, tables, valid

from tessella.operators import collect
from tessella.plans import export

READS = "sample_id string, run_id string, contig_id string, numreads long, covbases long, startpos long, endpos long"


def catalog(spark, command="samtools view -F 2308 -q 20 x; samtools coverage y"):
    rows = valid()
    for k, r in enumerate(rows["contigs"]):
        rows["contigs"][k] = (*r[:-1], "art_asm")
    rows["read_stats"] = [("s", "r", "read_qc", "art_reads", "r1", 100, 80, 20, 1, 1, 0)]
    rows["stages"].append(("s", "r", "binning", "binning", "completed", None, None, "t", "1", command, None, None, None))
    return tables(spark, rows)


def document(spark, t, reads):
    return json.loads(export.documents(t, spark.createDataFrame(reads, READS)).first().canonical)


def test_conserved_counts_and_digest(spark):
    t = catalog(spark)
    reads = [("s", "r", "c1", 30, 9, 1, 100), ("s", "r", "c2", 20, 9, 1, 50)]
    got = document(spark, t, reads)
    m = got["mapping"]
    assert (m["status"], m["assembly_mapped_reads"], m["bin_mapped_reads"], m["unbinned_mapped_reads"], m["without_qualifying_alignment_reads"]) == ("available", 50, 30, 20, 30)
    assert got["inventory_status"] == "complete" and [c["contig_id"] for c in got["contigs"]] == ["c1", "c2"] and got["qc"][0]["tool_name"] == "CheckEUK"
    frame = spark.createDataFrame(reads, READS)
    assert export.documents(t, frame).first().sha256 == export.documents(t, frame).first().sha256
    assert export.coverage_problems(frame, t["contigs"]).count() == 0
    assert export.coverage_problems(spark.createDataFrame([("s", "r", "c1", 1, 1, 1, 99), ("s", "r", "zz", 1, 1, 1, 9)], READS), t["contigs"]).count() == 3


def test_unknown_is_null_not_zero(spark):
    m = document(spark, catalog(spark), [("s", "r", "c1", 30, 9, 1, 100)])["mapping"]
    assert (m["status"], m["status_reason"], m["assembly_mapped_reads"]) == ("unavailable", "coverage_artifact_unavailable", None)
    m = document(spark, catalog(spark, "samtools view -q 20 x"), [("s", "r", "c1", 30, 9, 1, 100), ("s", "r", "c2", 20, 9, 1, 50)])["mapping"]
    assert m["status_reason"] == "primary_alignment_policy_unavailable"


def test_collection(spark):
    t = tables(spark, valid())
    keys = {r.stage_id: r.expected_result_keys for r in collect.expected_keys(t).collect()}
    assert keys["asm"] == ["assemblies:a1", "contigs:c1", "contigs:c2"]
    assert {r.stage_id for r in collect.skipped_stages(spark, t["stages"], ["asm", "busco"], "core mode").collect()} == {"busco"}
    decided = spark.createDataFrame([("s", "r", "b1", "viral_candidate")], "sample_id string, run_id string, bin_id string, candidate_class string")
    assert collect.with_routes(t["bins"], decided).first().candidate_class == "viral_candidate"
    arts = spark.createDataFrame([("s", "r", "bin.b1", "bin_fasta", "x/b1.fa", "d", 1, "bin"), ("s", "r", "genomad.viral_fasta", "viral_fasta", "v.fa", "d", 1, "v"), ("s", "r", "bin.b2", "bin_fasta", "x/b2.fa", "d", 1, "bin")], SCHEMAS["artifacts"])
    assert collect.stage_inputs("prodigal_gv", arts, t["bins"]).first().ids == ["bin.b1", "genomad.viral_fasta"]
    assert collect.stage_inputs("checkv", arts, t["bins"]).first().ids == ["genomad.viral_fasta"]
    assert collect.stage_inputs("assembly", arts, t["bins"]).first().ids == ["filtered_reads"]
    one = lambda *k: spark.createDataFrame([(x,) for x in k], "bin_id string")
    assert {(r.bin_id, r.detail) for r in collect.child_cover(one("a", "b"), one("b"), one("a", "b", "c")).collect()} == {("b", "completed and pending"), ("c", "neither")}


def test_annotations(spark):
    columns = ["#query", "Description", "evalue", "score", "eggNOG_OGs", "GOs", "EC", "KEGG_ko"]
    table = spark.createDataFrame([("g1", "-", "1e-5", "50", "O1@1|root,O2@2", "GO:1,GO:1", "-", "ko:K1")], ", ".join(f"`{c}` string" for c in columns))
    rows, clash = collect.annotation_rows(collect.eggnog(table, "5"))
    assert sorted(r.accession for r in rows.collect()) == ["GO:1", "O1@1", "O2@2", "ko:K1"] and clash.count() == 0
    names = ["protein", "analysis", "signature", "entry", "signature_name", "entry_name", "start", "stop", "score"]
    table = spark.createDataFrame([("g1", "Pfam", "PF1", "IPR1", "a", "b", "1", "9", "2.5"), ("g1", "Pfam", "PF2", "-", "-", "-", "2", "8", "-")], ", ".join(f"{c} string" for c in names))
    got = {(r.database_name, r.accession, r.function_name, r.score) for r in collect.interpro(table, "1").collect()}
    assert got == {("InterProScan:Pfam", "PF1", "a", 2.5), ("InterPro", "IPR1", "b", None), ("InterProScan:Pfam", "PF2", None, None)}
    identity = "\x1f".join(("interproscan", "g1", "InterPro", "IPR1", "1", "9"))
    rows, _ = collect.annotation_rows(collect.interpro(table, "1"))
    assert "ann:interproscan:" + hashlib.sha256(identity.encode()).hexdigest() in {r.annotation_id for r in rows.collect()}
