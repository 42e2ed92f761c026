from tessella.operators import genes
from tessella.sources import tables as src


def problems(p):
    return {(r.target, r.detail) for r in p.problems.collect()}


def test_prodigal_genes_agree_with_their_proteins(spark, tmp_path):
    g, f = tmp_path / "g.gff", tmp_path / "p.faa"
    g.write_text("##gff-version 3\n# Model Data: m;transl_table=11;x\nc1\tP\tCDS\t1\t9\t.\t+\t0\tID=1_1;genetic_code=11\nc1\tP\tCDS\t20\t40\t.\t-\t0\tID=1_2;genetic_code=11\n")
    f.write_text(">c1_1 # 1 # 9 # 1 # ID=1_1;genetic_code=11\nMKV*\n>c1_2 # 20 # 40 # -1 # ID=1_2;genetic_code=11\nMK\n")
    p = genes.prodigal(src.gff(spark, str(g)), src.fasta(spark, str(f)), "src", None, 11)
    assert problems(p) == set()
    assert sorted((r.gene_id, r.start, r.end, r.strand) for r in p.rows["genes"].collect()) == [("prodigal-gv:src:c1_1", 1, 9, "plus"), ("prodigal-gv:src:c1_2", 20, 40, "minus")]
    f.write_text(">c1_1 # 1 # 8 # 1 # ID=1_1;genetic_code=11\nMKV\n>c9_3 # 1 # 2 # 1 # ID=1_3;genetic_code=11\nM\n")
    assert problems(genes.prodigal(src.gff(spark, str(g)), src.fasta(spark, str(f)), "src", None, 4)) >= {("1_1", "header disagrees with its feature"), ("1_2", "features and proteins differ"), ("1_3", "features and proteins differ"), ("1_1", "code differs from the required one")}


def test_transcripts_and_merged_proteins(spark, tmp_path):
    g, f = tmp_path / "b.gff3", tmp_path / "b.faa"
    g.write_text("c\tA\tgene\t1\t90\t.\t-\t.\tID=g1\nc\tA\tmRNA\t1\t90\t.\t-\t.\tID=g1.t1;Parent=g1\nc\tA\tCDS\t1\t30\t.\t-\t2\tParent=g1.t1\nc\tA\tCDS\t60\t90\t.\t-\t0\tParent=g1.t1\n")
    f.write_text(">g1.t1\nMKV*\n")
    p = genes.braker(src.gff(spark, str(g)), src.fasta(spark, str(f)), "s 1", "b.1", 1)
    assert problems(p) == set()
    row = p.rows["genes"].first()
    assert row.phase == 0 and row.strand == "minus" and row.gene_id.startswith("braker3:s_1-") and row.gene_id.endswith(":b.1:g1.t1")
    merged = genes.merged_proteins([(src.fasta(spark, str(f)), "braker3", "s", "b")])
    assert problems(merged) == set() and merged.rows["proteins"].first().sequence == "MKV" and merged.rows["mapping"].first().native_gene_id == "g1"
    g.write_text("c\tA\tgene\t1\t80\t.\t-\t.\tID=g1\nc\tA\tmRNA\t1\t90\t.\t-\t.\tID=g1.t1;Parent=g1\nc\tA\tCDS\t60\t95\t.\t-\t.\tParent=g1.t1\n")
    f.write_text(">g1.t1\nM*V\n>g2.t1\nM\n")
    found = problems(genes.braker(src.gff(spark, str(g)), src.fasta(spark, str(f)), "s", "b", 1))
    assert {d for _, d in found} == {"transcript outside its gene", "coding part outside its transcript", "coding part without a phase", "transcripts and proteins differ"}
    assert {d for _, d in problems(genes.merged_proteins([(src.fasta(spark, str(f)), "braker3", "s", "b")]))} == {"stop inside the protein"}


def test_viral_candidates(spark):
    summary = spark.createDataFrame([("c1", "8", "Linear", "NA"), ("c2|provirus_3_6", "4", "Provirus", "3-6"), ("c2|provirus_6_7", "2", "Provirus", "6-7"), ("c3", "3", "Linear", "")], "seq_name string, length string, topology string, coordinates string")
    sequences = spark.createDataFrame([("c1", "A" * 8), ("c2|provirus_3_6", "ACGT"), ("c2|provirus_6_7", "AC"), ("c3", "ACG")], "name string, sequence string")
    routes = spark.createDataFrame([("c1", "viral", "b"), ("c2", "unresolved", "u")], "contig_id string, route string, bin_id string")
    p = genes.viral_candidates(summary, sequences, routes)
    rows = {r.native_id: r for r in p.rows["candidates"].collect()}
    assert rows["c1"].status == "excluded" and rows["c2|provirus_3_6"].reason.startswith("unresolved") and rows["c3"].reason.startswith("unbinned")
    assert rows["c2|provirus_3_6"].contig_id.startswith("genomad_c2_3_6_")
    assert problems(p) == {("c2|provirus_6_7", "candidates overlap")}
