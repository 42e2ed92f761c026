import pytest
from pyspark.sql import functions as F

from tessella.operators import collect, routing
from tessella.sources import sinks
from tessella.sources import tables as src

EGGNOG = "`#query` string, Description string, evalue string, score string, eggNOG_OGs string, GOs string, EC string, KEGG_ko string"


def eggnog(spark, *changes):
    names = ["#query", "Description", "evalue", "score", "eggNOG_OGs", "GOs", "EC", "KEGG_ko"]
    good = dict(zip(names, ["g1", "d", "1e-5", "50", "O1@1|root, O2@2", "GO:0000001,GO:0000001", "1.2.-.-", "ko:K00001"]))
    return spark.createDataFrame([tuple((good | c)[n] for n in names) for c in changes], EGGNOG)


def proteins(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def test_terms_keep_group_and_taxon(spark):
    rows, clash = collect.annotation_rows(collect.eggnog(eggnog(spark, {}), "5"))
    got = {(r.database_name, r.accession, r.function_name) for r in rows.collect()}
    assert got == {("eggNOG", "O1@1", "d"), ("eggNOG", "O2@2", "d"), ("Gene Ontology via eggNOG", "GO:0000001", None), ("Enzyme Commission via eggNOG", "1.2.-.-", None), ("KEGG Orthology via eggNOG", "ko:K00001", None)}
    assert clash.count() == 0
    assert [r.accession for r in collect.in_order(rows).collect()] == ["1.2.-.-", "GO:0000001", "ko:K00001", "O1@1", "O2@2"]


@pytest.mark.parametrize(
    ("change", "detail"),
    [
        ({"#query": "zz"}, "unknown protein"), ({"score": "x"}, "score"), ({"evalue": "nan"}, "evalue"), ({"evalue": "-1"}, "negative evalue"), ({"eggNOG_OGs": "O1"}, "invalid eggNOG_OGs"), ({"eggNOG_OGs": "O1@1| "}, "invalid eggNOG_OGs"), ({"eggNOG_OGs": "O1@1|a|b"}, "invalid eggNOG_OGs"),
        ({"GOs": "GO:1"}, "invalid GOs"), ({"GOs": "GO:0000001,"}, "invalid GOs"), ({"EC": "1.2"}, "invalid EC"), ({"KEGG_ko": "K00001"}, "invalid KEGG_ko"),
    ],
)
def test_malformed_orthology_rows(spark, change, detail):
    assert {(r.gene_id, r.detail) for r in collect.eggnog_problems(eggnog(spark, {"#query": "g2"}, change), proteins(spark, "g1", "g2")).collect()} == {(change.get("#query", "g1"), detail)}


def test_repeated_queries_and_missing_cells(spark):
    none = {c: "-" for c in ("evalue", "score", "eggNOG_OGs", "GOs", "EC", "KEGG_ko")}
    assert collect.eggnog_problems(eggnog(spark, none, {"#query": "g2"}), proteins(spark, "g1", "g2")).collect() == []
    assert {r.detail for r in collect.eggnog_problems(eggnog(spark, none, {}), proteins(spark, "g1")).collect()} == {"repeated query"}


@pytest.mark.parametrize(("change", "detail"), [({"stop": "101"}, "coordinates"), ({"start": "9", "stop": "8"}, "coordinates"), ({"start": "0"}, "coordinates"), ({"status": "F"}, "status"), ({"score": "inf"}, "score"), ({"entry": "IPR1"}, "invalid entry"), ({"analysis": "-"}, "no analysis"), ({"signature": ""}, "no signature"), ({"length": "99"}, "protein length changes"), ({"protein": "zz"}, "unknown protein")])
def test_malformed_domain_rows(spark, change, detail):
    names = ["protein", "length", "analysis", "signature", "start", "stop", "score", "status", "entry"]
    good = dict(zip(names, ["g1", "100", "Pfam", "PF1", "1", "90", "-", "T", "IPR000001"]))
    table = spark.createDataFrame([tuple((good | c)[n] for n in names) for c in ({}, change)], ", ".join(f"{n} string" for n in names))
    assert {r.detail for r in collect.interpro_problems(table, proteins(spark, "g1")).collect()} == {detail}


def test_orthology_tables_have_one_header(spark, tmp_path):
    p = tmp_path / "a"
    head, row = "\t".join(src.EGGNOG), "\t".join(f"v{k}" for k in range(21))
    p.write_text(f"## made\n{head}\n\n{row}\n## done\n")
    got = src.eggnog(spark, str(p)).collect()
    assert len(got) == 1 and got[0]["#query"] == "v0" and got[0].PFAMs == "v20"
    p.write_text(f"{head}\tmd5\n{row}\tx\n")
    assert src.eggnog(spark, str(p)).first().md5 == "x"
    for text in (row, head.replace("EC", "E C"), f"{head}\tother", ""):
        p.write_text(text + "\n")
        with pytest.raises(ValueError, match="unexpected eggNOG header"):
            src.eggnog(spark, str(p))
    for text, says in ((f"{head}\n# note\n", "unexpected comment"), (f"{head}\na\tb\n", "malformed row")):
        p.write_text(text)
        with pytest.raises(Exception, match=says):
            src.eggnog(spark, str(p)).collect()


def test_pending_lists_and_empty_sequence_files(spark, tmp_path):
    p = tmp_path / "pending.txt"
    p.write_text("b1\n# note\n\nb2\nb1\n")
    rows, twice = src.pending(spark, str(p))
    assert sorted(r.bin_id for r in rows.collect()) == ["b1", "b2"] and [tuple(r) for r in twice.collect()] == [("b1", 2)]
    (tmp_path / "e.faa").write_text("\n")
    assert src.fasta(spark, str(tmp_path / "e.faa")).collect() == []
    with pytest.raises(ValueError, match="no sequences"):
        src.fasta(spark, str(tmp_path / "e.faa"), allow_empty=False)


def test_the_ledger_of_no_bins_has_its_header(spark, tmp_path):
    none = spark.createDataFrame([], ", ".join(f"{c} string" for c in routing.LEDGER))
    sinks.write_table(none, f"{tmp_path}/ledger", routing.LEDGER)
    assert src.read_table(spark, f"{tmp_path}/ledger", routing.LEDGER).columns == routing.LEDGER
    assert src.read_table(spark, f"{tmp_path}/ledger").where(F.lit(True)).count() == 0
