import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.functions import text
from tessella.sources import sinks
from tessella.sources import tables as src


def test_native_table(spark, tmp_path):
    p = tmp_path / "t.tsv"
    p.write_text('#name\tvalue\tnote\nx\t1.5\t"a ""b"""\ny\t\tNA\n')
    rows = {r.name: r for r in src.read_table(spark, str(p), ["name", "value"], hash_header=True).collect()}
    assert rows["x"].note == 'a "b"' and rows["y"].value == ""
    with pytest.raises(ValueError, match="missing columns other"):
        src.read_table(spark, str(p), ["other"])
    p.write_text("a\tb\n1\n")
    assert src.ragged_rows(spark, str(p)).count() == 1
    with pytest.raises(Exception, match="(?i)malformed|token"):
        src.read_table(spark, str(p)).collect()
    p.write_text("a\ta\n")
    with pytest.raises(ValueError, match="repeated column"):
        src.read_table(spark, str(p))


def test_fasta(spark, tmp_path):
    p = tmp_path / "bin.1.fa"
    p.write_text(">c1 a > b\nACGT\nNN gg\n>c2\nTT\n")
    rows = {r.name: r for r in src.fasta(spark, str(p)).collect()}
    assert rows["c1"].sequence == "ACGTNNgg" and rows["c1"].header == "c1 a > b" and rows["c2"].sequence == "TT"
    lengths = {r.contig_id: (r.bin_id, r.length_bp, r.gc_bp) for r in src.contig_lengths(src.fasta(spark, str(p))).collect()}
    assert lengths == {"c1": ("bin.1", 8, 4), "c2": ("bin.1", 2, 0)}
    p.write_text(">c1\n>c2\nTT\n")
    with pytest.raises(Exception, match="no sequence"):
        src.fasta(spark, str(p)).collect()
    sinks.write_fasta(spark.createDataFrame([("c", "A" * 130)], "name string, sequence string"), f"{tmp_path}/out")
    lines = [r.value for r in spark.read.text(f"{tmp_path}/out").collect()]
    assert [len(x) for x in lines] == [2, 60, 60, 10]


def test_gff(spark, tmp_path):
    p = tmp_path / "g.gff"
    p.write_text("##gff-version 3\n# Model Data: x;transl_table=11;y\nc\ts\tCDS\t1\t9\t.\t+\t0\tID=a%2Bb+c;n=1\n# Model Data: transl_table=4\nc\ts\tCDS\t2\t8\t.\t?\t.\tID=z\n##FASTA\n>c\nbad line\n")
    rows = {r.attributes["ID"]: r for r in src.gff(spark, str(p)).collect()}
    assert rows["a+b+c"].transl_table == 11 and rows["a+b+c"].phase == 0 and rows["z"].transl_table == 4 and rows["z"].strand == "unknown" and len(rows) == 2


GFF_LINE = "c{k}\ts\t{f}\t{a}\t{b}\t.\t+\t0\tID=f{k}\n"


@pytest.mark.parametrize("size", ["20", "150", "128m"])
def test_gff_hands_code_and_end_mark_from_split_to_split(spark, tmp_path, size):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    want, body, code = [], "##gff-version 3\n", None
    for k in range(40):
        if k % 9 == 4:
            code = 11 + k
            body += f"# Model Data: version=x;transl_table={code};y=1\n"
        if k == 30:
            code = None
            body += "# Model Data: none\n"
        body += "\n" if k % 7 == 0 else "# note\n" if k % 5 == 0 else ""
        want.append((f"f{k}", body.count("\n"), code))
        body += GFF_LINE.format(k=k, f="CDS", a=k + 1, b=k + 9)
    (tmp_path / "a.gff").write_text(body + "##FASTA here\n>c\nno feature\n# Model Data: transl_table=5\n" + GFF_LINE.format(k=99, f="CDS", a=1, b=2))
    (tmp_path / "b.gff").write_text(GFF_LINE.format(k=7, f="gene", a=1, b=2))
    for k in old:
        spark.conf.set(k, size)
    rows = src.gff(spark, str(tmp_path))
    got = sorted((r.path[-5], r.attributes["ID"], r.line, r.transl_table) for r in rows.collect())
    counts = sorted((r.path[-5], r.feature, r.n) for r in src.feature_counts(rows).collect())
    for k, v in old.items():
        spark.conf.set(k, v)
    assert got == sorted([("a", *w) for w in want] + [("b", "f7", 0, None)])
    assert counts == [("a", "CDS", 40), ("b", "gene", 1)]


@pytest.mark.parametrize(("line", "says"), [("c\ts\tCDS\t9\t1\t.\t+\t0\tID=a", "end before start in line 2"), ("c\ts\tCDS\t1\t9\t.\tx\t0\tID=a", "bad strand"), ("c\ts\tCDS\t1\t9\t.\t+\t3\tID=a", "bad phase"), ("c\ts\tCDS\t0\t9\t.\t+\t0\tID=a", "bad coordinate"), ("c\ts\tCDS", "not nine columns")])
def test_broken_features_raise(spark, tmp_path, line, says):
    (tmp_path / "a.gff").write_text(f"##gff-version 3\n{line}\n")
    with pytest.raises(Exception, match=says):
        src.gff(spark, str(tmp_path / "a.gff")).collect()


def test_cells(spark):
    cells = ["", " NA ", "1_0", "1.0d", "0x1p3", "1e400", "nan", "-2.5", " 7 ", "12"]
    got = spark.createDataFrame([(c,) for c in cells], "c string").select(text.number(F.col("c")).alias("x"), text.whole(F.col("c")).alias("w"), text.is_bad_number(F.col("c"), least=0.0).alias("bad")).collect()
    assert [r.x for r in got] == [None] * 7 + [-2.5, 7.0, 12.0]
    assert [r.w for r in got] == [None] * 8 + [7, 12]
    assert [r.bad for r in got] == [False, False, True, True, True, True, False, True, False, False]


def test_names_and_formats(spark):
    c = F.lit
    row = spark.range(1).select(
        text.bin_name(c("a/bin.1.fa")).alias("a"), text.target_name(c("x/B.FAA")).alias("b"), text.path_name(c("p/q.fna.gz")).alias("c"), text.stem(c("d/bin.1")).alias("d"), text.safe_component(c("a b")).alias("e"),
        text.fixed(c(0.03125), 4).alias("f"), text.fixed(c(2.675), 2).alias("g"), text.unquoted(c("a%20b+c")).alias("h"), text.unquoted(c("a%zz")).alias("i"), text.stripped(c("  x\n")).alias("j"),
    ).first()
    assert (row.a, row.b, row.c, row.d) == ("bin.1", "B", "q", "bin")
    assert row.e.startswith("a_b-") and len(row.e) == 14
    assert (row.f, row.g, row.h, row.i, row.j) == ("0.0312", "2.67", "a b+c", "a%zz", "x")


def test_canonical_documents(spark):
    got = sinks.canonical(spark.createDataFrame([(1, '{"b": 1e-20, "a": [1, "é"]}')], "k int, document string")).first()
    assert got.canonical == '{"a":[1,"é"],"b":1e-20}' and len(got.sha256) == 64


def test_stage_lists(spark):
    stages = spark.createDataFrame([("s", "r", "x", ["a", "b"], ["bins:b:1"])], "sample_id string, run_id string, stage_id string, input_artifact_ids array<string>, expected_result_keys array<string>")
    inputs, expected = src.stage_lists(stages)
    assert sorted((r.position, r.artifact_id) for r in inputs.collect()) == [(0, "a"), (1, "b")]
    assert [(r.collection, r.record_id) for r in expected.collect()] == [("bins", "b:1")]


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("x\ty\n1\t2\n")
    (tmp_path / "b.tsv").write_text("y\tx\tz\n10\t20\t30\n")
    rows = src.read_table(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")], required=["x", "y"])
    assert sorted((r.x, r.y, r.z) for r in rows.collect()) == [("1", "2", ""), ("20", "10", "30")]
    with pytest.raises(ValueError, match="missing columns y"):
        (tmp_path / "c.tsv").write_text("x\n1\n")
        src.read_table(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "c.tsv")], required=["x", "y"])


def test_bundle_refuses_unknown_fields(spark, tmp_path):
    schema = T.StructType().add("schema_version", "string").add("bins", T.ArrayType(T.StructType().add("bin_id", "string")))
    good = tmp_path / "good.json"
    good.write_text('{"schema_version": "1", "bins": [{"bin_id": "a"}]}')
    assert src.collections(src.bundle(spark, str(good), schema))["bins"].first().bin_id == "a"
    for text in ('{"schema_version": "1", "bins": [], "other": 1}', '{"schema_version": "1", "bins": [{"bin_id": "a"}, {"bin_id": "b", "x": {}}]}'):
        (tmp_path / "bad.json").write_text(text)
        with pytest.raises(ValueError, match="unknown fields: (other|x)"):
            src.bundle(spark, str(tmp_path / "bad.json"), schema)
