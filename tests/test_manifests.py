import json

import pytest
from pyspark.sql import types as T

from tessella.plans import outputs
from tessella.sources import manifests as mf
from tessella.sources import routed, scratch
from tessella.sources import tables as src

GOOD = {"stage": "quality", "status": "completed", "tool": "nf", "tool_version": "1", "command": ["a", "b c"], "outputs": {"result": "x", "log": "y"}, "tools": {"checkm2": {"version": "2", "output": "q.tsv"}, "checkm1": {"version": "3", "output": "r.tsv", "status": "skipped"}}}


def write(path, *docs):
    for k, d in enumerate(docs):
        (path / f"m{k}.json").write_text(d if isinstance(d, str) else json.dumps(d))
    return str(path)


def changed(**values):
    return {k: v for k, v in (GOOD | values).items() if v != "drop"}


def test_stages_of_grouped_manifests(spark, tmp_path):
    alone = {"stage": "assembly", "status": "failed", "tool": "t", "tool_version": "1", "command": "run it", "reason": "broke"}
    both = {"stage": "functional_annotation", "status": "skipped", "tool": "t", "tool_version": "1", "command": "run", "reason": "no_called_proteins", "tools": {"eggnog": {"version": "5", "output": "e"}}}
    rows, bad = mf.manifests(spark, write(tmp_path, GOOD, alone, both))
    assert bad.collect() == []
    got = {r.stage: r for r in mf.stages(rows).collect()}
    assert set(got) == {"checkm2", "checkm1", "assembly", "functional_annotation", "eggnog"}
    r = got["checkm1"]
    assert (r.parent, r.status, r.tool_version, r.reason, r.outputs, json.loads(r.command)) == ("quality", "skipped", "3", "checkm1 had no applicable input in quality.", {"log": "y", "result": "r.tsv"}, ["a", "b c"])
    assert (got["checkm2"].status, got["checkm2"].reason, got["checkm2"].outputs["result"]) == ("completed", None, "q.tsv")
    assert (got["eggnog"].status, got["eggnog"].reason) == ("skipped", "no_called_proteins") and got["assembly"].command == "run it" and got["assembly"].parent is None


@pytest.mark.parametrize(
    ("document", "detail"),
    [
        ("{", "no JSON"), (changed(extra=1), "$.extra: unknown"), (changed(stage="drop"), "$.stage: missing"), (changed(tool=5), "$.tool: bigint"), (changed(status="done"), "unknown status: done"), (changed(outputs={"a": 1}), "$.outputs.*: bigint"),
        (changed(tools={"x": {"version": "1", "output": "o", "why": "?"}}), "$.tools.*.why: unknown"), (changed(tools={"x": {"version": "1"}}), "$.tools.*.output: missing"), (changed(tools={"x": {"version": "1", "output": "o", "status": "maybe"}}), "unknown status: maybe"),
        (changed(tools=[]), "$.tools: no object"), (changed(command="drop"), "$.command: missing"), (changed(command=7), "$.command: no text or list"), ("[]", "$: no object"), (changed(reason=True), "$.reason: boolean"), (changed(outputs={"a": None}), "$.outputs.*: missing"),
    ],
)
def test_manifests_are_strict_at_every_depth(spark, tmp_path, document, detail):
    _, bad = mf.manifests(spark, write(tmp_path, document, GOOD))
    found = {(r.path[-7:], r.detail) for r in bad.collect()}
    assert ("m0.json", detail) in found and {p for p, _ in found} == {"m0.json"}


def test_files_are_opened_once(spark, tmp_path):
    rows, bad = mf.manifests(spark, write(tmp_path, GOOD, changed(extra=1), "{"))
    for p in tmp_path.glob("m*.json"):
        p.unlink()
    assert {(r.path[-7:], r.detail) for r in bad.collect()} == {("m1.json", "$.extra: unknown"), ("m2.json", "no JSON")}
    assert sorted(r.stage for r in mf.stages(rows.where("path like '%m0.json'")).collect()) == ["checkm1", "checkm2"]


def test_manifest_files_are_dealt_to_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(outputs, "FOLDERS", 4)
    paths = iter(str(tmp_path / f"f{k}") for k in range(9))
    monkeypatch.setattr(scratch, "folder", lambda _: next(paths))
    # equal keys are two manifests as well
    rows = [(k, f"n{k}") for k in range(1, 21)] + [(7, "again")]
    spark.createDataFrame(rows, "s_suppkey long, s_name string").write.parquet(str(tmp_path / "supplier.parquet"))
    got = outputs.stage_manifests(spark, str(tmp_path)).collect()
    assert sorted((r.parent, r.stage, r.log) for r in got) == sorted((f"g{k}", t, n) for k, n in rows for t in ("alpha", "beta"))
    made = [p for p in (tmp_path / "f0").rglob("part-*")]
    assert len(made) == len(rows) and len({p.parent for p in made}) == 4


SCHEMA = T.StructType([
    T.StructField("schema_version", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("bins", T.ArrayType(T.StructType().add("bin_id", "string").add("n", "long").add("keys", T.ArrayType(T.StringType())))),
    T.StructField("genes", T.ArrayType(T.StructType().add("gene_id", "string").add("score", "double"))),
    T.StructField("none", T.ArrayType(T.StructType().add("x", "string"))),
])


def test_bundles_go_out_and_come_back(spark, tmp_path):
    bins = [(f"b{k:03d}", k if k % 3 else None, ["x", "y"] if k % 2 else []) for k in range(50)] + [("a", 1, None), ("a", 1, None), ("a", 2, None)]
    genes = [(f"g{k}", k / 7) for k in range(20)] + [('q"\n,é', 1e-20)]
    t = {"bins": spark.createDataFrame(bins, "bin_id string, n long, keys array<string>").repartition(4), "genes": spark.createDataFrame(genes, "gene_id string, score double").repartition(3), "none": spark.createDataFrame([], "x string")}
    path = f"{tmp_path}/bundle.json"
    keys = {"bins": ["bin_id"], "genes": ["gene_id"], "none": ["x"]}
    for _ in range(2):  # the second time over the first
        mf.write_bundle(t, {"schema_version": "1", "source": 'a"b'}, keys, path)
    whole = json.load(open(path, encoding="utf-8"))
    assert [b["bin_id"] for b in whole["bins"]] == sorted(b[0] for b in bins) and whole["source"] == 'a"b' and whole["none"] == []
    back = src.collections(src.bundle(spark, path, SCHEMA))
    assert sorted(map(tuple, back["bins"].collect()), key=str) == sorted(bins, key=str) and sorted(map(tuple, back["genes"].collect())) == sorted(genes) and back["none"].count() == 0
    first = open(path, "rb").read()
    mf.write_bundle({n: back[n] for n in t}, {"schema_version": "1", "source": 'a"b'}, keys, path)
    assert open(path, "rb").read() == first


def test_routed_folders_go_out_and_come_back(spark, tmp_path):
    rows = [("eukaryotic_candidate", "bin 1", k, f"c{k}", "ACGT" * (20 + k), f"p{k}", 1, 4 * (20 + k)) for k in range(9, -1, -1)] + [("viral_candidate", "v=2+ %3D", 0, "x", "AC", "px", 5, 6)]
    records = spark.createDataFrame(rows, "route string, bin_id string, ordinal int, name string, sequence string, parent_contig string, start long, end long").repartition(4)
    path = f"{tmp_path}/staged"
    routed.write(records, path)
    files = [p for p in (tmp_path / "staged/sequences").rglob("part-*") if not p.name.endswith(".crc")]
    assert len(files) == 2
    headers = [line for line in max(files, key=lambda p: p.stat().st_size).read_text().split("\n") if line.startswith(">")]
    assert headers == [f">c{k}" for k in range(10)]
    back, s, o = routed.read(spark, path), routed.sources(spark, path), routed.origins(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted((r, b, n, q) for r, b, _, n, q, *_ in rows)
    assert sorted(map(tuple, s.collect())) == [("eukaryotic_candidate", "bin 1", 10, sum(4 * (20 + k) for k in range(10))), ("viral_candidate", "v=2+ %3D", 1, 2)] and o.count() == 11
    assert routed.problems(back, s, o).collect() == []
    moved = back.union(spark.createDataFrame([("viral_candidate", "v=2+ %3D", "c3", "A")], back.schema))
    assert {r.detail for r in routed.problems(moved, s, o).collect()} == {"in more than one folder", "no origin", "totals differ from the sources"}
    assert {r.detail for r in routed.problems(back.where("name <> 'x'"), s, o).collect()} == {"not staged", "totals differ from the sources"}


@pytest.mark.parametrize("layout", ["lines", "pretty", "flat"])
def test_bundles_are_read_in_splits(spark, tmp_path, monkeypatch, layout):
    bins = [(f"b{k:03d}", k if k % 3 else None, ["], {", "y"] if k % 2 else []) for k in range(80)]
    t = {"bins": spark.createDataFrame(bins, "bin_id string, n long, keys array<string>"), "genes": spark.createDataFrame([('"genes": [', 0.5)], "gene_id string, score double"), "none": spark.createDataFrame([], "x string")}
    path = tmp_path / "bundle.json"
    mf.write_bundle(t, {"schema_version": "1", "source": "a"}, {"bins": ["bin_id"], "genes": ["gene_id"], "none": ["x"]}, str(path))
    if layout == "lines":
        # a whole document of more than 128 MB is no value that Spark parses; here none is parsed as a whole
        monkeypatch.setattr(src, "bundle", None)
    else:
        (tmp_path / ".bundle.json.crc").unlink(missing_ok=True)
        path.write_text(json.dumps(json.loads(path.read_text()), indent=1 if layout == "pretty" else None))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in old:
        spark.conf.set(k, "700")
    try:
        back = src.bundle_tables(spark, str(path), SCHEMA)
        assert sorted(map(tuple, back["bins"].collect()), key=str) == sorted(bins, key=str) and list(map(tuple, back["genes"].collect())) == [('"genes": [', 0.5)] and back["none"].count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize(("old", "new", "says"), [('"n":1', '"n":"1"', "MALFORMED|Malformed|malformed"), ('"n":1', '"m":1', "unknown fields: m"), ('"source"', '"sauce"', "unknown fields: sauce"), (',{"bin_id":"b1"', '{"bin_id":"b1"', "MALFORMED|Malformed|malformed"), ('\n}', '', "MALFORMED|Malformed|malformed")])
def test_bundles_in_splits_are_strict(spark, tmp_path, old, new, says):
    t = {"bins": spark.createDataFrame([("b0", 0), ("b1", 1)], "bin_id string, n long"), "genes": spark.createDataFrame([("g", 0.5)], "gene_id string, score double")}
    path = tmp_path / "bundle.json"
    mf.write_bundle(t, {"schema_version": "1", "source": "a"}, {"bins": ["bin_id"], "genes": ["gene_id"]}, str(path))
    assert old in path.read_text()
    path.write_text(path.read_text().replace(old, new))
    (tmp_path / ".bundle.json.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match=says):
        src.bundle_tables(spark, str(path), SCHEMA)["bins"].collect()
