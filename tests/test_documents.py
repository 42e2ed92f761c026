import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F
from test_export import READS, catalog

from tessella.plans import evidence, export
from tessella.sources import documents as doc


def text_of(parts, keys):
    texts = {}
    for r in sorted(parts.collect(), key=lambda r: r.part):
        texts.setdefault(tuple(r[k] for k in keys), []).append(r)
    out = {}
    for key, rows in texts.items():
        text = "".join(r.text for r in rows)
        assert [r.sha256 for r in rows[:-1]] == [None] * (len(rows) - 1) and rows[-1].sha256 == hashlib.sha256(text.encode()).hexdigest() and rows[-1].size_bytes == len(text.encode())
        out[key] = text
    return out


def test_encoder_writes_what_dumps_writes():
    draw = random.Random(2)

    def thing(depth):
        kind = draw.choice(["v", "l", "o"]) if depth else "o"
        if kind == "v":
            return draw.choice([None, 1, 2.5, 1e-20, "é\"\n", True, {"z": 1, "a": [1, {"q": None}]}])
        if kind == "l":
            return [draw.choice([1, "x", {"b": 1, "a": 2}]) for _ in range(draw.randint(0, 3))]
        return {draw.choice("abcdeéZ_") + str(k): thing(depth + 1 if depth < 3 else 0) if depth < 3 else 1 for k in range(draw.randint(1, 4))}

    def pieces(x, path):
        if isinstance(x, dict) and path != [] and draw.random() < 0.3:
            yield path, doc.VALUE, 0, x
        elif isinstance(x, dict):
            for k, v in x.items():
                yield from pieces(v, [*path, k])
        elif isinstance(x, list):
            yield path, doc.LIST, 0, None
            for n, v in enumerate(x):
                yield path, doc.ITEM, n, v
        else:
            yield path, doc.VALUE, 0, x

    for _ in range(200):
        x = thing(0)
        encoder, out = doc.Encoder(), ""
        for path, kind, _, v in sorted(pieces(x, []), key=lambda p: p[:3]):
            out += encoder.add(path, kind, json.dumps(v))
        assert out + encoder.end() == json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    encoder = doc.Encoder()
    encoder.add(["a"], doc.VALUE, "1")
    for path in (["a"], ["a", "b"]):
        with pytest.raises(ValueError):
            encoder.add(path, doc.VALUE, "1")


@pytest.mark.parametrize("part", [7, 1 << 20])
def test_streamed_documents_equal_gathered_ones(spark, part):
    t = catalog(spark)
    reads = spark.createDataFrame([("s", "r", "c1", 30, 9, 1, 100), ("s", "r", "c2", 20, 9, 1, 50)], READS)
    want = export.documents(t, reads).first()
    parts = doc.streamed(export.pieces(t, reads), export.SCOPE, part)
    got = text_of(parts, export.SCOPE)
    empty = {k: v for k, v in json.loads(want.canonical).items()}
    mine = json.loads(got[("s", "r", "a1")])
    assert {k: v for k, v in mine.items() if v != []} == {k: v for k, v in empty.items() if v is not None or mine[k] is None}
    assert got[("s", "r", "a1")] == json.dumps(mine, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    full = {k: [] if v is None and isinstance(mine[k], list) else v for k, v in empty.items()}
    assert hashlib.sha256(json.dumps(full, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest() == parts.where("sha256 is not null").first().sha256
    assert "collect_list" not in parts._jdf.queryExecution().optimizedPlan().toString().split("scope_assembly")[0]


def test_written_documents_and_their_index(spark, tmp_path):
    rows = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "k string, v int")
    parts = doc.streamed([doc.value(rows.select("k").distinct(), ["k"], ["k"], F.col("k")), doc.items(rows, ["k"], ["list"], ["v"])], ["k"], part=10)
    doc.write(parts, ["k"], f"{tmp_path}/out")
    index = {r.k: r for r in spark.read.json(f"{tmp_path}/out/index").collect()}
    lines = [r.value for r in spark.read.text(f"{tmp_path}/out/documents/bundle_id={index['x'].bundle_id}").collect()]
    assert json.loads("\n".join(lines)) == {"k": "x", "list": [{"v": 1}, {"v": 2}]} and hashlib.sha256("".join(lines).encode()).hexdigest() == index["x"].sha256


def sha(b):
    return hashlib.sha256(b).hexdigest()


def evident(spark, tmp_path, status="completed", changed=False):
    t = catalog(spark)
    quality, twice, lost = b"Name\tScore\nb1.fa\t9\nother\t1\n", b"Bin Id\tx\nb1\t1\n", b"none"
    for name, b in (("q.tsv", quality), ("m1.tsv", twice), ("m2.tsv", twice)):
        (tmp_path / name).write_bytes(b + (b"more\n" if changed else b""))
    paths = [str(tmp_path / n) for n in ("q.tsv", "m1.tsv", "m2.tsv", "gone.tsv")]
    columns = t["artifacts"].schema
    own = [("s", "r", "checkm2.q", "qc_report", paths[0], sha(quality), 1, "checkm2"), ("s", "r", "checkm1.b", "qc_report", paths[2], sha(twice), 1, "checkm1"), ("s", "r", "checkm1.a", "qc_report", paths[1], sha(twice), 1, "checkm1"), ("s", "r", "gvclass.x", "taxonomy_report", paths[3], sha(lost), 1, "gvclass"), ("s", "r", "else", "other", "nowhere", "0", 1, "checkm2")]
    t["artifacts"] = spark.createDataFrame(own, columns)
    stages = [("s", "r", n, n, s, why, None, n, "1", "run", None, None, None) for n, s, why in (("checkm2", "completed", None), ("checkm1", "completed", None), ("gvclass", status, "late"))]
    t["stages"] = t["stages"].union(spark.createDataFrame(stages, t["stages"].schema))
    return t, paths


def test_evidence_states_rows_and_receipts(spark, tmp_path):
    t, paths = evident(spark, tmp_path, "failed")
    found = evidence.reports(t, paths)
    states = {r.method: (r.status, r.stage_status, r.status_reason, r.source_ids) for r in evidence.states(t, found).collect()}
    assert len(states) == 8
    assert states["checkm2"] == ("completed", "completed", None, ["artifact:checkm2.q"]) and states["checkm1"] == ("completed", "completed", None, ["artifact:checkm1.a"])
    assert states["gvclass"] == ("unavailable", "failed", "registered_artifact_unavailable", ["artifact:gvclass.x"]) and states["routing"] == ("unassessed", "unassessed", None, [])
    assert {(r.source_id, r.verification) for r in evidence.receipts(found).collect()} == {("artifact:checkm2.q", "verified"), ("artifact:checkm1.a", "verified"), ("artifact:checkm1.b", "verified"), ("artifact:gvclass.x", "unavailable")}
    reads = spark.createDataFrame([("s", "r", "c1", 30, 9, 1, 100), ("s", "r", "c2", 20, 9, 1, 50)], READS)
    whole = json.loads(text_of(export.streamed(t, reads, evidence.pieces(t, found)), export.SCOPE)[("s", "r", "a1")])
    assert whole["evidence"]["checkm2"]["rows"] == [{"Name": "b1.fa", "Score": "9", "source_id": "artifact:checkm2.q"}]
    assert whole["evidence"]["checkm1"]["rows"] == [{"Bin Id": "b1", "x": "1", "source_id": "artifact:checkm1.a"}] and whole["evidence"]["gtdbtk"]["rows"] == []
    assert [s["source_id"] for s in whole["sources"]] == ["artifact:checkm1.a", "artifact:checkm1.b", "artifact:checkm2.q", "artifact:gvclass.x"] and whole["mapping"]["status"] == "available"


def test_changed_or_lost_evidence_is_refused(spark, tmp_path):
    t, paths = evident(spark, tmp_path)
    with pytest.raises(Exception, match="needs its registered evidence: gvclass.x"):
        evidence.receipts(evidence.reports(t, paths)).collect() and evidence.rows(evidence.reports(t, paths)).collect()
    t, paths = evident(spark, tmp_path, "failed", changed=True)
    with pytest.raises(Exception, match="digest of a file changed"):
        evidence.rows(evidence.reports(t, paths)).collect()
