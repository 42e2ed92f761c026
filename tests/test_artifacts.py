import hashlib
import random

import pytest

from tessella.sources import artifacts as ar

SAMPLES = [b"", b"\n", b"a", b"a\n", b"a\nb", b"\n\n\nx\n\n", b"\r\n\ra\r", b"\xef\xbb\xbfmarked\n", b"\xef\xbb\xbf", b"\xef\xbb\xbf\n", b"\xff\xfe\x00\n\x80\xef\xbb\xbf", bytes(range(256)) * 40, b"no break" * 5000]


def sha(b):
    return hashlib.sha256(b).hexdigest()


def write(folder, samples):
    folder.mkdir(exist_ok=True)
    for k, b in enumerate(samples):
        (folder / f"f{k}").write_bytes(b)


def test_digests_of_any_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ar, "BATCH_LINES", 7)
    draw = random.Random(1)
    every = SAMPLES + [bytes(draw.randrange(256) for _ in range(20_000)) for _ in range(3)]
    write(tmp_path / "x", every)
    write(tmp_path / "x/deep", [b"inner"])
    got = {r.path.split("/x/")[1]: (r.size_bytes, r.sha256) for r in ar.digests(spark, str(tmp_path / "x")).collect()}
    assert got == {f"f{k}": (len(b), sha(b)) for k, b in enumerate(every)} | {"deep/f0": (5, sha(b"inner"))}


def test_outputs_with_their_index_and_folders(spark, tmp_path):
    (tmp_path / "a.bam").write_bytes(b"BAM")
    (tmp_path / "a.bam.bai").write_bytes(b"index")
    (tmp_path / "a.bam.txt").write_bytes(b"no output")
    write(tmp_path / "bins", [b"one", b"two"])
    write(tmp_path / "bins/sub", [b"three"])
    got = ar.outputs(spark, "binning", str(tmp_path), {"bam": "a.bam", "bins": "bins"}, {"bam": "alignment"})
    rows = {r.path.split(f"{tmp_path}/")[1]: r for r in got.collect()}
    assert set(rows) == {"a.bam", "a.bam.bai", "bins/f0", "bins/f1", "bins/sub/f0"}
    r = rows["bins/sub/f0"]
    assert (r.artifact_id, r.kind, r.sha256, r.size_bytes, r.producer_stage_id) == ("binning.bins." + sha(b"bins/sub/f0")[:12], "other", sha(b"three"), 5, "binning")
    assert rows["a.bam.bai"].kind == "alignment" and rows["a.bam.bai"].artifact_id == "binning.bam." + sha(b"a.bam.bai")[:12]
    with pytest.raises(FileNotFoundError, match="missing binning output"):
        ar.outputs(spark, "binning", str(tmp_path), {"x": "none"}, {})


def test_changed_files_are_named(spark, tmp_path):
    write(tmp_path / "x", [b"same", b"longer now", b"other"])
    p = lambda k: str(tmp_path / f"x/f{k}")
    receipts = spark.createDataFrame([(p(0), sha(b"same"), 4), (p(1), sha(b"short"), 5), (p(2), sha(b"OTHER"), 5), (p(3), sha(b""), 0)], "path string, sha256 string, size_bytes long")
    assert {r.path[-2:]: r.reason for r in ar.changed(spark, receipts, str(tmp_path / "x")).collect()} == {"f1": "size", "f2": "digest", "f3": "missing"}


def test_tables_are_parsed_from_the_verified_bytes(spark, tmp_path):
    one, two = b'a\tb\n1\t"x ""y"""\n\n2\n', b"b\tc\r\n3\t4\r\n"
    write(tmp_path / "x", [one, two])
    paths = [str(tmp_path / "x/f0"), str(tmp_path / "x/f1")]
    receipts = spark.createDataFrame([(paths[0], sha(one)), (paths[1], sha(two)), (str(tmp_path / "x/none"), "0")], "path string, sha256 string")
    found = ar.contents(spark, paths, receipts)
    assert {r.path[-4:]: r.content is None for r in found.collect()} == {"x/f0": False, "x/f1": False, "none": True}
    assert sorted((r.path[-2:], r.ordinal, tuple(sorted(r.cells.items()))) for r in ar.parsed(found).collect()) == [("f0", 1, (("a", "1"), ("b", 'x "y"'))), ("f0", 2, (("a", "2"), ("b", None))), ("f1", 1, (("b", "3"), ("c", "4")))]
    (tmp_path / "x/f1").write_bytes(two + b"5\t6\n")
    with pytest.raises(Exception, match="digest of a file changed"):
        ar.parsed(ar.contents(spark, paths, receipts)).collect()
    wide = spark.createDataFrame([(b"a\n1\t2\n",)], "content binary")
    with pytest.raises(Exception, match="more cells than columns"):
        ar.parsed(wide).collect()
