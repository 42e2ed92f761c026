import math
import random

import pytest
from pyspark.sql import functions as F

from tessella.sources import reads as rd
from tessella.sources import splits


def text_of(records):
    return "".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in records)


def draw(seed, n):
    r = random.Random(seed)
    out = []
    for k in range(n):
        size = r.choice([0, 1, 3, 40, 200])
        out.append((f"r{k} x=@{k}", "".join(r.choice("ACGTN") for _ in range(size)), "".join(chr(33 + r.randrange(60)) for _ in range(size))))
    return out


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set(k, size) for k in old]
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", ["10", "64", "333", "128m"])
def test_records_survive_any_split(spark, tmp_path, small_splits, size):
    one, two = draw(1, 5 if size == "10" else 30), draw(2, 8)
    (tmp_path / "a.fastq").write_text(text_of(one) + "\n\n")
    (tmp_path / "b.fastq").write_text(text_of(two).replace("\n", "\r\n"))
    small_splits(size)
    got = rd.fastq(spark, [str(tmp_path / "a.fastq"), str(tmp_path / "b.fastq")]).collect()
    want = [("a", k, n, n.split()[0], s, q) for k, (n, s, q) in enumerate(one)] + [("b", k, n, n.split()[0], s, q) for k, (n, s, q) in enumerate(two)]
    assert sorted((r.path[-7], r.record, r.header, r.name, r.sequence, r.quality) for r in got) == want


def test_splits_meet_by_a_shuffle_beyond_the_bound(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(splits, "BROADCAST_SPLITS", 0)
    records = draw(3, 40)
    (tmp_path / "a.fastq").write_text(text_of(records))
    small_splits("100")
    assert sorted((r.record, r.sequence) for r in rd.fastq(spark, str(tmp_path)).collect()) == [(k, s) for k, (_, s, _) in enumerate(records)]


@pytest.mark.parametrize(("text", "says"), [("@a\nAC\n+\n", "missing lines|differ"), ("a\nAC\n+\nII\n", "no @"), ("@a\nAC\nII\nII\n", "no \\+"), ("@ a\nAC\n+\nII\n", "no name"), ("@a\nAC\n+\nI\n", "differ"), ("@a\nAC\n+\nII\n@b\nA\n", "missing lines in record 2")])
def test_broken_records_raise(spark, tmp_path, text, says):
    (tmp_path / "a.fastq").write_text(text)
    with pytest.raises(Exception, match=says):
        rd.fastq(spark, str(tmp_path)).collect()


def test_boundaries_of_length_and_quality(spark, tmp_path):
    cases = [("short_q40", 999, "I"), ("boundary_q40", 1000, "I"), ("long_q9", 2000, "*"), ("long_q10", 1777, "+"), ("long_q11", 2000, ","), ("long_q40", 2000, "I")]
    (tmp_path / "a.fastq").write_text(text_of([(n, "A" * k, q * k) for n, k, q in cases]))
    rows = rd.measured(rd.fastq(spark, str(tmp_path)))
    assert sorted(r.name for r in rd.kept(rows).collect()) == ["boundary_q40", "long_q10", "long_q11", "long_q40"]
    assert sorted(r.name for r in rd.kept(rows, "hifi").collect()) == ["boundary_q40", "long_q10", "long_q11", "long_q40", "long_q9"]
    means = {r.name: r.q for r in rows.select("name", rd.mean_quality().alias("q")).collect()}
    assert means == {"short_q40": 40.0, "boundary_q40": 40.0, "long_q9": 9.0, "long_q10": 10.0, "long_q11": 11.0, "long_q40": 40.0}


def test_statistics_and_writing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rd, "PIECE", 50)
    records = draw(4, 50)
    frame = spark.createDataFrame(records, "header string, sequence string, quality string")
    rd.write_fastq(frame.repartition(3), f"{tmp_path}/out")
    rows = rd.measured(rd.fastq(spark, f"{tmp_path}/out"))
    got = rd.statistics(rows.withColumn("sample_id", F.lit("s")), ["sample_id"]).first()
    sizes = sorted((len(s) for _, s, _ in records), reverse=True)
    run, half = 0, None
    for x in sizes:
        run += x
        if half is None and 2 * run >= sum(sizes):
            half = x
    assert (got.num_seqs, got.sum_len, got.min_len, got.max_len, got.n50_bp) == (50, sum(sizes), 0, 200, half)
    assert got.gc_bp == sum(s.count("G") + s.count("C") for _, s, _ in records) and got.error_sum == sum(rd.errors(ord(c) - 33) for _, _, q in records for c in q)
    each = {r.header: r.q for r in rows.select("header", rd.mean_quality().alias("q")).collect()}
    for n, _, q in records:
        assert each[n] is None if not q else abs(each[n] + 10 * math.log10(sum(10 ** (-(ord(c) - 33) / 10) for c in q) / len(q))) < 1e-5


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.fastq").write_text("")
    assert rd.fastq(spark, str(tmp_path)).collect() == []


def test_sums_beyond_64_bits_are_exact(spark):
    rows = spark.range(4).selectExpr("'s' AS sample_id", "'GA' AS sequence", "2L AS length", f"{5 * 10**18}L + id AS error_sum")
    got = rd.statistics(rows, ["sample_id"]).first()
    assert got.error_sum == 20 * 10**18 + 6 and (got.num_seqs, got.sum_len, got.gc_bp, got.n50_bp) == (4, 8, 4, 2)
