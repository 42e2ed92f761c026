import random
import re

import pytest
from pyspark.sql import functions as F

from tessella.operators import keys, measures
from tessella.plans import records as plans
from tessella.sources import alignments as al


def walk(cigar, start, breaks):
    """Blocks of a CIGAR text, base by base; the span's end."""
    at, blocks, open_ = start, [], None
    for n, op in re.findall(r"([0-9]+)([A-Z=])", cigar):
        for _ in range(int(n)):
            if op in "MDN=X":
                if op in breaks:
                    open_ = None
                elif open_ is None:
                    open_ = [at, at]
                    blocks.append(open_)
                else:
                    open_[1] = at
                at += 1
        if op in breaks:
            open_ = None
    return [tuple(b) for b in blocks], max(start, at - 1)


def cigars(seed, n):
    draw = random.Random(seed)
    out = ["*", "5M", "3S4M2I3M1H", "2N5M", "5M2N", "3M0N2M", "3M1D2M", "0M", "4M3N0M2N3M", "2I", "5M10N5M3D7M", "3M2I4M"]
    for _ in range(n):
        out.append("".join(f"{draw.randint(1, 12)}{draw.choice('MMMIDNSHP=X')}" for _ in range(draw.randint(1, 9))))
    return out + ["".join(f"{1 + k % 7}{'MIMD'[k % 4]}" for k in range(4000))]


def test_blocks_and_spans_equal_a_walk_over_the_bases(spark):
    rows = [(k, c, 1 + 7 * k) for k, c in enumerate(cigars(1, 150))]
    df = spark.createDataFrame(rows, "k int, cigar string, start long").repartition(2)
    df = df.withColumns({"exons": al.exons(F.col("cigar"), F.col("start")), "blocks": al.aligned_blocks(F.col("cigar"), F.col("start"))})
    for r in al.with_end(df).collect():
        blocks, end = walk(r.cigar, r.start, "ND")
        assert [tuple(b) for b in r.blocks] == blocks and r.end == end, r.cigar
        parts, _ = walk(r.cigar, r.start, "N")
        assert [tuple(b) for b in r.exons] == parts, r.cigar


LINE = "{q}\t{f}\tc\t{s}\t{m}\t{c}\t*\t0\t0\tACGT\tIIII\tNM:i:0"


def test_records_are_read_and_broken_ones_raise(spark, tmp_path):
    p = tmp_path / "a.sam"
    p.write_text("@HD\tVN:1.6\n@SQ\tSN:c\tLN:9\n" + LINE.format(q="r1", f=16, s=3, m=60, c="4M") + "\n" + LINE.format(q="r2", f=4, s=0, m=0, c="*") + "\n")
    rows = sorted(tuple(r)[1:] for r in al.sam(spark, str(p)).collect())
    assert rows == [("r1", 16, "c", 3, 60, "4M", "ACGT", "IIII"), ("r2", 4, "c", 0, 0, "*", "ACGT", "IIII")]
    for text, says in (("r\t0\tc\t1", "too few"), (LINE.format(q="r", f="x", s=1, m=1, c="4M"), "no number in flag"), (LINE.format(q="r", f=0, s=1, m=1, c="4M3"), "no CIGAR"), (LINE.format(q="r", f=0, s=-1, m=1, c="4M"), "no number in start")):
        p.write_text(text + "\n")
        with pytest.raises(Exception, match=says):
            al.sam(spark, str(p)).collect()


@pytest.mark.parametrize("window", [1 << 16, 8])
def test_selection_by_intervals_equals_brute_force(spark, monkeypatch, window):
    monkeypatch.setattr(al, "WINDOW", window)
    draw = random.Random(4)
    records = [(f"r{k}", draw.choice("ab"), s := draw.randint(1, 90), s + draw.randint(0, 40)) for k in range(120)]
    beds = [(f"bin{draw.randrange(4)}", draw.choice("abc"), x := draw.randint(0, 80), x + draw.choice([0, 1, 5, 60])) for _ in range(25)]
    got = al.selected(spark.createDataFrame(records, "qname string, contig string, start long, end long"), spark.createDataFrame(beds, "bin_id string, contig string, from long, to long"))
    want = {(b, q, c, s, e) for q, c, s, e in records for b, c2, x, y in beds if c == c2 and x < y and s <= y and e >= x + 1}
    assert sorted(map(tuple, got.select("bin_id", "qname", "contig", "start", "end").collect())) == sorted(want)


@pytest.mark.parametrize("width", [5, 37, keys.WIDTH])
def test_blocks_carry_what_lies_before_them(spark, width):
    draw = random.Random(width)
    rows = [(draw.choice(["x", "x", "x", "y", None]), s := draw.randint(1, 200), s + draw.choice([0, 3, 10, 120]), f"n{k}") for k in range(150)] + [("long", 1, 100, "a"), ("long", 2, 3, "b"), ("long", 90, 95, "c")]
    df = spark.createDataFrame(rows, "contig string, start long, end long, name string").repartition(3)
    sums, found, groups = {}, [], {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    for c, members in groups.items():
        sums[c] = (len(members), sum(e - s + 1 for _, s, e, _ in members), len({p for _, s, e, _ in members for p in range(s, e + 1)}))
        members.sort(key=lambda r: r[1:])
        found += [(c, b[3], a[3]) for a, b in zip(members, members[1:]) if a[2] >= b[1]]
    got = measures.covered_bases(df, ["contig"], width)
    assert {r.contig: (r.numreads, r.aligned_bp, r.covbases) for r in got.collect()} == sums
    assert sorted(map(tuple, keys.overlaps(df, ["contig"], width=width).collect()), key=str) == sorted(found, key=str)
    values = [(draw.choice(["u", "v", None]), k, draw.choice([None, None, f"t{k}"])) for k in range(120)]
    last, want = {}, []
    for u, k, v in values:
        last[u] = v if v is not None else last.get(u)
        want.append((u, k, last[u]))
    got = keys.carried(spark.createDataFrame(values, "u string, k long, v string").repartition(3), "v", "k", ["u"], width)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_no_window_holds_more_than_a_block_of_a_contig(spark):
    df = spark.createDataFrame([("x", 1, 2, "a")], "contig string, start long, end long, name string")
    for plan in (measures.covered_bases(df, ["contig"]), keys.overlaps(df, ["contig"]), keys.carried(df, "name", "start", ["contig"])):
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in text.splitlines() if "Window [" in line]
        assert windows and all("_block" in w.split("windowspecdefinition(")[1] for w in windows)


def test_mean_depth(spark):
    contigs = spark.createDataFrame([("a", 100), ("b", 50)], "contig string, length_bp long")
    records = spark.createDataFrame([("a", "10M5D10M", 1), ("a", "20M", 6), ("z", "5M", 1)], "contig string, cigar string, start long")
    blocks = records.select("contig", F.explode(al.aligned_blocks(F.col("cigar"), F.col("start"))).alias("b")).select("contig", "b.*")
    got = sorted(map(tuple, measures.contig_coverage(contigs, records, blocks, ["contig"], width=7).collect()))
    assert got == [("a", 100, 2, 25, 25.0, 0.4), ("b", 50, 0, 0, 0.0, 0.0)]


@pytest.mark.parametrize("width", [3, 50, keys.WIDTH])
def test_coverage_of_records_in_one_pass_equals_brute_force(spark, width):
    draw = random.Random(width)
    stretch = lambda: (s := draw.randint(1, 150), s + draw.choice([-1, 0, 4, 90]))
    rows = [(draw.choice("abz"), [stretch() for _ in range(draw.randint(0, 4))]) for _ in range(60)] + [("a", None), ("b", [(1, 400), (2, 3)])]
    df = spark.createDataFrame(rows, "contig string, blocks array<struct<start:bigint,end:bigint>>").repartition(3)
    contigs = spark.createDataFrame([("a", 500), ("b", 500), ("c", 500)], "contig string, length_bp long")
    want = []
    for c in "abc":
        own = [b for n, b in rows if n == c]
        every = [x for b in own for x in b or []]
        covered = len({p for s, e in every for p in range(s, e + 1)})
        want.append((c, 500, len(own), covered, 100 * covered / 500, sum(e - s + 1 for s, e in every) / 500))
    assert sorted(map(tuple, measures.record_coverage(contigs, df, ["contig"], width=width).collect())) == want
    other = measures.contig_coverage(contigs, df, df.select("contig", F.explode("blocks").alias("b")).select("contig", "b.*"), ["contig"], width=width)
    assert sorted(map(tuple, other.collect())) == want


def test_alignment_coverage_reads_records_once(spark, tmp_path):
    lines = [(1, 1, 3, 6, 25.0, 0.05), (1, 2, 4, 7, 30.0, 0.0), (2, 1, 3, 8, 25.0, 0.05)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_quantity double, l_discount double").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(3,), (4,), (5,)], "s_suppkey long").write.parquet(str(tmp_path / "supplier.parquet"))
    got = plans.alignment_coverage(spark, str(tmp_path))
    assert sorted((r.contig, r.numreads, r.covbases) for r in got.collect()) == [("c3", 1, 31), ("c4", 1, 30), ("c5", 0, 0)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [value") == 1 and plan.count("split(value") == 1
