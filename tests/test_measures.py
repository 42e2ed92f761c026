import hashlib

from tessella.operators import measures
from tessella.plans import queries


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_digest_of_sorted_records_without_a_gathered_group(spark):
    rows = [("a", k % 3, f"n{k % 70}", "acGT"[k % 4] * (k % 5)) for k in range(25_000)] + [("a", None, "x", "A"), ("b", 1, "x", "c"), ("b", 2, None, "c"), ("b", 1, None, "c")]
    frame = spark.createDataFrame(rows, "s string, g int, name string, sequence string").repartition(4)
    got = measures.sequence_digest(frame, ["s", "g"])
    want = {}
    for s, g, name, seq in rows:
        want.setdefault((s, g), []).extend([] if name is None else [f">{name}\n{seq.upper()}\n"])
    assert {(r.s, r.g): r.digest for r in got.collect()} == {k: hashlib.sha256("".join(sorted(v)).encode()).hexdigest() for k, v in want.items()}
    assert got.count() == len(want) and got.schema["g"].dataType.simpleString() == "int"
    assert "collect_list" not in plan(got)


def test_expected_keys_are_numbered_as_rows(spark, tmp_path):
    spark.createDataFrame([(1, "2-HIGH", 9), (2, "1-URGENT", 41), (3, "1-URGENT", 1), (4, "x", 2)], "o_orderkey long, o_orderpriority string, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    got = queries.expected_keys_explode(spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == [(1, "1-URGENT", "2:x", 0), (1, "1-URGENT", "3:x", 1), (2, "x", "4:x", 0), (9, "2-HIGH", "1:x", 0)]
    assert "collect_list" not in plan(got)
