"""The pipeline's stages on small tables: rows, columns, nulls, empty tables, clashing names."""

import hashlib
import random

import pytest

import corpus_pipeline as cp
from tessella.llm import queries

tokenizers = pytest.importorskip("tokenizers")
NAMES = ["quality", "near_duplicates", "decontamination", "personal_data", "tokens"]
GOOD = "the river of stone was walking gently in bright morning light and the letter came from the window near a house".split()
ITEM = "one two three four five six seven eight nine ten eleven twelve"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Good and bad documents, copies, a benchmark passage, personal data, nulls and repeated rows."""
    draw = random.Random(1)
    base = str(tmp_path_factory.mktemp("corpus"))
    rows, marks = [], []
    for k in range(240):
        good = k % 3 > 0
        words = [draw.choice(GOOD) + str(draw.randint(0, 99)) * (draw.random() < 0.3) if good else draw.choice(["$$$", "&&&", "%%%", "BUY!!"]) * draw.randint(1, 4) for _ in range(draw.randint(30, 80))]
        rows.append((k, " ".join(words)))
        marks.append((k, int(good), 0))
    good = [k for k in range(240) if k % 3 > 0]
    text = dict(rows)
    rows += [(1000, text[good[0]]), (1001, text[good[1]] + " end"), (1002, f"{text[good[2]]} {ITEM}"), (1003, f"{text[good[3]][::-1]} mail ab.c@d.example.com now"), (1004, None), (1005, ""), (1004, None)]
    docs = spark.createDataFrame([(k, t, "en", f"s{k % 3}", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.selectExpr("*", "7 as __row", "'x' as class").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base


def test_each_stage_takes_effect_and_keeps_the_columns(spark, folder):
    assert [name for name, _ in cp.STAGES] == NAMES and cp.ORACLE_SQL is None
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in cp.STAGES:
        before = docs
        docs = stage(spark, before, folder)
        docs.write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
        assert name == "tokens" or docs.columns == columns
    good, bad = [k for k in range(240) if k % 3 > 0], [k for k in range(240) if k % 3 == 0]
    assert not set(bad) & set(seen["quality"]) and set(good) <= set(seen["quality"])
    # copies go, the first of each group stays
    assert set(good) <= set(seen["near_duplicates"]) and not {1000, 1001} & set(seen["near_duplicates"])
    assert set(seen["near_duplicates"]) - set(seen["decontamination"]) <= {1002} and 1002 not in seen["decontamination"]
    assert set(seen["personal_data"]) == set(seen["decontamination"]) == set(seen["tokens"])
    if 1003 in seen["personal_data"]:
        assert "<EMAIL>" in seen["personal_data"][1003].text and "ab.c@d" not in seen["personal_data"][1003].text
    assert all(r.n_chars == len(r.text or "") for r in seen["personal_data"].values())
    library = tokenizers.Tokenizer.from_file(queries.vocabulary_path())
    for k, r in seen["tokens"].items():
        ids = library.encode(seen["personal_data"][k].text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_run_gives_the_stages_rows_and_an_empty_table_gives_none(spark, folder, tmp_path):
    assert {r.doc_id for r in cp.run(spark, folder).collect()} == {r.doc_id for r in spark.read.parquet(f"{folder}/tokens").collect()}
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_every_query_runs_on_the_small_tables(spark):
    counts = {}
    of_texts = {n: q for n, q in queries.QUERIES.items() if n != "op13_hard_negatives"}  # whose rows follow from the anchors
    for name, query in of_texts.items():
        counts[name] = query(spark, "/root/testdata/sf0.001").count()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
    assert counts == {name: pages if name.startswith("op5") else docs for name in of_texts}
