from tessella.operators import cover


def cells(df):
    return sorted(tuple(r) for r in df.collect())


def test_omitted_bins(spark):
    expected = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "bin_id string")
    reported = spark.createDataFrame([("a",), ("d",), ("x",)], "bin_id string")
    proteins = spark.createDataFrame([("a", 5), ("b", 0), ("c", 0), ("d", 0)], "bin_id string, size_bytes long")
    lines = spark.createDataFrame([("[10:00] WARNING: Skipping protein file /p/b.faa as it was empty.",), ("WARNING: Skipping protein file c.faa as it was empty.",), ("WARNING: Skipping protein file c.faa as it was empty.",), ("INFO: Skipping",), ("",)], "value string")
    left_out, problems = cover.omitted_bins(expected, reported, proteins, cover.warned_bins(lines))
    assert cells(left_out) == [("b",), ("c",), ("e",)]
    assert cells(problems) == [("c", "repeated warning"), ("d", "evidence disagrees"), ("e", "not one protein file"), ("x", "unknown bin")]
    assert cover.log_errors(lines).count() == 0
    assert cover.log_errors(spark.createDataFrame([("x ERROR: bad",), ("TERROR:",), ("Traceback (most recent call last):",)], "value string")).count() == 2


def test_restored(spark):
    records = spark.createDataFrame([("s1", "ACgt"), ("s2", ""), ("s9", "A")], "name string, sequence string")
    aliases = spark.createDataFrame([("s1", "contig 1 x"), ("s2", "contig 2"), ("s3", "contig 3")], "alias string, original string")
    rows, unknown = cover.restored(records, aliases)
    assert cells(rows) == [("contig 1 x", "ACgt"), ("contig 2", "")] and cells(unknown) == [("s9",)]


def test_contigs_alignments_and_counts(spark):
    contigs = spark.createDataFrame([("c1", "a"), ("c1", "b"), ("c2", "a"), ("c2", "a"), ("c3", "b")], "contig_id string, bin_id string")
    assert cells(cover.contig_problems(contigs)) == [("c1", "several bins"), ("c2", "repeated")]
    alignments = spark.createDataFrame([("c3", 1), ("c9", 2)], "contig_id string, read long")
    assert cells(cover.of_bins(alignments, contigs)) == [("c3", 1, "b")]
    assert cells(cover.row_count_problems(alignments, contigs)) == [(2, 5)] and cells(cover.row_count_problems(contigs, contigs)) == []


def test_identities_and_empty_gene_files(spark):
    bundles = spark.createDataFrame([("1", "w", "2", "r", 1), ("1", "w", "2", "r", 2)], "schema_version string, workflow_name string, workflow_version string, source_revision string, n int")
    assert cells(cover.bundle_identities(bundles)) == [("1", "w", "2", "r")]
    good = ["##gff-version  3", "# Sequence Data: seqnum=1", "# Model Data: version=x;transl_table=11;"]
    files = {"good": good, "old": ["##gff-version 2", *good[1:]], "codeless": [*good[:2], "# Model Data: x"], "none": [""], "other": [*good[:2], "# Model Data: transl_table=4"]}
    lines = spark.createDataFrame([(p, x) for p, rows in files.items() for x in rows], "path string, value string")
    assert cells(cover.empty_gene_files(lines, 11)) == [("codeless", "model without genetic code"), ("none", "not an empty result"), ("old", "not an empty result"), ("other", "another genetic code")]
    assert "other" not in [r[0] for r in cells(cover.empty_gene_files(lines))]


LOG = ["[1] INFO: x", "[2] WARNING: Skipping protein file p/b2.faa as it was empty.", "[3] ERROR: No DIAMOND annotation was generated. Exiting"]


def refused(spark, log=LOG, hits=(("h", 0),), bins=(("b1", 5), ("b2", 5)), proteins=(("b1", 9), ("b2", 0)), code=1, report=False):
    f = lambda rows, c: spark.createDataFrame(list(rows), c)
    got = cover.no_annotation_problems(f([(x,) for x in log], "value string"), f(hits, "path string, size_bytes long"), f(bins, "bin_id string, size_bytes long"), f(proteins, "bin_id string, size_bytes long"), code, report)
    return {(r.target, r.detail) for r in got.collect()}


def test_a_run_without_annotations_is_accepted_only_as_a_whole(spark):
    assert refused(spark) == set()
    assert refused(spark, code=0, report=True) == {("run", "exit code"), ("run", "a report is there")}
    assert refused(spark, log=LOG[:2]) == {("run", "not one error")}
    assert refused(spark, log=[*LOG, "ERROR: other"]) == {("run", "not one error"), ("run", "another error")}
    assert refused(spark, hits=()) == {("run", "no hit table")} and refused(spark, hits=(("h", 0), ("i", 1))) == {("run", "hits are there")}
    assert refused(spark, log=[LOG[2]]) == {("b2", "warnings and empty proteins differ")}
    assert refused(spark, log=[*LOG[:2], *LOG[1:]]) == {("b2", "warnings and empty proteins differ")}
    assert refused(spark, bins=(("b1", 0), ("b2", 5), ("b3", 1)), proteins=(("b1", 9), ("b2", 0), ("zz", 1))) == {("b1", "empty bin"), ("b3", "no protein file"), ("zz", "no bin of that name")}
    assert refused(spark, bins=(), proteins=(), log=[LOG[2]]) == {("run", "no bins")}
