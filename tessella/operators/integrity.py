"""Integrity rules over the catalog's tables.

Each rule is a query of violations (rule_id, rule_order, sample_id, run_id,
key, detail). Publication requires that their union is empty; the first rule
to be reported is the one of least order. Tables carry sample_id and run_id;
``tables`` maps a name to its DataFrame, and rules whose tables are missing
are left out.
"""

from __future__ import annotations

import atexit
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.operators.measures import n50
from tessella.sources import scratch

SCOPE = ["sample_id", "run_id"]
#: Each result table's key and the kind of artifact it comes from.
RESULT_KEYS = {
    "read_stats": "record_id", "assemblies": "assembly_id", "contigs": "contig_id", "bins": "bin_id", "memberships": "membership_id", "qc": "record_id",
    "taxonomy": "record_id", "ssu": "record_id", "viruses": "record_id", "phenotypes": "record_id", "genes": "gene_id", "annotations": "annotation_id",
}
RESULT_KINDS = {
    "read_stats": "qc_report", "assemblies": "assembly", "contigs": "assembly", "bins": "bin_fasta", "memberships": "bin_fasta", "qc": "qc_report",
    "taxonomy": "taxonomy_report", "ssu": "ssu_report", "viruses": "viral_report", "phenotypes": "phenotype_report", "genes": "gene_annotation", "annotations": "functional_annotation",
}
TARGETS = {"assembly": ("assemblies", "assembly_id"), "contig": ("contigs", "contig_id"), "bin": ("bins", "bin_id"), "virus": ("viruses", "record_id"), "gene": ("genes", "gene_id")}
EUK_FIELDS = ["completeness_support", "contamination_support", "completeness_reliability", "contamination_reliability", "checkeuk_expected_markers_present", "checkeuk_expected_markers_total"]

#: Rules over whichever result tables, or feature tables, there are.
ANY_RESULT, ANY_FEATURE = {19, 20, 21, 22, 24, 25, 26, 29}, {52, 53, 54}

Tables = dict[str, DataFrame]
RULES: dict[str, tuple[int, list[str], Callable[[Tables], DataFrame]]] = {}


def rule(number: int, *needs: str) -> Callable:
    def keep(f: Callable[[Tables], DataFrame]) -> Callable:
        RULES[f.__name__] = (number, list(needs), f)
        return f

    return keep


def _said(rows: DataFrame, key: Column | str, detail: str) -> DataFrame:
    run = F.col("run_id") if "run_id" in rows.columns else F.lit(None)
    key = F.col(key) if isinstance(key, str) else key
    return rows.select(F.col("sample_id").cast("string").alias("sample_id"), run.cast("string").alias("run_id"), key.cast("string").alias("key"), F.lit(detail).alias("detail"))


def _twice(rows: DataFrame, keys: list[str], detail: str) -> DataFrame:
    return _said(rows.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1"), keys[-1], detail)


def _missing(rows: DataFrame, parent: DataFrame, on: dict[str, str], key: str, detail: str) -> DataFrame:
    some = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    known = parent.select(*[F.col(p).alias(c) for c, p in on.items()]).distinct()
    return _said(rows.where(some).join(known, list(on), "left_anti"), key, detail)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _result_tables(t: Tables) -> Tables:
    """(collection, key, scope, stage_id, artifact_id) of every row of each result table."""
    return {n: t[n].select(F.lit(n).alias("collection"), F.col(k).cast("string").alias("key"), *SCOPE, "stage_id", "artifact_id") for n, k in RESULT_KEYS.items() if n in t}


def _results(t: Tables) -> DataFrame:
    return _union(list(_result_tables(t).values()))


def _scoped(on: dict[str, str]) -> dict[str, str]:
    return {c: c for c in SCOPE} | on


@rule(1, "samples")
def duplicate_sample(t: Tables) -> DataFrame:
    return _twice(t["samples"], ["sample_id"], "duplicate sample")


@rule(2, "runs", "samples")
def run_sample(t: Tables) -> DataFrame:
    return _missing(t["runs"], t["samples"], {"sample_id": "sample_id"}, "run_id", "run without its sample")


@rule(3, "runs")
def duplicate_run(t: Tables) -> DataFrame:
    return _twice(t["runs"], SCOPE, "duplicate run")


@rule(4, "runs")
def basecaller(t: Tables) -> DataFrame:
    return _said(t["runs"].where("platform <> 'ONT' and (basecaller is not null or basecaller_model is not null)"), "run_id", "basecaller on another platform")


@rule(5, "stages")
def duplicate_stage(t: Tables) -> DataFrame:
    return _twice(t["stages"], [*SCOPE, "stage_id"], "duplicate stage")


@rule(6, "artifacts")
def duplicate_artifact(t: Tables) -> DataFrame:
    return _twice(t["artifacts"], [*SCOPE, "artifact_id"], "duplicate artifact")


@rule(7, "artifacts", "runs")
def artifact_run(t: Tables) -> DataFrame:
    return _missing(t["artifacts"], t["runs"], _scoped({}), "artifact_id", "artifact without its run")


@rule(8, "artifacts")
def path_identity(t: Tables) -> DataFrame:
    found = t["artifacts"].groupBy("path").agg(F.countDistinct(F.struct("sha256", "size_bytes")).alias("n"), F.min("sample_id").alias("sample_id")).where("n > 1")
    return _said(found, "path", "one path with several contents")


@rule(9, "artifacts", "stages")
def producer(t: Tables) -> DataFrame:
    return _missing(t["artifacts"], t["stages"], _scoped({"producer_stage_id": "stage_id"}), "artifact_id", "artifact without its producer stage")


@rule(10, "stages", "runs")
def stage_run(t: Tables) -> DataFrame:
    return _missing(t["stages"], t["runs"], _scoped({}), "stage_id", "stage without its run")


def _stage_filter(number: int, name: str, condition: str, detail: str) -> None:
    RULES[name] = (number, ["stages"], lambda t: _said(t["stages"].where(condition), "stage_id", detail))


_stage_filter(11, "database_version", "(database_name is null) <> (database_version is null)", "database name and version must appear together")
_stage_filter(12, "database_checksum", "database_sha256 is not null and database_name is null", "database checksum without a name")
_stage_filter(13, "completed_reason", "status = 'completed' and status_reason is not null", "completed stage with a reason")
_stage_filter(14, "completed_command", "status = 'completed' and command is null", "completed stage without a command")
_stage_filter(15, "open_reason", "status <> 'completed' and status_reason is null", "stage that is not completed lacks a reason")


@rule(16, "stage_inputs")
def repeated_input(t: Tables) -> DataFrame:
    return _twice(t["stage_inputs"], [*SCOPE, "artifact_id", "stage_id"], "stage repeats an input artifact")


@rule(17, "stage_inputs", "artifacts")
def input_artifact(t: Tables) -> DataFrame:
    return _missing(t["stage_inputs"], t["artifacts"], _scoped({"artifact_id": "artifact_id"}), "stage_id", "stage input without its artifact")


@rule(18, "stage_inputs", "artifacts")
def own_output(t: Tables) -> DataFrame:
    own = t["artifacts"].where("producer_stage_id is not null").select(*SCOPE, "artifact_id", F.col("producer_stage_id").alias("stage_id"))
    return _said(t["stage_inputs"].join(own, [*SCOPE, "artifact_id", "stage_id"], "left_semi"), "stage_id", "stage consumes its own output")


@rule(19)
def duplicate_result(t: Tables) -> DataFrame:
    return _twice(_results(t), [*SCOPE, "collection", "key"], "duplicate key of a result")


@rule(20, "runs")
def result_run(t: Tables) -> DataFrame:
    return _missing(_results(t), t["runs"], _scoped({}), "key", "result without its run")


@rule(21, "stages")
def result_stage(t: Tables) -> DataFrame:
    return _missing(_results(t), t["stages"], _scoped({"stage_id": "stage_id"}), "key", "result without its stage")


@rule(22, "artifacts")
def result_artifact(t: Tables) -> DataFrame:
    return _missing(_results(t), t["artifacts"], _scoped({"artifact_id": "artifact_id"}), "key", "result without its artifact")


@rule(23, "contigs", "artifacts")
def coverage_artifact(t: Tables) -> DataFrame:
    return _missing(t["contigs"], t["artifacts"], _scoped({"coverage_artifact_id": "artifact_id"}), "contig_id", "coverage artifact is missing")


@rule(24, "stages")
def result_status(t: Tables) -> DataFrame:
    open_ = t["stages"].where("status <> 'completed'").select(*SCOPE, "stage_id")
    return _said(_results(t).join(open_, [*SCOPE, "stage_id"], "left_semi"), "key", "result of a stage that is not completed")


@rule(25, "artifacts")
def result_producer(t: Tables) -> DataFrame:
    made = t["artifacts"].select(*SCOPE, "artifact_id", "producer_stage_id")
    return _said(_results(t).join(made, [*SCOPE, "artifact_id"]).where("not (stage_id <=> producer_stage_id)"), "key", "result and artifact come from different stages")


@rule(26, "artifacts")
def result_kind(t: Tables) -> DataFrame:
    wanted = F.element_at(F.create_map(*[F.lit(x) for pair in RESULT_KINDS.items() for x in pair]), F.col("collection"))
    return _said(_results(t).join(t["artifacts"].select(*SCOPE, "artifact_id", "kind"), [*SCOPE, "artifact_id"]).where(F.col("kind") != wanted), "key", "artifact kind does not match its table")


@rule(27, "stage_expected_keys")
def repeated_expected(t: Tables) -> DataFrame:
    return _twice(t["stage_expected_keys"], [*SCOPE, "collection", "record_id", "stage_id"], "stage repeats an expected key")


@rule(28, "stages", "stage_expected_keys")
def open_expected(t: Tables) -> DataFrame:
    open_ = t["stages"].where("status <> 'completed'").select(*SCOPE, "stage_id")
    return _said(t["stage_expected_keys"].join(open_, [*SCOPE, "stage_id"], "left_semi"), "record_id", "stage that is not completed expects rows")


@rule(29, "stages", "stage_expected_keys")
def expected_keys(t: Tables) -> DataFrame:
    done = t["stages"].where("status = 'completed'").select(*SCOPE, "stage_id")
    cols = [*SCOPE, "stage_id", "collection", "key"]
    e = t["stage_expected_keys"].withColumn("key", F.col("record_id").cast("string")).join(done, [*SCOPE, "stage_id"], "left_semi").select(*cols).distinct().withColumn("e", F.lit(1))
    a = _results(t).join(done, [*SCOPE, "stage_id"], "left_semi").select(*cols).distinct().withColumn("a", F.lit(1))
    return _said(e.join(a, cols, "full_outer").where("e is null or a is null"), F.concat_ws(":", "collection", "key"), "expected and actual keys differ")


def _filter(number: int, name: str, table: str, key: str, condition: str, detail: str) -> None:
    RULES[name] = (number, [table], lambda t: _said(t[table].where(condition), key, detail))


_filter(30, "read_sum", "read_stats", "record_id", "retained_reads + rejected_reads <> total_reads", "reads do not add up")
_filter(31, "base_sum", "read_stats", "record_id", "retained_bases + rejected_bases <> total_bases", "bases do not add up")


@rule(32, "contigs", "assemblies")
def contig_assembly(t: Tables) -> DataFrame:
    return _missing(t["contigs"], t["assemblies"], _scoped({"assembly_id": "assembly_id"}), "contig_id", "contig without its assembly")


_filter(33, "depth_artifact", "contigs", "contig_id", "mean_depth_x is not null and coverage_artifact_id is null", "depth without a coverage artifact")


#: Rules over an assembly and the sums of its contigs: (condition, detail).
ASSEMBLY: dict[str, tuple[str, str]] = {}


def _assembly(number: int, name: str, condition: str, detail: str) -> None:
    ASSEMBLY[name] = (condition, detail)

    def found(t: Tables) -> DataFrame:
        keys = [*SCOPE, "assembly_id"]
        seen = t["contigs"].groupBy(*keys).agg(F.count("*").alias("n"), F.sum("length_bp").alias("bp"), F.max("length_bp").alias("longest"))
        both = t["assemblies"].join(seen, keys, "left").join(n50(t["contigs"], keys).withColumnRenamed("n50_bp", "seen_n50"), keys, "left").na.fill(0, ["n", "bp"])
        return _said(both.where(condition), "assembly_id", detail)

    RULES[name] = (number, ["assemblies", "contigs"], found)


_assembly(34, "contig_count", "contig_count <> n", "contig count differs from its rows")
_assembly(35, "assembly_length", "assembly_length_bp <> bp", "assembly length differs from its rows")
_assembly(36, "n50_present", "n > 0 and n50_bp is null", "assembly with contigs lacks its N50")
_assembly(37, "n50_absent", "n = 0 and n50_bp is not null", "empty assembly has an N50")
_assembly(38, "n50_bound", "n50_bp > longest", "N50 exceeds the longest contig")
_assembly(39, "n50_value", "n > 0 and n50_bp <> seen_n50", "N50 differs from its rows")


def _reference(number: int, name: str, table: str, key: str, parent: str, on: dict[str, str], detail: str) -> None:
    RULES[name] = (number, [table, parent], lambda t: _missing(t[table], t[parent], _scoped(on), key, detail))


_reference(40, "bin_assembly", "bins", "bin_id", "assemblies", {"assembly_id": "assembly_id"}, "bin without its assembly")
_reference(41, "member_bin", "memberships", "membership_id", "bins", {"bin_id": "bin_id"}, "membership without its bin")
_reference(42, "member_contig", "memberships", "membership_id", "contigs", {"contig_id": "contig_id"}, "membership without its contig")
RULES["one_bin"] = (43, ["memberships"], lambda t: _twice(t["memberships"], [*SCOPE, "contig_id"], "contig in more than one bin"))


def _targets(t: Tables, rows: DataFrame, detail: str) -> DataFrame:
    known = [t[n].select(*SCOPE, F.lit(kind).alias("target_kind"), F.col(k).cast("string").alias("target_id")) for kind, (n, k) in TARGETS.items() if n in t]
    return _said(rows.join(_union(known).distinct(), [*SCOPE, "target_kind", "target_id"], "left_anti"), "record_id", detail)


RULES["qc_target"] = (44, ["qc"], lambda t: _targets(t, t["qc"], "measurement without its target"))


@rule(45, "qc", "stages")
def foreign_fields(t: Tables) -> DataFrame:
    some = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in EUK_FIELDS if c in t["qc"].columns])
    rows = t["qc"].join(t["stages"].select(*SCOPE, "stage_id", "tool_name"), [*SCOPE, "stage_id"])
    return _said(rows.where((F.lower(F.coalesce("tool_name", F.lit(""))) != "checkeuk") & some), "record_id", "fields of another tool")


@rule(46, "qc")
def no_measurement(t: Tables) -> DataFrame:
    cells = ["completeness_percent", "contamination_percent", *[c for c in EUK_FIELDS if c in t["qc"].columns]]
    return _said(t["qc"].where(reduce(lambda a, b: a & b, [F.col(c).isNull() for c in cells])), "record_id", "row without a measurement")


_filter(47, "completeness_basis", "qc", "record_id", "completeness_percent is not null and completeness_basis is null", "completeness lacks its basis")
_filter(48, "contamination_basis", "qc", "record_id", "contamination_percent is not null and contamination_basis is null", "contamination lacks its basis")
_filter(49, "marker_pair", "qc", "record_id", "(checkeuk_expected_markers_present is null) <> (checkeuk_expected_markers_total is null)", "marker counts must appear together")
_filter(50, "marker_order", "qc", "record_id", "checkeuk_expected_markers_present > checkeuk_expected_markers_total", "more markers than expected")
RULES["taxonomy_target"] = (51, ["taxonomy"], lambda t: _targets(t, t["taxonomy"], "assertion without its target"))


def _features(t: Tables) -> DataFrame:
    return _union([t[n].select(*SCOPE, F.col(RESULT_KEYS[n]).cast("string").alias("key"), "contig_id", "start", "end") for n in ("ssu", "viruses", "genes") if n in t])


RULES["feature_contig"] = (52, ["contigs"], lambda t: _missing(_features(t), t["contigs"], _scoped({"contig_id": "contig_id"}), "key", "feature without its contig"))
RULES["feature_order"] = (53, ["contigs"], lambda t: _said(_features(t).where("start > end"), "key", "feature ends before it starts"))


@rule(54, "contigs")
def feature_bounds(t: Tables) -> DataFrame:
    return _said(_features(t).join(t["contigs"].select(*SCOPE, "contig_id", "length_bp"), [*SCOPE, "contig_id"]).where("end > length_bp"), "key", "feature beyond its contig")


_reference(55, "gene_bin", "genes", "gene_id", "bins", {"bin_id": "bin_id"}, "gene without its bin")
_reference(56, "gene_member", "genes", "gene_id", "memberships", {"bin_id": "bin_id", "contig_id": "contig_id"}, "gene on a contig that is not in its bin")


@rule(57, "genes", "bins", "samples")
def genetic_code(t: Tables) -> DataFrame:
    fixed = t["bins"].where("candidate_class = 'bacterial_archaeal_candidate'").select(*SCOPE, "bin_id")
    codes = t["samples"].where("genetic_code is not null").select("sample_id", F.col("genetic_code").alias("sample_code"))
    return _said(t["genes"].join(fixed, [*SCOPE, "bin_id"], "left_semi").join(codes, "sample_id").where("genetic_code <> sample_code"), "gene_id", "gene code differs from the sample's")


_reference(58, "phenotype_bin", "phenotypes", "record_id", "bins", {"bin_id": "bin_id"}, "phenotype without its bin")
_filter(59, "threshold", "phenotypes", "record_id", "passes_threshold <> (raw_score >= threshold)", "flag contradicts the threshold")
_filter(60, "applicability", "phenotypes", "record_id", "not is_applicable and applicability_reason is null", "not applicable without a reason")
_reference(61, "annotation_gene", "annotations", "annotation_id", "genes", {"gene_id": "gene_id"}, "annotation without its gene")
_filter(62, "paired_coordinates", "annotations", "annotation_id", "(start is null) <> (end is null)", "coordinates must appear together")
_filter(63, "coordinate_order", "annotations", "annotation_id", "start > end", "annotation ends before it starts")


# ---------------------------------------------------------------- rules that share their joins

#: Rules that one job finds together: (names, the job). It takes the tables and the wanted ones of its rules.
JOINT: list[tuple[list[str], Callable[[Tables, set[str]], DataFrame]]] = []


def joint(*names: str) -> Callable:
    def keep(f: Callable[[Tables, set[str]], DataFrame]) -> Callable:
        JOINT.append((list(names), f))
        return f

    return keep


def _told(rows: DataFrame, found: dict[str, tuple[Column, Column | str, str]], names: set[str]) -> DataFrame:
    """``found`` maps a rule to (how often a row breaks it, its key, the detail); a condition counts once."""
    said = [(name, *f) for name, f in found.items() if name in names]
    broken = F.concat(*[F.array_repeat(F.lit(k), F.coalesce(times.cast("int"), F.lit(0))) for k, (_, times, _, _) in enumerate(said)])
    keys = [(F.col(key) if isinstance(key, str) else key).cast("string").alias(f"k{k}") for k, (_, _, key, _) in enumerate(said)]
    every = rows.select(F.col("sample_id").cast("string").alias("sample_id"), F.col("run_id").cast("string").alias("run_id"), *keys, F.explode(broken).alias("k"))
    of = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("k") + 1)
    key = reduce(lambda other, k: F.when(F.col("k") == k, F.col(f"k{k}")).otherwise(other), range(1, len(said)), F.col("k0"))
    return every.select(of([name for name, *_ in said]).alias("rule_id"), of([RULES[name][0] for name, *_ in said]).alias("rule_order"), "sample_id", "run_id", key.alias("key"), of([detail for *_, detail in said]).alias("detail"))


def _there(*columns: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*SCOPE, *columns]])


#: Rows of the tables of one part, if they are several.
PART_ROWS = 1 << 26


class _Parts:
    """Rules over many tables, some tables after the others, so that the shuffles of one part are gone before the next.

    What breaks a rule is written as it is found, a few bytes for a row, as the
    shuffles of one plan would all stay until its last row is read. Up to
    PART_ROWS rows make one part, which is a lazy plan.
    """

    def __init__(self, tables: Tables) -> None:
        sizes = {r["n"]: r["rows"] for r in _union([d.groupBy().agg(F.lit(n).alias("n"), F.count("*").alias("rows")) for n, d in tables.items()]).collect()}
        self.spark, self.parts, room = next(iter(tables.values())).sparkSession, [], 0
        for name in sorted(tables, key=lambda n: -sizes[n]):
            if not self.parts or sizes[name] > room:
                self.parts.append([])
                room = PART_ROWS
            self.parts[-1].append(name)
            room -= sizes[name]

    def parent(self, df: DataFrame) -> DataFrame:
        """``df``, computed once for all parts."""
        return scratch.stable(df) if len(self.parts) > 1 else df

    def found(self, find: Callable[[list[str]], DataFrame]) -> DataFrame:
        """All that ``find`` gives for the names of each part."""
        if len(self.parts) == 1:
            return find(self.parts[0])
        path = scratch.folder(self.spark)
        atexit.register(scratch.drop, self.spark, path)
        for names in self.parts:
            broken = find(names)
            schema = broken.schema
            broken.write.mode("append").option("compression", "zstd").parquet(path)
            del broken
            scratch.settle(self.spark)
        return self.spark.read.schema(schema).parquet(path)


def _any(rows: DataFrame, kept: list[str], found: dict[str, Column]) -> DataFrame:
    """Rows that break a rule: the ``kept`` columns, and how often they break each."""
    counted = rows.select(*kept, *[F.coalesce(times.cast("int"), F.lit(0)).alias(f"_{name}") for name, times in found.items()])
    return counted.where(reduce(lambda a, b: a | b, [F.col(f"_{name}") > 0 for name in found]))


def _stage_states(t: Tables) -> DataFrame:
    is_done = F.col("status") == "completed"
    return t["stages"].groupBy("stage_id", *SCOPE).agg(F.coalesce(F.bool_or(~is_done), F.lit(False)).alias("_open"), F.coalesce(F.bool_or(is_done), F.lit(False)).alias("_done"))


@joint("result_run", "result_stage", "result_artifact", "coverage_artifact", "result_status", "result_producer", "result_kind")
def _result_parents(t: Tables, names: set[str]) -> DataFrame:
    """Results meet each of their parents once; equal parents are counted, not multiplied."""
    rows = _result_tables(t)
    if "coverage_artifact" in names:  # contigs once more, by their other artifact and without a collection
        none = F.lit(None).cast("string")
        rows["coverage"] = t["contigs"].where("coverage_artifact_id is not null").select(none.alias("collection"), F.col("contig_id").cast("string").alias("key"), *SCOPE, none.alias("stage_id"), F.col("coverage_artifact_id").alias("artifact_id"))
    parts = _Parts(rows)
    if "result_run" in names:
        runs = t["runs"].select(*SCOPE).distinct().withColumn("_run", F.lit(True))
    if names & {"result_stage", "result_status"}:
        stages = parts.parent(_stage_states(t).drop("_done"))
    if names & {"result_artifact", "coverage_artifact", "result_producer", "result_kind"}:
        of = ["artifact_id", *SCOPE]
        made = t["artifacts"].where("artifact_id is not null").groupBy(*of, "producer_stage_id", "kind").agg(F.count("*").alias("_n"))
        made = parts.parent(made.withColumn("_first", F.row_number().over(Window.partitionBy(*of).orderBy("producer_stage_id", "kind")) == 1))
    result, once, wanted = F.col("collection").isNotNull(), F.lit(True), F.element_at(F.create_map(*[F.lit(x) for pair in RESULT_KINDS.items() for x in pair]), F.col("collection"))
    if names & {"result_artifact", "coverage_artifact", "result_producer", "result_kind"}:
        once = F.coalesce("_first", F.lit(True))  # a row that meets several kinds of an artifact
    found = {
        "result_run": lambda: result & once & _there() & F.col("_run").isNull(),
        "result_stage": lambda: result & once & _there("stage_id") & F.col("_open").isNull(),
        "result_artifact": lambda: result & _there("artifact_id") & F.col("_n").isNull(),
        "coverage_artifact": lambda: ~result & _there("artifact_id") & F.col("_n").isNull(),
        "result_status": lambda: result & once & F.col("_open"),
        "result_producer": lambda: F.when(result & ~F.col("stage_id").eqNullSafe(F.col("producer_stage_id")), F.col("_n")),
        "result_kind": lambda: F.when(F.col("kind") != wanted, F.col("_n")),
    }
    details = {
        "result_run": "result without its run", "result_stage": "result without its stage", "result_artifact": "result without its artifact", "coverage_artifact": "coverage artifact is missing",
        "result_status": "result of a stage that is not completed", "result_producer": "result and artifact come from different stages", "result_kind": "artifact kind does not match its table",
    }

    def find(of_part: list[str]) -> DataFrame:
        met = _union([rows[n] for n in of_part])
        if "result_run" in names:
            met = met.join(runs, SCOPE, "left")
        if names & {"result_stage", "result_status"}:
            met = met.join(stages, ["stage_id", *SCOPE], "left")
        if names & {"result_artifact", "coverage_artifact", "result_producer", "result_kind"}:
            met = met.join(made, of, "left")  # sorted by what differs most
        return _any(met, [*SCOPE, "key"], {n: f() for n, f in found.items() if n in names})

    return _told(parts.found(find), {n: (F.col(f"_{n}"), "key", details[n]) for n in found if n in names}, names)


@joint("duplicate_result", "repeated_expected", "open_expected", "expected_keys")
def _result_keys(t: Tables, names: set[str]) -> DataFrame:
    """Keys of results and expected keys meet once, by collection and key."""
    keys, one, none = ["key", "collection", *SCOPE], F.lit(1).cast("long"), F.lit(0).cast("long")
    results = {n: d.select(*keys, "stage_id", one.alias("a"), none.alias("e")) for n, d in _result_tables(t).items()}
    if names - {"duplicate_result"}:
        expected = t["stage_expected_keys"].select(F.col("record_id").cast("string").alias("key"), "collection", *SCOPE, "stage_id", none.alias("a"), one.alias("e"))
        results = results or {"": expected.where(F.lit(False))}
    parts = _Parts(results)
    if names & {"open_expected", "expected_keys"}:
        stages = parts.parent(_stage_states(t))
    found = {
        "duplicate_result": (lambda: (F.col("upto") > 1) & (F.col("upto") - F.col("a") <= 1), "key", "duplicate key of a result"),
        "repeated_expected": (lambda: F.col("e") > 1, "stage_id", "stage repeats an expected key"),
        "open_expected": (lambda: F.when(F.col("_open"), F.col("e")), "key", "stage that is not completed expects rows"),
        "expected_keys": (lambda: F.col("_done") & ((F.col("a") > 0) != (F.col("e") > 0)), F.concat_ws(":", "collection", "key"), "expected and actual keys differ"),
    }

    def find(of_part: list[str]) -> DataFrame:
        both = _union([results[n] for n in of_part])
        if names - {"duplicate_result"}:
            known = lambda names: F.coalesce(F.col("collection").isin(names), F.lit(False))
            # those of collections that are no table come with the first part
            of = F.lit(True) if len(parts.parts) == 1 else known(of_part) | ~known(list(results)) if of_part is parts.parts[0] else known(of_part)
            both = both.unionByName(expected.where(of))
        sums = both.repartition(*keys).groupBy(*keys, "stage_id").agg(F.sum("a").alias("a"), F.sum("e").alias("e"))
        # a running sum passes one once, and needs no look at the whole group
        rows = sums.withColumn("upto", F.sum("a").over(Window.partitionBy(*keys).orderBy("stage_id").rowsBetween(Window.unboundedPreceding, 0)))
        if names & {"open_expected", "expected_keys"}:
            rows = rows.join(stages, ["stage_id", *SCOPE], "left")
        repeated = F.when(F.col("e") > 1, F.col("stage_id")).alias("stage_id")
        return _any(rows, [*keys, repeated], {n: f() for n, (f, *_) in found.items() if n in names})

    return _told(parts.found(find), {n: (F.col(f"_{n}"), *said) for n, (_, *said) in found.items() if n in names}, names)


@joint("contig_count", "assembly_length", "n50_present", "n50_absent", "n50_bound", "n50_value")
def _assembly_sums(t: Tables, names: set[str]) -> DataFrame:
    """Assemblies meet the sums of their contigs once."""
    keys = [*SCOPE, "assembly_id"]
    by_length = t["contigs"].groupBy(*keys, "length_bp").agg(F.count("*").alias("n"), F.sum("length_bp").alias("bp"))
    w = Window.partitionBy(*keys)
    run = by_length.withColumns({"upto": F.sum("bp").over(w.orderBy(F.desc("length_bp")).rowsBetween(Window.unboundedPreceding, 0)), "total": F.sum("bp").over(w)})
    half = F.when(F.col("upto") >= F.expr("(total + 1) div 2"), F.col("length_bp"))
    seen = run.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bp").alias("bp"), F.max("length_bp").alias("longest"), F.max(half).alias("seen_n50"))
    rows = t["assemblies"].join(seen, keys, "left").na.fill(0, ["n", "bp"])
    return _told(rows, {name: (F.expr(condition), "assembly_id", detail) for name, (condition, detail) in ASSEMBLY.items()}, names)


@joint("qc_target", "taxonomy_target")
def _finding_targets(t: Tables, names: set[str]) -> DataFrame:
    """Findings meet their targets once; only targets that a finding could name are compared."""
    own = [*SCOPE, "target_kind", "target_id"]
    rows = _union([t[n].select(*SCOPE, "target_kind", F.col("target_id").cast("string").alias("target_id"), F.col("record_id").cast("string").alias("record_id"), F.lit(f"{n}_target").alias("of")) for n in ("qc", "taxonomy")])
    known = [t[n].select(*SCOPE, F.lit(kind).alias("target_kind"), F.col(k).cast("string").alias("target_id")) for kind, (n, k) in TARGETS.items() if n in t]
    # an anti join would be pushed below the union and read all targets twice
    lost = rows.join(_union(known).withColumn("_known", F.lit(True)), own, "left").where("_known is null")
    return _told(lost, {"qc_target": (F.col("of") == "qc_target", "record_id", "measurement without its target"), "taxonomy_target": (F.col("of") == "taxonomy_target", "record_id", "assertion without its target")}, names)


@joint("feature_contig", "feature_bounds")
def _feature_contigs(t: Tables, names: set[str]) -> DataFrame:
    """Features meet their contigs once."""
    rows = _features(t).join(t["contigs"].select(*SCOPE, "contig_id", "length_bp", F.lit(True).alias("_contig")), [*SCOPE, "contig_id"], "left")
    return _told(rows, {"feature_contig": (_there("contig_id") & F.col("_contig").isNull(), "key", "feature without its contig"), "feature_bounds": (F.col("end") > F.col("length_bp"), "key", "feature beyond its contig")}, names)


@joint("gene_bin", "genetic_code")
def _gene_bins(t: Tables, names: set[str]) -> DataFrame:
    """Genes meet their bins once, and the codes of their sample."""
    bins = t["bins"].groupBy(*SCOPE, "bin_id").agg(F.coalesce(F.bool_or(F.col("candidate_class") == "bacterial_archaeal_candidate"), F.lit(False)).alias("_fixed"))
    codes = t["samples"].where("genetic_code is not null").groupBy("sample_id").agg(F.collect_list("genetic_code").alias("_codes"))
    rows = t["genes"].select(*SCOPE, "gene_id", "bin_id", "genetic_code").join(bins, [*SCOPE, "bin_id"], "left").join(codes, "sample_id", "left")
    other = F.when(F.col("_fixed") & F.col("genetic_code").isNotNull(), F.size(F.filter(F.coalesce("_codes", F.array().cast("array<int>")), lambda c: c != F.col("genetic_code"))))
    return _told(rows, {"gene_bin": (_there("bin_id") & F.col("_fixed").isNull(), "gene_id", "gene without its bin"), "genetic_code": (other, "gene_id", "gene code differs from the sample's")}, names)


def violations(tables: Tables, names: list[str] | None = None) -> DataFrame:
    """All violations of all rules whose tables are there, or of the named ones."""
    wanted = {}
    for name, (number, needs, find) in sorted(RULES.items(), key=lambda x: x[1][0]):
        if (names is None or name in names) and all(n in tables for n in needs) and (number not in ANY_RESULT or any(n in tables for n in RESULT_KEYS)) and (number not in ANY_FEATURE or any(n in tables for n in ("ssu", "viruses", "genes"))):
            wanted[name] = find
    parts = []
    for group, find in JOINT:
        several = {n for n in group if n in wanted}
        if len(several) > 1:
            parts.append(find(tables, several))
            wanted = {n: f for n, f in wanted.items() if n not in several}
    parts += [find(tables).select(F.lit(name).alias("rule_id"), F.lit(RULES[name][0]).alias("rule_order"), "*") for name, find in wanted.items()]
    return _union(parts)


def require_valid(tables: Tables) -> None:
    """Raises with the first violated rule and one of its keys."""
    first = violations(tables).orderBy("rule_order", "sample_id", "run_id", "key").first()
    if first is not None:
        raise ValueError(f"{first.detail}: {first.sample_id} {first.run_id} {first.key}")
