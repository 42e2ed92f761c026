"""The report's tables over a catalog, as Spark plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCOPE = ["sample_id", "run_id"]
STAGE = [*SCOPE, "stage_id"]
FEATURE_KINDS = ["gene_annotation", "protein_fasta", "functional_annotation"]
Tables = dict[str, DataFrame]

#: Plain projections with their table, columns and order, as the report shows them.
PROJECTIONS: dict[str, tuple[str, list[str], list[str]]] = {
    "metadata": ("catalog_metadata", ["schema_version", "workflow_name", "workflow_version", "source_revision"], ["schema_version"]),
    "runs": ("runs", [*SCOPE, "platform", "rna_technology", "basecaller", "basecaller_model", "library_prep"], SCOPE),
    "read_filtering": ("read_stats", [*SCOPE, "record_id", "total_reads", "total_bases", "retained_reads", "retained_bases", "rejected_reads", "rejected_bases"], [*SCOPE, "record_id"]),
    "assemblies": ("assemblies", [*SCOPE, "assembly_id", "assembly_length_bp", "contig_count", "n50_bp", "gc_fraction"], [*SCOPE, "assembly_id"]),
    "bins": ("bins", [*SCOPE, "bin_id", "assembly_id", "candidate_class"], [*SCOPE, "bin_id"]),
    "ssu": ("ssu", [*SCOPE, "record_id", "contig_id", "ssu_type", "start", "end", "strand", "hit_accession", "taxon_name", "taxonomy_assignment_method", "reference_identifiers", "reference_source", "reference_versions", "reference_taxonomy", "identity_percent", "query_coverage_percent"], [*SCOPE, "contig_id", "start", "record_id"]),
    "artifacts": ("artifacts", [*SCOPE, "artifact_id", "kind", "path", "sha256", "size_bytes", "producer_stage_id"], [*SCOPE, "kind", "artifact_id"]),
}
#: Tables with the tool of their stage: table, own columns, stage columns, order.
WITH_STAGE: dict[str, tuple[str, list[str], list[str], list[str]]] = {
    "taxonomy": ("taxonomy", [*SCOPE, "record_id", "target_kind", "target_id", "rank", "taxon_name", "taxon_id", "score", "lineage_confidence"], ["tool_name", "tool_version", "database_name", "database_version"], [*SCOPE, "target_kind", "target_id", "rank"]),
    "viruses": ("viruses", [*SCOPE, "record_id", "contig_id", "start", "end", "strand", "score", "viral_taxon"], ["tool_name", "tool_version"], [*SCOPE, "contig_id", "start", "tool_name"]),
    "phenotypes": ("phenotypes", [*SCOPE, "record_id", "bin_id", "raw_class", "raw_score", "threshold", "passes_threshold", "thresholded_class", "is_applicable", "applicability_reason"], ["tool_name", "tool_version"], [*SCOPE, "bin_id", "tool_name"]),
}


def projection(t: Tables, name: str) -> DataFrame:
    table, columns, order = PROJECTIONS[name]
    return t[table].select(*columns).orderBy(*order)


def with_stage(t: Tables, name: str) -> DataFrame:
    table, own, tool, order = WITH_STAGE[name]
    return t[table].join(t["stages"].select(*STAGE, *tool), STAGE).select(*own, *tool).orderBy(*order)


def quality(t: Tables) -> DataFrame:
    """Every measurement with its tool, all columns."""
    return t["qc"].join(t["stages"].select(*STAGE, "tool_name", "tool_version"), STAGE).orderBy(*SCOPE, "target_kind", "target_id", "tool_name")


def same_rank_conflicts(t: Tables) -> DataFrame:
    """Ranks of a target with several names. Both sets are small and form map-side, in one shuffle."""
    keys = [*SCOPE, "target_kind", "target_id", "rank"]
    named = t["taxonomy"].join(t["stages"].select(*STAGE, "tool_name"), STAGE)
    found = named.groupBy(*keys).agg(F.size(F.collect_set("taxon_name")).alias("taxon_labels"), F.array_join(F.array_sort(F.collect_set(F.concat("tool_name", F.lit(": "), "taxon_name"))), ",").alias("evidence"))
    return found.where("taxon_labels > 1").orderBy(*keys)


def coding_models(t: Tables) -> DataFrame:
    counted = t["genes"].groupBy(*SCOPE, "bin_id", "stage_id").agg(F.count("*").alias("coding_models"))
    columns = [*SCOPE, "bin_id", "stage_id", F.col("name").alias("stage_name"), "status", "status_reason", "tool_name", "tool_version", "coding_models"]
    return counted.join(t["stages"], STAGE).select(*columns).orderBy(*SCOPE, "bin_id", "stage_id")


def annotation_hits(t: Tables) -> DataFrame:
    keys = [*SCOPE, "database_name", "database_version"]
    return t["annotations"].groupBy(*keys).agg(F.count("*").alias("annotation_hits"), F.countDistinct("gene_id").alias("annotated_models")).orderBy(*keys)


def gene_caller_states(t: Tables, word: str = "braker") -> DataFrame:
    wanted = t["stages"].where(F.lower("name").contains(word) | F.lower("tool_name").contains(word))
    counted = t["genes"].groupBy(*STAGE).agg(F.count("gene_id").alias("cataloged_models"))
    out = wanted.join(counted, STAGE, "left").na.fill(0, ["cataloged_models"])
    return out.select(*STAGE, "name", "status", "status_reason", "tool_name", "tool_version", "cataloged_models").orderBy(*STAGE)


def feature_artifacts(t: Tables) -> DataFrame:
    return projection(t, "artifacts").where(F.col("kind").isin(FEATURE_KINDS))


def stage_states(t: Tables) -> DataFrame:
    """Both children are counted before they meet the stages, so that they never multiply."""
    i = t["stage_inputs"].groupBy(*STAGE).agg(F.countDistinct("position").alias("input_artifacts"))
    e = t["stage_expected_keys"].groupBy(*STAGE).agg(F.countDistinct("collection", "record_id").alias("expected_records"))
    return t["stages"].join(i, STAGE, "left").join(e, STAGE, "left").na.fill(0, ["input_artifacts", "expected_records"]).orderBy(*STAGE)


def record_counts(t: Tables) -> DataFrame:
    names = [n for n in t if n != "catalog_metadata"]
    return reduce(DataFrame.union, [t[n].agg(F.count("*").alias("records")).select(F.lit(n).alias("table"), "records") for n in names])


def read_outcomes(t: Tables, n: int = 30) -> DataFrame:
    sums = t["read_stats"].groupBy(*SCOPE).agg(F.sum("retained_reads").alias("retained_reads"), F.sum("rejected_reads").alias("rejected_reads"))
    sums = sums.withColumn("total", F.col("retained_reads") + F.col("rejected_reads"))
    return sums.orderBy(F.desc("total"), *SCOPE).limit(n).orderBy(*SCOPE)


def assembly_lengths(t: Tables, n: int = 30) -> DataFrame:
    sums = t["assemblies"].groupBy(*SCOPE).agg(F.sum("assembly_length_bp").alias("assembly_length_bp"))
    return sums.orderBy(F.desc("assembly_length_bp"), *SCOPE).limit(n).orderBy(*SCOPE)


def bins_per_class(t: Tables) -> DataFrame:
    return t["bins"].groupBy("candidate_class").agg(F.count("*").alias("bins"))


def identity_problems(t: Tables, provenance: DataFrame) -> DataFrame:
    """(sample_id, run_id, detail): executions (sample_id, run_id, original_source_revision) that are not those of the catalog."""
    source = t["catalog_metadata"].agg(F.count("*").alias("n"), F.min("source_revision").alias("source")).first()
    same = F.col("original_source_revision").eqNullSafe(F.lit(source.source)) if source.n == 1 else F.lit(False)
    other = provenance.where(~same).select(*SCOPE, F.lit("source revision differs").alias("detail"))
    return other.union(provenance.join(t["runs"].select(*SCOPE), SCOPE, "left_anti").select(*SCOPE, F.lit("run is not in the catalog").alias("detail")))
