"""One nested document for each assembly of a run, with digests; a run without assembly has one.

``streamed`` writes them piece by piece and holds no list of an assembly.
``documents`` gathers every table by scope before the join and gives a row for
each document; text and digest are the same where no list is empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.operators.measures import inventory_status
from tessella.operators.parse import PRIMARY
from tessella.sources import documents as doc
from tessella.sources.sinks import canonical

RUN = ["sample_id", "run_id"]
SCOPE = [*RUN, "assembly_id"]
NO_DEFAULTS = 1796
Tables = dict[str, DataFrame]


def _gathered(rows: DataFrame, name: str, order: list[str]) -> DataFrame:
    """One sorted list of records for each scope."""
    record = F.struct(*[c for c in rows.columns if c != "scope_assembly"])
    listed = rows.groupBy(*RUN, F.col("scope_assembly").alias("assembly_id")).agg(F.array_sort(F.collect_list(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], record.alias("r")))).alias("x"))
    return listed.select(*SCOPE, F.transform("x", lambda e: e["r"]).alias(name))


def scoped(t: Tables) -> Tables:
    """Bins, contigs and what hangs on them, each row with the assembly that it belongs to."""
    out = {n: t[n].withColumn("scope_assembly", F.col("assembly_id")) for n in ("bins", "contigs")}
    of_bin = t["bins"].select(*RUN, "bin_id", F.col("assembly_id").alias("scope_assembly"))
    of_contig = t["contigs"].select(*RUN, "contig_id", F.col("assembly_id").alias("scope_assembly"))
    for n in ("memberships", "phenotypes"):
        if n in t:
            out[n] = t[n].join(of_bin, [*RUN, "bin_id"])
    for n in ("ssu", "viruses"):
        if n in t:
            out[n] = t[n].join(of_contig, [*RUN, "contig_id"])
    own = t["assemblies"].select(*RUN, F.lit("assembly").alias("target_kind"), F.col("assembly_id").alias("target_id"), F.col("assembly_id").alias("scope_assembly"))
    targets = own.union(of_bin.select(*RUN, F.lit("bin"), "bin_id", "scope_assembly")).union(of_contig.select(*RUN, F.lit("contig"), "contig_id", "scope_assembly"))
    for n in ("qc", "taxonomy"):
        if n in t:
            out[n] = t[n].join(targets, [*RUN, "target_kind", "target_id"])
    if "qc" in out:
        out["qc"] = out["qc"].join(t["stages"].select(*RUN, "stage_id", "tool_name", "tool_version", "status"), [*RUN, "stage_id"])
    return out


def policy(command: Column) -> dict[str, Column]:
    """Least mapping quality and excluded flags of a command that keeps primary alignments only, else null."""
    view = F.regexp_extract(command, r"samtools\s+view\s+([^;|\n]+)", 1)
    flags, quality = (F.regexp_extract(view, rf"-{x}\s+([0-9]+)", 1).try_cast("int") for x in "Fq")
    mask = F.when(command.rlike(r"samtools\s+coverage\s+[^;|\n]"), flags.bitwiseOR(NO_DEFAULTS))
    primary = F.coalesce(mask.bitwiseAND(PRIMARY) == PRIMARY, F.lit(False))
    return {"minimum_mapq": F.when(primary, quality), "excluded_sam_flags": F.when(primary, mask)}


def coverage_problems(coverage: DataFrame, contigs: DataFrame) -> DataFrame:
    """Contigs whose coverage row is missing, repeated, partial or out of bounds."""
    seen = coverage.groupBy(*RUN, "contig_id").agg(F.count("*").alias("rows"), F.min("numreads").alias("reads"), F.min("covbases").alias("least"), F.max("covbases").alias("most"), F.min("startpos").alias("s"), F.max("endpos").alias("e"))
    both = contigs.select(*RUN, "contig_id", "length_bp").join(seen, [*RUN, "contig_id"], "full_outer")
    bad = F.col("length_bp").isNull() | F.col("rows").isNull() | (F.col("rows") > 1) | (F.col("reads") < 0) | (F.col("least") < 0) | (F.col("most") > F.col("length_bp")) | (F.col("s") != 1) | (F.col("e") != F.col("length_bp"))
    return both.where(F.coalesce(bad, F.lit(True))).select(*RUN, "contig_id")


def mapping(t: Tables, coverage: DataFrame) -> DataFrame:
    """Read counts of every assembly with their status; null where unknown, never zero."""
    with_reads = t["contigs"].join(coverage.select(*RUN, "contig_id", "numreads"), [*RUN, "contig_id"], "left")
    member = t["memberships"].select(*RUN, "contig_id", F.lit(True).alias("binned"))
    sums = with_reads.join(member, [*RUN, "contig_id"], "left").groupBy(*SCOPE).agg(F.sum("numreads").alias("assembly_mapped_reads"), F.sum(F.when(F.col("binned"), F.col("numreads")).otherwise(0)).alias("bin_mapped_reads"), F.count(F.when(F.col("coverage_artifact_id").isNull(), 1)).alias("bare"), F.count(F.when(F.col("numreads").isNull(), 1)).alias("unread"))
    kept = t["read_stats"].where("stage_id = 'read_qc' and retained_reads is not null").groupBy(*RUN).agg(F.count("*").alias("rows"), F.first("retained_reads").alias("input_reads")).where("rows = 1").drop("rows")
    command = t["stages"].where("stage_id = 'binning'").select(*RUN, *[c.alias(n) for n, c in policy(F.coalesce("command", F.lit(""))).items()])
    all_ = t["assemblies"].select(*SCOPE).join(sums, SCOPE, "left").join(kept, RUN, "left").join(command, RUN, "left")
    reason = F.when(F.coalesce(F.col("bare") > 0, F.lit(True)), F.lit("coverage_not_registered")).when(F.col("unread") > 0, F.lit("coverage_artifact_unavailable")).when(F.col("minimum_mapq").isNull() | F.col("excluded_sam_flags").isNull(), F.lit("primary_alignment_policy_unavailable")).when(F.col("input_reads").isNull(), F.lit("denominator_unavailable"))
    status = F.when(reason.isNull(), F.lit("available")).when(reason == "denominator_unavailable", F.lit("partial")).otherwise("unavailable")
    known = lambda c: F.when(status != "unavailable", c)
    rest = F.col("input_reads") - F.col("assembly_mapped_reads")
    checked = F.when(rest < 0, F.raise_error(F.lit("more primary reads than retained ones"))).otherwise(rest)
    return all_.select(*SCOPE, status.alias("status"), reason.alias("status_reason"), "input_reads", "minimum_mapq", "excluded_sam_flags", known(F.col("assembly_mapped_reads")).alias("assembly_mapped_reads"), known(F.col("bin_mapped_reads")).alias("bin_mapped_reads"), known(F.col("assembly_mapped_reads") - F.col("bin_mapped_reads")).alias("unbinned_mapped_reads"), F.when(status == "available", checked).alias("without_qualifying_alignment_reads"))


ORDERS = {"bins": ["bin_id"], "contigs": ["contig_id"], "memberships": ["membership_id"]}


def _heads(t: Tables, coverage: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scope and assembly, scope with inventory state and mapping block) of every document."""
    shown = inventory_status(t["assemblies"], t["contigs"], SCOPE)
    state = F.when(F.col("status") == "error", F.raise_error(F.lit("contigs exceed the assembly's totals"))).otherwise(F.col("status"))
    inventory = shown.select(*SCOPE, state.alias("inventory_status"))
    counts = mapping(t, coverage).join(inventory, SCOPE)
    partial = F.col("inventory_status") == "partial"
    counts = counts.withColumns({"status": F.when(partial, F.lit("partial")).otherwise(F.col("status")), "status_reason": F.when(partial, F.lit("partial_assembly_inventory")).otherwise(F.col("status_reason")), "without_qualifying_alignment_reads": F.when(~partial, F.col("without_qualifying_alignment_reads"))})
    block = counts.select(*SCOPE, "inventory_status", F.struct(*[c for c in counts.columns if c not in (*SCOPE, "inventory_status")]).alias("mapping"))
    keyed = t["runs"].select(*RUN).join(t["assemblies"], RUN, "left").select(*SCOPE, F.when(F.col("assembly_id").isNotNull(), F.struct(*[c for c in t["assemblies"].columns if c not in RUN])).alias("assembly"))
    return keyed, block


def documents(t: Tables, coverage: DataFrame) -> DataFrame:
    """(sample_id, run_id, assembly_id, document, canonical, sha256); every list of an assembly in one row, for catalogs of moderate size."""
    keyed, block = _heads(t, coverage)
    lists = [_gathered(d, n, ORDERS.get(n, ["record_id"])) for n, d in scoped(t).items()]
    whole = reduce(lambda a, b: a.join(b, SCOPE, "left"), [block, *lists], keyed)
    named = [c for c in whole.columns if c not in SCOPE]
    document = whole.select(*SCOPE, F.to_json(F.struct(*SCOPE, F.lit(1).alias("schema_version"), *named), {"ignoreNullFields": "false"}).alias("document"))
    return canonical(document)


def pieces(t: Tables, coverage: DataFrame) -> list[DataFrame]:
    """The same documents in pieces for ``sources.documents.streamed``, whose lists are never gathered; a list without items is empty, not null."""
    keyed, block = _heads(t, coverage)
    scopes = keyed.select(*SCOPE)
    both = keyed.join(block, SCOPE, "left")
    out = [doc.value(both, SCOPE, [c], F.lit(1) if c == "schema_version" else F.col(c)) for c in (*SCOPE, "schema_version", "assembly", "inventory_status", "mapping")]
    for name, rows in scoped(t).items():
        own = rows.withColumn("assembly_id_", F.col("scope_assembly")).drop("scope_assembly")
        record = F.struct(*[c for c in rows.columns if c != "scope_assembly"])
        placed = own.select(*RUN, F.col("assembly_id_").alias("assembly_id"), *[F.col(c).alias(f"o{k}") for k, c in enumerate(ORDERS.get(name, ["record_id"]))], record.alias("record"))
        out += [doc.empty_lists(scopes, SCOPE, [name]), doc.items(placed, SCOPE, [name], [c for c in placed.columns if c.startswith("o")], F.col("record"))]
    return out


def streamed(t: Tables, coverage: DataFrame, more: list[DataFrame] = []) -> DataFrame:  # noqa: B006
    """(sample_id, run_id, assembly_id, part, text, sha256, size_bytes): documents in parts, with further pieces such as evidence."""
    return doc.streamed([*pieces(t, coverage), *more], SCOPE)
