"""Native evidence of a run: registered reports, read only from bytes whose digest was verified.

Eight methods have a state each: ``unassessed`` without a stage, else what
the stage says, and ``unavailable`` if a registered report is not there. Every
report leaves a receipt, and every row names the receipt that it comes from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import path_name
from tessella.sources import artifacts as files
from tessella.sources import documents

RUN = ["sample_id", "run_id"]
SCOPE = [*RUN, "assembly_id"]
#: Methods with the column of their reports that names the bin, report kinds, fields of a stage's version.
METHODS = {"routing": "bin_id", "checkeuk": "genome", "checkeuk_detail": "genome", "gvclass": "query", "checkm2": "Name", "checkm1": "Bin Id", "gtdbtk": "user_genome", "quickclade": "#QueryName"}
KINDS = ["qc_report", "taxonomy_report"]
VERSION = ["tool_name", "tool_version", "database_name", "database_version"]


def stage_of(method: Column) -> Column:
    """The stage that runs a method."""
    return F.when(method == "quickclade", F.lit("binning")).otherwise(F.regexp_replace(method, "_detail$", ""))


def method_of(artifact: Column, stage: Column) -> Column:
    """The method whose report an artifact is; null for other reports."""
    own = F.when(stage.isin(list(METHODS)), stage)
    return F.when(artifact == "checkeuk.detail", F.lit("checkeuk_detail")).when(artifact == "quickclade", F.lit("quickclade")).otherwise(own)


def reports(t: dict[str, DataFrame], paths: list[str]) -> DataFrame:
    """Registered reports with their method, verified content and state of verification.

    A report that is not there although its stage is completed raises, as does one whose bytes changed.
    """
    own = t["artifacts"].where(F.col("kind").isin(KINDS))
    found = files.contents(own.sparkSession, paths, own)
    state = t["stages"].select(*RUN, F.col("stage_id").alias("producer_stage_id"), F.col("status").alias("_status"))
    both = found.join(state, [*RUN, "producer_stage_id"], "left")
    lost = F.col("content").isNull() & (F.col("_status") == "completed")
    content = F.when(lost, F.raise_error(F.concat(F.lit("a completed stage needs its registered evidence: "), F.col("artifact_id")))).otherwise(F.col("content"))
    verification = F.when(content.isNull(), F.lit("unavailable")).otherwise(F.lit("verified"))
    return both.select(*own.columns, F.concat(F.lit("artifact:"), F.col("artifact_id")).alias("source_id"), method_of(F.col("artifact_id"), F.col("producer_stage_id")).alias("method"), content.alias("content"), verification.alias("verification"))


def receipts(found: DataFrame) -> DataFrame:
    """One row for each registered report: what it is, and whether its bytes were verified."""
    return found.drop("content", "method")


def used(found: DataFrame) -> DataFrame:
    """The reports of known methods; of those with the same bytes for a method, the one of the least id."""
    first = found.where("method is not null").groupBy(*RUN, "method", "sha256").agg(F.min("artifact_id").alias("artifact_id"))
    return found.join(first, [*RUN, "method", "sha256", "artifact_id"])


def states(t: dict[str, DataFrame], found: DataFrame) -> DataFrame:
    """(sample_id, run_id, method, status, stage_status, status_reason, version fields, source_ids): eight rows for each run."""
    every = t["runs"].select(*RUN, F.explode(F.array(*map(F.lit, METHODS))).alias("method")).withColumn("stage_id", stage_of(F.col("method")))
    stage = t["stages"].select(*RUN, "stage_id", "status", "status_reason", *VERSION)
    sources = used(found).groupBy(*RUN, "method").agg(F.array_sort(F.collect_list("source_id")).alias("source_ids"), F.bool_or(F.col("verification") == "unavailable").alias("lost"))
    both = every.join(stage, [*RUN, "stage_id"], "left").join(sources, [*RUN, "method"], "left")
    status = F.coalesce("status", F.lit("unassessed"))
    lost = F.coalesce("lost", F.lit(False))
    return both.select(
        *RUN, "method", F.when(lost, F.lit("unavailable")).otherwise(status).alias("status"), status.alias("stage_status"), F.when(lost, F.lit("registered_artifact_unavailable")).otherwise(F.col("status_reason")).alias("status_reason"),
        *VERSION, F.coalesce("source_ids", F.array().cast("array<string>")).alias("source_ids"),
    )


def rows(found: DataFrame) -> DataFrame:
    """(sample_id, run_id, method, source_id, ordinal, bin_id, cells) of every row of the verified reports.

    A report without its method's identifier column raises.
    """
    keep = used(found).where("content is not null").select(*RUN, "method", "source_id", "content")
    parsed = files.parsed(keep)
    column = F.element_at(F.create_map(*[F.lit(x) for pair in METHODS.items() for x in pair]), F.col("method"))
    name = F.element_at("cells", column)
    checked = F.when(name.isNull(), F.raise_error(F.concat(F.lit("a report lacks its identifier column: "), F.col("method")))).otherwise(name)
    return parsed.select(*RUN, "method", "source_id", "ordinal", path_name(checked).alias("bin_id"), F.map_concat("cells", F.create_map(F.lit("source_id"), F.col("source_id"))).alias("cells"))


def pieces(t: dict[str, DataFrame], found: DataFrame) -> list[DataFrame]:
    """The blocks ``evidence`` and ``sources`` of every assembly's document, in pieces.

    Of the reports' rows, an assembly's document has those of its bins.
    """
    scopes = t["runs"].select(*RUN).join(t["assemblies"].select(*SCOPE), RUN, "left")
    each = scopes.join(states(t, found), RUN)
    at = lambda name: F.array(F.lit("evidence"), F.col("method"), F.lit(name))
    out = [documents.value(each, SCOPE, at(c), F.col(c)) for c in ("status", "stage_status", "status_reason", *VERSION, "source_ids")]
    out.append(documents.empty_lists(each, SCOPE, at("rows")))
    mine = rows(found).join(t["bins"].select(*SCOPE, "bin_id"), [*RUN, "bin_id"]).withColumn("place", F.lpad("ordinal", 12, "0"))
    out.append(documents.items(mine, SCOPE, at("rows"), ["source_id", "place"], F.col("cells")))
    receipts_ = scopes.join(receipts(found), RUN)
    out += [documents.empty_lists(scopes, SCOPE, ["sources"]), documents.items(receipts_, SCOPE, ["sources"], ["source_id"])]
    return out


def bundled(t: dict[str, DataFrame], found: DataFrame, blocks: list[DataFrame]) -> DataFrame:
    """Documents of all assemblies with their evidence, streamed: ``blocks`` are the other pieces."""
    return documents.streamed([*blocks, *pieces(t, found)], SCOPE)

