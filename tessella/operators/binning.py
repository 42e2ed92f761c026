"""From assemblies and bins to catalog rows, and from loci and viruses on contigs to bins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import bin_name, number, stem
from tessella.operators import native
from tessella.operators.keys import coverage, duplicates
from tessella.operators.native import Parsed

#: What makes a locus eukaryotic, how a provirus names its contig, least length of a classified contig, names of the quality tools.
EUKARYOTIC_MODEL, EUKARYOTIC = "RF01960", "Eukaryota"
PROVIRUS_MARK = "|provirus_"
LEAST_CLASSIFIED = 1000
TOOLS = {"checkeuk": "checkeuk", "checkm1": "checkm1", "checkm2": "checkm2", "gvclass": "gvclass", "gtdb-tk": "gtdbtk", "gtdbtk": "gtdbtk", "symclatron": "symclatron", "quickclade": "quickclade", "busco": "busco"}


def assembled(records: DataFrame, keys: list[str] = []) -> Parsed:  # noqa: B006
    """Contigs of assemblies (keys, name, sequence) with length and GC share; a name that comes twice is a problem."""
    upper, size = F.upper("sequence"), F.length("sequence").cast("long")
    gc = F.length(F.regexp_replace(upper, "[^GC]", "")).cast("long")
    rows = records.select(*keys, F.col("name").alias("contig_id"), size.alias("length_bp"), gc.alias("gc_bp"), (gc / size).alias("gc_fraction"))
    twice = duplicates(rows, [*keys, "contig_id"]).select(F.col("contig_id").alias("target"), F.lit("repeated contig").alias("detail"))
    return Parsed({"contigs": rows}, twice, rows.select(F.col("contig_id").alias("target")))


def _differ(expected: DataFrame, actual: DataFrame, key: str, what: str) -> DataFrame:
    return coverage(expected, actual, [key]).select(F.col(key).cast("string").alias("target"), F.concat(F.lit(f"{what}: "), "side").alias("detail"))


def binned(contigs: DataFrame, depths: DataFrame, records: DataFrame, clades: DataFrame | None) -> Parsed:
    """Contigs with their depth, bins, memberships, and a lineage row of each bin.

    ``depths`` are the native rows of a coverage table (#rname, meandepth),
    ``records`` the sequences of all bin files (path, name), ``clades`` the
    native rows that name a lineage for each bin. Depths must cover the
    contigs exactly, lineages the bins; members must be contigs, each in one
    bin; bins without lineages are a problem unless there are none.
    """
    depth = depths.select(F.col("#rname").alias("contig_id"), number(F.col("meandepth")).alias("mean_depth_x"))
    deep = contigs.join(depth.dropDuplicates(["contig_id"]), "contig_id", "left")
    members = records.select(bin_name(F.col("path")).alias("bin_id"), F.col("name").alias("contig_id"))
    bins = members.select("bin_id").distinct().withColumn("candidate_class", F.lit("unresolved"))
    found = [
        _differ(contigs, depth, "contig_id", "coverage and contigs differ"), duplicates(depth, ["contig_id"]).select(F.col("contig_id").alias("target"), F.lit("repeated in coverage").alias("detail")),
        depth.where(F.col("mean_depth_x").isNull() | (F.col("mean_depth_x") < 0)).select(F.col("contig_id").alias("target"), F.lit("depth").alias("detail")),
        members.join(contigs.select("contig_id"), "contig_id", "left_anti").select(F.col("contig_id").alias("target"), F.lit("member is no contig").alias("detail")),
        duplicates(members, ["contig_id"]).select(F.col("contig_id").alias("target"), F.lit("in more than one place").alias("detail")),
    ]
    rows = {"contigs": deep, "bins": bins, "memberships": members.select(F.concat_ws(":", "bin_id", "contig_id").alias("membership_id"), "bin_id", "contig_id")}
    if clades is None:
        found.append(bins.select(F.col("bin_id").alias("target"), F.lit("no lineage").alias("detail")))
    else:
        named = clades.select(stem(F.col("#QueryName")).alias("bin_id"), "lineage", "R_TaxID")
        found += [_differ(bins, named, "bin_id", "lineages and bins differ"), duplicates(named, ["bin_id"]).select(F.col("bin_id").alias("target"), F.lit("repeated lineage").alias("detail"))]
        rows["taxonomy"] = named.select(F.concat(F.lit("quickclade:"), "bin_id").alias("record_id"), F.lit("bin").alias("target_kind"), F.col("bin_id").alias("target_id"), F.lit("lineage").alias("rank"), F.col("lineage").alias("taxon_name"), F.col("R_TaxID").alias("taxon_id"))
    return Parsed(rows, reduce(DataFrame.union, found), bins.select(F.col("bin_id").alias("target")))


def _text(table: DataFrame, c: str) -> Column:
    return F.col(c) if c in table.columns else F.lit("")


def linked_loci(table: DataFrame, contig_bins: DataFrame) -> DataFrame:
    """(bin_id, ordinal, item, record) of the eukaryotic loci on contigs of bins, as ``routing.bin_facts`` takes them.

    ``table`` has the native columns and ``ordinal``. A locus is eukaryotic if
    its domain says so or a lineage begins so; older tables lack the lineages.
    """
    lineages = [_text(table, c).startswith(EUKARYOTIC) for c in ("reference_taxonomy", "blast_candidate_taxonomy")]
    own = table.where((F.col("model") == EUKARYOTIC_MODEL) & ((F.col("taxonomy_domain") == EUKARYOTIC) | lineages[0] | lineages[1]))
    record = F.struct("name", "contig_name", "taxonomy", "taxonomy_domain", *[_text(table, c).alias(c) for c in ("reference_taxonomy", "blast_candidate_taxonomy")])
    rows = own.select(F.col("contig_name").alias("contig_id"), "ordinal", F.concat("name", F.lit("@"), "contig_name").alias("item"), record.alias("record"))
    return rows.join(contig_bins.select("contig_id", "bin_id"), "contig_id").drop("contig_id")


def linked_viruses(table: DataFrame, contig_bins: DataFrame) -> DataFrame:
    """(bin_id, ordinal, item, record) of the viral calls on contigs of bins; a provirus belongs to the contig that its name begins with."""
    contig = F.substring_index("seq_name", PROVIRUS_MARK, 1)
    rows = table.select(contig.alias("contig_id"), "ordinal", F.col("seq_name").alias("item"), F.struct("seq_name", "virus_score", "taxonomy").alias("record"))
    return rows.join(contig_bins.select("contig_id", "bin_id"), "contig_id").drop("contig_id")


def classifiable(contigs: DataFrame, least: int = LEAST_CLASSIFIED) -> DataFrame:
    """Contigs long enough to be classified; the others count as unclassified."""
    return contigs.where(F.col("length_bp") >= least)


def quality(tool: str, table: DataFrame, detail: DataFrame | None = None, evidence: tuple[DataFrame, ...] | None = None) -> Parsed:
    """The parser of a quality tool by the tool's name, however it is written.

    A detail table belongs to CheckEUK alone, calls that decide applicability
    to Symclatron alone, which needs them.
    """
    name = TOOLS.get(tool.strip().casefold())
    if name is None:
        raise ValueError(f"unsupported quality tool {tool!r}; expected one of {', '.join(sorted(TOOLS))}")
    if detail is not None and name != "checkeuk":
        raise ValueError("a detail table is supported only for CheckEUK")
    if (evidence is None) == (name == "symclatron"):
        raise ValueError("calls on applicability are required for and only for Symclatron")
    parser = getattr(native, name)
    if name == "checkeuk":
        if detail is None:
            raise ValueError("CheckEUK needs its detail table")
        return parser(table, detail)
    return parser(table, *evidence) if evidence is not None else parser(table)


def braker_inputs(artifacts: DataFrame, bins: DataFrame, skip_masking: bool, bin_id: str | None = None) -> DataFrame:
    """(sample_id, run_id, ids): the sorted artifacts that a eukaryotic gene caller consumes, for one bin or as a whole."""
    run = ["sample_id", "run_id"]
    chosen = bins.where(F.lit(skip_masking) & (F.col("candidate_class") == "eukaryotic_candidate"))
    chosen = chosen if bin_id is None else chosen.where(F.col("bin_id") == bin_id)
    unmasked = chosen.select(*run, F.concat(F.lit("bin."), "bin_id").alias("artifact_id"), F.lit(True).alias("mine"))
    rows = artifacts.join(unmasked, [*run, "artifact_id"], "left")
    made = F.col("producer_stage_id").isin("repeat_masking", "rna_alignment")
    own = made if bin_id is None else made & F.substring_index("path", "/", -1).startswith(f"{bin_id}.")
    picked = rows.where(F.coalesce("mine", F.lit(False)) | (F.col("artifact_id") == "protein_reference") | F.coalesce(own, F.lit(False)))
    return picked.groupBy(*run).agg(F.array_sort(F.collect_set("artifact_id")).alias("ids"))

