"""Native tool tables to catalog rows.

Every function takes all-text tables and gives a ``Parsed``: typed rows by
collection, and the problems (target, detail) for which the table must be
refused. Nothing runs until a caller looks; ``accepted`` raises at the first
problem.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import is_bad_number, number, present, stripped, target_name, whole, yes
from tessella.operators.parse import RANKS, first_failing, lineage, virus_lineage


class Parsed(NamedTuple):
    rows: dict[str, DataFrame]
    problems: DataFrame
    targets: DataFrame


#: Thresholds, panel size, texts and model names of the native tools.
THRESHOLD = 0.725
LEAST_UNI56 = 50.0
PANEL = 1085
BUSCO_FAILURES = ["No genes found", "Run failed; check logs"]
SSU_MODELS = {"RF00177": "rrna_16s", "RF01960": "rrna_18s"}


def accepted(p: Parsed) -> Parsed:
    first = p.problems.orderBy("detail", "target").first()
    if first is not None:
        raise ValueError(f"{first.detail}: {first.target}")
    return p


def _keyed(table: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The table with its target, and the problems of unsafe and repeated targets."""
    rows = table.withColumn("target", target_name(F.col(f"`{column}`")))
    unsafe = rows.where("target is null").select(F.col(f"`{column}`").alias("target"), F.lit("not a safe name").alias("detail"))
    twice = rows.groupBy("target").agg(F.count("*").alias("n")).where("n > 1").select("target", F.lit("repeated target").alias("detail"))
    return rows, unsafe.union(twice)


def _bad(rows: DataFrame, *checks: tuple[Column, str]) -> DataFrame:
    return reduce(DataFrame.union, [rows.where(c).select("target", F.lit(text).alias("detail")) for c, text in checks])


def _lacks(c: str) -> Column:
    return present(F.col(f"`{c}`")).isNull()


def _wrong(c: str, least: float | None, most: float | None, required: bool = False) -> Column:
    bad = is_bad_number(F.col(f"`{c}`"), least, most)
    return bad | _lacks(c) if required else bad


def _qc(rows: DataFrame, tool: str, **values: Column) -> DataFrame:
    return rows.select(F.concat(F.lit(f"{tool}:qc:"), F.col("target")).alias("record_id"), F.lit("bin").alias("target_kind"), F.col("target").alias("target_id"), *[v.alias(k) for k, v in values.items()])


def _taxonomy(rows: DataFrame, tool: str, text: str, kind: str = "bin") -> tuple[DataFrame, DataFrame]:
    named = lineage(rows.where(present(F.col(text)).isNotNull()), text)
    id_ = F.concat_ws(":", F.lit(tool), F.lit("taxonomy"), F.col("target"), F.col("rank"))
    twice = named.groupBy("target", "rank").agg(F.count("*").alias("n")).where("n > 1").select("target", F.lit("repeated rank").alias("detail"))
    return named.select("*", id_.alias("record_id"), F.lit(kind).alias("target_kind"), F.col("target").alias("target_id")), twice


def _num(c: str) -> Column:
    return number(F.col(f"`{c}`"))


def checkm1(table: DataFrame) -> Parsed:
    """Contamination may exceed 100."""
    rows, keyed = _keyed(table, "Bin Id")
    problems = keyed.union(_bad(rows, (_wrong("Completeness", 0, 100, True), "completeness"), (_wrong("Contamination", 0, None, True), "contamination"), (stripped(F.col("Marker lineage")) == "", "empty marker lineage")))
    qc = _qc(rows, "checkm1", completeness_percent=_num("Completeness"), contamination_percent=_num("Contamination"), completeness_basis=stripped(F.col("Marker lineage")), contamination_basis=F.lit("CheckM1 marker-set multi-copy estimate"))
    return Parsed({"qc": qc}, problems, rows.select("target"))


def checkm2(table: DataFrame) -> Parsed:
    rows, keyed = _keyed(table, "Name")
    problems = keyed.union(_bad(rows, (_wrong("Completeness", 0, 100, True), "completeness"), (_wrong("Contamination", 0, None, True), "contamination"), (stripped(F.col("Completeness_Model_Used")) == "", "empty model")))
    qc = _qc(rows, "checkm2", completeness_percent=_num("Completeness"), contamination_percent=_num("Contamination"), completeness_basis=stripped(F.col("Completeness_Model_Used")), contamination_basis=F.lit("CheckM2 reported contamination"))
    return Parsed({"qc": qc}, problems, rows.select("target"))


def checkeuk(table: DataFrame, detail: DataFrame) -> Parsed:
    """``ok`` rows give measurements and ranks; ``filtered`` ones only a note; others are refused."""
    rows, keyed = _keyed(table, "genome")
    more, more_keyed = _keyed(detail.select("genome", "n_present_core", "n_present_expected", "n_expected"), "genome")
    both = rows.join(more.drop("genome"), "target", "left")
    ok = both.where(stripped(F.col("status")) == "ok")
    note = r"markers\s+([0-9]+)/([0-9]+)"
    noted = [F.when(F.col("completeness_note").rlike(note), F.regexp_extract("completeness_note", note, k).cast("long")) for k in (1, 2)]
    has, total, core, observed = whole(F.col("n_present_expected")), whole(F.col("n_expected")), whole(F.col("n_present_core")), whole(F.col("pfam_observed_families"))
    problems = keyed.union(more_keyed).union(_bad(
        both, (~stripped(F.col("status")).isin("ok", "filtered"), "unsupported status"),
    )).union(_bad(
        ok, (_wrong("completeness", 0, 100), "completeness"), (_wrong("contamination", 0, 100), "contamination"), (_wrong("completeness_bom", 0, 100), "completeness_bom"), (_wrong("pfam_completeness", 0, 100), "pfam_completeness"),
        (_num("completeness").isNotNull() & _lacks("completeness_basis"), "completeness lacks its basis"),
        (observed.isNotNull() & ~whole(F.col("pfam_union_families")).eqNullSafe(PANEL), "panel of another size"), (F.coalesce(observed > PANEL, F.lit(False)), "recovery exceeds the panel"),
        (~F.coalesce((total > 0) & (total <= 74) & (has <= total), F.lit(False)), "marker counts"), (~F.coalesce(core <= 74, F.lit(False)), "inventory"),
        (noted[0].isNotNull() & ~(noted[0].eqNullSafe(has) & noted[1].eqNullSafe(total)), "summary and detail differ"),
    )).union(rows.join(more, "target", "full_outer").where(rows["genome"].isNull() | more["genome"].isNull()).select("target", F.lit("summary and detail hold different targets").alias("detail")))
    contamination = _num("contamination")
    qc = _qc(ok, "checkeuk", completeness_percent=_num("completeness"), completeness_basis=F.when(_num("completeness").isNotNull(), stripped(F.col("completeness_basis"))), contamination_percent=contamination, contamination_basis=F.when(contamination.isNotNull(), F.lit("CheckEUK report contamination")),
             checkeuk_pfam_ridge_completeness_percent=_num("pfam_completeness"), checkeuk_bom_completeness_percent=_num("completeness_bom"), checkeuk_inventory74_present=core, checkeuk_expected_markers_present=has, checkeuk_expected_markers_total=total, checkeuk_pfam1085_distinct=observed)
    taxonomy, twice = _taxonomy(ok.select("target", "lineage"), "checkeuk", "lineage")
    reason = F.coalesce(present(F.col("completeness_note"), ("",)), F.lit("reason not reported"))
    notes = both.where(stripped(F.col("status")) == "filtered").select(F.concat(F.lit("CheckEUK filtered "), F.col("target"), F.lit(" before scoring: "), reason, F.lit(".")).alias("note"))
    return Parsed({"qc": qc, "taxonomy": taxonomy, "notes": notes}, problems.union(twice), rows.select("target"))


SUPPORT = ["completeness_query_support", "completeness_model_reliability", "contamination_query_support", "contamination_model_reliability"]


def gvclass(table: DataFrame) -> Parsed:
    """A measurement row only where an estimate is there; ranks carry the lineage's confidence."""
    rows, keyed = _keyed(table, "query")
    done, extra = _num("estimated_completeness"), _num("estimated_contamination")
    some = rows.where(done.isNotNull() | extra.isNotNull())
    problems = keyed.union(_bad(rows, (_wrong("estimated_completeness", 0, 100), "completeness"), (_wrong("estimated_contamination", 0, 100), "contamination")))
    problems = problems.union(_bad(some, (done.isNotNull() & _lacks("estimated_completeness_strategy"), "completeness lacks its strategy"), (extra.isNotNull() & _lacks("estimated_contamination_strategy"), "contamination lacks its strategy"), *[(stripped(F.col(c)) == "", f"empty {c}") for c in SUPPORT]))
    qc = _qc(some, "gvclass", completeness_percent=done, completeness_basis=F.when(done.isNotNull(), stripped(F.col("estimated_completeness_strategy"))), contamination_percent=extra, contamination_basis=F.when(extra.isNotNull(), stripped(F.col("estimated_contamination_strategy"))), **{c: stripped(F.col(c)) for c in SUPPORT})
    taxonomy, twice = _taxonomy(rows.select("target", "taxonomy_majority", stripped(F.col("taxonomy_confidence")).alias("lineage_confidence")), "gvclass", "taxonomy_majority")
    problems = problems.union(twice).union(_bad(taxonomy, (present(F.col("lineage_confidence")).isNull(), "ranks without confidence")))
    return Parsed({"qc": qc, "taxonomy": taxonomy}, problems, rows.select("target"))


def gtdbtk(table: DataFrame) -> Parsed:
    """A classification without ranks gives one row at the rank of domain."""
    rows, keyed = _keyed(table, "user_genome")
    ranked, twice = _taxonomy(rows.select("target", "classification"), "gtdbtk", "classification")
    rest = rows.join(ranked.select("target").distinct(), "target", "left_anti")
    columns = ["record_id", "target_kind", "target_id", "rank", "taxon_name"]
    bare = rest.select(F.concat(F.lit("gtdbtk:taxonomy:"), F.col("target"), F.lit(":domain")).alias("record_id"), F.lit("bin").alias("target_kind"), F.col("target").alias("target_id"), F.lit("domain").alias("rank"), stripped(F.col("classification")).alias("taxon_name"))
    return Parsed({"taxonomy": ranked.select(*columns).union(bare)}, keyed.union(twice).union(_bad(rows, (_lacks("classification"), "empty classification"))), rows.select("target"))


def symclatron(table: DataFrame, eukaryotic: DataFrame, viral: DataFrame, calls: DataFrame) -> Parsed:
    """Measurements and phenotypes; not applicable by the first of five checks that fails.

    eukaryotic and viral hold ``target``; calls has target, classification and warnings.
    """
    rows, keyed = _keyed(table, "taxon_oid")
    score, passes, uni = _num("confidence"), yes(F.col("passes_confidence_threshold")), _num("completeness_UNI56")
    problems = keyed.union(_bad(rows, (_wrong("confidence", 0, 1, True), "confidence"), (_wrong("completeness_UNI56", 0, 100, True), "completeness"), (passes.isNull(), "flag is no boolean"), (passes != (score >= THRESHOLD), "flag contradicts the threshold"), (_lacks("classification"), "empty class"), (_lacks("classification_thresholded"), "empty thresholded class")))
    joined = rows.withColumnRenamed("classification", "raw").join(eukaryotic.select("target", F.lit(True).alias("euk")).distinct(), "target", "left").join(viral.select("target", F.lit(True).alias("vir")).distinct(), "target", "left").join(calls.select("target", F.col("classification").alias("call"), "warnings"), "target", "left")
    prokaryotic = F.col("call").startswith("d__Bacteria;") | F.col("call").startswith("d__Archaea;")
    reason = first_failing([
        (F.col("euk").isNotNull(), "CheckEUK assigns eukaryotic taxonomy"), (F.col("vir").isNotNull(), "GVClass majority is viral"), (F.lower("warnings").contains("domain questionable"), "GTDB-Tk flags the domain as questionable"),
        (~F.coalesce(prokaryotic, F.lit(False)), "No GTDB-Tk bacterial or archaeal classification"), (uni < LEAST_UNI56, "UNI56 completeness below 50 percent"),
    ])
    phenotypes = joined.select(F.concat(F.lit("symclatron:phenotype:"), F.col("target")).alias("record_id"), F.col("target").alias("bin_id"), stripped(F.col("raw")).alias("raw_class"), score.alias("raw_score"), F.lit(THRESHOLD).alias("threshold"), passes.alias("passes_threshold"), stripped(F.col("classification_thresholded")).alias("thresholded_class"), reason.isNull().alias("is_applicable"), reason.alias("applicability_reason"))
    qc = _qc(rows, "symclatron", completeness_percent=uni, completeness_basis=F.lit("UNI56 marker inventory (56 markers)"))
    return Parsed({"qc": qc, "phenotypes": phenotypes}, problems, rows.select("target"))


def busco(table: DataFrame) -> Parsed:
    """A row with a failure text has no other value and gives a note only."""
    rows, keyed = _keyed(table, "Input_file")
    failed = stripped(F.col("Dataset")).isin(BUSCO_FAILURES)
    rest = [c for c in table.columns if c not in ("Input_file", "Dataset")]
    filled = reduce(lambda a, b: a | b, [stripped(F.col(f"`{c}`")) != "" for c in rest])
    good, bad = rows.where(~failed), rows.where(failed)
    problems = keyed.union(_bad(bad, (filled, "failure row with values"))).union(_bad(good, (_lacks("Dataset"), "empty dataset"), (whole(F.col("n_markers")).isNull(), "n_markers"), *[(_wrong(c, 0, 100, True), c) for c in ("Complete", "Duplicated", "Fragmented", "Missing")]))
    basis = F.concat(F.lit("BUSCO "), stripped(F.col("Dataset")), F.lit(" complete (n="), whole(F.col("n_markers")), F.lit(")"))
    qc = _qc(good, "busco", completeness_percent=_num("Complete"), completeness_basis=basis, contamination_percent=_num("Duplicated"), contamination_basis=F.lit("BUSCO duplicated (not a contamination estimate)"))
    notes = bad.select(F.concat("target", F.lit(": BUSCO "), stripped(F.col("Dataset"))).alias("note")).union(good.select(F.concat("target", F.lit(": BUSCO fragmented "), stripped(F.col("Fragmented")), F.lit("%, missing "), stripped(F.col("Missing")), F.lit("%"))))
    return Parsed({"qc": qc, "notes": notes}, problems, rows.select("target"))


def quickclade(table: DataFrame) -> Parsed:
    """Ranks with the score of ``rank:score;...``; the confidence level must agree with it."""
    rows, keyed = _keyed(table, "#QueryName")
    pairs = F.filter(F.split(F.coalesce(present(F.col("Confidence")), F.lit("")), ";"), lambda x: x != "")
    full = F.create_map(*[F.lit(x) for pair in RANKS.items() for x in pair])
    rank_of = lambda c: F.coalesce(F.element_at(full, F.lower(F.trim(c))), F.lower(F.trim(c)))
    entries = F.transform(pairs, lambda p: F.struct(rank_of(F.substring_index(p, ":", 1)).alias("key"), F.substring_index(p, ":", -1).try_cast("double").alias("value")))
    level = r"\A\s*([^:]+):([0-9]+(\.[0-9]+)?)\s*\z"
    rows = rows.withColumns({"entries": entries, "level_rank": F.when(F.col("ConfLevel").rlike(level), rank_of(F.regexp_extract("ConfLevel", level, 1))), "level_score": F.regexp_extract("ConfLevel", level, 2).try_cast("double")})
    rows = rows.withColumn("scores", F.map_from_entries(F.array_distinct("entries")))
    known = F.element_at("scores", F.col("level_rank"))
    problems = keyed.union(_bad(
        rows, (F.exists(pairs, lambda p: ~p.contains(":") | p.startswith(":")), "malformed confidence"), (F.exists("entries", lambda e: e["value"].isNull() | (e["value"] < 0) | (e["value"] > 1)), "confidence out of bounds"),
        ((stripped(F.col("ConfLevel")) != "") & F.col("level_rank").isNull(), "malformed confidence level"), (known.isNotNull() & (known != F.col("level_score")), "confidence fields disagree"),
    ))
    taxonomy, twice = _taxonomy(rows.select("target", "lineage", "scores", "level_rank", "level_score"), "quickclade", "lineage")
    score = F.coalesce(F.element_at("scores", F.col("rank")), F.when(F.col("rank") == F.col("level_rank"), F.col("level_score")))
    return Parsed({"taxonomy": taxonomy.select("record_id", "target_kind", "target_id", "rank", "taxon_name", score.alias("score"))}, problems.union(twice), rows.select("target"))


COORDINATES = r"\A([0-9]+)-([0-9]+)\z"


def ssu(table: DataFrame) -> Parsed:
    """Loci with one-based inclusive coordinates; match values need an accession."""
    at = lambda k: F.regexp_extract(F.trim("coordinates"), COORDINATES, k).try_cast("long")
    rows = table.withColumns({"target": stripped(F.col("name")), "start": at(1), "end": at(2)})
    models = F.create_map(*[F.lit(x) for pair in SSU_MODELS.items() for x in pair])
    kind, strand = F.element_at(models, F.trim("model")), F.element_at(F.create_map(F.lit("+"), F.lit("plus"), F.lit("-"), F.lit("minus")), F.trim("strand"))
    identity, cover, hit = _num("blast_pident"), _num("blast_query_coverage"), present(F.col("blast_sseqid"))
    id_ = F.concat(F.lit("ssuextract:ssu:"), F.trim("contig_name"), F.lit(":"), F.col("start"), F.lit("-"), F.col("end"), F.lit(":"), F.trim("model"))
    out = rows.select("target", id_.alias("record_id"), F.trim("contig_name").alias("contig_id"), kind.alias("ssu_type"), "start", "end", strand.alias("strand"), hit.alias("hit_accession"), *[present(F.col(c)).alias(n) for c, n in (("reference_identifiers", "reference_identifiers"), ("reference_source", "reference_source"), ("reference_versions", "reference_versions"), ("reference_taxonomy", "reference_taxonomy"), ("taxonomy", "taxon_name"), ("taxonomy_assignment_method", "taxonomy_assignment_method"))], identity.alias("identity_percent"), (cover * 100).alias("query_coverage_percent"))
    twice = lambda d, c: d.groupBy(c).agg(F.count("*").alias("n")).where("n > 1").select(F.col(c).alias("target"), F.lit(f"repeated {c}").alias("detail"))
    problems = twice(rows, "name").union(twice(out, "record_id")).union(_bad(
        rows, (F.col("start").isNull() | (F.col("start") < 1) | (F.col("end") < F.col("start")), "coordinates"), (~whole(F.col("length")).eqNullSafe(F.col("end") - F.col("start") + 1), "length disagrees with coordinates"), (kind.isNull(), "unsupported model"), (strand.isNull(), "strand"),
        (_wrong("blast_pident", 0, 100), "identity"), (_wrong("blast_query_coverage", 0, 1), "coverage"), ((identity.isNotNull() | cover.isNotNull()) & hit.isNull(), "match without an accession"),
    ))
    return Parsed({"ssu": out.drop("target")}, problems, rows.select("target"))


PROVIRUS = r"\A(.+)\|provirus_([0-9]+)_([0-9]+)\z"


def genomad(table: DataFrame, contigs: DataFrame) -> Parsed:
    """Viral calls on whole contigs or on the stretch that a provirus names; contigs has contig_id and length_bp."""
    part = lambda k: F.regexp_extract("target", PROVIRUS, k)
    rows = table.withColumn("target", stripped(F.col("seq_name"))).withColumn("pro", F.col("target").rlike(PROVIRUS))
    rows = rows.withColumn("contig_id", F.when(F.col("pro"), part(1)).otherwise(F.col("target"))).join(contigs.select("contig_id", F.col("length_bp").alias("contig_bp")), "contig_id", "left")
    rows = rows.withColumns({"start": F.when(F.col("pro"), part(2).try_cast("long")).otherwise(F.lit(1).cast("long")), "end": F.when(F.col("pro"), part(3).try_cast("long")).otherwise(F.col("contig_bp"))})
    shown, provirus = present(F.col("coordinates")), F.trim("topology") == "Provirus"
    named = F.concat(F.col("start"), F.lit("-"), F.col("end"))
    problems = rows.groupBy("target").agg(F.count("*").alias("n")).where("n > 1").select("target", F.lit("repeated target").alias("detail")).union(_bad(
        rows, (F.col("contig_bp").isNull(), "unknown contig"), (F.col("pro") & ~shown.eqNullSafe(named), "provirus coordinates disagree"), (F.col("pro") & ~provirus, "provirus topology disagrees"), (~F.col("pro") & shown.isNotNull(), "whole contig with coordinates"),
        (~F.col("pro") & provirus, "provirus without coordinates"), ((F.col("start") < 1) | (F.col("end") < F.col("start")) | (F.col("end") > F.col("contig_bp")), "coordinates beyond the contig"), (~whole(F.col("length")).eqNullSafe(F.col("end") - F.col("start") + 1), "length disagrees with coordinates"),
        (_wrong("virus_score", 0, 1, True), "score"), (_wrong("fdr", 0, 1), "fdr"), (_wrong("marker_enrichment", None, None), "enrichment"), (whole(F.col("n_genes")).isNull() | whole(F.col("n_hallmarks")).isNull() | ~F.coalesce(whole(F.col("genetic_code")) >= 1, F.lit(False)), "counts"), (_lacks("topology"), "topology"), (_lacks("taxonomy"), "taxonomy"),
    ))
    id_ = F.concat(F.lit("genomad:virus:"), F.col("contig_id"), F.when(F.col("pro"), F.concat(F.lit(":"), named)).otherwise(""))
    viruses = rows.select("target", id_.alias("record_id"), "contig_id", "start", "end", F.lit("unknown").alias("strand"), _num("virus_score").alias("score"), present(F.col("taxonomy")).alias("viral_taxon"))
    ranked = viruses.where("viral_taxon is not null and lower(viral_taxon) <> 'unclassified'")
    problems = problems.union(_bad(ranked, (F.trim(F.substring_index("viral_taxon", ";", 1)) != "Viruses", "lineage without its root"), (F.size(F.split("viral_taxon", ";")) > 9, "too many ranks")))
    taxonomy = virus_lineage(ranked.select("record_id", "viral_taxon"), "viral_taxon").select(F.concat(F.lit("genomad:taxonomy:"), F.col("record_id"), F.lit(":"), F.col("rank")).alias("id"), F.lit("virus").alias("target_kind"), F.col("record_id").alias("target_id"), "rank", F.trim("taxon_name").alias("taxon_name")).withColumnRenamed("id", "record_id")
    return Parsed({"viruses": viruses, "taxonomy": taxonomy}, problems, rows.select("target"))


def checkv(table: DataFrame, viruses: DataFrame) -> Parsed:
    """Estimates of the viruses (target, record_id); both tables hold the same targets."""
    rows = table.withColumn("target", stripped(F.col("contig_id")))
    done, extra, method = _num("completeness"), _num("contamination"), present(F.col("completeness_method"))
    provirus, size, part = yes(F.col("provirus"), "yes", "no"), whole(F.col("contig_length")), whole(F.col("proviral_length"))
    known = viruses.select("target", "record_id")
    twice = rows.groupBy("target").agg(F.count("*").alias("n")).where("n > 1").select("target", F.lit("repeated target").alias("detail"))
    sides = rows.select("target").distinct().withColumn("a", F.lit(1)).join(known.select("target").withColumn("b", F.lit(1)), "target", "full_outer").where("a is null or b is null").select("target", F.lit("target sets differ").alias("detail"))
    problems = twice.union(sides).union(_bad(
        rows, (_wrong("completeness", 0, 100), "completeness"), (_wrong("contamination", 0, 100), "contamination"), (done.isNotNull() != method.isNotNull(), "completeness and method must appear together"), (~F.coalesce(size >= 1, F.lit(False)), "length"), (provirus.isNull(), "provirus flag"),
        (provirus != part.isNotNull(), "provirus and its length must appear together"), (F.coalesce(part > size, F.lit(False)), "provirus longer than its contig"), (~F.coalesce(whole(F.col("viral_genes")) + whole(F.col("host_genes")) <= whole(F.col("gene_count")), F.lit(False)), "gene counts"),
        (_lacks("checkv_quality"), "quality tier"), (_lacks("miuvig_quality"), "second tier"), (_wrong("kmer_freq", 0, None), "frequency"),
    ))
    some = rows.join(known, "target").where(done.isNotNull() | extra.isNotNull())
    qc = some.select(F.concat(F.lit("checkv:qc:"), F.col("record_id")).alias("id"), F.lit("virus").alias("target_kind"), F.col("record_id").alias("target_id"), done.alias("completeness_percent"), method.alias("completeness_basis"), extra.alias("contamination_percent"), F.when(extra.isNotNull(), F.lit("CheckV predicted host-region fraction")).alias("contamination_basis")).withColumnRenamed("id", "record_id")
    return Parsed({"qc": qc}, problems, rows.select("target"))
