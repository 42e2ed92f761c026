"""Stage results to catalog rows: envelopes, expected keys, lineage, annotations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.text import number, present, row_digest, stem, stripped
from tessella.operators.integrity import RESULT_KEYS
from tessella.operators.keys import deduplicated
from tessella.operators.parse import member_and_integrated, terms

RUN = ["sample_id", "run_id"]
EVIDENCE_KINDS = ["bin_fasta", "taxonomy_report", "ssu_report", "viral_report"]


def enveloped(rows: DataFrame, sample: str, run: str, stage: str, artifact: str) -> DataFrame:
    """Rows with their scope and provenance in front."""
    return rows.select(F.lit(sample).alias("sample_id"), F.lit(run).alias("run_id"), F.lit(stage).alias("stage_id"), F.lit(artifact).alias("artifact_id"), "*")


def expected_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """For each stage, the sorted ``collection:key`` of all rows that it made."""
    parts = [tables[n].select(*RUN, "stage_id", F.concat(F.lit(f"{n}:"), F.col(k)).alias("key")) for n, k in RESULT_KEYS.items() if n in tables]
    return reduce(DataFrame.union, parts).groupBy(*RUN, "stage_id").agg(F.array_sort(F.collect_set("key")).alias("expected_result_keys"))


def skipped_stages(spark: SparkSession, present_stages: DataFrame, names: list[str], reason: str) -> DataFrame:
    """Rows for stages of the full set that a run does not have."""
    runs = present_stages.select(*RUN).distinct()
    full = runs.select(*RUN, F.explode(F.array(*[F.lit(n) for n in names])).alias("stage_id"))
    return full.join(present_stages.select(*RUN, "stage_id"), [*RUN, "stage_id"], "left_anti").select(*RUN, "stage_id", F.lit("skipped").alias("status"), F.lit(reason).alias("status_reason"))


def with_routes(bins: DataFrame, decisions: DataFrame) -> DataFrame:
    """Bins with the class that routing gave them; leftovers keep theirs."""
    new = decisions.select(*RUN, "bin_id", F.col("candidate_class").alias("routed"))
    out = bins.join(new, [*RUN, "bin_id"], "left")
    kept = F.when((F.col("candidate_class") == "chaff") | F.col("routed").isNull(), F.col("candidate_class")).otherwise(F.col("routed"))
    return out.withColumn("candidate_class", kept).drop("routed")


def _class(*names: str) -> Column:
    return F.col("candidate_class").isin(list(names))


def stage_inputs(stage: str, artifacts: DataFrame, bins: DataFrame, skip_masking: bool = False) -> DataFrame:
    """(sample_id, run_id, ids): the sorted artifacts that a stage consumes."""
    wanted = {"repeat_masking": _class("eukaryotic_candidate"), "rna_alignment": _class("eukaryotic_candidate"), "prodigal_gv": _class("bacterial_archaeal_candidate", "viral_candidate"), "checkm1": _class("bacterial_archaeal_candidate"), "gtdbtk": _class("bacterial_archaeal_candidate"), "symclatron": _class("bacterial_archaeal_candidate"), "busco": _class("eukaryotic_candidate"), "tidk": _class("eukaryotic_candidate")}
    chosen = bins.where(wanted.get(stage, F.lit(True))).select(*RUN, F.col("bin_id").alias("b"), F.lit(True).alias("mine"))
    a = artifacts.withColumn("b", stem(F.col("path"))).join(chosen, [*RUN, "b"], "left").withColumn("mine", F.coalesce("mine", F.lit(False)))
    id_, kind = F.col("artifact_id"), F.col("kind")
    own_bin = (kind == "bin_fasta") & F.col("mine")
    rules = {
        "routing": kind.isin(EVIDENCE_KINDS) | (id_ == "checkm2.quality_report.qc"), "repeat_masking": (id_ == "supplied_softmasked") | own_bin, "prodigal_gv": id_.isin("routing.evidence", "genomad.viral_fasta") | own_bin,
        "rna_alignment": id_.isin("assembly", "rna_reads") | ((F.col("producer_stage_id") == "repeat_masking") & (kind == "assembly")) | (own_bin & F.lit(skip_masking)), "checkv": id_ == "genomad.viral_fasta",
        "functional_annotation": (kind == "protein_fasta") & (F.col("producer_stage_id").startswith("braker3") | F.col("producer_stage_id").startswith("prodigal_gv")), "eggnog": id_.isin("functional_annotation.proteins", "functional_annotation.protein_map"), "interpro": id_.isin("functional_annotation.proteins", "functional_annotation.protein_map"),
    }
    if stage == "assembly":
        ids = F.when(F.bool_or(id_ == "supplied_assembly"), F.array(F.lit("supplied_assembly"))).otherwise(F.array(F.lit("filtered_reads")))
        return a.groupBy(*RUN).agg(ids.alias("ids"))
    return a.where(rules.get(stage, own_bin)).groupBy(*RUN).agg(F.array_sort(F.collect_set("artifact_id")).alias("ids"))


def child_cover(completed: DataFrame, pending: DataFrame, bins: DataFrame, key: str = "bin_id") -> DataFrame:
    """Keys that are both completed and pending, in neither, or unknown."""
    c, p, b = (d.select(key).distinct().withColumn(n, F.lit(True)) for d, n in ((completed, "c"), (pending, "p"), (bins, "b")))
    both = c.join(p, key, "full_outer").join(b, key, "full_outer").na.fill(False, ["c", "p", "b"])
    detail = F.when(F.col("c") & F.col("p"), F.lit("completed and pending")).when(F.col("b") & ~F.col("c") & ~F.col("p"), F.lit("neither")).when(~F.col("b"), F.lit("unknown"))
    return both.select(key, detail.alias("detail")).where("detail is not null")


#: The fields of an annotation, and of its identity in ``annotation_id``.
ANNOTATION = ["gene_id", "database_name", "database_version", "accession", "function_name", "start", "end", "score", "evalue"]


def annotation_id() -> Column:
    """``ann:<source>:`` and a digest of what a hit is: source, gene, database, accession and place."""
    return F.concat(F.lit("ann:"), F.col("source"), F.lit(":"), row_digest(*[F.col(c) for c in ("source", "gene_id", "database_name", "accession", "start", "end")]))


def annotation_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with their identity as key, keys whose rows differ); equal repeats collapse."""
    cells = rows.select("source", *[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in ANNOTATION])
    keyed = cells.withColumn("annotation_id", annotation_id()).drop("source")
    return deduplicated(keyed, ["annotation_id"])


#: List columns of the orthology table with the database of their terms, and the forms of accessions.
TERM_COLUMNS = {"eggNOG_OGs": "eggNOG", "GOs": "Gene Ontology via eggNOG", "EC": "Enzyme Commission via eggNOG", "KEGG_ko": "KEGG Orthology via eggNOG"}
TERM_FORMS = {"eggNOG_OGs": r"\A[^@|\s]+@[0-9]+(\|[^|]*[^|\s][^|]*)?\z", "GOs": r"\AGO:[0-9]{7}\z", "EC": r"\A[0-9]+(\.([0-9]+|-)){3}\z", "KEGG_ko": r"\Ako:K[0-9]{5}\z"}
ENTRY_FORM = r"\AIPR[0-9]{6}\z"


def eggnog(table: DataFrame, version: str) -> DataFrame:
    """One row for each term of the list columns; ``table`` has the tool's columns as text.

    Orthologous groups keep ``group@taxon`` and lose the label after it, and
    they alone have the description.
    """
    listed = lambda c: F.array_join(F.transform(F.split(present(F.col(c), ("", "-")), ","), lambda x: stripped(F.substring_index(x, "|", 1) if c == "eggNOG_OGs" else x)), ",")
    named = table.select(F.col("#query").alias("gene_id"), present(F.col("Description"), ("", "-")).alias("function_name"), number(F.col("evalue"), ("", "-")).alias("evalue"), number(F.col("score"), ("", "-")).alias("score"), *[listed(c).alias(c) for c in TERM_COLUMNS])
    found = terms(named, TERM_COLUMNS).withColumnRenamed("database", "database_name")
    described = F.when(F.col("database_name") == "eggNOG", F.col("function_name"))
    return found.withColumns({"function_name": described, "database_version": F.lit(version), "source": F.lit("eggnog")})


def _unknown_or(found: list[DataFrame], rows: DataFrame, proteins: DataFrame) -> DataFrame:
    """The problems, and those of rows whose gene is no accepted protein (name)."""
    strange = rows.join(proteins.select(F.col("name").alias("gene_id")), "gene_id", "left_anti")
    return reduce(DataFrame.union, [strange.select("gene_id", F.lit("unknown protein").alias("detail")).distinct(), *found])


def eggnog_problems(table: DataFrame, proteins: DataFrame) -> DataFrame:
    """(gene_id, detail) for which an orthology table must be refused."""
    rows = table.withColumnRenamed("#query", "gene_id")
    bad = lambda when, text: rows.where(F.coalesce(when, F.lit(False))).select("gene_id", F.lit(text).alias("detail"))
    found = [rows.groupBy("gene_id").agg(F.count("*").alias("n")).where("n > 1").select("gene_id", F.lit("repeated query").alias("detail"))]
    for c in ("score", "evalue"):
        found.append(bad(present(F.col(c), ("", "-")).isNotNull() & number(F.col(c), ("", "-")).isNull(), c))
    found.append(bad(number(F.col("evalue"), ("", "-")) < 0, "negative evalue"))
    for c, form in TERM_FORMS.items():
        found.append(bad(_any_other(c, form), f"invalid {c}"))
    return _unknown_or(found, rows, proteins)


def _any_other(c: str, form: str) -> Column:
    """Whether a list cell has a term of another form."""
    return F.exists(F.split(present(F.col(c), ("", "-")), ","), lambda x: ~stripped(x).rlike(form))


def interpro_problems(table: DataFrame, proteins: DataFrame) -> DataFrame:
    """(gene_id, detail) for which a domain table must be refused; ``table`` has protein, length, analysis, signature, start, stop, score, status and entry as text."""
    rows = table.withColumnRenamed("protein", "gene_id")
    bad = lambda when, text: rows.where(F.coalesce(when, F.lit(False))).select("gene_id", F.lit(text).alias("detail"))
    whole_ = lambda c: F.when(F.col(c).rlike(r"\A[0-9]{1,18}\z"), F.col(c).cast("long"))
    start, stop, length = whole_("start"), whole_("stop"), whole_("length")
    changed = rows.groupBy("gene_id").agg(F.countDistinct("length").alias("n")).where("n > 1").select("gene_id", F.lit("protein length changes").alias("detail"))
    found = [
        changed, bad(stripped(F.col("analysis")).isin("", "-"), "no analysis"), bad(stripped(F.col("signature")).isin("", "-"), "no signature"), bad(~F.coalesce((length >= 1) & (start >= 1) & (stop >= start) & (stop <= length), F.lit(False)), "coordinates"),
        bad(F.col("status") != "T", "status"), bad(present(F.col("score"), ("", "-")).isNotNull() & number(F.col("score"), ("", "-")).isNull(), "score"), bad(present(F.col("entry"), ("", "-")).isNotNull() & ~F.col("entry").rlike(ENTRY_FORM), "invalid entry"),
    ]
    return _unknown_or(found, rows, proteins)


def in_order(annotations: DataFrame) -> DataFrame:
    """Annotations as they are published: by gene, database, accession and place, rows without a place first."""
    return annotations.orderBy("gene_id", "database_name", "accession", F.coalesce("start", F.lit(0)), F.coalesce("end", F.lit(0)))


def interpro(table: DataFrame, version: str) -> DataFrame:
    """A row for each member signature, and one for the entry that it is integrated in."""
    rows = table.select(F.col("protein").alias("gene_id"), F.col("analysis").alias("member_db"), F.col("signature").alias("member"), F.col("entry").alias("integrated"), present(F.col("signature_name"), ("", "-")).alias("member_name"), present(F.col("entry_name"), ("", "-")).alias("entry_name"), F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("end"), number(F.col("score"), ("", "-")).alias("score"))
    both = member_and_integrated(rows)
    entry = F.col("accession").startswith("IPR")
    return both.select("gene_id", F.when(entry, F.lit("InterPro")).otherwise(F.concat(F.lit("InterProScan:"), F.col("member_db"))).alias("database_name"), F.lit(version).alias("database_version"), "accession", F.when(entry, F.col("entry_name")).otherwise(F.col("member_name")).alias("function_name"), "start", "end", "score", F.lit("interproscan").alias("source"))
