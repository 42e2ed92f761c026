"""Gene models: callers' features joined to their proteins, merged proteins, staged viral candidates.

Features come from ``sources.tables.gff``, proteins from ``sources.tables.fasta``.
As in ``native``, every function gives rows and the problems for which they
must be refused.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import attributes, present, safe_component, stripped, whole
from tessella.operators.keys import edge_phase, overlaps
from tessella.operators.native import PROVIRUS, Parsed

#: Strand names, and routes whose contigs gene callers handle already.
STRANDS = {"+": "plus", "-": "minus", "1": "plus", "-1": "minus"}
CALLED_ROUTES = ["prokaryotic", "eukaryotic", "viral"]
MISSING = ("", "na", "n/a", "none", "null", ".")


def normalized_id(caller: str, source: Column, bin_id: Column, native: Column) -> Column:
    """caller:source[:bin]:native, every part made safe."""
    return F.concat_ws(":", F.lit(caller), safe_component(stripped(source)), F.when(bin_id.isNotNull(), safe_component(stripped(bin_id))), safe_component(stripped(native)))


def _strand(c: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in STRANDS.items() for x in pair]), c)


def _bad(rows: DataFrame, key: str, *checks: tuple[Column, str]) -> DataFrame:
    return reduce(DataFrame.union, [rows.where(F.coalesce(c, F.lit(True))).select(F.col(key).alias("target"), F.lit(text).alias("detail")) for c, text in checks])


def _twice(rows: DataFrame, key: str, text: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(F.col(key).alias("target"), F.lit(text).alias("detail"))


def _one_sided(a: DataFrame, b: DataFrame, key: str, text: str) -> DataFrame:
    x, y = a.select(key).distinct().withColumn("a", F.lit(1)), b.select(key).distinct().withColumn("b", F.lit(1))
    return x.join(y, key, "full_outer").where("a is null or b is null").select(F.col(key).alias("target"), F.lit(text).alias("detail"))


def protein_headers(proteins: DataFrame) -> DataFrame:
    """id # start # end # strand # attributes, typed; null where a part is missing."""
    part = F.transform(F.split("header", " # "), stripped)
    notes = attributes(F.coalesce(F.get(part, F.lit(4)), F.lit("")))
    return proteins.select("name", "sequence", F.element_at(notes, F.lit("ID")).alias("gene"), whole(F.get(part, F.lit(1))).alias("p_start"), whole(F.get(part, F.lit(2))).alias("p_end"), _strand(F.get(part, F.lit(3))).alias("p_strand"), whole(F.element_at(notes, F.lit("genetic_code"))).alias("p_code"))


def prodigal(features: DataFrame, proteins: DataFrame, source: str, bin_id: str | None = None, code: int | None = None) -> Parsed:
    """One gene for each protein; coding features and proteins hold the same native genes and agree."""
    cds = features.where("feature = 'CDS'").select(F.element_at("attributes", F.lit("ID")).alias("gene"), F.col("contig").alias("contig_id"), "start", "end", _strand(F.col("strand")).alias("strand"), "phase", whole(F.element_at("attributes", F.lit("genetic_code"))).cast("int").alias("genetic_code"), "transl_table")
    heads = protein_headers(proteins)
    both = cds.join(heads, "gene")
    expected = F.concat(F.col("contig_id"), F.lit("_"), F.substring_index("gene", "_", -1))
    problems = reduce(DataFrame.union, [
        _twice(cds, "gene", "repeated coding feature"), _twice(heads, "gene", "repeated protein"), _one_sided(cds, heads, "gene", "features and proteins differ"),
        _bad(cds, "gene", (F.col("genetic_code").isNull(), "no genetic code"), (F.col("transl_table").isNotNull() & (F.col("transl_table") != F.col("genetic_code")), "code differs from its model's"), *([(F.col("genetic_code") != code, "code differs from the required one")] if code else [])),
        _bad(both, "gene", (F.col("name") != expected, "protein name differs from contig and feature"), (~(F.col("p_start").eqNullSafe(F.col("start")) & F.col("p_end").eqNullSafe(F.col("end")) & F.col("p_strand").eqNullSafe(F.col("strand")) & F.col("p_code").eqNullSafe(F.col("genetic_code"))), "header disagrees with its feature")),
    ])
    own = F.lit(bin_id).cast("string")
    genes = both.select(normalized_id("prodigal-gv", F.lit(source), own, F.col("name")).alias("gene_id"), "contig_id", own.alias("bin_id"), "start", "end", "strand", "phase", "genetic_code")
    return Parsed({"genes": genes}, problems, heads.select(F.col("gene").alias("target")))


def braker(features: DataFrame, proteins: DataFrame, source: str, bin_id: str | None, code: int) -> Parsed:
    """One gene for each translated transcript: one parent gene, contained parts, phase of the first coding part."""
    id_, parent = F.element_at("attributes", F.lit("ID")), F.filter(F.split(F.coalesce(F.element_at("attributes", F.lit("Parent")), F.lit("")), ","), lambda p: p != "")
    place = ["contig", "start", "end", "strand"]
    genes = features.where("feature = 'gene'").select(id_.alias("id"), *place)
    transcripts = features.where("feature in ('mRNA', 'transcript')").select(id_.alias("id"), parent.alias("parents"), *place)
    cds = features.where("feature = 'CDS'").select(F.explode(parent).alias("id"), "phase", *place)
    named = proteins.select(F.col("name").alias("id"))
    wanted = transcripts.join(named, "id", "left_semi")
    t = wanted.select("id", F.get("parents", F.lit(0)).alias("gene"), *place)
    outside = lambda i, o: F.expr(f"{i}.contig <> {o}.contig or {i}.strand <> {o}.strand or {i}.start < {o}.start or {i}.end > {o}.end")
    in_gene = t.alias("i").join(genes.withColumnRenamed("id", "gene").alias("o"), "gene")
    parts = cds.alias("i").join(t.alias("o"), "id")
    problems = reduce(DataFrame.union, [
        _twice(genes, "id", "repeated gene"), _twice(transcripts, "id", "repeated transcript"), _one_sided(transcripts, named, "id", "transcripts and proteins differ"), _bad(wanted, "id", (F.size("parents") != 1, "not one parent gene")),
        t.join(genes.select(F.col("id").alias("gene")), "gene", "left_anti").select(F.col("id").alias("target"), F.lit("unknown parent").alias("detail")),
        in_gene.where(outside("i", "o")).select(F.col("i.id").alias("target"), F.lit("transcript outside its gene").alias("detail")), parts.where(outside("i", "o")).select(F.col("id").alias("target"), F.lit("coding part outside its transcript").alias("detail")),
        t.join(cds.select("id"), "id", "left_anti").select(F.col("id").alias("target"), F.lit("no coding part").alias("detail")), parts.where(F.col("i.phase").isNull()).select(F.col("id").alias("target"), F.lit("coding part without a phase").alias("detail")),
    ])
    phases = edge_phase(cds.select(F.col("id").alias("transcript"), "strand", "start", "end", "phase")).select(F.col("transcript").alias("id"), "phase")
    own = F.lit(bin_id).cast("string")
    rows = t.join(phases, "id").select(normalized_id("braker3", F.lit(source), own, F.col("id")).alias("gene_id"), F.col("contig").alias("contig_id"), own.alias("bin_id"), "start", "end", _strand(F.col("strand")).alias("strand"), "phase", F.lit(code).alias("genetic_code"))
    return Parsed({"genes": rows}, problems, named.select(F.col("id").alias("target")))


def merged_proteins(sources: list[tuple[DataFrame, str, str, str | None]]) -> Parsed:
    """Proteins of all (proteins, caller, source, bin) under normalized names, without one final stop."""
    parts = []
    for proteins, caller, source, bin_id in sources:
        gene = F.regexp_extract("name", r"^(.+)\.t[0-9]+$", 1) if caller == "braker3" else F.element_at(attributes(F.coalesce(F.get(F.split("header", " # "), F.lit(4)), F.lit(""))), F.lit("ID"))
        own = F.lit(bin_id).cast("string")
        parts.append(proteins.select(normalized_id(caller, F.lit(source), own, F.col("name")).alias("normalized_id"), F.col("name").alias("native_id"), gene.alias("native_gene_id"), F.lit(caller).alias("caller"), F.lit(source).alias("source_id"), own.alias("bin_id"), F.regexp_replace("sequence", r"\*$", "").alias("sequence")))
    rows = reduce(DataFrame.unionByName, parts)
    problems = _twice(rows, "normalized_id", "repeated name").union(_bad(rows, "normalized_id", ((F.col("sequence") == "") | F.col("sequence").contains("*"), "stop inside the protein"), (F.coalesce(F.col("native_gene_id"), F.lit("")) == "", "no native gene")))
    return Parsed({"proteins": rows.select(F.col("normalized_id").alias("name"), "sequence"), "mapping": rows.drop("sequence")}, problems, rows.select(F.col("normalized_id").alias("target")))


def viral_candidates(summary: DataFrame, sequences: DataFrame, routes: DataFrame) -> Parsed:
    """Staged viral candidates with their place on the parent contig.

    summary has seq_name, length, topology and coordinates; sequences name and
    sequence; routes contig_id, route and bin_id. Candidates on contigs of a
    called bin are excluded; the included ones may not overlap on a parent.
    """
    part = lambda k: F.regexp_extract("name", PROVIRUS, k)
    size = F.length("sequence").cast("long")
    rows = sequences.select("name", "sequence").join(summary.select(F.col("seq_name").alias("name"), "length", "topology", "coordinates"), "name").withColumn("pro", F.col("name").rlike(PROVIRUS))
    rows = rows.withColumns({"parent": F.when(F.col("pro"), part(1)).otherwise(F.col("name")), "start": F.when(F.col("pro"), part(2).try_cast("long")).otherwise(F.lit(1).cast("long")), "end": F.when(F.col("pro"), part(3).try_cast("long")).otherwise(size)})
    provirus, shown = F.trim("topology") == "Provirus", present(F.col("coordinates"), MISSING)
    routed = rows.join(routes.select(F.col("contig_id").alias("parent"), "route", "bin_id"), "parent", "left").withColumns({"route": F.coalesce("route", F.lit("unbinned")), "bin_id": F.coalesce("bin_id", F.lit(""))})
    out = F.col("route").isin(CALLED_ROUTES)
    reason = F.when(out, F.lit("parent_assigned_to_called_bin")).when(F.col("route") == "unresolved", F.lit("unresolved_parent_genomad_candidate")).otherwise(F.lit("unbinned_parent_genomad_candidate"))
    id_ = F.concat_ws("_", F.lit("genomad"), safe_component(F.col("parent")), "start", "end", F.substring(F.sha2("name", 256), 1, 10))
    staged = routed.select(F.col("name").alias("native_id"), id_.alias("contig_id"), F.col("parent").alias("parent_contig"), "start", "end", "sequence", "bin_id", F.when(F.col("pro"), F.lit("genomad_provirus")).otherwise("genomad_full").alias("category"), F.when(out, F.lit("excluded")).otherwise("included").alias("status"), reason.alias("reason"))
    crossing = overlaps(staged.where("status = 'included'"), ["parent_contig"], name="native_id").select(F.col("native_id").alias("target"), F.lit("candidates overlap").alias("detail"))
    same = _twice(staged.withColumn("region", F.concat_ws(":", "parent_contig", "start", "end")), "region", "repeated interval")
    problems = reduce(DataFrame.union, [
        crossing, same, _one_sided(sequences, summary.withColumnRenamed("seq_name", "name"), "name", "sequences and summary differ"),
        _bad(rows, "name", (~whole(F.col("length")).eqNullSafe(size), "length disagrees"), (F.col("end") - F.col("start") + 1 != size, "coordinates disagree with the sequence"), (F.col("pro") & ~shown.eqNullSafe(F.concat("start", F.lit("-"), "end")), "summary coordinates disagree"), (F.col("pro") != provirus, "topology disagrees"), (~F.col("pro") & shown.isNotNull(), "whole contig with coordinates")),
    ])
    return Parsed({"candidates": staged}, problems, rows.select(F.col("name").alias("target")))
