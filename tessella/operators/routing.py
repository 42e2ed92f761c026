"""Routing: seven evidence tables become one exclusive, explained decision for each bin.

``bin_facts`` joins and aggregates the evidence; ``route`` is one chain of
conditions over it. Both are single plans: the only shuffles are the contig
aggregation and the joins on the bin.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import fixed, stripped
from tessella.operators.keys import coverage, duplicates

#: Labels, thresholds and sentences that results must show.
QUICK_DOMAINS = {
    "d__Bacteria": "prokaryotic", "d__Archaea": "prokaryotic", "d__Eukaryota": "eukaryotic",
    "sk__Bacteria": "prokaryotic", "sk__Archaea": "prokaryotic", "sk__Eukaryota": "eukaryotic",
}
MAJORITY_DOMAINS = {
    "d_BAC": "prokaryotic", "d_ARC": "prokaryotic", "d_EUK": "eukaryotic", "d_NCLDV": "viral", "d_PPV": "viral",
    "d_MIRUS": "viral", "d_PHAGE": "viral", "d_PLASTID": "organelle", "d_MITO": "organelle", "d_EUK-pEVE": "ambiguous",
}
NO_MAJORITY = ["", "d_", "nd"]
STATUSES = ["ok", "filtered"]
TIARA_FIRST_STAGE = {"archaea": "prokaryote", "bacteria": "prokaryote", "prokarya": "prokaryote", "eukarya": "eukaryote", "organelle": "organelle", "unknown": "unclassified"}
TIARA_ORGANELLES = ["mitochondrion", "plastid"]
DUPLICATED = "_duplicated-yes"
LEDGER = [
    "sample_id", "run_id", "bin_id", "route", "candidate_class", "reason", "checkeuk_status", "checkeuk_lineage", "taxonomy", "taxonomy_source", "quickclade_domain", "quickclade_lineage", "quickclade_confidence",
    "gvclass_domain", "gvclass_taxonomy_majority", "gvclass_taxonomy_confidence", "linked_eukaryotic_ssu", "linked_genomad_viruses", "supporting_evidence", "conflicting_evidence", "bin_bp", "tiara_eukaryote_fraction",
    "tiara_prokaryote_fraction", "tiara_organelle_fraction", "tiara_unclassified_fraction", "viral_contig_fraction", "checkm2_completeness", "checkm2_contamination", "duplicated_contig_fraction",
]
LEAST_MARKERS = 5
HALF, STRONG = 0.5, 0.8
ORGANELLE_BP = 2_000_000
LEAST_COMPLETE = 10.0
SSU_LINE = "a physically linked eukaryotic 18S locus"
FALLBACK = "GVClass supports a eukaryotic route; CheckEUK has too few markers to name a lineage"
CONFLICT = "supported evidence conflicts across routes"
AMBIGUOUS = "GVClass reports an ambiguous eukaryote-virus class"
ORGANELLE_MAJORITY = "GVClass reports an organelle class without a gene-calling route"
ORGANELLE_SHARE = "Tiara classifies most of the bin as organelle sequence without a gene-calling route"
PROKARYOTIC_SHARE = "Tiara and CheckM2 support a prokaryotic route"
PROKARYOTIC_MAJORITY = "GVClass supports a prokaryotic route without a supported eukaryotic or viral conflict"
VIRAL = "GVClass or linked whole-contig geNomad evidence supports a viral route"
ONE_LINE = "eukaryotic evidence does not meet the combined support rule"
NO_LINE = "no supported routing evidence"
PROK_VIRAL = "prokaryotic evidence conflicts with viral evidence"
EUK_VIRAL = "eukaryotic evidence conflicts with viral evidence"
ORGANELLE_ANY = "organelle evidence conflicts with supported routing evidence"


def _mapped(table: dict[str, str], c: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c)


def composition(contigs: DataFrame, keys: list[str]) -> DataFrame:
    """Base pairs of each bin by class of its contigs, and those of whole-contig viruses.

    ``contigs`` has the keys, contig_id, length_bp, contig_class and is_virus.
    """
    of = lambda name: F.sum(F.when(F.col("contig_class") == name, F.col("length_bp")).otherwise(0)).cast("long")
    return contigs.groupBy(*keys).agg(
        F.sum("length_bp").cast("long").alias("bin_bp"), of("eukaryote").alias("euk_bp"), of("prokaryote").alias("prok_bp"),
        of("organelle").alias("org_bp"), of("unclassified").alias("uncl_bp"),
        F.sum(F.when(F.col("is_virus"), F.col("length_bp")).otherwise(0)).cast("long").alias("viral_bp"),
        F.sum(F.when(F.col("contig_id").contains(DUPLICATED), F.col("length_bp")).otherwise(0)).cast("long").alias("dup_bp"),
    )


def classified(contigs: DataFrame, calls: DataFrame) -> DataFrame:
    """Contigs with the class that ``calls`` (contig_id, contig_class) gives them, else unclassified."""
    return contigs.join(calls, "contig_id", "left").withColumn("contig_class", F.coalesce("contig_class", F.lit("unclassified")))


def tiara_calls(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(contig_id, contig_class) from the two stages of native rows, and the rows with a problem.

    The second stage only counts where it names an organelle. A contig named
    twice, an empty name and an unknown class are problems.
    """
    first, second = stripped(F.col("class_fst_stage")), stripped(F.col("class_snd_stage"))
    name = F.regexp_extract("sequence_id", r"^\s*(\S*)", 1)
    kind = F.when(_mapped(TIARA_FIRST_STAGE, first).isNull(), F.lit(None)).when(second.isin(TIARA_ORGANELLES), F.lit("organelle")).otherwise(_mapped(TIARA_FIRST_STAGE, first))
    rows = table.select(name.alias("contig_id"), kind.alias("contig_class"), first.alias("label"))
    twice = rows.groupBy("contig_id").agg(F.count("*").alias("n")).where("n > 1").select("contig_id", F.lit("repeated").alias("problem"))
    bad = rows.where(F.col("contig_class").isNull()).select("contig_id", F.concat(F.lit("unsupported class: "), "label").alias("problem"))
    return rows.select("contig_id", "contig_class"), bad.union(rows.where("contig_id = ''").select("contig_id", F.lit("empty name").alias("problem"))).union(twice)


def input_problems(bins: DataFrame, lineage: DataFrame, majority: DataFrame, quick: DataFrame, completeness: DataFrame, keys: list[str]) -> DataFrame:
    """(table, keys, problem) for which routing must be refused.

    lineage, majority and quick must hold each bin exactly once; completeness
    may hold fewer bins, but no unknown and no repeated one. Statuses and
    domains must be known.
    """
    found = []
    for name, rows, whole in (("lineage", lineage, True), ("majority", majority, True), ("quick", quick, True), ("completeness", completeness, False)):
        cover = coverage(bins, rows, keys)
        cover = cover if whole else cover.where("side = 'unexpected'")
        found.append(cover.select(F.lit(name).alias("table"), *keys, F.col("side").alias("problem")))
        found.append(duplicates(rows, keys).select(F.lit(name).alias("table"), *keys, F.lit("repeated").alias("problem")))
    status = lineage.where(~F.coalesce(F.col("status").isin(STATUSES), F.lit(False)))
    found.append(status.select(F.lit("lineage").alias("table"), *keys, F.concat(F.lit("unsupported status: "), F.coalesce("status", F.lit("null"))).alias("problem")))
    domain = F.substring_index(stripped(F.col("majority")), ";", 1)
    known = F.coalesce(domain.isin([*MAJORITY_DOMAINS, *NO_MAJORITY]), F.lit(False))
    found.append(majority.where(~known).select(F.lit("majority").alias("table"), *keys, F.concat(F.lit("unsupported domain: "), F.coalesce(domain, F.lit("null"))).alias("problem")))
    empty = stripped(F.col("quick_lineage")).rlike(r"\A(d|sk)__\s*(;|\z)")
    found.append(quick.where(empty).select(F.lit("quick").alias("table"), *keys, F.lit("malformed domain").alias("problem")))
    return reduce(DataFrame.unionByName, found)


def require_inputs(problems: DataFrame) -> None:
    """Raise with the first problems of ``input_problems``, if there are any."""
    some = problems.limit(5).collect()
    if some:
        raise ValueError("; ".join(" ".join(str(x) for x in row) for row in some))


def bin_facts(bins: DataFrame, contigs: DataFrame, lineage: DataFrame, majority: DataFrame, quick: DataFrame, loci: DataFrame, viruses: DataFrame, completeness: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each bin with all evidence.

    lineage, majority and quick must hold every bin (``input_problems`` tells;
    a bin that they lack keeps nulls here and is not dropped); loci, viruses
    and completeness may be partial. Loci and viruses carry ``ordinal``, their
    place in the source, and come as arrays in that order.
    """
    ordered = lambda d, name: d.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "item"))), lambda x: x["item"]).alias(name))
    facts = bins.join(composition(contigs, keys), keys, "left").na.fill(0, ["bin_bp", "euk_bp", "prok_bp", "org_bp", "uncl_bp", "viral_bp", "dup_bp"])
    facts = facts.join(lineage, keys, "left").join(majority, keys, "left").join(quick, keys, "left")
    facts = facts.join(ordered(loci, "ssu"), keys, "left").join(ordered(viruses, "virus_items"), keys, "left").join(completeness, keys, "left")
    none = F.array().cast("array<string>")
    return facts.withColumn("ssu", F.coalesce("ssu", none)).withColumn("virus_items", F.coalesce("virus_items", none))


def signals(facts: DataFrame) -> DataFrame:
    """The support flags that the rules use, beside the facts."""
    share = lambda c: F.when(F.col("bin_bp") > 0, F.col(c) / F.col("bin_bp")).otherwise(0.0)
    out = facts.withColumn("gv", _mapped(MAJORITY_DOMAINS, F.substring_index(stripped(F.col("majority")), ";", 1)))
    first = F.substring_index(stripped(F.col("quick_lineage")), ";", 1)
    out = out.withColumn("quick_domain", F.when(first.startswith("d__") | first.startswith("sk__"), first).otherwise("")).withColumn("quick", _mapped(QUICK_DOMAINS, F.col("quick_domain")))
    out = out.withColumns({"euk_share": share("euk_bp"), "prok_share": share("prok_bp"), "org_share": share("org_bp"), "uncl_share": share("uncl_bp"), "viral_share": share("viral_bp")})
    gv_is = lambda x: F.col("gv").eqNullSafe(x)
    named = stripped(F.col("lineage")) != ""
    out = out.withColumns({
        "resolved": (F.col("status") == "ok") & named,
        "fallback": (F.col("status") == "ok") & ~named & (F.col("markers") < LEAST_MARKERS) & gv_is("eukaryotic"),
        "has_ssu": F.size("ssu") > 0,
        "derived_share": F.col("euk_share") + F.col("org_share"),
        "strong_prok": F.col("prok_share") >= STRONG,
        "share_organelle": (F.col("org_share") >= HALF) & (F.col("bin_bp") <= ORGANELLE_BP) & ~gv_is("prokaryotic"),
        "complete": F.coalesce(F.col("completeness") >= LEAST_COMPLETE, F.lit(False)),
        "viral": gv_is("viral") | (F.col("viral_share") >= HALF),
    })
    lines = F.array(F.when(F.col("resolved"), F.lit("CheckEUK")), F.when(gv_is("eukaryotic"), F.lit("GVClass")), F.when(F.col("has_ssu"), F.lit(SSU_LINE)), F.when(F.col("derived_share") >= HALF, F.lit("Tiara")))
    out = out.withColumn("lines", F.array_compact(lines))
    out = out.withColumns({"euk": (F.size("lines") >= 2) | F.col("fallback"), "share_prok": F.col("strong_prok") & F.col("complete") & ~F.col("has_ssu"), "other_line": F.exists("lines", lambda x: x != "Tiara")})
    return out.withColumns({"prok": gv_is("prokaryotic") | F.col("share_prok"), "organelle": gv_is("organelle") | F.col("share_organelle")})


def route(facts: DataFrame) -> DataFrame:
    """The facts with signals, route, candidate_class, reason and both evidence arrays."""
    s = signals(facts)
    gv_is = lambda x: F.col("gv").eqNullSafe(x)
    outcome = lambda r, k, why: F.struct(F.lit(r).alias("route"), F.lit(k).alias("candidate_class"), (why if isinstance(why, Column) else F.lit(why)).alias("reason"))
    clash = outcome("unresolved", "conflicting", CONFLICT)
    organelle_why = F.when(gv_is("organelle"), F.lit(ORGANELLE_MAJORITY)).otherwise(F.lit(ORGANELLE_SHARE))
    euk_why = F.when(F.col("fallback"), F.lit(FALLBACK)).otherwise(F.concat(F.get("lines", F.lit(0)), F.lit(" and "), F.get("lines", F.lit(1)), F.lit(" support a eukaryotic route")))
    decided = (
        F.when(gv_is("ambiguous"), outcome("unresolved", "conflicting", AMBIGUOUS))
        .when(F.col("organelle") & (F.col("euk") | F.col("viral")), outcome("unresolved", "conflicting", organelle_why))
        .when(F.col("organelle"), outcome("unresolved", "unresolved", organelle_why))
        .when(F.col("share_prok") & F.col("viral"), clash)
        .when(F.col("share_prok"), outcome("prokaryotic", "bacterial_archaeal_candidate", F.when(gv_is("prokaryotic"), F.lit(PROKARYOTIC_MAJORITY)).otherwise(F.lit(PROKARYOTIC_SHARE))))
        .when(F.col("euk") & (F.col("viral") | gv_is("prokaryotic") | F.col("strong_prok")), clash)
        .when(F.col("euk"), outcome("eukaryotic", "eukaryotic_candidate", euk_why))
        .when(F.col("viral") & (F.col("prok") | F.col("other_line")), clash)
        .when(F.col("viral"), outcome("viral", "viral_candidate", VIRAL))
        .when(gv_is("prokaryotic"), outcome("prokaryotic", "bacterial_archaeal_candidate", PROKARYOTIC_MAJORITY))
        .otherwise(outcome("unresolved", "unresolved", F.when(F.size("lines") > 0, F.lit(ONE_LINE)).otherwise(F.lit(NO_LINE))))
    )
    s = s.withColumn("o", decided).select("*", "o.route", "o.candidate_class", "o.reason").drop("o")
    tagged = lambda tag, c: F.concat(F.lit(tag + ":"), c)
    one = lambda when, item: F.when(when, F.array(item)).otherwise(F.array().cast("array<string>"))
    many = lambda when, items: F.when(when, items).otherwise(F.array().cast("array<string>"))
    major, check, quick = tagged("GVClass", F.col("majority")), tagged("CheckEUK", F.col("lineage")), tagged("QuickClade", F.col("quick_lineage"))
    prok_share = tagged("Tiara", fixed(F.col("prok_share"), 4))
    euk_shown = F.col("euk") & (F.col("route") != "prokaryotic")
    supporting = F.flatten(F.array(
        one(gv_is("organelle"), major), one(F.col("share_organelle"), tagged("Tiara", fixed(F.col("org_share"), 4))),
        one(euk_shown & F.col("resolved"), check), one(euk_shown & gv_is("eukaryotic"), major), many(euk_shown, F.transform("ssu", lambda x: F.concat(F.lit("SSU:"), x))),
        one(euk_shown & (F.col("derived_share") >= HALF), tagged("Tiara", fixed(F.col("derived_share"), 4))),
        one(gv_is("prokaryotic"), major), one(gv_is("prokaryotic") & F.col("quick").eqNullSafe("prokaryotic"), quick),
        one(F.col("share_prok"), prok_share), one(F.col("share_prok"), F.concat(F.lit("CheckM2:"), fixed(F.col("completeness"), 2), F.lit("/"), fixed(F.col("contamination"), 2))),
        one(gv_is("viral"), major), many(F.col("viral_share") >= HALF, F.transform(F.filter("virus_items", lambda x: ~x.contains("|provirus_")), lambda x: F.concat(F.lit("geNomad:"), x))),
    ))
    conflicting = F.flatten(F.array(
        one((F.col("quick_domain") != "") & F.col("quick").isNull(), tagged("QuickClade-unresolved", F.col("quick_lineage"))),
        one(F.col("euk") & F.col("quick").eqNullSafe("prokaryotic"), quick),
        one(F.col("viral") & F.col("prok"), F.lit(PROK_VIRAL)),
        one(F.col("viral") & F.col("other_line"), F.lit(EUK_VIRAL)),
        one(F.col("euk") & gv_is("prokaryotic"), major), one(F.col("euk") & F.col("strong_prok") & ~F.col("share_prok"), prok_share),
        one(gv_is("ambiguous"), major), one(F.col("organelle") & (F.col("euk") | F.col("viral")), F.lit(ORGANELLE_ANY)),
        one(F.col("share_prok") & F.col("resolved"), check), one(F.col("share_prok") & gv_is("eukaryotic"), major),
        one((F.col("viral_share") > 0) & (F.col("viral_share") < HALF), tagged("geNomad-minority", fixed(F.col("viral_share"), 4))),
    ))
    named = F.when(F.col("resolved"), stripped(F.col("lineage"))).when(F.col("reason") == FALLBACK, F.col("majority")).otherwise("")
    source = F.when(F.col("resolved"), F.lit("checkeuk")).when(F.col("reason") == FALLBACK, F.lit("gvclass_fallback")).otherwise("")
    return s.withColumns({"supporting": supporting, "conflicting": conflicting, "taxonomy": named, "taxonomy_source": source})


def ledger(routed: DataFrame, loci: DataFrame, viruses: DataFrame, keys: list[str]) -> DataFrame:
    """The ledger's text columns (``LEDGER`` but for scope columns that are not keys).

    ``routed`` has quick_confidence and majority_confidence; loci and viruses
    have ``ordinal`` and ``record``, a struct that becomes one JSON object.
    """
    listed = lambda d, name: d.groupBy(*keys).agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "record"))), lambda x: x["record"])).alias(name))
    rows = routed.join(listed(loci, "ssu_json"), keys, "left").join(listed(viruses, "virus_json"), keys, "left")
    share = lambda c: fixed(F.col(c), 4)
    dup = F.when(F.col("bin_bp") > 0, F.col("dup_bp") / F.col("bin_bp")).otherwise(0.0)
    none = F.lit("[]")
    shown = {
        "route": F.col("route"), "candidate_class": F.col("candidate_class"), "reason": F.col("reason"), "checkeuk_status": F.col("status"), "checkeuk_lineage": F.col("lineage"), "taxonomy": F.col("taxonomy"), "taxonomy_source": F.col("taxonomy_source"),
        "quickclade_domain": F.col("quick_domain"), "quickclade_lineage": F.col("quick_lineage"), "quickclade_confidence": F.col("quick_confidence"), "gvclass_domain": F.substring_index(stripped(F.col("majority")), ";", 1), "gvclass_taxonomy_majority": F.col("majority"),
        "gvclass_taxonomy_confidence": F.col("majority_confidence"), "linked_eukaryotic_ssu": F.coalesce("ssu_json", none), "linked_genomad_viruses": F.coalesce("virus_json", none), "supporting_evidence": F.to_json("supporting"), "conflicting_evidence": F.to_json("conflicting"),
        "bin_bp": F.col("bin_bp").cast("string"), "tiara_eukaryote_fraction": share("euk_share"), "tiara_prokaryote_fraction": share("prok_share"), "tiara_organelle_fraction": share("org_share"), "tiara_unclassified_fraction": share("uncl_share"),
        "viral_contig_fraction": share("viral_share"), "checkm2_completeness": F.coalesce(fixed(F.col("completeness"), 2), F.lit("")), "checkm2_contamination": F.when(F.col("completeness").isNull(), F.lit("")).otherwise(fixed(F.col("contamination"), 2)),
        "duplicated_contig_fraction": fixed(dup, 4),
    }
    return rows.select(*[F.col(k).cast("string").alias(k) for k in keys], *[c.alias(n) for n, c in shown.items()])
