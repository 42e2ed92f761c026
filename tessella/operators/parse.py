"""Native cells to record rows: lineages, ranks, terms, markers, decisions by rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import present, stripped

#: Rank prefixes of lineage strings, and the ranks of viral lineages by place.
RANKS = {"d": "domain", "k": "kingdom", "sg": "supergroup", "p": "phylum", "c": "class", "o": "order", "f": "family", "g": "genus", "s": "species"}
VIRUS_RANKS = ["root", "realm", "kingdom", "phylum", "class", "order", "family", "genus", "species"]
PRIMARY = 2308
ORGANISM_FLAGS = 1796


def lineage(rows: DataFrame, text: str = "lineage") -> DataFrame:
    """One row for each named rank: rank, taxon_name, and its place. Empty names are skipped; an unknown prefix is its own rank."""
    out = rows.select("*", F.posexplode(F.split(text, ";")).alias("place", "part")).withColumn("part", stripped(F.col("part")))
    prefix, name = F.regexp_extract("part", r"^([a-z]+)_{1,2}(.*)$", 1), F.regexp_extract("part", r"^([a-z]+)_{1,2}(.*)$", 2)
    ranks = F.create_map(*[F.lit(x) for pair in RANKS.items() for x in pair])
    out = out.withColumn("rank", F.coalesce(F.element_at(ranks, prefix), prefix)).withColumn("taxon_name", stripped(name))
    return out.where("rank <> '' and taxon_name <> ''").drop("part")


def repeated_ranks(ranked: DataFrame, keys: list[str]) -> DataFrame:
    return ranked.groupBy(*keys, "rank").agg(F.count("*").alias("times")).where("times > 1")


def virus_lineage(rows: DataFrame, text: str = "lineage") -> DataFrame:
    """Ranks by place from the root ``Viruses`` on; blank places are skipped."""
    out = rows.where(F.substring_index(text, ";", 1) == "Viruses").select("*", F.posexplode(F.split(text, ";")).alias("place", "taxon_name"))
    ranks = F.array(*[F.lit(r) for r in VIRUS_RANKS])
    return out.withColumn("rank", F.get(ranks, F.col("place"))).where((stripped(F.col("taxon_name")) != "") & F.col("rank").isNotNull())


def terms(rows: DataFrame, columns: dict[str, str], sep: str = ",") -> DataFrame:
    """One row for each different term of list-valued cells; ``columns`` maps a column to its database."""
    keep = [c for c in rows.columns if c not in columns]
    parts = [rows.select(*keep, F.lit(db).alias("database"), F.explode(F.array_distinct(F.split(present(F.col(c), ("", "-")), sep))).alias("accession")) for c, db in columns.items()]
    return reduce(DataFrame.unionByName, parts).where("accession <> ''")


def member_and_integrated(rows: DataFrame, member: str = "member", integrated: str = "integrated") -> DataFrame:
    """One row for the member signature and one for the entry it is integrated in, which has no score."""
    both = F.array_compact(F.array(F.struct(F.col(member).alias("accession"), F.lit(True).alias("scored")), F.when(present(F.col(integrated), ("", "-")).isNotNull(), F.struct(F.col(integrated).alias("accession"), F.lit(False).alias("scored")))))
    return rows.withColumn("x", F.explode(both)).withColumns({"accession": F.col("x.accession"), "score": F.when(F.col("x.scored"), F.col("score"))}).drop("x", member, integrated)


def marker_fraction(cell: Column) -> tuple[Column, Column]:
    """(present, total) of a cell ``k/n``; null if it is none."""
    pattern = r"\A([0-9]+)/([0-9]+)\z"
    part = lambda k: F.when(cell.rlike(pattern), F.regexp_extract(cell, pattern, k).cast("long"))
    return part(1), part(2)


def first_failing(checks: list[tuple[Column, str]]) -> Column:
    """The text of the first check that holds; null if none does."""
    out: Column | None = None
    for when, text in checks:
        out = F.when(when, F.lit(text)) if out is None else out.when(when, F.lit(text))
    return out if out is not None else F.lit(None).cast("string")


def pair_scores(cell: Column) -> Column:
    """A map from ``rank:score;rank:score``."""
    return F.str_to_map(cell, F.lit(";"), F.lit(":"))


def mapping_policy(command: Column) -> Column:
    """Whether a command keeps primary alignments only: its excluded flags, with the defaults, hold all of PRIMARY."""
    flags = F.coalesce(F.regexp_extract(command, r"-F\s+([0-9]+)", 1).try_cast("int"), F.lit(0))
    return flags.bitwiseOR(ORGANISM_FLAGS).bitwiseAND(PRIMARY) == PRIMARY


def kept_alignments(rows: DataFrame, flag: str = "flag", quality: str = "mapq", least: int = 20) -> DataFrame:
    return rows.where((F.col(flag).bitwiseAND(PRIMARY) == 0) & (F.col(quality) >= least))


def kept_reads(rows: DataFrame, least_length: int = 1000, least_quality: float = 10.0) -> DataFrame:
    return rows.where((F.col("length") >= least_length) & (F.col("mean_quality") >= least_quality))
