"""Column functions for native cells: missing tokens, numbers, names, exact formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Cells that mean "no value", compared without case.
MISSING_MEASURE = ("", "na", "n/a", "nan", "none", "nd", "unavailable")
MISSING_ANNOTATION = ("", "-")
MISSING_COORDINATE = ("", "na", "n/a", "none", "null", ".")


def stripped(c: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def present(c: Column, missing: tuple[str, ...] = MISSING_MEASURE) -> Column:
    """The stripped cell, null for a missing token."""
    text = stripped(F.coalesce(c, F.lit("")))
    return F.when(~F.lower(text).isin(list(missing)), text)


def number(c: Column, missing: tuple[str, ...] = MISSING_MEASURE) -> Column:
    """A finite double, null where the cell is missing or no plain number."""
    text = present(c, missing)
    plain = text.rlike(r"\A[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z")
    value = F.when(plain, text.try_cast("double"))
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def is_bad_number(c: Column, least: float | None = None, most: float | None = None, missing: tuple[str, ...] = MISSING_MEASURE) -> Column:
    """True where a cell holds something that is no finite number within the bounds."""
    value = number(c, missing)
    bad = value.isNull()
    if least is not None:
        bad = bad | (value < least)
    if most is not None:
        bad = bad | (value > most)
    return present(c, missing).isNotNull() & F.coalesce(bad, F.lit(True))


def whole(c: Column, missing: tuple[str, ...] = MISSING_MEASURE) -> Column:
    """A whole number of digits only, else null."""
    text = present(c, missing)
    return F.when(text.rlike(r"\A[0-9]+\z"), text.try_cast("bigint"))


def yes(c: Column, true: str = "true", false: str = "false") -> Column:
    text = F.lower(stripped(c))
    return F.when(text == true, F.lit(True)).when(text == false, F.lit(False))


def fixed(c: Column, places: int) -> Column:
    """The exact binary value rounded half to even, as C's printf rounds it."""
    return F.call_function("format_number", c, F.lit("0" + ("." + "0" * places if places else "")))


def base_name(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def bin_name(c: Column) -> Column:
    """Base name without one FASTA suffix; case matters."""
    return F.regexp_replace(base_name(c), r"\.(fasta|fna|fa)\z", "")


def target_name(c: Column) -> Column:
    """Base name without one FASTA or protein suffix in any case; null if not a safe name."""
    name = F.regexp_replace(base_name(stripped(c)), r"(?i)\.(fasta|fna|faa|fa)\z", "")
    return F.when(name.rlike(r"\A[A-Za-z0-9][A-Za-z0-9._|:-]*\z"), name)


def path_name(c: Column) -> Column:
    """Base name without ``.gz`` and then each of three suffixes in turn."""
    name = F.regexp_replace(base_name(c), r"\.gz\z", "")
    for suffix in ("fasta", "fna", "fa"):
        name = F.regexp_replace(name, rf"\.{suffix}\z", "")
    return name


def stem(c: Column) -> Column:
    """Base name up to its last dot; a leading dot is part of the name."""
    return F.regexp_replace(base_name(c), r"(?<=.)\.[^.]+\z", "")


def first_word(c: Column) -> Column:
    return F.regexp_extract(c, r"^(\S+)", 1)


def safe_component(c: Column) -> Column:
    """A name as it is if safe, else with other characters replaced and ten digits of its digest."""
    cleaned = F.regexp_replace(F.regexp_replace(c, r"[^A-Za-z0-9_.-]+", "_"), r"^[_.-]+|[_.-]+$", "")
    started = F.when(cleaned.rlike(r"\A[A-Za-z0-9]"), cleaned).otherwise(F.concat(F.lit("id_"), cleaned))
    return F.when(c.rlike(r"\A[A-Za-z0-9][A-Za-z0-9_.-]*\z"), c).otherwise(F.concat(started, F.lit("-"), F.substring(F.sha2(c, 256), 1, 10)))


def unquoted(c: Column) -> Column:
    """Percent escapes resolved; plus signs and malformed escapes stay."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def attributes(c: Column) -> Column:
    """A map from the ninth column of a feature table: ``key=value;key=value``."""
    pairs = F.filter(F.transform(F.split(c, ";"), stripped), lambda p: p != "")
    return F.map_from_entries(F.transform(pairs, lambda p: F.struct(unquoted(F.substring_index(p, "=", 1)).alias("key"), unquoted(F.regexp_replace(p, r"^[^=]*=?", "")).alias("value"))))


def row_digest(*columns: Column) -> Column:
    """SHA-256 of the columns' text joined by the unit separator; null reads None."""
    return F.sha2(F.concat_ws(chr(31), *[F.coalesce(c.cast("string"), F.lit("None")) for c in columns]), 256)
