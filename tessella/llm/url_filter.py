"""URL filters from path templates, in DataFrame operations only.

Each host's paths form a tree. Segments that vary freely become wildcards,
level by level. Sibling branches are merged if what follows them has the same
forms as often, and their labelled shares do not differ beyond chance; a
branch without labels joins its siblings if the labelled ones all agree. So
labels reach pages that no rule names. A template is rejected if the share of
blocked pages among its labelled ones, smoothed by a prior, is high enough.
Fixed rules come before the templates and also label them.

The tree is built on counts of templates, not on pages, so a host with most
of the pages has no more rows there than it has different paths.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.shared import materialize

#: Levels of the tree; what lies below is one segment of the last level.
MAX_DEPTH = 6
#: Stands between the segments of that one.
REST = "\u203a"
SALTS = 16


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(url, pattern, 2)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def first_template(path: Column) -> Column:
    """The path's segments, joined, with numbers and opaque tokens (over 40 characters) generalised.

    Below MAX_DEPTH, the rest of the path counts as one segment, whole.
    """
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    general = F.transform(parts, lambda s: F.when(F.length(s) > 40, F.lit("*")).otherwise(F.regexp_replace(s, r"[0-9][0-9A-Fa-f]*", "#")))
    rest = F.array_join(F.slice(general, MAX_DEPTH + 1, F.size(general)), REST)
    return F.array_join(F.when(F.size(general) > MAX_DEPTH, F.concat(F.slice(general, 1, MAX_DEPTH), F.array(rest))).otherwise(general), "/")


def form(parts: Column, level: int) -> Column:
    """What follows the segment at ``level``, with every run of letters as one sign."""
    return F.regexp_replace(F.array_join(F.slice(parts, level + 2, F.size(parts)), "/"), r"\p{L}+", "a")


def templates(pages: DataFrame, variety: int = 20, share: float = 0.3, z: float = 1.96) -> DataFrame:
    """(host, t0, template, blocked, allowed): final templates of all first templates.

    ``pages`` has host, t0 and mark ('block', 'allow' or null). Under one
    parent, segments become a wildcard if there are more than ``variety`` of
    them and they make up more than ``share`` of the pages there. Else those
    are merged into one that pass two tests of ``z`` deviations each: the
    forms that follow are as frequent as in the labelled sibling with most
    pages (chi-square of two samples), and the blocked share is that of all
    siblings that passed the first test.
    Without labels of its own, a segment needs the second test to hold for
    all labelled ones.
    """
    counted = pages.groupBy("host", "t0").agg(F.count("*").alias("n"), F.count(F.when(F.col("mark") == "block", 1)).alias("b"), F.count(F.when(F.col("mark") == "allow", 1)).alias("a"))
    tree = materialize(counted.withColumn("parts", F.split("t0", "/")).withColumn("template", F.lit("")))
    depth = tree.agg(F.max(F.size("parts")).alias("d")).first().d or 0
    for level in range(depth):
        seg = F.get("parts", F.lit(level))
        under = tree.where(F.size("parts") > level).withColumn("seg", seg).withColumn("form", form(F.col("parts"), level))
        forms = under.groupBy("host", "template", "seg", "form").agg(*[F.sum(c).alias(c) for c in "nba"])
        counted = forms.groupBy("host", "template", "seg").agg(*[F.sum(c).alias(c) for c in "nba"], F.count("*").alias("forms")).withColumn("labelled", F.col("a") + F.col("b"))
        size = F.struct("n", "seg", "forms")
        parent = counted.groupBy("host", "template").agg(F.count("*").alias("kinds"), F.sum("n").alias("all_n"), F.max(F.when(F.col("labelled") > 0, size)).alias("x"))
        parent = parent.select("host", "template", "kinds", "all_n", F.col("x.seg").alias("x_seg"), F.col("x.n").alias("x_n"), F.col("x.forms").alias("x_forms"))
        model = forms.join(parent, ["host", "template"]).where("seg = x_seg").select("host", "template", "form", F.col("n").alias("form_n"))
        both = forms.join(model, ["host", "template", "form"], "left").join(counted.select("host", "template", "seg", F.col("n").alias("own")), ["host", "template", "seg"]).join(parent.select("host", "template", "x_n"), ["host", "template"])
        m = F.coalesce("form_n", F.lit(0))
        gap = F.sqrt(F.col("x_n") / F.col("own")) * F.col("n") - F.sqrt(F.col("own") / F.col("x_n")) * m
        chi = both.groupBy("host", "template", "seg").agg(F.sum(gap * gap / (F.col("n") + m)).alias("chi"), F.sum(m).alias("met"), F.count("form_n").alias("common"))
        child = counted.join(parent, ["host", "template"]).join(chi, ["host", "template", "seg"])
        # forms that only the model has
        chi = F.col("chi") + F.col("n") / F.col("x_n") * (F.col("x_n") - F.col("met"))
        df = F.col("forms") + F.col("x_forms") - F.col("common") - 1
        shaped = (F.col("kinds") > 1) & (chi <= df + z * F.sqrt(2 * df) + 1e-6)
        child = child.withColumn("shaped", F.coalesce(shaped, F.lit(False)))
        siblings = child.where("shaped").groupBy("host", "template").agg(F.sum("b").alias("all_b"), F.sum("labelled").alias("all_l"))
        both = child.join(siblings, ["host", "template"], "left")
        base = (F.col("all_b") + 1) / (F.col("all_l") + 2)
        apart = F.abs(F.col("b") - F.col("labelled") * base) / F.sqrt(F.col("labelled") * base * (1 - base) + 0.25)
        both = both.withColumn("fits", F.col("shaped") & (apart < z))
        agree = both.where("shaped and labelled > 0").groupBy("host", "template").agg(F.bool_and("fits").alias("agree"))
        both = both.join(agree, ["host", "template"], "left")
        free = (F.col("kinds") > variety) & (F.col("kinds") > share * F.col("all_n"))
        alike = F.when(F.col("labelled") > 0, F.col("fits")).otherwise(F.col("shaped") & F.col("agree"))
        names = both.select("host", "template", "seg", F.when(free | F.coalesce(alike, F.lit(False)), F.lit("*")).otherwise(F.col("seg")).alias("kept"))
        t, m = tree.withColumn("seg", seg).alias("t"), names.alias("m")
        joined = t.join(m, (F.col("t.host") == F.col("m.host")) & (F.col("t.template") == F.col("m.template")) & (F.col("t.seg") == F.col("m.seg")), "left")
        step = F.when(F.col("t.seg").isNull(), F.col("t.template")).otherwise(F.concat_ws("/", "t.template", F.coalesce("m.kept", "t.seg")))
        tree = materialize(joined.select("t.host", "t.t0", "t.n", "t.b", "t.a", "t.parts", step.alias("template")))
    total = tree.groupBy("host", "template").agg(F.sum("b").alias("blocked"), F.sum("a").alias("allowed"))
    return tree.select("host", "template", "t0").join(total, ["host", "template"])


def smoothed(prior: float = 0.25, weight: float = 4.0) -> Column:
    """The blocked share of a template's labelled pages, with ``weight`` pages of share ``prior`` added."""
    return (F.col("blocked") + prior * weight) / (F.col("blocked") + F.col("allowed") + weight)


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", key: str = "page_id", prior: float = 0.25, weight: float = 4.0, limit: float = 0.5) -> DataFrame:
    """key, host, path, rule, verdict, template and purity of every row.

    The verdict is the rule's, else the template's: ``block`` if its smoothed
    blocked share reaches ``limit``. Templates without a labelled page keep
    the prior and so are allowed. Null urls and urls without a scheme have an
    empty host and path and no rule; they share one template. Repeated rows
    give a row each.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(pages[key].alias("key"), pages[url].alias("url")).select("key", host.alias("host"), path.alias("path"))
    name, mark = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", name).withColumn("mark", mark).withColumn("t0", first_template(F.col("path")))
    found = templates(rows).select("host", "t0", "template", smoothed(prior, weight).alias("purity"))
    # copies of the templates for each salt let a hot host's pages spread
    found = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("key", "path"), F.lit(SALTS)).cast("int"))
    joined = salted.join(found, ["host", "t0", "salt"], "left")
    verdict = F.coalesce("mark", F.when(F.col("purity") >= limit, F.lit("block")).otherwise(F.lit("allow")))
    return joined.select(F.col("key").alias(key), "host", "path", "rule", verdict.alias("verdict"), "template", "purity")
