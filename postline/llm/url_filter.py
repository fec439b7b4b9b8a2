"""URL filter: rules first, then a tree of path templates per host.

A path is a list of segments; runs of digits in one, and long hexadecimal
names, are wildcards from the start. Then level by level, per host and the
template so far: where a level has many different segments, those with a small
share become one wildcard, and so do those whose share of rejected labels does
not differ from their siblings' by a two-proportion test. The labels of what
has become one template give its purity, smoothed by the share of all labels;
impure templates are blocked.

The tree is tables of counts: a hot host is many rows that are added up before
they are shuffled.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.session import stage

# Standard deviations by which shares differ, and labels without which a child cannot differ.
DIFFER = 1.96
LEAST_LABELS = 5
# Weight of the overall share of good labels, and the purity below which a template is rejected.
PRIOR = 5.0
PURITY = 0.5
ANY = "*"
# Digits and long hexadecimal names in a segment.
DIGITS = "[0-9]+"
HEX_NAME = "(?i)\\b[0-9a-f]{8}-?[0-9a-f-]{8,}\\b"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """From the first `://` to the next `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or for NULL."""
    return F.translate(F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host to the next `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule whose host the host is or ends in, and whose path the path starts with; else NULL."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, rule.name).otherwise(found)
    return found


def segments(path: Column) -> Column:
    """The segments of a path, with digits and long hexadecimal names as wildcards."""
    parts = F.filter(F.split(path, "/"), lambda part: part != "")
    return F.transform(parts, lambda part: F.regexp_replace(F.regexp_replace(part, HEX_NAME, ANY), DIGITS, ANY))


def _counts() -> list[Column]:
    return [F.sum(name).alias(name) for name in ("n", "good", "bad")]


def _level(leaves: DataFrame, level: int) -> DataFrame:
    """The leaves with their template grown by one segment; by all that is left, where a node has a single leaf."""
    segment = F.try_element_at("segments", F.lit(level + 1))
    named = leaves.withColumn("_segment", segment)
    node = ["host", "template"]
    children = named.filter("_segment IS NOT NULL").groupBy(*node, "_segment").agg(F.count(F.lit(1)).alias("leaves"), *_counts())
    parents = children.groupBy(*node).agg(
        F.count(F.lit(1)).alias("_kids"), F.sum("leaves").alias("_leaves"), *[F.sum(c).alias(f"_{c}") for c in ("good", "bad")]
    )
    labels, others = F.col("good") + F.col("bad"), F.col("_good") + F.col("_bad") - F.col("good") - F.col("bad")
    # Without labels a share is NULL, and differs from nothing.
    pooled = F.try_divide("_bad", F.col("_good") + F.col("_bad"))
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), labels) + F.try_divide(F.lit(1.0), others)))
    shares = F.try_divide("bad", labels), F.try_divide(F.col("_bad") - F.col("bad"), others)
    apart = F.abs(shares[0] - shares[1]) > DIFFER * spread
    differs = (labels >= LEAST_LABELS) & (others >= LEAST_LABELS) & F.coalesce(apart, F.lit(False))
    alone = F.col("_kids") == 1
    grown = F.when(differs | alone, F.col("_segment")).otherwise(F.lit(ANY))
    single = (F.col("_leaves") == 1).alias("_single")
    chosen = children.join(parents, node).select(*node, "_segment", grown.alias("_grown"), single)
    joined = named.join(chosen, [*node, "_segment"])
    rest = F.array_join(F.slice("segments", level + 1, F.size("segments")), "/")
    longer = F.concat("template", F.lit("/"), F.when(F.col("_single"), rest).otherwise(F.col("_grown")))
    return joined.select("host", "segments", longer.alias("template"), "n", "good", "bad", F.col("_single").alias("done"))


def path_templates(labelled: DataFrame) -> DataFrame:
    """host, segments, template, purity of every kind of path in `labelled`, which has url and bad.

    `bad` is 1, 0, or NULL where there is no label.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    one = lambda value: F.sum((F.col("bad") == value).cast("bigint"))
    leaves = (
        labelled.select(host.alias("host"), segments(path).alias("segments"), "bad")
        .groupBy("host", "segments")
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(one(0), F.lit(0)).alias("good"), F.coalesce(one(1), F.lit(0)).alias("bad"))
        .withColumns({"template": F.lit(""), "done": F.lit(False)})
    )
    leaves = stage(leaves, "paths")
    totals = leaves.agg(F.sum("good"), F.sum("bad")).first()
    level = 0
    while True:
        grows = ~F.col("done") & (F.size("segments") > level)
        if leaves.filter(grows).isEmpty():
            break
        grown = _level(leaves.filter(grows).drop("done"), level)
        leaves = stage(leaves.filter(~grows).select(*grown.columns).unionByName(grown), "paths")
        level += 1
    good, bad = totals[0] or 0, totals[1] or 0
    share = good / (good + bad) if good + bad else 1.0
    purity = (F.sum("good") + PRIOR * share) / (F.sum("good") + F.sum("bad") + PRIOR)
    pure = leaves.groupBy("host", "template").agg(purity.alias("purity"))
    return leaves.join(pure, ["host", "template"]).select("host", "segments", "template", "purity")


def judge_urls(
    pages: DataFrame, labels: DataFrame, rules: tuple[Rule, ...], keep: tuple[str, ...] = ("page_id",)
) -> DataFrame:
    """The kept columns, host, path, rule, verdict and template of every url.

    `labels` has url and bad (1, 0 or NULL), one row per known or unknown url of
    the corpus. A url that is NULL or has no `://` has an empty host and path,
    and is judged like any other host's. Hosts and paths without labels have
    the purity of all labels. Repeated rows are all returned; without any
    labels all that no rule blocks is allowed; an empty table gives no rows.
    """
    judged = stage(path_templates(labels), "templates").select(
        F.col("host").alias("_h"), F.col("segments").alias("_s"), "template", "purity"
    )
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    named = pages.select(*keep, host.alias("host"), path.alias("path")).withColumn("segments", segments(F.col("path")))
    found = named.join(judged, (F.col("host") == F.col("_h")) & (F.col("segments") == F.col("_s")), "left")
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    verdicts = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.verdict)]) if rules else None
    own = F.when(F.col("purity") < PURITY, "block").otherwise("allow")
    verdict = F.coalesce(F.element_at(verdicts, F.col("rule")), own) if rules else own
    return found.withColumn("rule", rule).select(*keep, "host", "path", "rule", verdict.alias("verdict"), "template")
