"""URL filter: listed rules, then a tree of path templates per host.

A listed rule fits its host and all subdomains where the path starts with the rule's; the longest
wins. Up to ``IN_PLAN`` rules are an expression; more are a table that the distinct (host, path) are joined with, by the
ends of the host and the path's beginnings of the lengths that the rules of such an end have. Urls under a rule are also the labelled examples of the method, which judges the rest:

1. Per host the distinct paths are walked level by level. At each node a segment with fewer than
   ``SUPPORT`` urls of its own, or one of digits only, is variable: it becomes ``*``. Any other stays a branch,
   whatever its share. Beyond ``DEPTH`` levels the rest of a path is one segment.
2. Constant branches of a node that are statistically similar merge. Branches whose urls are all blocked,
   all allowed or all unlabelled are similar to their like and enter as one unit each; these and the
   mixed branches (at most one per rule) are put in order of their blocked share and joined while a
   homogeneity test over (blocked, allowed, unlabelled) does not tell neighbours apart.
3. A template is rejected if its labelled purity is at least ``PURITY``. It is smoothed by ``PRIOR`` urls of
   even odds and by ``DOUBT`` of such a url for each unlabelled one, so a few blocked urls do not
   speak for thousands nobody labelled. Templates without labels stay at 0.5 and are allowed.

Everything is counted per distinct (host, path) first, so a host with a third of all rows ships
its distinct paths only; the labels of branches, few per node, are joined back to them.

Defined results: a null url, or one without ``://``, has empty host and path; repeated rows
count for the weight of their path; ties between rules of one length go to the first in order;
an empty table gives no rows. Extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formlake.llm.common import staged
from formlake.operators.joins import lookup_join, lookup_scope

SUPPORT = 5
DEPTH = 8
CHI2 = 9.21  # two degrees of freedom, 1 %
PRIOR = 2.0
DOUBT = 0.1
PURITY = 0.85
IN_PLAN = 100
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Rule = tuple[str, str]  # ("host/path", "allow" or "block")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return F.translate(part(1), _UPPER, _LOWER), part(2)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, as one expression over all rules; nulls where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        text, verdict = F.when(fits, F.lit(rule)).otherwise(text), F.when(fits, F.lit(says)).otherwise(verdict)
    return text, verdict


def with_rules(urls: DataFrame, rules: Sequence[Rule], label: str = "url") -> DataFrame:
    """``urls`` (host, path and others) with the longest rule that fits and its verdict ``says``; any number of rules."""
    if len(rules) <= IN_PLAN:
        rule, says = rule_of(F.col("host"), F.col("path"), rules)
        return urls.withColumns({"rule": rule, "says": says})
    split = [(*rule.partition("/")[::2], rule, says) for rule, says in dict(rules).items()]
    listed = urls.sparkSession.createDataFrame([(name, f"/{rest}", rule, says) for name, rest, rule, says in split], "name string, start string, rule string, says string")
    lengths = listed.groupBy("name").agg(F.collect_set(F.length("start")).alias("lengths"))
    names = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(names)), lambda i: F.array_join(F.slice(names, i, F.size(names)), "."))
    with lookup_scope():
        tried = urls.select("host", "path").distinct().withColumn("name", F.explode(ends))
        tried = lookup_join(tried, lengths, ["name"], "inner").withColumn("size", F.explode("lengths")).filter(F.length("path") >= F.col("size"))
        tried = tried.withColumn("start", F.substring("path", F.lit(1), F.col("size"))).select("host", "path", "name", "start")
        fits = lookup_join(tried, listed, ["name", "start"], "inner")
        first = F.min(F.struct((-F.length("rule")).alias("size"), "rule", "says")).alias("x")
        found = staged(fits.groupBy("host", "path").agg(first).select("host", "path", "x.rule", "x.says"), f"{label}-ruled")
    return urls.join(found, ["host", "path"], "left").select(*urls.columns, "rule", "says")


def _counts() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("n", "blocked", "allowed")]


def _branches(kids: DataFrame) -> DataFrame:
    """(node, segment, label) of the constant branches; similar ones share a label."""
    branches = kids.filter((F.col("n") >= SUPPORT) & ~F.col("segment").rlike("^[0-9]+$"))
    whole = [F.when(F.col(c) == F.col("n"), F.lit(c)) for c in ("blocked", "allowed")]
    unlabelled = F.when(F.col("blocked") + F.col("allowed") == 0, F.lit("none"))
    branches = branches.withColumn("unit", F.coalesce(*whole, unlabelled, F.concat(F.lit("="), "segment")))
    kept = branches.groupBy("node", "unit").agg(*_counts(), F.min("segment").alias("low"), F.max("segment").alias("high"), F.count(F.lit(1)).alias("size"))
    order = Window.partitionBy("node").orderBy(F.col("blocked") / F.col("n"), F.col("allowed") / F.col("n"), "low")
    # homogeneity of a branch and the one before it over blocked, allowed and unlabelled urls
    statistic, columns = F.lit(0.0), {"blocked": F.col("blocked"), "allowed": F.col("allowed"), "rest": F.col("n") - F.col("blocked") - F.col("allowed")}
    size, before = F.col("n"), F.lag("n").over(order)
    for value in columns.values():
        last = F.lag(value).over(order)
        for observed, own in ((value, size), (last, before)):
            expected = (value + last) * own / (size + before)
            statistic = statistic + F.when(expected > 0, (observed - expected) ** 2 / expected).otherwise(0.0)
    kept = kept.withColumn("differs", F.coalesce((statistic > CHI2).cast("int"), F.lit(1)))
    kept = kept.withColumn("set", F.sum("differs").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # a label names the first and the last of its branches and how many lie between
    own = Window.partitionBy("node", "set")
    first, last, size = F.min("low").over(own), F.max("high").over(own), F.sum("size").over(own)
    between = F.when(size > 2, F.concat(F.lit("+"), (size - 2).cast("string"), F.lit("|"))).otherwise(F.lit(""))
    label = F.when(size == 1, first).otherwise(F.concat(F.lit("{"), first, F.lit("|"), between, last, F.lit("}")))
    return lookup_join(branches.select("node", "segment", "unit"), kept.select("node", "unit", label.alias("label")), ["node", "unit"]).drop("unit")


def path_templates(paths: DataFrame, label: str = "url") -> DataFrame:
    """(host, path, template, purity) of ``paths``: one row per (host, path) with n, blocked, allowed."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    tail = F.when(F.size("segments") > DEPTH, F.concat(F.slice("segments", 1, DEPTH - 1), F.array(F.array_join(F.expr(f"slice(segments, {DEPTH}, size(segments))"), "/")))).otherwise(F.col("segments"))
    state = paths.withColumn("segments", segments).withColumn("segments", tail).withColumn("node", F.col("host"))
    state = staged(state, f"{label}-paths")
    depth = state.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(1, depth + 1):
        here = state.withColumn("segment", F.get("segments", F.lit(level - 1)))
        kids = here.filter("segment is not null").groupBy("node", "segment").agg(*_counts())
        with lookup_scope():
            branches = staged(_branches(kids), f"{label}-branches")
        named = here.join(branches, ["node", "segment"], "left")
        step = F.when(F.col("segment").isNull(), F.col("node")).otherwise(F.concat("node", F.lit("/"), F.coalesce("label", F.lit("*"))))
        state = staged(named.withColumn("node", step).drop("segment", "label"), f"{label}-level{level}")
    doubt = PRIOR + DOUBT * (F.col("n") - F.col("blocked") - F.col("allowed"))
    purity = (F.col("blocked") + doubt / 2) / (F.col("blocked") + F.col("allowed") + doubt)
    judged = state.groupBy("node").agg(*_counts()).select("node", purity.alias("purity"))
    return state.select("host", "path", "node").join(judged, "node").withColumnRenamed("node", "template")


def judge_urls(pages: DataFrame, rules: Sequence[Rule], label: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every row of ``pages`` (page_id, url)."""
    host, path = url_parts(F.col("url"))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    own = with_rules(own, rules, label)
    count = lambda v: F.sum((F.col("says") == v).cast("long"))
    paths = own.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.coalesce(count("block"), F.lit(0)).alias("blocked"), F.coalesce(count("allow"), F.lit(0)).alias("allowed"))
    found = path_templates(paths, label)
    method = F.when(F.col("purity") >= PURITY, "block").otherwise("allow")
    return own.join(found, ["host", "path"], "left").select("page_id", "host", "path", "rule", F.coalesce("says", method).alias("verdict"), "template", "purity")
