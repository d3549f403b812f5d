"""Verdicts on addresses by rules, and by a tree of path templates learned from what the rules say.

Per host the path's segments make a tree, as deep as the paths are. Going down, a value that few of a
node's addresses have is variable and becomes the wildcard. Where fewer addresses go on than a value
needs to stay, nothing below can stay: from a fixed level on, their rest becomes one last wildcard.
The templates below one node are then compared: those whose share of blocked addresses does not
differ, by a chi-square test, from that of all labelled ones below the node are merged. A template
is rejected when the smoothed share of blocked ones among its labelled addresses is high enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.llm.common import written

# Fixed values: (verdict, host, path) of the rules.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: levels at which every segment has a level of its own, however few addresses go on
DEPTH = 3
#: a value stays when at least LEAST addresses have it, and these are SUPPORT, or one in SHARE of its
#: node's, or CHANCE standard deviations more than an even deal over the node's values gives
LEAST, SHARE, SUPPORT, CHANCE = 5, 50, 50, 5
#: weight of smoothing, and the smoothed share (in tenths) from which a template is rejected
SMOOTHING, REJECT = 4, 8
#: of chi-square with one degree of freedom, 5 %
DIFFERS = 3.84

_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty where there is no `://`."""
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), *_LOWER)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def by_rules(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits host and path; null where none does."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    out = None
    for verdict, of, start in ordered:
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        found = F.struct(F.lit(of + start).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out


def templates(rows: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Adds `parent` and `template` to rows of host and path.

    Values are counted over all rows. A level is worked for the rows whose paths reach it; the others
    have left, so that the number of levels is that of the deepest path enough addresses go along.
    """
    segments = F.split(F.substring("path", 2, 2147483647), "/")
    rows = rows.withColumn("segments", F.when(F.col("path") != "", segments).otherwise(F.array()))
    rows = written(
        rows.withColumn("template", F.col("host")).withColumn("parent", F.col("host")), "urls"
    )
    size = F.size("segments")
    done = [rows.filter(size == 0)]
    level = 0
    rows = rows.filter(size > 0)
    while rows.limit(1).count():
        rows = rows.withColumn("value", F.get("segments", F.lit(level)))
        counts = written(rows.groupBy("template", "value").count(), "counts")
        totals = counts.groupBy("template").agg(
            F.sum("count").alias("total"), F.count("*").alias("values")
        )
        even = F.col("total") / F.col("values")
        stays = (F.col("count") >= LEAST) & (
            (F.col("count") >= SUPPORT)
            | (SHARE * F.col("count") >= F.col("total"))
            | (F.col("count") > even + CHANCE * F.sqrt(even))
        )
        # written, so that its exact size tells Spark whether rows need a shuffle to meet it
        kept = written(
            counts.join(totals, "template").filter(stays).select("template", "value", F.lit(True).alias("fixed")),
            "kept",
        )
        rows = rows.join(kept, ["template", "value"], "left")
        if level >= depth:
            many = written(totals.filter(F.col("total") >= LEAST).select("template", F.lit(True).alias("many")), "many")
            rows = rows.join(many, "template", "left")
        else:
            rows = rows.withColumn("many", F.lit(True))
        step = F.when(F.col("many").isNull(), "**").when(F.col("fixed"), F.col("value")).otherwise("*")
        rows = written(
            rows.withColumn("parent", F.col("template"))
            .withColumn("template", F.concat("template", F.lit("/"), step))
            .withColumn("ends", F.col("many").isNull() | (size <= level + 1))
            .drop("fixed", "many", "value"),
            "urls",
        )
        done.append(rows.filter("ends").drop("ends"))
        rows = rows.filter("not ends").drop("ends")
        level += 1
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    return every.drop("segments")


def judged_templates(rows: DataFrame) -> DataFrame:
    """template, merged, labelled, blocked, rejected of every template in `rows`.

    `rows` has parent, template and known (1 blocked, 0 allowed, null without a label).
    """
    own = rows.groupBy("parent", "template").agg(
        F.count("known").alias("n"), F.coalesce(F.sum("known"), F.lit(0)).cast("long").alias("b")
    )
    below = own.groupBy("parent").agg(F.sum("n").alias("all_n"), F.sum("b").alias("all_b"))
    own = own.join(below, "parent")
    # the template against the other labelled ones below its parent
    rest_n, rest_b = F.col("all_n") - F.col("n"), F.col("all_b") - F.col("b")
    free = F.col("all_n") - F.col("all_b")
    gap = (F.col("b") * rest_n - rest_b * F.col("n")).cast("double")
    differs = F.col("all_n") * gap * gap > DIFFERS * (
        F.col("n").cast("double") * rest_n * F.col("all_b") * free
    )
    merged = (F.col("n") > 0) & ~differs
    own = own.withColumn("merged", merged)
    pooled = own.filter("merged").groupBy("parent").agg(F.sum("n").alias("m_n"), F.sum("b").alias("m_b"))
    own = own.join(pooled, "parent", "left")
    own = own.withColumn("labelled", F.when(F.col("merged"), F.col("m_n")).otherwise(F.col("n")))
    own = own.withColumn("blocked", F.when(F.col("merged"), F.col("m_b")).otherwise(F.col("b")))
    # smoothed towards one half
    rejected = 10 * (2 * F.col("blocked") + SMOOTHING) >= 2 * REJECT * (F.col("labelled") + SMOOTHING)
    return own.select("parent", "template", "merged", "labelled", "blocked", rejected.alias("rejected"))


def url_verdicts(
    pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, depth: int = DEPTH
) -> DataFrame:
    """page_id, host, path, rule, verdict, template of every row of `pages` (page_id, url).

    A rule fits its host and all subdomains where the path starts with its path; the longest wins
    (of equally long ones the first by name), and its verdict stands. Other addresses are blocked
    if their template is rejected, else allowed; templates without labelled addresses are allowed.
    Null addresses and those without `://` have empty host and path, and share one template.
    Repeated rows get a row each; other columns are ignored.
    """
    host, path = split_url(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("by_rule", by_rules(F.col("host"), F.col("path"), rules))
    rows = rows.select(
        "page_id",
        "host",
        "path",
        F.col("by_rule.rule").alias("rule"),
        F.col("by_rule.verdict").alias("said"),
    )
    rows = rows.withColumn("known", F.when(F.col("said") == "block", 1).when(F.col("said") == "allow", 0))
    rows = templates(rows, depth)
    judged = written(judged_templates(rows).select("parent", "template", "rejected"), "judged")
    learned = F.when(F.col("rejected"), "block").otherwise("allow")
    return rows.join(judged, ["parent", "template"]).select(
        "page_id", "host", "path", "rule", F.coalesce("said", learned).alias("verdict"), "template"
    )
