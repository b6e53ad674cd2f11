"""URL filter: path templates per host, judged by smoothed labelled purity.

Explicit rules come first: the longest rule whose host is the URL's host or a
parent domain and whose path starts the URL's path gives the verdict.  The URLs a rule
judges are the labels for the others:

* per host, a tree of path segments is built level by level.  A node with many
  children, few visits each, is variable: its children become the wildcard ``*``;
* siblings whose labelled share of blocked URLs does not differ significantly
  from their siblings' pooled share are merged into one branch ``~`` (a test
  against the pool, so no pairs of siblings);
* a template - the generalised path on its host - is rejected when its share of
  blocked labels, smoothed by the same template on all hosts, which is smoothed
  by all labels, exceeds a threshold.

All levels run on distinct (host, path) pairs with counts; grouping is by sums
and counts, so a host with a third of all rows is pre-aggregated map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborline.session import materialize

# The rules of the registered query.
RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)
# Shapes that are variable however few a node has: numbers and long hexadecimal ids, with or without a file ending.
VARIABLE = "^([0-9]+|[0-9a-f]{8,})([.][A-Za-z0-9]+)?$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_column(url: str) -> Column:
    found = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_column(url: str) -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, NULL without one."""
    rule = verdict = F.lit(None).cast("string")
    for host, path, what in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def templates(urls: DataFrame, max_depth: int, max_children: int, z: float) -> DataFrame:
    """(host, path, n, labelled, blocked) to the same with ``template``."""
    level = urls.withColumn("segments", F.expr("filter(split(path, '/'), x -> x != '')")).withColumn("template", F.lit(""))
    depth = level.agg(F.max(F.size("segments"))).first()[0] or 0
    for d in range(min(depth, max_depth)):
        # Below the last level the rest of a path is one segment.
        rest = F.expr("array_join(slice(segments, {0}, greatest(size(segments) - {1}, 1)), '/')".format(d + 1, d))
        level = level.withColumn("segment", F.when(F.size("segments") > d, rest if d == max_depth - 1 else F.col("segments")[d]))
        branches = level.where("segment IS NOT NULL").groupBy("host", "template", "segment").agg(
            F.sum("n").alias("n"), F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
        nodes = branches.groupBy("host", "template").agg(
            F.count("*").alias("children"), F.sum("n").alias("visits"), F.sum("l").alias("pool_l"), F.sum("b").alias("pool_b"))
        share, pool = F.col("b") / F.col("l"), (F.col("pool_b") + 0.5) / (F.col("pool_l") + 1)
        similar = (F.col("l") > 0) & (F.abs(share - pool) <= z * F.sqrt(pool * (1 - pool) / F.col("l")))
        named = branches.join(nodes, ["host", "template"]).select(
            "host", "template", "segment",
            F.when((F.col("children") > max_children) & (2 * F.col("children") > F.col("visits")) | F.col("segment").rlike(VARIABLE), F.lit("*"))
            .when((F.col("children") > 1) & similar, F.lit("~")).otherwise(F.col("segment")).alias("name"))
        level = materialize(
            level.join(named, ["host", "template", "segment"], "left")
            .withColumn("template", F.when(F.col("name").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), "name")))
            .drop("segment", "name"), "url_level")
    return level.drop("segments")


def url_verdicts(pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES, max_depth: int = 6,
                 max_children: int = 20, z: float = 2.0, smoothing: float = 5.0, threshold: float = 0.5) -> DataFrame:
    """One row per input row: key, host, path, rule, verdict, template, blocked_share.

    NULL URLs and those without ``://`` have empty host and path and are judged
    like any other template.  Repeated rows are judged alike; without any label
    all is allowed; an empty table gives an empty result.  Other columns are
    ignored.
    """
    rows = pages.select(F.col(key).alias("key"), host_column(url).alias("host"), path_column(url).alias("path"))
    rule, verdict = rule_columns(rules)
    rows = rows.withColumns({"rule": rule, "by_rule": verdict})
    urls = materialize(rows.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count("by_rule").alias("labelled"), F.count_if(F.col("by_rule") == "block").alias("blocked")), "urls")
    named = templates(urls, max_depth, max_children, z)
    totals = named.groupBy("host", "template").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
    everywhere = totals.groupBy("template").agg(F.sum("l").alias("all_l"), F.sum("b").alias("all_b"))
    overall = urls.agg(F.sum("labelled"), F.sum("blocked")).first()
    base = (overall[1] or 0) / overall[0] if overall[0] else 0.0
    prior = (F.col("all_b") + smoothing * base) / (F.col("all_l") + smoothing)
    judged = totals.join(everywhere, "template").select(
        "host", "template", ((F.col("b") + smoothing * prior) / (F.col("l") + smoothing)).alias("blocked_share"))
    of_url = named.select("host", "path", "template").join(judged, ["host", "template"]).select(
        "host", "path", "template", "blocked_share")
    return rows.join(of_url, ["host", "path"]).select(
        "key", "host", "path", "rule",
        F.coalesce("by_rule", F.when(F.col("blocked_share") > threshold, "block").otherwise("allow")).alias("verdict"),
        "template", "blocked_share")
