"""Connected components by alternating stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from harborline.session import materialize


def components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node on a link; root is the smallest node of its component.

    Every round hooks neighbours to the smallest node they see, once for larger
    and once for smaller neighbours, so long chains shrink geometrically.  Rows
    per round never exceed the links; nothing is collected but two numbers.
    """
    star = materialize(
        links.selectExpr(f"greatest({a}, {b}) AS u", f"least({a}, {b}) AS v").where("u > v").distinct(), "links")
    before = None
    for _ in range(max_rounds):
        mark = star.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return star.selectExpr("u AS node", "v AS root").union(star.selectExpr("v AS node", "v AS root").distinct())
        before = mark
        both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u")
        star = materialize(
            small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small.select("u", F.col("m").alias("v"))).distinct(), "links")
    raise RuntimeError("components did not settle")
