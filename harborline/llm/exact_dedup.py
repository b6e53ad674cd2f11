"""Exact dedup by a tree merge of sorted digest runs.

Every map task reduces its rows to a run: one row per digest with the winning
identifier and a count, sorted by digest.  In each round ``fan_in`` neighbouring
runs (binomial: 2, 4, 8 or 16) are exchanged to one owner, merged in digest order
and reduced again, until one run is left.  The digest space is cut into ranges
that go through the tree independently, so no task ever holds the final run:
the last level is spread over all ranges.  A group of copies of any size is one
row per run before anything is shuffled.

The digest is SHA-256 together with the text's length and an independent 64-bit
hash, so equal digests are verified at every level: rows that differ in any of
the three never merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborline.llm.common import UID, stored, with_uid

DIGEST = ["_sha", "_len", "_xx"]


def digests(docs: DataFrame, text: str = "text") -> dict[str, Column]:
    whole = F.coalesce(F.col(text), F.lit(""))
    return {"_sha": F.unhex(F.sha2(whole, 256)), "_len": F.octet_length(whole), "_xx": F.xxhash64(whole)}


def merge_runs(runs: DataFrame, keep: str) -> DataFrame:
    """One level: runs that share (range, run) meet in one task and merge in digest order."""
    best = F.max("_best") if keep == "max" else F.min("_best")
    return (
        runs.repartition("_range", "_run").sortWithinPartitions("_range", "_run", *DIGEST)
        .groupBy("_range", "_run", *DIGEST).agg(best.alias("_best"), F.sum("_n").alias("_n")))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "min",
                carry: list[str] | None = None, fan_in: int = 16, ranges: int | None = None) -> DataFrame:
    """Return every row of ``docs`` (columns ``carry``, all by default) with its group's verdict.

    Added columns: keep_id (the smallest or, with ``keep="max"``, largest key of
    the group), group_size, kept and text_sha256.  NULL text counts as empty.  A
    NULL key loses against any other; among rows that repeat key and text, one
    arbitrary but single row is kept.  An empty table gives an empty result.
    Columns of the input that clash with added ones are replaced.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep must be min or max")
    if fan_in < 2:
        raise ValueError("fan_in must be 2 or more")
    spark = docs.sparkSession
    added = ("keep_id", "group_size", "kept", "text_sha256")
    names = [c for c in (carry if carry is not None else docs.columns) if c not in added]
    # Carried columns travel inside a struct, where their names cannot clash.
    rows = stored(with_uid(docs.select(
        F.struct(*names).alias("_row"), F.col(key).alias("_key"), *[c.alias(n) for n, c in digests(docs, text).items()])), "digests")

    # A key wins by (is present, key, row number); negated for "min" a NULL would win, so it is ranked last.
    present = F.col("_key").isNotNull()
    order = F.struct((present if keep == "max" else ~present).alias("p"), F.col("_key").alias("k"), F.col(UID).alias("u"))
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = rows.select(
        F.pmod(F.col("_xx"), F.lit(ranges)).cast("int").alias("_range"), F.spark_partition_id().alias("_run"),
        *DIGEST, order.alias("_best"), F.lit(1).cast("long").alias("_n"))
    # Level 0: reduced in the map task already, before rows leave it.
    best = F.max("_best") if keep == "max" else F.min("_best")
    level = runs.groupBy("_range", "_run", *DIGEST).agg(best.alias("_best"), F.sum("_n").alias("_n"))
    left = max(1, rows.rdd.getNumPartitions())
    while left > 1:
        level = merge_runs(level.withColumn("_run", F.floor(F.col("_run") / fan_in).cast("int")), keep)
        left = -(-left // fan_in)
    winners = level.select(*[F.col(c).alias(f"w{c}") for c in DIGEST], "_best", F.col("_n").alias("group_size"))

    same = [F.col(c) == F.col(f"w{c}") for c in DIGEST]
    joined = rows.join(winners, same[0] & same[1] & same[2])
    return joined.select(
        "_row.*", F.col("_best.k").alias("keep_id"), "group_size", (F.col("_best.u") == F.col(UID)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"))
