"""Exact windows and joins for groups of any size.

A window puts one whole group into one task.  That is right for ordinary keys
and fatal for a key that holds a third of the table.  The helpers here route the
few hot groups through a range-partitioned path and leave everything else on the
plain operator; both paths give the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from harborline.session import materialize

HOT_ROWS_CONF = "harborline.skew.hotGroupRows"
HOT_SAMPLE_CONF = "harborline.skew.sampleFraction"
DEFAULT_HOT_ROWS = 2_000_000
DEFAULT_SAMPLE = 0.001
STORED_ROWS_CONF = "harborline.skew.rowsPerTask"
DEFAULT_ROWS_PER_TASK = 100_000   # few enough that small inputs have full tasks as well


def by_key(stored: DataFrame, key: str) -> DataFrame:
    """A stored table spread by a key over as many tasks as its rows need.

    A fixed number of shuffle partitions would let what a task sorts grow with the
    input.  The count comes from the footers of the stored files.
    """
    spark = stored.sparkSession
    rows = int(spark.conf.get(STORED_ROWS_CONF, str(DEFAULT_ROWS_PER_TASK)))
    return stored.repartition(max(spark.sparkContext.defaultParallelism, math.ceil(stored.count() / rows)), key)


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Keys whose group is too large for one task, or None when there are none.

    A sampled, column-pruned count finds them; the sample only decides which of
    two exact paths a group takes, so a miss costs time and never changes a
    result.  The keys stay a written table, however many there are.  With each
    goes ``_tasks``, over how many tasks its rows should meet a partner.
    """
    spark = df.sparkSession
    limit = int(spark.conf.get(HOT_ROWS_CONF, str(DEFAULT_HOT_ROWS)))
    fraction = float(spark.conf.get(HOT_SAMPLE_CONF, str(DEFAULT_SAMPLE)))
    probe = df.select(*keys)
    counted = probe.sample(False, fraction, seed=17) if fraction < 1.0 else probe
    hot = materialize(
        counted.groupBy(*keys).agg(F.expr("COUNT(*) AS _n"))
        .where(f"_n >= {max(1, math.ceil(limit * fraction))}")
        .selectExpr(*keys, f"CAST(CEIL(_n / {limit * fraction}D) AS INT) AS _tasks"), "hot_keys")
    return None if hot.isEmpty() else hot


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """NULL-safe equality on all keys; a window treats NULL as a group as well."""
    condition = left[keys[0]].eqNullSafe(right[keys[0]])
    for key in keys[1:]:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def only_keys(df: DataFrame, wanted: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows whose key is (left_semi) or is not (left_anti) among the wanted ones.

    The written list is broadcast if its size allows; beyond that the adaptive
    skew join splits the hot rows, which a semi or anti join only looks up.
    """
    renamed = wanted.select(*[F.col(k).alias(f"_hot_{k}") for k in keys])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    return df.join(renamed, condition, how)


def split_hot(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Split rows into (ordinary groups, hot groups or None)."""
    hot = hot_keys(df, keys)
    if hot is None:
        return df, None
    return only_keys(df, hot, keys, "left_anti"), only_keys(df, hot, keys)


def join_unique(many: DataFrame, one: DataFrame, key: str, probe: DataFrame | None = None) -> DataFrame:
    """Inner join where ``one`` has one row per key and ``many`` may have a hot key.

    Ordinary keys meet in a shuffled join, hot keys in a salted one.
    ``probe`` is a table to look for hot keys in when ``many`` is costly to
    compute, such as the rows it is derived from; any choice gives the same rows.
    """
    hot = hot_keys(many if probe is None else probe, [key])
    if hot is None:
        return many.join(one, key)
    return only_keys(many, hot, [key], "left_anti").join(one, key).unionByName(
        join_hot(only_keys(many, hot, [key]), one, hot, key)
    )


def join_hot(hot_rows: DataFrame, one: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Each partner row is repeated once per task its key's rows are dealt to.

    A key gets one task per ``hotGroupRows`` rows, so there are never more repeats
    than rows they meet, however many keys are hot.
    """
    tasks = hot.selectExpr(f"{key} AS _hot_key", "_tasks")
    salted = hot_rows.join(tasks, F.col(key) == F.col("_hot_key")).withColumn(
        "_salt", F.pmod(F.xxhash64(*[hot_rows[c] for c in hot_rows.columns]), F.col("_tasks")).cast("int")).drop("_hot_key", "_tasks")
    partners = one.join(tasks, F.col(key) == F.col("_hot_key")).selectExpr(*one.columns, "EXPLODE(SEQUENCE(0, _tasks - 1)) AS _salt")
    return salted.join(partners, [key, "_salt"]).drop("_salt")


def _row_number(keys: Sequence[str], order: Sequence[str]) -> str:
    return f"CAST(ROW_NUMBER() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)}) AS BIGINT)"


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` at any group size.

    ``order`` holds sort expressions such as ``"day ASC NULLS LAST"``.
    """
    cold, hot = split_hot(df, keys)
    result = cold.selectExpr("*", f"{_row_number(keys, order)} AS {out}")
    return result if hot is None else result.unionByName(ranked_sliced(hot, keys, order, out))


def _sort_column(text: str) -> Column:
    """``"day ASC NULLS LAST"`` as a Column, for the range partitioning."""
    name, direction = text.split(" ", 1)
    return {"ASC NULLS LAST": F.col(name).asc_nulls_last, "DESC NULLS LAST": F.col(name).desc_nulls_last}[direction]()


def ranked_sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """The same row numbers, with every group spread over many tasks.

    Range partitioning on keys and order cuts a large group into consecutive
    slices.  A row's number is its place within the slice plus the sizes of the
    group's earlier slices.  The written copy pins each row to its slice.
    """
    sliced = materialize(
        df.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys], *[_sort_column(o) for o in order])
        .selectExpr("*", "SPARK_PARTITION_ID() AS _slice"),
        "slices",
    )
    local = sliced.selectExpr("*", f"{_row_number([*keys, '_slice'], order)} AS _place")
    # only a slice's first and last group can go on in another one
    key = f"STRUCT({', '.join(keys)})"
    ends = sliced.groupBy("_slice").agg(F.expr(f"MIN({key}) AS _first"), F.expr(f"MAX({key}) AS _last")).selectExpr(
        "_slice AS _at", "_first", "_last")
    offsets = (
        sliced.join(F.broadcast(ends), F.expr(f"_slice = _at AND ({key} <=> _first OR {key} <=> _last)"), "left_semi")
        .groupBy(*keys, "_slice").agg(F.expr("COUNT(*) AS _n"))
        .selectExpr(
            *keys, "_slice",
            f"SUM(_n) OVER (PARTITION BY {', '.join(keys)} ORDER BY _slice "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _offset",
        )
        .where("_offset > 0")
    )
    # Only a group cut by a slice border has an offset, and each border cuts at
    # most one group: there are fewer offsets than slices.
    joined = local.join(F.broadcast(offsets), _same(local, offsets, [*keys, "_slice"]), "left")
    return joined.select(*[local[c] for c in df.columns], local["_place"], offsets["_offset"]).selectExpr(
        *df.columns, f"_place + COALESCE(_offset, 0) AS {out}"
    )
