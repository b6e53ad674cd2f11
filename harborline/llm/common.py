"""Helpers the operators share: row identity, distributed running sums, Arrow slices."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from harborline.session import materialize, shared_folder

# Fixed value: the white space of the word contracts, \x20 and \x09-\x0D.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"

UID = "_uid"


def settings(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds: documents may be megabytes long."""
    for key, value in {
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    }.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    settings(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_uid(docs: DataFrame) -> DataFrame:
    """A row number that is only stable once written; callers materialize it."""
    return docs.withColumn(UID, F.monotonically_increasing_id())


def new_folder(spark: SparkSession, label: str) -> str:
    """A path of its own in the folder that driver and executors share."""
    return f"{shared_folder(spark)}/harborline/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``materialize`` for wide columns (texts, ids): the same, tightly compressed."""
    path = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_column(text: str = "text"):
    """SQL text of the array of words of a column; NULL has none."""
    return f"filter(split(coalesce(`{text}`, ''), '{SPACE_CLASS}'), w -> w != '')".replace("\\", "\\\\")


def running_sums(rows: DataFrame, order: list[str], sums: dict[str, str], group: str | None = None) -> DataFrame:
    """Add, per entry ``new: column``, the sum of ``column`` over all earlier rows of the group.

    Rows are range-partitioned by (group, order), so a group that holds a third
    of all rows is spread over many tasks: sums inside a partition come from a
    window, sums of the partitions before it from their totals.  NULL groups
    form one group.  ``order`` must be unique for a defined result.
    """
    keys = ([group] if group else []) + order
    ranged = materialize(
        rows.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys]).withColumn("_pid", F.spark_partition_id()),
        "ranged")
    by = ["_pid"] + ([group] if group else [])
    inside = Window.partitionBy(*by).orderBy(*[F.col(k).asc_nulls_first() for k in order]).rowsBetween(
        Window.unboundedPreceding, -1)
    local = ranged.withColumns({f"_in_{new}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for new, c in sums.items()})
    totals = ranged.groupBy(*by).agg(*[F.sum(c).alias(f"_all_{new}") for new, c in sums.items()])
    before = (Window.partitionBy(group) if group else Window.partitionBy(F.lit(1))).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = totals.select(
        F.col("_pid").alias("_base_pid"), *([F.col(group).alias("_base_group")] if group else []),
        *[F.coalesce(F.sum(f"_all_{new}").over(before), F.lit(0)).alias(f"_base_{new}") for new in sums])
    condition = F.col("_pid") == F.col("_base_pid")
    if group:
        condition = condition & F.col(group).eqNullSafe(F.col("_base_group"))
    joined = local.join(bases, condition)
    return joined.select(*rows.columns, *[(F.col(f"_in_{n}") + F.col(f"_base_{n}")).cast("long").alias(n) for n in sums])


def key_slices(batches: Iterable[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[pa.Table]:
    """Regroup a key-sorted stream into tables of about ``rows`` rows that never split a key."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        whole = pa.Table.from_batches(held)
        changed = np.zeros(whole.num_rows, dtype=bool)
        for key in keys:
            values = whole.column(key).to_numpy()
            changed[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(changed)
        if not len(starts):
            continue
        yield whole.slice(0, starts[-1])
        held = whole.slice(starts[-1]).combine_chunks().to_batches()
        count = sum(b.num_rows for b in held)
    if held:
        yield pa.Table.from_batches(held)


def ragged_positions(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated index ranges start, start+1, ... for every (start, length)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
