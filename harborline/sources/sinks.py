"""Where results go: full-refresh tables and ordered CSV extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Full refresh of a Parquet table; returns the stored copy.

    The input must not read from ``path``.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def refresh_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replace only the partitions present in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_csv(df: DataFrame, path: str, *order: str) -> None:
    """CSV with header, sorted across its part files."""
    df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).write.mode("overwrite").option("header", True).csv(path)

