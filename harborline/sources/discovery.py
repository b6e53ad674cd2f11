"""Which delivered files belong to which day."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, StringType, StructField, StructType

# File names per table; {date} is the ISO date of the delivery.
DAILY_PATTERNS = {
    "orders": "orders_{date}.csv",
    "order_items": "order_items_{date}.csv",
    "gateway_txns": "gateway_txns_{date}.csv",
    "ledger_entries": "ledger_entries_{date}.csv",
    "utm_touches": "utm_touches_{date}.csv",
}
AD_PATTERNS = {
    "facebook": "facebook_ads_{date}.json",
    "google": "google_ads_{date}.csv",
    "tiktok": "tiktok_ads_{date}.csv",
}


@dataclass(frozen=True)
class Delivery:
    """One file that should exist: its table, day, and where it was found."""

    table: str
    file_name: str
    file_date: date
    path: str | None


def choose_dates(
    every: bool = False,
    day: date | None = None,
    start: date | None = None,
    end: date | None = None,
    available: Iterable[date] = (),
) -> list[date]:
    """All available days, one day, or an inclusive range."""
    if every:
        return sorted(set(available))
    if day is not None:
        return [day]
    if start is not None and end is not None:
        if start > end:
            raise ValueError(f"start {start} is after end {end}; a reversed range would load nothing")
        return [start + timedelta(days=n) for n in range((end - start).days + 1)]
    raise ValueError("choose every day, one day, or a start and an end")


NAMES_PER_GLOB = 500


def _listed(spark: SparkSession, path: str, **options: str) -> list[str]:
    """Paths that exist; a listing, the contents are not read."""
    try:
        return [r.path for r in spark.read.format("binaryFile").options(**options).load(path).select("path").collect()]
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return []
        raise


def list_files(spark: SparkSession, root: str, glob: str) -> dict[str, str]:
    """File name to path of all files under ``root`` that look like ``glob``."""
    return {path.rsplit("/", 1)[-1]: path for path in _listed(spark, root, pathGlobFilter=glob)}


def find_files(spark: SparkSession, root: str, names: Sequence[str]) -> dict[str, str]:
    """File name to path of those of the named files that exist; the rest of the folder never reaches the driver."""
    found = {}
    for lo in range(0, len(names), NAMES_PER_GLOB):
        for path in _listed(spark, f"{root.rstrip('/')}/{{{','.join(names[lo:lo + NAMES_PER_GLOB])}}}"):
            found[path.rsplit("/", 1)[-1]] = path
    return found


def available_dates(spark: SparkSession, root: str, pattern: str) -> list[date]:
    """Days for which a file named by ``pattern`` was delivered."""
    before, after = pattern.split("{date}")
    days = []
    for name in list_files(spark, root, pattern.replace("{date}", "*")):
        text = name[len(before): len(name) - len(after)]
        try:
            days.append(date.fromisoformat(text))
        except ValueError:
            continue  # another file that merely looks similar
    return sorted(days)


def find_deliveries(
    spark: SparkSession, roots: Sequence[str], table: str, pattern: str, dates: Iterable[date]
) -> list[Delivery]:
    """One delivery per day; the first root that has the file wins.

    A file of no bytes is not listed: it counts as missing, and its earlier load stays.
    Pass the folder of late arrivals as a second root to backfill from it.
    """
    dates = list(dates)
    listings = [find_files(spark, root, [pattern.format(date=day) for day in dates]) for root in roots]
    deliveries = []
    for day in dates:
        name = pattern.format(date=day)
        path = next((files[name] for files in listings if name in files), None)
        deliveries.append(Delivery(table, name, day, path))
    return deliveries


def missing(spark: SparkSession, deliveries: Iterable[Delivery]) -> DataFrame:
    """Deliveries without a file: a warning to look at, not a failure."""
    rows = [(d.table, d.file_name, d.file_date) for d in deliveries if d.path is None]
    schema = StructType([
        StructField("table_name", StringType()), StructField("file_name", StringType()),
        StructField("file_date", DateType()),
    ])
    return spark.createDataFrame(rows, schema)
