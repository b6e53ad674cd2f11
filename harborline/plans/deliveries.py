"""The landing rows as delivered files, loaded, sent again, restated and streamed.

:mod:`~harborline.plans.bridge` derives landing rows; here they are written to an
inbox the way source systems deliver them, and go through the real loaders, jobs
and streams.  Every function takes the warehouse of a query.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from harborline.operators import quality, reconciliation
from harborline.operators.skew import HOT_ROWS_CONF, HOT_SAMPLE_CONF
from harborline.plans import bridge, increments, jobs
from harborline.plans.warehouse import Warehouse
from harborline.schemas import AD_PLATFORMS, RAW_COLUMNS
from harborline.session import TIGHT, materialize, shared_folder
from harborline.sources import sinks
from harborline.sources.ad_exports import GOOGLE_COLUMNS, TIKTOK_COLUMNS, read_deliveries
from harborline.sources.discovery import AD_PATTERNS, DAILY_PATTERNS, Delivery, available_dates, find_deliveries
from harborline.sources.landing import Lake
from harborline.sources.published import Published
from harborline.streaming.orders import maintain_orders


_made: dict[tuple, object] = {}


def made_once(make: Callable) -> Callable:
    """Deliver, load or build once per application and input; the queries over the result share it."""
    @wraps(make)
    def run(w: Warehouse, *options):
        key = (make.__name__, w.spark.sparkContext.applicationId, w.sf_dir, *options)
        if key not in _made:
            _made[key] = make(w, *options)
        return _made[key]

    return run


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/harborline/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def deliver(rows: DataFrame, inbox: str, text: bool = False) -> None:
    """Write each value of ``_file`` as one file of that name: CSV with a head, or a column of lines."""
    spark = rows.sparkSession
    staged = f"{inbox}/_staged-{uuid.uuid4().hex}"
    writer = rows.repartition("_file").write.partitionBy("_file")
    if text:
        writer.text(staged)
    else:
        writer.options(header=True, emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(staged)
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = paths(staged).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in files.listStatus(paths(staged)):  # one per file
        name = folder.getPath().getName()
        if name.startswith("_file="):
            parts = [p.getPath() for p in files.listStatus(folder.getPath()) if p.getPath().getName().startswith("part-")]
            files.rename(parts[0], paths(f"{inbox}/{name.removeprefix('_file=')}"))


# ------------------------------------------------------------------ daily files

_MONTH = "SUBSTRING(_source_file, 8, 7)"
_KEY = "CAST(SUBSTRING_INDEX(order_id, '-', -1) AS BIGINT)"


def _month_file(rows: DataFrame) -> DataFrame:
    return rows.selectExpr("*", f"'orders_' || {_MONTH} || '-01.csv' AS _file")


@made_once
def order_files(w: Warehouse) -> Lake:
    """Orders in one file a month; then three months again: one with fewer rows, one with short rows, one with another head."""
    spark, columns = w.spark, RAW_COLUMNS["orders"]
    lake, inbox, second = Lake(spark, new_folder(spark, "lake")), new_folder(spark, "inbox"), new_folder(spark, "inbox")
    rows = _month_file(w.landing("orders")).select(*columns, "_file")
    deliver(rows, inbox)

    def load(folder: str) -> None:
        days = available_dates(spark, folder, DAILY_PATTERNS["orders"])
        lake.load_daily("orders", find_deliveries(spark, [folder], "orders", DAILY_PATTERNS["orders"], days), strict=False)

    load(inbox)
    deliver(rows.where(f"_file LIKE '%1995-03-01%' AND {_KEY} % 2 = 0"), second)
    short = "CONCAT_WS(',', " + ", ".join(f"COALESCE({c}, '')" for c in columns[:-1]) + f") || IF({_KEY} % 2 = 0, ',' || channel, '')"
    for month, head, line in (("1995-04", columns, short), ("1995-05", columns[::-1], short)):
        some = rows.where(f"_file LIKE '%{month}-01%'").selectExpr("_file", f"{short} AS line")
        headed = some.select("_file").distinct().selectExpr("_file", "0 AS n", f"'{','.join(head)}' AS line").unionByName(
            some.selectExpr("_file", "1 AS n", "line"))
        whole = headed.groupBy("_file").agg(F.expr("ARRAY_JOIN(TRANSFORM(ARRAY_SORT(COLLECT_LIST(STRUCT(n, line))), x -> x.line), '\\n') AS value"))
        deliver(whole, second, text=True)
    load(second)
    return lake


def landed_orders(w: Warehouse) -> DataFrame:
    return order_files(w).table("orders").drop("_ingested_at").withColumnRenamed("_source_file", "delivered_in")


def landed_files(w: Warehouse) -> DataFrame:
    """What every file came to: rows loaded, or bad rows and the reason it was refused."""
    lake = order_files(w)
    return lake.load_log().selectExpr("file_name", "file_date", "'loaded' AS state", "row_count AS rows").unionByName(
        lake.rejected_files().selectExpr("file_name", "file_date", "reason AS state", "bad_rows AS rows"))


def landed_snapshot(w: Warehouse) -> DataFrame:
    """Products as of the second delivery; the first had every other one."""
    spark = w.spark
    lake, rows = Lake(spark, new_folder(spark, "lake")), w.landing("products").withColumn("_file", F.lit("products.csv"))
    for part in (rows.where("CAST(SUBSTRING(product_id, 2) AS BIGINT) % 2 = 0"), rows):
        inbox = new_folder(spark, "inbox")
        deliver(part, inbox)
        lake.load_snapshot("products", inbox)
    return lake.table("products").select(*RAW_COLUMNS["products"])


def landed_log(w: Warehouse) -> DataFrame:
    """Loads per month file after the log was compacted between two deliveries."""
    spark = w.spark
    lake, inbox = Lake(spark, new_folder(spark, "lake")), new_folder(spark, "inbox")
    rows = _month_file(w.landing("orders")).select(*RAW_COLUMNS["orders"], "_file")
    deliver(rows, inbox)
    days = available_dates(spark, inbox, DAILY_PATTERNS["orders"])
    found = find_deliveries(spark, [inbox], "orders", DAILY_PATTERNS["orders"], days)
    lake.load_daily("orders", found)
    lake.compact_log()
    lake.load_daily("orders", [d for d in found if d.file_date.year == 1996])
    return lake.load_log().selectExpr("file_name", "row_count AS rows", "commit_no")


# ------------------------------------------------------------------- ad exports

def _ad_files(w: Warehouse, inbox: str) -> None:
    """Each platform's export of each day in that platform's format; the late ones in a folder of their own."""
    ads = w.landing("ad_performance")
    name = "platform || '_ads_' || report_date"
    late = f"CASE WHEN {bridge.LATE_EXPORT} THEN 'late' ELSE 'due' END AS folder"
    facebook = ads.where("platform = 'facebook'").groupBy("platform", "report_date").agg(F.expr("""TO_JSON(NAMED_STRUCT(
        'account', 'shop', 'date_start', report_date, 'timezone', 'UTC', 'campaigns', COLLECT_LIST(NAMED_STRUCT(
            'campaign_name', campaign_name, 'adsets', ARRAY(NAMED_STRUCT('adset_id', '1', 'ads', ARRAY(NAMED_STRUCT(
                'spend', spend, 'impressions', impressions, 'clicks', clicks, 'conversions', conversions)))))))) AS value"""))
    facebook = facebook.selectExpr(f"{name} || '.json' AS _file", late, "value")

    def report(platform: str, head: list[str], line: list[str]) -> DataFrame:
        quoted = ", ".join(f"COALESCE('\"' || REPLACE({c}, '\"', '\"\"') || '\"', '')" for c in line)
        lines = ads.where(f"platform = '{platform}'").groupBy("platform", "report_date").agg(
            F.expr(f"ARRAY_JOIN(COLLECT_LIST(CONCAT_WS(',', {quoted})), '\\n') AS body"))
        return lines.selectExpr(f"{name} || '.csv' AS _file", late, f"'{'\\n'.join(head)}\\n' || body AS value")

    google = report("google", ["Campaign report", "all days", ",".join(GOOGLE_COLUMNS)], [
        "campaign_name", "spend", "impressions", "clicks", "conversions", "DATE_FORMAT(CAST(report_date AS DATE), 'dd/MM/yyyy')"])
    tiktok = report("tiktok", [",".join(TIKTOK_COLUMNS)], [
        "REPLACE(report_date, '-', '')", "campaign_id", "campaign_name", "spend", "impressions", "clicks", "conversions"])
    files = materialize(facebook.unionByName(google).unionByName(tiktok), "ad-files")
    deliver(files.where("folder = 'due'").drop("folder"), inbox, text=True)
    deliver(files.where("folder = 'late'").drop("folder"), f"{inbox}/late_arrivals", text=True)


@made_once
def ad_files(w: Warehouse, include_late: bool) -> Lake:
    """All exports that came in time; with ``include_late`` the days are loaded again with the late folder."""
    spark = w.spark
    lake, inbox = Lake(spark, new_folder(spark, "lake")), new_folder(spark, "inbox")
    _ad_files(w, inbox)
    days = available_dates(spark, inbox, AD_PATTERNS["facebook"])
    for roots in [[inbox]] + [[inbox, f"{inbox}/late_arrivals"]] * include_late:
        found: list[Delivery] = [
            d for pattern in AD_PATTERNS.values() for d in find_deliveries(spark, roots, "ad_performance", pattern, days)]
        lake.load_frame("ad_performance", found, read_deliveries)
    return lake


def landed_ads(w: Warehouse, include_late: bool = False) -> DataFrame:
    return ad_files(w, include_late).table("ad_performance").select(*RAW_COLUMNS["ad_performance"])


def files_not_delivered(w: Warehouse) -> DataFrame:
    """Exports that were due and did not come, as the load log tells."""
    log = ad_files(w, False).load_log().where("table_name = 'ad_performance'")
    days = log.select("file_date").distinct()
    platforms = ", ".join(f"'{p}'" for p in AD_PLATFORMS)
    due = days.selectExpr("file_date", f"EXPLODE(ARRAY({platforms})) AS platform")
    came = log.selectExpr("file_date", "SUBSTRING_INDEX(file_name, '_', 1) AS platform")
    return due.join(came, ["file_date", "platform"], "left_anti")


# --------------------------------------------------- restatement, stream, checks

# The test orders spread thinly over seven years, so a year is a part.
YEARLY = {"business_date": 4}
# The change set: what landed in files from this day on.
CUTOFF = "SUBSTRING(_source_file, 8, 10) >= '1996-06-01'"
_LATE_LINE = "PMOD(XXHASH64(order_id), 5) = 0"


def _dimensions(w: Warehouse) -> increments.Dimensions:
    return increments.Dimensions(w.stg_customers, w.stg_products)


@made_once
def restated(w: Warehouse) -> Published:
    """Order tables built from the files before a day, then restated by the rest; every fifth order's lines come late, too."""
    store = Published(w.spark, new_folder(w.spark, "tables"), YEARLY)
    orders, items = materialize(w.landing("orders"), "orders", TIGHT), materialize(w.landing("order_items"), "items", TIGHT)
    build = store.begin()
    increments.build_orders(build, orders.where(f"NOT ({CUTOFF})"), items.where(f"NOT ({_LATE_LINE})"), _dimensions(w))
    increments.build_history(build, orders.where(f"NOT ({CUTOFF})"))
    build.publish()
    build = store.begin()
    change = increments.Change(orders.where(CUTOFF))
    increments.restate_orders(build, change, increments.Change(items.where(_LATE_LINE)), _dimensions(w))
    increments.restate_history(build, change)
    build.publish()
    return store


def from_restated(name: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: restated(w).snapshot().table(name)


def rematched(w: Warehouse) -> DataFrame:
    """Reconciled without every tenth row of both sides, then restated by those rows."""
    store = Published(w.spark, new_folder(w.spark, "tables"))
    sides = [materialize(w.landing(name), name) for name in ("gateway_txns", "ledger_entries")]
    late = ["PMOD(XXHASH64(txn_id), 10) = 0", "PMOD(XXHASH64(entry_id), 10) = 0"]
    build = store.begin()
    increments.build_recon(build, *[side.where(f"NOT ({when})") for side, when in zip(sides, late)], buckets=16)
    build.publish()
    build = store.begin()
    increments.restate_recon(build, *[increments.Change(side.where(when)) for side, when in zip(sides, late)], buckets=16)
    return increments.recon_results(build.publish())


@made_once
def streamed(w: Warehouse) -> Published:
    """Order tables kept by a stream over the landed rows: half of them land, the stream is drained, then the others."""
    spark, folder, progress = w.spark, new_folder(w.spark, "landed"), new_folder(w.spark, "progress")
    rows, items = materialize(w.landing("orders"), "orders", TIGHT), materialize(w.landing("order_items"), "items", TIGHT)
    store = Published(spark, new_folder(spark, "tables"), YEARLY)
    for part in range(2):
        # each half is one micro-batch of as many files as tasks wrote it
        rows.where(f"PMOD(XXHASH64(order_id, updated_at), 2) = {part}").write.mode("append").option("compression", TIGHT).parquet(folder)
        query = maintain_orders(spark.readStream.schema(rows.schema).parquet(folder), store, _dimensions(w), progress, items)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    return store


def from_stream(name: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: streamed(w).snapshot().table(name)


def built_checks(w: Warehouse) -> DataFrame:
    """All rules as a build counts them: each table is written once, row rules ride on the write."""
    target = Published(w.spark, new_folder(w.spark, "tables"), YEARLY).begin()
    jobs.build_orders(w, target)
    jobs.build(w, target, jobs.MARKETING_TABLES)
    return quality.observed_checks(target.counted, {n: target.table(n) for n in quality.RULES})


def follow_ups_as_csv(w: Warehouse) -> DataFrame:
    """The follow-up list as written to CSV and read back."""
    rows, path = reconciliation.follow_ups(w.recon_results), new_folder(w.spark, "follow_ups")
    sinks.write_csv(rows, path, "txn_date", "match_type", "ref")
    return w.spark.read.schema(rows.schema).option("header", True).csv(path)


def with_every_group_hot(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """The same table with every group of two or more rows on the path of hot groups."""
    def run(w: Warehouse) -> DataFrame:
        conf = w.spark.conf
        before = {k: conf.get(k, None) for k in (HOT_ROWS_CONF, HOT_SAMPLE_CONF)}
        conf.set(HOT_ROWS_CONF, "2")
        conf.set(HOT_SAMPLE_CONF, "1.0")
        try:
            return build(w)
        finally:
            for key, value in before.items():
                conf.unset(key) if value is None else conf.set(key, value)

    return run
