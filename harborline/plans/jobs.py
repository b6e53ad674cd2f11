"""The three jobs end to end: load files, rebuild or refresh tables, check, publish, report.

Each job loads what was delivered, builds its tables from the landing tables,
checks them, and publishes all of them at once; a build that breaks a rule raises
and the tables before it stay what readers see.  A missing daily file is returned
as a row, never an error; a missing snapshot is an error, and so is a refused file,
after all others of the job are loaded.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame

from harborline.operators import advertising, cleaning, quality, reconciliation, reports, sales
from harborline.plans import increments
from harborline.plans.warehouse import Warehouse
from harborline.session import configure
from harborline.sources import discovery, seeds, sinks
from harborline.sources.ad_exports import read_deliveries
from harborline.sources.landing import Lake, RejectedFiles, Rejection
from harborline.sources.published import Build, Published, Snapshot

# Tables of a job in the order they build on each other.
ORDER_TABLES = (
    "stg_orders", "rejected_orders", "stg_order_items", "stg_customers", "stg_products",
    "order_status_history", "orders_enriched", "order_lines",
    "daily_orders", "daily_sales", "refund_analysis", "dim_customers", "dim_products",
)
RECON_TABLES = ("norm_gateway", "norm_ledger", "recon_results", "recon_summary", "recon_alerts")
MARKETING_TABLES = (
    "stg_fx_rates", "stg_ad_performance", "stg_utm_touches", "campaign_mapping",
    "attributed_revenue", "channel_performance", "campaign_performance",
)
DIMENSION_TABLES = ("stg_customers", "stg_products", "dim_customers", "dim_products")
COMMIT = "orders_commit"   # manifest property: the load the order tables stand at


def warehouse(lake: Lake, utm_sources: DataFrame | None = None, campaigns: DataFrame | None = None) -> Warehouse:
    """The warehouse over the committed landing tables of a lake."""
    spark = configure(lake.spark)
    return Warehouse(
        lake.table,
        utm_sources if utm_sources is not None else seeds.utm_sources(spark),
        campaigns if campaigns is not None else seeds.campaigns(spark),
    )


def store(lake: Lake, root: str) -> Published:
    return Published(configure(lake.spark), f"{root.rstrip('/')}/tables")


def build(tables: Warehouse, target: Build, names: Sequence[str]) -> Warehouse:
    """Build tables in order; each is written once, its row rules are counted meanwhile, and later ones read the copy."""
    for name in names:
        tables.__dict__[name] = target.replace(name, getattr(tables, name), metrics=quality.rule_metrics(name))
    return tables


def build_orders(tables: Warehouse, target: Build) -> Warehouse:
    """The order tables from scratch, in parts by business date."""
    build(tables, target, DIMENSION_TABLES)
    increments.build_orders(target, tables.landing("orders"), tables.landing("order_items"), _dimensions(target))
    increments.build_history(target, tables.landing("orders"))
    tables.__dict__.update({name: target.table(name) for name in ("order_base", *ORDER_TABLES)})
    return tables


def _dimensions(target: Build | Snapshot) -> increments.Dimensions:
    return increments.Dimensions(target.table("stg_customers"), target.table("stg_products"))


# --------------------------------------------------------------------- loading

def _load(lake: Lake, folder: str, names: Sequence[str], dates: Iterable[date],
          expected: Sequence[discovery.Delivery] = (), rejected: Sequence[Rejection] = ()) -> DataFrame:
    dates, expected, rejected = list(dates), list(expected), list(rejected)
    for table in names:
        deliveries = discovery.find_deliveries(
            lake.spark, [folder], table, discovery.DAILY_PATTERNS[table], dates
        )
        rejected += lake.load_daily(table, deliveries, strict=False).rejected
        expected += deliveries
    if rejected:
        raise RejectedFiles(rejected)
    return discovery.missing(lake.spark, expected)


def ingest_orders(lake: Lake, folder: str, dates: Iterable[date]) -> DataFrame:
    """Snapshots and daily order files; returns the files that were not there."""
    for table in ("products", "customers"):
        lake.load_snapshot(table, folder)
    return _load(lake, folder, ("orders", "order_items"), dates)


def ingest_payments(lake: Lake, folder: str, dates: Iterable[date]) -> DataFrame:
    return _load(lake, folder, ("gateway_txns", "ledger_entries"), dates)


def ingest_marketing(lake: Lake, folder: str, dates: Iterable[date], include_late: bool = False) -> DataFrame:
    """Rates, ad exports and touches; late files are taken from late_arrivals/ on request."""
    dates = list(dates)
    lake.load_snapshot("fx_rates", folder)
    roots = [folder] + ([f"{folder.rstrip('/')}/late_arrivals"] if include_late else [])
    ads = [
        delivery
        for pattern in discovery.AD_PATTERNS.values()
        for delivery in discovery.find_deliveries(lake.spark, roots, "ad_performance", pattern, dates)
    ]
    refused = lake.load_frame("ad_performance", ads, read_deliveries, strict=False).rejected
    return _load(lake, folder, ("utm_touches",), dates, ads, refused)


# ---------------------------------------------------------------------- running

def _checks(target: Build, names: Sequence[str], parts: dict[str, set[str]] | None = None) -> DataFrame:
    """The rules of the tables a build wrote; ``parts`` narrows the search for repeats to what was written."""
    tables = {n: target.table(n, (parts or {}).get(n)) for n in names if n in quality.RULES and n in target}
    return quality.observed_checks(target.counted, tables)


def order_gate(enriched: DataFrame, customers: DataFrame, lines: DataFrame, refunds: DataFrame) -> DataFrame:
    """The checks across order tables that every build runs: every order has its customer, refunds agree with their lines."""
    broken = quality.refund_money_mismatch(lines, refunds)
    return quality.relationship_check("orders_enriched", enriched, "customer_id", customers, "customer_id").unionByName(
        quality.as_check("refund_analysis", "refunds_match_lines", broken))


def _publish(target: Build, checks: DataFrame, strict: bool, **properties: str) -> Snapshot:
    if strict:
        quality.require(checks)
    return target.publish(**properties)


def _order_sections(tables: Build | Snapshot, checks: DataFrame) -> dict[str, DataFrame]:
    daily_sales, daily_orders, refunds = map(tables.table, ("daily_sales", "daily_orders", "refund_analysis"))
    return {
        "headline": reports.headline(daily_sales, daily_orders),
        "by_category": reports.best_first(reports.by_category(daily_sales), "net_amount", "category"),
        "by_channel": reports.best_first(reports.by_channel(daily_orders), "net_amount", "channel"),
        "refunds": reports.best_first(refunds, "refund_rate_pct", "category"),
        "daily_trend": reports.in_order(reports.daily_trend(daily_sales, daily_orders), "business_date"),
        "rejected": reports.best_first(reports.reject_counts(tables.table("rejected_orders")), "rows", "reject_reason"),
        "checks": checks,
    }


def run_orders(lake: Lake, root: str, strict: bool = True) -> dict[str, DataFrame]:
    """Rebuild the order tables from all landing rows; returns the sections of the business report.

    A strict run raises when a table breaks one of its rules, and publishes nothing.
    """
    commit, target = lake.last_commit(), store(lake, root).begin()
    build_orders(warehouse(lake), target)
    checks = _checks(target, ORDER_TABLES).unionByName(order_gate(*map(
        target.table, ("orders_enriched", "dim_customers", "order_lines", "refund_analysis"))))
    return _order_sections(_publish(target, checks, strict, **{COMMIT: str(commit)}), checks)


def refresh_orders(lake: Lake, root: str, strict: bool = True) -> dict[str, DataFrame]:
    """Bring the order tables up to the newest load by what it touched; the report of :func:`run_orders`.

    Without earlier tables, or when customers or products changed, it is a full run.
    Rules are checked on the parts that were written.
    """
    commit, target = lake.last_commit(), store(lake, root).begin()
    since = target.base.properties.get(COMMIT)
    if since is None or "order_base" not in target or _dimensions_changed(lake, target):
        return run_orders(lake, root, strict)
    changes = {
        name: increments.Change(*lake.changes(name, int(since), commit), lake.table(name, commit))
        for name in ("orders", "order_items")}
    days = increments.restate_orders(target, changes["orders"], changes["order_items"], _dimensions(target))
    places = increments.restate_history(target, changes["orders"])
    written = {n: days for n in ("stg_orders", "rejected_orders", "orders_enriched", "daily_orders", "daily_sales", "order_lines")}
    checks = _checks(target, [*written, "order_status_history", "refund_analysis"], {**written, "order_status_history": places})
    touched = {name: target.table(name, days) for name in ("orders_enriched", "order_lines", "daily_refunds")}
    checks = checks.unionByName(order_gate(
        touched["orders_enriched"], target.table("dim_customers"), touched["order_lines"], sales.refund_rates(touched["daily_refunds"])))
    return _order_sections(_publish(target, checks, strict, **{COMMIT: str(commit)}), checks)


def _dimensions_changed(lake: Lake, target: Build) -> bool:
    now = {"stg_customers": cleaning.clean_customers(lake.table("customers")), "stg_products": cleaning.clean_products(lake.table("products"))}
    return any(not quality.same_rows(target.table(name), rows) for name, rows in now.items())


def run_reconciliation(lake: Lake, root: str) -> dict[str, DataFrame]:
    """Match, verify, summarise, alert, publish, and write the follow-up list as CSV.

    Alerts are business signals and never fail the job; a broken guarantee does,
    and then nothing is published.
    """
    target, w = store(lake, root).begin(), warehouse(lake)
    build(w, target, ("norm_gateway", "norm_ledger", "recon_results"))
    reconciliation.check_invariants(w.recon_results)
    build(w, target, ("recon_summary", "recon_alerts"))
    target.publish()
    follow_ups = reconciliation.follow_ups(w.recon_results)
    sinks.write_csv(follow_ups, f"{root.rstrip('/')}/reports/recon_follow_ups", "txn_date", "match_type", "ref")
    return {
        "daily": reports.in_order(w.recon_summary, "txn_date"),
        "alerts": reports.in_order(w.recon_alerts, "txn_date", "severity", "rule"),
        "follow_up_count": reports.follow_up_count(follow_ups),
    }


def run_marketing(lake: Lake, root: str, strict: bool = True) -> dict[str, DataFrame]:
    """Rebuild the marketing tables over the orders as landed and publish them; checked like the order tables."""
    target = store(lake, root).begin()
    w = build(warehouse(lake), target, MARKETING_TABLES)
    checks = _checks(target, MARKETING_TABLES)
    _publish(target, checks, strict)
    return {
        "blended": reports.blended_roas(w.channel_performance),
        "channels": reports.best_first(reports.channel_scoreboard(w.channel_performance), "roas", "platform"),
        "campaigns": reports.best_first(reports.campaign_scoreboard(w.campaign_performance), "roas", "canonical"),
        "gaps": advertising.missing_deliveries(w.stg_ad_performance),
        "missing_conversions": reports.missing_conversion_rows(w.stg_ad_performance),
        "unmapped": advertising.unmapped(w.stg_utm_touches, w.campaign_mapping),
        "checks": checks,
    }
