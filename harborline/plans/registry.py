"""Named queries over the test tables: callable (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, IntegerType, TimestampType

from harborline.operators import advertising, cleaning, history, quality, reconciliation, reports, sales
from harborline.plans import bridge, deliveries
from harborline.plans.warehouse import Warehouse
from harborline.schemas import UNKNOWN_CUSTOMER
from harborline.session import configure, materialize
from harborline.sources import seeds

Query = Callable[[SparkSession, str], DataFrame]


def bridged(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse over landing tables derived from the test tables."""
    configure(spark)

    def landing(name: str) -> DataFrame:
        return getattr(bridge, f"raw_{name}")(spark, sf_dir)

    warehouse = Warehouse(landing, seeds.utm_sources(spark), seeds.campaigns(spark))
    warehouse.spark, warehouse.sf_dir = spark, sf_dir
    return warehouse


def present(df: DataFrame) -> DataFrame:
    """Output types that read the same everywhere: naive UTC instants, wide numbers."""
    columns = []
    for field in df.schema.fields:
        kind = field.dataType
        if isinstance(kind, TimestampType):
            columns.append(f"CAST({field.name} AS TIMESTAMP_NTZ) AS {field.name}")
        elif isinstance(kind, DecimalType):
            columns.append(f"CAST({field.name} AS DECIMAL(38,{kind.scale})) AS {field.name}")
        elif isinstance(kind, IntegerType):
            columns.append(f"CAST({field.name} AS BIGINT) AS {field.name}")
        else:
            columns.append(field.name)
    return df.selectExpr(*columns)


def _query(build: Callable[[Warehouse], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(build(bridged(spark, sf_dir)))

    return run


def _log(w: Warehouse) -> DataFrame:
    return bridge.load_log(w.spark, w.sf_dir)


def _relationships(w: Warehouse) -> DataFrame:
    return quality.relationship_check(
        "orders_enriched", w.located_orders, "customer_id", w.dim_customers, "customer_id"
    ).unionByName(quality.relationship_check(
        "stg_order_items", w.stg_order_items, "product_id", w.dim_products, "product_id"
    ))


def _invariants(w: Warehouse) -> DataFrame:
    return reconciliation.invariant_violations(w.recon_results)


def _caught_orders(w: Warehouse) -> DataFrame:
    """(case, id) of the order dirt as the operators dealt with it."""
    def caught(case: str, df: DataFrame, column: str) -> DataFrame:
        return df.selectExpr(f"'{case}' AS case", f"{column} AS id")

    amount_rejects = w.rejected_orders.where("reject_reason IN ('amount_null_or_invalid', 'amount_negative')")
    late = w.stg_orders.where(
        r"CAST(REGEXP_EXTRACT(_source_file, '(\\d{4}-\\d{2}-\\d{2})', 1) AS DATE) = DATE_ADD(TO_DATE(order_ts), 1)"
    )
    once = w.order_base.groupBy("order_id").count().where("count = 1")
    refunded = w.order_status_history.groupBy("order_id").agg(
        F.expr("COUNT(*) AS n"), F.expr("COUNT_IF(is_current AND status = 'refunded') AS now_refunded")
    ).where("n >= 2 AND now_refunded = 1")
    orphans = w.located_orders.where(f"customer_id = '{UNKNOWN_CUSTOMER}'")
    bad_emails = w.stg_customers.where("NOT email_is_valid")
    return (
        caught("duplicate", once, "order_id")
        .unionByName(caught("late_refund", refunded, "order_id"))
        .unionByName(caught("late_arrival", late, "order_id"))
        .unionByName(caught("bad_amount", amount_rejects, "order_id"))
        .unionByName(caught("orphan_customer", orphans, "order_id"))
        .unionByName(caught("invalid_email", bad_emails, "customer_id"))
    )


def _recall_orders(w: Warehouse) -> DataFrame:
    return quality.recall(bridge.injected_order_cases(w.spark, w.sf_dir), _caught_orders(w))


def _recall_payments(w: Warehouse) -> DataFrame:
    caught = w.recon_results.selectExpr("match_type AS case", "ref AS id")
    return quality.recall(bridge.injected_payment_cases(w.spark, w.sf_dir), caught)


_CHECKED = (
    "stg_orders", "rejected_orders", "order_status_history", "orders_enriched", "daily_sales",
    "refund_analysis", "dim_customers", "dim_products", "stg_ad_performance",
    "channel_performance", "campaign_performance", "recon_results",
)


def _checksums(w: Warehouse) -> DataFrame:
    """Checksums of all tables; what several of them are derived from is written once."""
    for name in ("order_base", "order_lines", "stg_ad_performance", "attributed_revenue"):
        setattr(w, name, materialize(getattr(w, name), name))
    w.recon_sides = reconciliation.stored_sides(
        bridge.raw_gateway_txns(w.spark, w.sf_dir, w.order_base), bridge.raw_ledger_entries(w.spark, w.sf_dir, w.order_base))
    return quality.checksums({name: getattr(w, name) for name in _CHECKED})


BUILDERS: dict[str, Callable[[Warehouse], DataFrame]] = {
    # cleaning
    "stg_orders": lambda w: w.stg_orders,
    "rejected_orders": lambda w: w.rejected_orders,
    "stg_order_items": lambda w: w.stg_order_items,
    "stg_customers": lambda w: w.stg_customers,
    "stg_products": lambda w: w.stg_products,
    "money_orders": lambda w: cleaning.money_orders(w.landing("orders")),
    "money_orders_window": lambda w: cleaning.money_orders(w.landing("orders"), "1996-01-01", "1998-12-31"),
    # history and facts
    "order_status_history": lambda w: w.order_status_history,
    "line_totals": lambda w: sales.line_totals(w.stg_order_items),
    "orders_enriched": lambda w: w.orders_enriched,
    "order_lines": lambda w: w.order_lines,
    "daily_orders": lambda w: w.daily_orders,
    "daily_sales": lambda w: w.daily_sales,
    "refund_analysis": lambda w: w.refund_analysis,
    "dim_customers": lambda w: w.dim_customers,
    "dim_products": lambda w: w.dim_products,
    # analyst questions and report sections
    "weekday_compare": lambda w: reports.weekday_compare(w.daily_sales),
    "top_categories": lambda w: reports.top_categories(w.daily_sales),
    "days_to_refund": lambda w: history.days_to_refund(w.order_status_history),
    "regional_revenue": lambda w: reports.regional_revenue(w.located_orders),
    "quarantine_health": lambda w: reports.quarantine_health(w.rejected_orders),
    "headline": lambda w: reports.headline(w.daily_sales, w.daily_orders),
    "daily_trend": lambda w: reports.in_order(reports.daily_trend(w.daily_sales, w.daily_orders), "business_date"),
    "by_category": lambda w: reports.best_first(reports.by_category(w.daily_sales), "net_amount", "category"),
    "by_channel": lambda w: reports.best_first(reports.by_channel(w.daily_orders), "net_amount", "channel"),
    "refund_listing": lambda w: reports.best_first(w.refund_analysis, "refund_rate_pct", "category"),
    "reject_counts": lambda w: reports.best_first(reports.reject_counts(w.rejected_orders), "rows", "reject_reason"),
    # reconciliation
    "norm_gateway": lambda w: w.norm_gateway,
    "norm_ledger": lambda w: w.norm_ledger,
    "recon_results": lambda w: w.recon_results,
    "recon_bucket_counts": lambda w: reconciliation.bucket_counts(w.recon_results),
    "gateway_daily": lambda w: reconciliation.gateway_daily(w.norm_gateway),
    "ledger_daily": lambda w: reconciliation.ledger_daily(
        reconciliation.ledger_columns(w.landing("ledger_entries"))),
    "recon_summary": lambda w: reports.in_order(w.recon_summary, "txn_date"),
    "recon_alerts": lambda w: reports.in_order(w.recon_alerts, "txn_date", "severity", "rule"),
    "recon_followups": lambda w: reports.in_order(
        reconciliation.follow_ups(w.recon_results), "txn_date", "match_type", "ref"),
    "recon_followup_count": lambda w: reports.follow_up_count(reconciliation.follow_ups(w.recon_results)),
    "recon_invariants": _invariants,
    # advertising
    "stg_fx_rates": lambda w: w.stg_fx_rates,
    "stg_ad_performance": lambda w: w.stg_ad_performance,
    "stg_utm_touches": lambda w: w.stg_utm_touches,
    "campaign_mapping": lambda w: w.campaign_mapping,
    "unmapped": lambda w: advertising.unmapped(w.stg_utm_touches, w.campaign_mapping),
    "attributed_revenue": lambda w: w.attributed_revenue,
    "channel_performance": lambda w: w.channel_performance,
    "campaign_performance": lambda w: w.campaign_performance,
    "channel_scoreboard": lambda w: reports.best_first(
        reports.channel_scoreboard(w.channel_performance), "roas", "platform"),
    "blended_roas": lambda w: reports.blended_roas(w.channel_performance),
    "campaign_scoreboard": lambda w: reports.best_first(
        reports.campaign_scoreboard(w.campaign_performance), "roas", "canonical"),
    "missing_conversions": lambda w: reports.missing_conversion_rows(w.stg_ad_performance),
    "late_file_gaps": lambda w: advertising.missing_deliveries(w.stg_ad_performance.where(f"NOT ({bridge.LATE_EXPORT})")),
    # quality
    "dq_suite": deliveries.built_checks,
    "dq_relationships": _relationships,
    "dq_refund_money": lambda w: quality.refund_money_mismatch(w.order_lines, w.refund_analysis),
    "dq_restated_refunds": lambda w: quality.restated_refund_mismatch(
        w.daily_sales, w.dated_orders, w.stg_order_items),
    "dq_net_identity": lambda w: quality.net_is_gross_minus_refund(w.daily_sales),
    "dq_money_by_layer": lambda w: quality.net_money_by_layer(w.daily_sales, w.stg_orders, w.stg_order_items),
    "dq_header_totals": lambda w: quality.header_differs_from_lines(w.stg_orders, w.stg_order_items),
    "dq_order_grain": lambda w: quality.order_count_by_layer(w.daily_orders, w.stg_orders),
    "dq_order_accounting": lambda w: quality.order_accounting(
        w.landing("orders"), w.stg_orders, w.rejected_orders),
    "dq_spend_by_layer": lambda w: quality.spend_by_layer(w.stg_ad_performance, w.channel_performance),
    "dq_resends": lambda w: quality.collapsed_resends(w.landing("ad_performance"), w.stg_ad_performance),
    "dq_finite_ratios": lambda w: quality.undefined_ratios(w.channel_performance),
    "dq_attribution": lambda w: quality.attribution_completeness(
        w.stg_utm_touches, w.stg_orders, w.attributed_revenue),
    "dq_waterfall": lambda w: quality.waterfall_completeness(
        w.landing("gateway_txns"), w.landing("ledger_entries"), w.recon_results),
    "dq_bucket_sums": lambda w: quality.bucket_sum_mismatch(w.recon_summary),
    "freshness": lambda w: quality.freshness(_log(w)),
    "daily_volume": lambda w: quality.daily_volume(_log(w)),
    "volume_anomaly": lambda w: quality.volume_anomalies(quality.daily_volume(_log(w))),
    "late_orders": lambda w: quality.off_schedule_files(w.stg_orders),
    "recall_orders": _recall_orders,
    "recall_payments": _recall_payments,
    # files, restatement, streams, hot groups
    "landed_orders": deliveries.landed_orders,
    "landed_files": deliveries.landed_files,
    "landed_snapshot": deliveries.landed_snapshot,
    "landed_log": deliveries.landed_log,
    "landed_ads": deliveries.landed_ads,
    "late_backfill": lambda w: deliveries.landed_ads(w, include_late=True),
    "files_not_delivered": deliveries.files_not_delivered,
    "restated_daily_sales": deliveries.from_restated("daily_sales"),
    "restated_refunds": deliveries.from_restated("refund_analysis"),
    "restated_orders_enriched": deliveries.from_restated("orders_enriched"),
    "merged_status_history": deliveries.from_restated("order_status_history"),
    "rematched_results": deliveries.rematched,
    "streamed_orders": deliveries.from_stream("stg_orders"),
    "streamed_status_history": deliveries.from_stream("order_status_history"),
    "streamed_daily_sales": deliveries.from_stream("daily_sales"),
    "hot_recon_results": deliveries.with_every_group_hot(lambda w: w.recon_results),
    "hot_status_history": deliveries.with_every_group_hot(lambda w: w.order_status_history),
    "hot_order_lines": deliveries.with_every_group_hot(lambda w: w.order_lines),
    "hot_attributed_revenue": deliveries.with_every_group_hot(lambda w: w.attributed_revenue),
    "followup_csv": deliveries.follow_ups_as_csv,
    "ids_filter": lambda w: quality.only_ids(
        cleaning.money_orders(w.landing("orders")), w.landing("utm_touches").where("utm_source = 'bing'"), "order_id"),
    "table_checksums": _checksums,
}


def queries() -> dict[str, Query]:
    return {name: _query(build) for name, build in BUILDERS.items()}
