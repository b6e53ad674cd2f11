"""The analyst questions and report sections, each one query over the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from harborline.functions.ratios import ratio
from harborline.operators.sales import IS_NET


def _agg(df: DataFrame, keys: list[str], *expressions: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(e) for e in expressions])


def weekday_compare(sales: DataFrame) -> DataFrame:
    """Latest day against the same weekday a week earlier, per channel.

    The rollup by day has as many rows as the calendar has days (times
    channels), whatever the size of the fact, so a window without a key is fine.
    """
    daily = _agg(sales, ["channel", "business_date"], "SUM(net_amount) AS net_amount")
    aged = daily.selectExpr(
        "channel", "net_amount", "DATEDIFF(MAX(business_date) OVER (PARTITION BY 1), business_date) AS age"
    )
    sums = _agg(
        aged, ["channel"],
        "SUM(CASE WHEN age = 0 THEN net_amount END) AS yesterday",
        "SUM(CASE WHEN age = 7 THEN net_amount END) AS same_day_last_week",
    )
    change = ratio("yesterday - same_day_last_week", "same_day_last_week", digits=1, times=100)
    return sums.selectExpr("channel", "yesterday", "same_day_last_week", f"{change} AS pct_change")


def top_categories(sales: DataFrame, n: int = 10) -> DataFrame:
    """Top categories by net revenue with the refunded share of gross."""
    sums = _agg(
        sales, ["category"],
        "SUM(net_amount) AS net_revenue", "SUM(refund_amount) AS refunded", "SUM(gross_amount) AS gross",
    )
    return best_first(sums, "net_revenue", "category").limit(n).selectExpr(
        "category", "net_revenue", "refunded",
        f"{ratio('refunded', 'gross', times=100)} AS refund_pct_of_gross",
    )


def regional_revenue(located: DataFrame) -> DataFrame:
    """Net orders and revenue per region; orphans show as ``unknown``."""
    net = located.where(IS_NET).selectExpr("COALESCE(region, 'unknown') AS region", "total_amount")
    # One row per order: counting rows needs no second shuffle.
    return _agg(net, ["region"], "COUNT(*) AS orders", "SUM(total_amount) AS revenue")


def quarantine_health(rejected: DataFrame) -> DataFrame:
    """Rejects per reason with one example file."""
    return _agg(rejected, ["reject_reason"], "COUNT(*) AS rows", "MIN(_source_file) AS example_file")


def headline(sales: DataFrame, orders: DataFrame) -> DataFrame:
    """One row: period, money, order counts, refund rate."""
    money = _agg(
        sales, [],
        "MIN(business_date) AS first_date", "MAX(business_date) AS last_date",
        "SUM(net_amount) AS net_revenue", "SUM(gross_amount) AS gross_revenue",
        "SUM(refund_amount) AS refunded_revenue", "1 AS _one",
    )
    counts = _agg(
        orders, [],
        "SUM(net_orders) AS net_orders", "SUM(refunded_orders) AS refunded_orders", "1 AS _one",
    )
    rate = ratio("refunded_orders", "net_orders + refunded_orders", times=100)
    # two global aggregates of one row each
    return money.join(counts, "_one").drop("_one").selectExpr("*", f"{rate} AS refund_rate_pct")


def daily_trend(sales: DataFrame, orders: DataFrame) -> DataFrame:
    """Net orders, net and refunded money per date; dates both facts know."""
    money = _agg(
        sales, ["business_date"], "SUM(net_amount) AS net_amount", "SUM(refund_amount) AS refund_amount"
    )
    counts = _agg(orders, ["business_date"], "SUM(net_orders) AS net_orders")
    return money.join(counts, "business_date").select("business_date", "net_orders", "net_amount", "refund_amount")


def by_category(sales: DataFrame) -> DataFrame:
    return _agg(sales, ["category"], "SUM(net_amount) AS net_amount")


def by_channel(orders: DataFrame) -> DataFrame:
    return _agg(orders, ["channel"], "SUM(net_orders) AS net_orders", "SUM(net_amount) AS net_amount")


def reject_counts(rejected: DataFrame) -> DataFrame:
    return _agg(rejected, ["reject_reason"], "COUNT(*) AS rows")


_ROAS = ratio("attributed_revenue_thb", "spend_thb")


def channel_scoreboard(channels: DataFrame) -> DataFrame:
    """Per platform over all days."""
    return _agg(
        channels, ["platform"],
        "SUM(spend_thb) AS spend_thb", "SUM(attributed_orders) AS attributed_orders",
        "SUM(attributed_revenue_thb) AS attributed_revenue_thb",
    ).selectExpr("*", f"{_ROAS} AS roas")


def blended_roas(channels: DataFrame) -> DataFrame:
    """Paid channels together; organic and unknown platforms stay out."""
    return _agg(
        channels.where("platform != 'organic'"), [],
        "SUM(spend_thb) AS spend_thb", "SUM(attributed_revenue_thb) AS attributed_revenue_thb",
    ).selectExpr("*", f"{_ROAS} AS blended_roas")


def campaign_scoreboard(campaigns: DataFrame) -> DataFrame:
    return campaigns.select(
        "canonical", "n_platforms", "spend_thb", "attributed_orders", "attributed_revenue_thb", "roas"
    )


def missing_conversion_rows(ads: DataFrame) -> DataFrame:
    return _agg(ads, [], "COUNT_IF(conversions_missing) AS rows")


def follow_up_count(follow_ups: DataFrame) -> DataFrame:
    return _agg(follow_ups, [], "COUNT(*) AS rows")


# Presentation order.  A sort is the last step before showing or writing.

def best_first(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    """Largest first, undefined last, ties by name."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])


def in_order(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])
