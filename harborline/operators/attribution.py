"""Last-touch attribution and the return-on-ad-spend facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from harborline.functions.ratios import ratio
from harborline.operators.advertising import with_canonical
from harborline.operators.sales import IS_NET
from harborline.operators.skew import join_unique


def attributed_revenue(
    touches: DataFrame, orders: DataFrame, campaign_seed: DataFrame, raw_touches: DataFrame | None = None
) -> DataFrame:
    """Revenue of net orders on the platform and campaign of their touch.

    ``orders`` needs order_id, business_date, status and total_amount.  Organic
    revenue keeps its own bucket.  A touch whose platform is unknown has no
    campaign.  With ``raw_touches`` the check for hot orders scans one landed
    column instead of computing the distinct touches for it.
    """
    net = orders.where(IS_NET).select("order_id", "business_date", "total_amount")
    joined = join_unique(touches, net, "order_id", raw_touches)
    return with_canonical(joined, campaign_seed, "utm_campaign").selectExpr(
        "business_date", "platform",
        """CASE WHEN platform = 'organic' THEN 'organic'
                WHEN platform IS NOT NULL AND utm_campaign IS NOT NULL THEN canonical END AS campaign_canonical""",
        "order_id",
        "total_amount AS revenue_thb",
    )


_DELIVERY = (
    "SUM(spend_thb) AS spend_thb",
    "SUM(impressions) AS impressions",
    "SUM(clicks) AS clicks",
    "SUM(COALESCE(conversions, 0)) AS platform_conversions",
)
_REVENUE = ("COUNT(*) AS attributed_orders", "SUM(revenue_thb) AS attributed_revenue_thb")
_MEASURES = (
    "spend_thb", "impressions", "clicks", "platform_conversions",
    "attributed_orders", "attributed_revenue_thb",
)


def _or_zero(names) -> list[str]:
    return [f"COALESCE({n}, 0) AS {n}" for n in names]


def _exprs(expressions) -> list:
    return [F.expr(e) for e in expressions]


def channel_performance(ads: DataFrame, revenue: DataFrame) -> DataFrame:
    """Daily spend and delivery next to attributed revenue per platform.

    Both sides are aggregated before they meet.  A NULL platform never matches
    and stays a row of its own.  A ratio without a denominator is NULL.
    """
    spent = ads.withColumnRenamed("report_date", "activity_date").groupBy("activity_date", "platform").agg(
        *_exprs(_DELIVERY)
    )
    earned = revenue.withColumnRenamed("business_date", "activity_date").groupBy("activity_date", "platform").agg(
        *_exprs(_REVENUE)
    )
    return spent.join(earned, ["activity_date", "platform"], "full").selectExpr(
        "activity_date", "platform", *_or_zero(_MEASURES),
        f"{ratio('attributed_revenue_thb', 'spend_thb')} AS roas",
        f"{ratio('spend_thb', 'clicks')} AS cpc_thb",
        f"{ratio('spend_thb', 'attributed_orders')} AS cpa_thb",
        f"{ratio('clicks', 'impressions', times=100)} AS ctr_pct",
    )


def campaign_performance(ads: DataFrame, revenue: DataFrame, campaign_seed: DataFrame) -> DataFrame:
    """The same across platforms, one row per canonical campaign."""
    named = with_canonical(ads.where("platform IS NOT NULL"), campaign_seed, "campaign_name")
    # a partial sum per platform first, so that counting platforms needs no distinct
    per_platform = named.groupBy("canonical", "platform").agg(*_exprs(_DELIVERY))
    spent = per_platform.groupBy("canonical").agg(
        *_exprs(["COUNT(*) AS n_platforms", *[f"SUM({n}) AS {n}" for n in _MEASURES[:4]]])
    )
    earned = (
        revenue.where("campaign_canonical IS NOT NULL")
        .withColumnRenamed("campaign_canonical", "canonical")
        .groupBy("canonical").agg(*_exprs(_REVENUE))
    )
    return spent.join(earned, "canonical", "full").selectExpr(
        "canonical", *_or_zero(["n_platforms", *_MEASURES]),
        f"{ratio('attributed_revenue_thb', 'spend_thb')} AS roas",
    )
