"""Ad exports and order touches: value cleaning, currency, campaign identity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from harborline.functions import casts, text
from harborline.schemas import AD_PLATFORMS


def clean_ads(raw: DataFrame, fx_rates: DataFrame) -> DataFrame:
    """Typed ad rows in THB; exact resends collapse, also across files.

    A conversion text that is no number is flagged and its row kept: the spend
    is real.  The distinct runs on the narrow cleaned columns, and its map-side
    pass absorbs a hot group of copies before the shuffle.
    """
    conversions = casts.whole_number("conversions")
    cleaned = raw.where("campaign_name IS NOT NULL").selectExpr(
        f"{casts.calendar_date('report_date')} AS report_date",
        "platform", "campaign_id", "ad_id",
        "TRIM(campaign_name) AS campaign_name",
        casts.money("REPLACE(spend, ',', '')") + " AS spend_local",
        f"{text.tidy_upper('currency')} AS currency",
        f"{casts.whole_number('impressions')} AS impressions",
        f"{casts.whole_number('clicks')} AS clicks",
        f"{conversions} AS conversions",
        f"{conversions} IS NULL AND conversions IS NOT NULL AS conversions_missing",
    ).distinct()
    rates = fx_rates.withColumnRenamed("fx_date", "report_date")
    return to_thb(cleaned.join(rates, "report_date", "left"))


def to_thb(priced: DataFrame) -> DataFrame:
    """THB stays; any other currency, also a missing one, counts as USD."""
    return priced.selectExpr(
        "report_date", "platform", "campaign_id", "ad_id", "campaign_name", "spend_local", "currency",
        """CAST(CASE WHEN currency = 'THB' THEN spend_local
                     ELSE ROUND(spend_local * usd_thb, 2) END AS DECIMAL(24,2)) AS spend_thb""",
        "impressions", "clicks", "conversions", "conversions_missing",
    )


def clean_touches(raw: DataFrame, source_seed: DataFrame) -> DataFrame:
    """Distinct order touches with their platform.

    No source is ``organic``; a source the seed does not know keeps a NULL
    platform so that the unmapped check can see it.  The seed's known size lets
    Spark broadcast it; one that outgrows the threshold is joined by shuffle.
    """
    seed = source_seed.selectExpr("utm_source_variant AS _variant", "platform AS _platform")
    joined = raw.where("order_id IS NOT NULL").join(seed, F.expr("TRIM(utm_source) = _variant"), "left")
    return joined.selectExpr(
        "order_id", "utm_source", "utm_campaign",
        "CASE WHEN utm_source IS NULL OR TRIM(utm_source) = '' THEN 'organic' ELSE _platform END AS platform",
    ).distinct()


def with_canonical(df: DataFrame, campaign_seed: DataFrame, name: str) -> DataFrame:
    """Add ``canonical`` and ``is_unmapped`` for (platform, name).

    The identity of a campaign is a function of platform and name: the seed's
    entry, else the name reduced to letters and digits.  So it is computed in
    place with the small seed, and nobody joins against the list of all
    campaigns ever seen.
    """
    seed = campaign_seed.selectExpr(
        "platform AS _platform", "campaign_name AS _name", "canonical AS _canonical"
    )
    return df.join(seed, F.expr(f"platform = _platform AND {name} = _name"), "left").selectExpr(
        *df.columns,
        f"COALESCE(_canonical, {text.alnum_key(name)}) AS canonical",
        "_canonical IS NULL AS is_unmapped",
    )


def observed_campaigns(ads: DataFrame, touches: DataFrame) -> DataFrame:
    """Distinct (platform, campaign_name) seen in ads or in paid touches."""
    from_touches = touches.where(
        "utm_campaign IS NOT NULL AND platform != 'organic'"
    ).selectExpr("platform", "utm_campaign AS campaign_name")
    return ads.select("platform", "campaign_name").unionByName(from_touches).distinct()


def campaign_mapping(ads: DataFrame, touches: DataFrame, campaign_seed: DataFrame) -> DataFrame:
    return with_canonical(observed_campaigns(ads, touches), campaign_seed, "campaign_name")


def unmapped(touches: DataFrame, mapping: DataFrame) -> DataFrame:
    """How many touches and campaigns the seeds do not know."""
    sources = touches.agg(F.expr("COUNT_IF(platform IS NULL) AS unmapped"))
    campaigns = mapping.agg(F.expr("COUNT_IF(is_unmapped) AS unmapped"))
    return sources.selectExpr("'utm_source' AS kind", "unmapped").unionByName(
        campaigns.selectExpr("'campaign' AS kind", "unmapped")
    )


def missing_deliveries(ads: DataFrame, platforms: Sequence[str] = AD_PLATFORMS) -> DataFrame:
    """(report_date, platform) without any ad row, on days that do have ad rows.

    One aggregation per day notes which platforms delivered - never more than
    there are platforms - and the gap is a set difference; the ads are not
    joined with themselves.
    """
    known = f"ARRAY({', '.join(text.quote(p) for p in platforms)})"
    delivered = f"COLLECT_SET(CASE WHEN {text.one_of('platform', platforms)} THEN platform END) AS delivered"
    per_day = ads.where("report_date IS NOT NULL").groupBy("report_date").agg(F.expr(delivered))
    return per_day.selectExpr("report_date", f"EXPLODE(ARRAY_EXCEPT({known}, delivered)) AS platform")
