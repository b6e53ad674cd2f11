"""From untyped landing rows to clean, typed rows - and the rejects with a reason."""

from __future__ import annotations

from pyspark.sql import DataFrame

from harborline.functions import casts, text
from harborline.schemas import GROSS_STATUSES, REPORTING_ZONE


def parse_orders(raw: DataFrame) -> DataFrame:
    """Typed order versions; the raw text of instants and amounts is kept."""
    return raw.selectExpr(
        "order_id",
        "customer_id",
        "order_ts AS order_ts_raw",
        "total_amount AS total_amount_raw",
        f"{casts.instant('order_ts')} AS order_ts",
        f"{casts.instant('updated_at')} AS updated_at",
        f"{text.tidy_lower('status')} AS status",
        f"{casts.money('total_amount')} AS total_amount",
        f"{text.tidy_lower('channel')} AS channel",
        "_source_file",
        "_ingested_at",
    )


# Newest version first.  The content columns at the end make the order total:
# two serialisations of one instant must not swap places between runs.
_NEWEST_FIRST = ", ".join(f"{c} DESC NULLS LAST" for c in (
    "updated_at", "_ingested_at", "order_ts_raw",
    "total_amount_raw", "status", "customer_id", "channel", "_source_file",
))


def latest_versions(parsed: DataFrame) -> DataFrame:
    """One row per order_id: its newest version.

    ``row_number() = 1`` lets Spark keep one row per key in each map task before
    the shuffle (WindowGroupLimit), so an order resent a billion times, or a
    third of all rows without an id, still reaches the reducer as a few rows.
    """
    number = f"ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY {_NEWEST_FIRST}) AS _rn"
    return parsed.selectExpr("*", number).where("_rn = 1").drop("_rn")


def order_base(raw: DataFrame) -> DataFrame:
    """Parse and keep the latest version; shared by clean and rejected orders."""
    return latest_versions(parse_orders(raw))


# First broken rule in precedence order, NULL for a clean row.
_REJECT_REASON = """CASE
    WHEN order_id IS NULL THEN 'missing_order_id'
    WHEN order_ts IS NULL OR updated_at IS NULL THEN 'unparseable_timestamp'
    WHEN total_amount IS NULL THEN 'amount_null_or_invalid'
    WHEN total_amount < 0 THEN 'amount_negative'
END"""


def clean_orders(base: DataFrame, *carried: str) -> DataFrame:
    """Rows that break no rule.  Judged on the latest version only."""
    return base.where(f"{_REJECT_REASON} IS NULL").select(
        "order_id", "customer_id", "order_ts", "updated_at", "status",
        "total_amount", "channel", "_source_file", *carried,
    )


def rejected_orders(base: DataFrame, *carried: str) -> DataFrame:
    """The exact complement of :func:`clean_orders`, with the reason."""
    return base.selectExpr(
        "order_id", "customer_id", "order_ts_raw", "total_amount_raw", "status",
        "channel", "_source_file", f"{_REJECT_REASON} AS reject_reason", *carried,
    ).where("reject_reason IS NOT NULL")


def with_business_date(orders: DataFrame, zone: str = REPORTING_ZONE) -> DataFrame:
    """Add the calendar date of the order in the reporting zone."""
    return orders.selectExpr("*", f"{casts.reporting_date('order_ts', zone)} AS business_date")


def money_orders(raw: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Current orders that moved money, optionally within inclusive UTC dates."""
    return money_moved(order_base(raw), start, end)


def money_moved(base: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """The same from the latest versions, such as a written :func:`order_base`."""
    conditions = [text.one_of("status", GROSS_STATUSES), "total_amount > 0"]
    if start is not None:
        conditions.append(f"{casts.utc_date('order_ts')} >= DATE '{start}'")
    if end is not None:
        conditions.append(f"{casts.utc_date('order_ts')} <= DATE '{end}'")
    return base.where(" AND ".join(conditions)).select("order_id", "order_ts", "total_amount")


def typed_items(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "order_id",
        "product_id",
        f"{casts.whole_number('qty', 'INT')} AS qty",
        f"{casts.money('unit_price', 12, 2)} AS unit_price",
    ).where("order_id IS NOT NULL AND qty > 0 AND unit_price >= 0")


def clean_items(raw: DataFrame) -> DataFrame:
    """Typed distinct order lines; the map-side pass of distinct absorbs hot copies."""
    return typed_items(raw).distinct()


def clean_customers(raw: DataFrame) -> DataFrame:
    """All customers with an id; a bad e-mail is flagged, not dropped."""
    return raw.where("customer_id IS NOT NULL").selectExpr(
        "customer_id",
        "email",
        f"email RLIKE '{text.EMAIL_PATTERN}' AS email_is_valid",
        f"{casts.calendar_date('signup_date')} AS signup_date",
        "region",
    )


def clean_products(raw: DataFrame) -> DataFrame:
    return raw.where("product_id IS NOT NULL").selectExpr(
        "product_id", "name", "category", f"{casts.money('cost', 12, 2)} AS cost"
    )


def clean_fx_rates(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        f"{casts.calendar_date('`date`')} AS fx_date",
        f"{casts.money('usd_thb', 10, 4)} AS usd_thb",
    )
