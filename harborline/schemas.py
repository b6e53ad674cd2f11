"""Column contracts of the landing tables and the vocabularies of the domain."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DateType, LongType, StringType, StructField, StructType, TimestampType

# Landing-table columns, in file order.  The order is part of the
# contract with the source systems.
RAW_COLUMNS: dict[str, list[str]] = {
    "orders": ["order_id", "customer_id", "order_ts", "updated_at", "status", "total_amount", "channel"],
    "order_items": ["order_id", "product_id", "qty", "unit_price"],
    "products": ["product_id", "name", "category", "cost"],
    "customers": ["customer_id", "email", "signup_date", "region"],
    "gateway_txns": [
        "txn_id", "gateway_ref", "amount", "currency", "fee", "status",
        "created_at", "merchant_id", "payment_method",
    ],
    "ledger_entries": [
        "entry_id", "external_ref", "amount", "currency", "posted_at", "account_code", "entry_type",
    ],
    "ad_performance": [
        "report_date", "platform", "campaign_id", "ad_id", "campaign_name",
        "spend", "currency", "impressions", "clicks", "conversions",
    ],
    "utm_touches": ["order_id", "utm_source", "utm_campaign"],
    "fx_rates": ["date", "usd_thb"],
}

SNAPSHOT_FILES = {"products": "products.csv", "customers": "customers.csv", "fx_rates": "fx_rates.csv"}
DAILY_TABLES = ("orders", "order_items", "gateway_txns", "ledger_entries", "utm_touches")
LINEAGE = ("_source_file", "_ingested_at")

# Vocabularies.
ORDER_STATUSES = ("pending", "paid", "shipped", "delivered", "cancelled", "refunded")
NET_STATUSES = ("paid", "shipped", "delivered")
GROSS_STATUSES = ("paid", "shipped", "delivered", "refunded")
CHANNELS = ("web", "shopee", "lazada")
AD_PLATFORMS = ("facebook", "google", "tiktok")
MART_PLATFORMS = ("facebook", "google", "tiktok", "organic")
REJECT_REASONS = (
    "missing_order_id", "unparseable_timestamp", "amount_null_or_invalid", "amount_negative",
)
FOLLOW_UP_TYPES = (
    "missing_in_ledger", "missing_in_gateway", "amount_other", "possible_ref_issue", "duplicate_posting",
)
UNKNOWN_CUSTOMER = "unknown"
REPORTING_ZONE = "Asia/Bangkok"


def text_schema(columns: list[str]) -> StructType:
    """Landing data stays text; types are the business of cleaning."""
    return StructType([StructField(name, StringType()) for name in columns])


LOG_SCHEMA = StructType([
    StructField("file_name", StringType()),
    StructField("load_id", StringType()),
    StructField("table_name", StringType()),
    StructField("file_date", DateType()),
    StructField("loaded_at", TimestampType()),
    StructField("row_count", LongType()),
    StructField("commit_no", LongType()),
])

REJECTED_SCHEMA = StructType([
    StructField("file_name", StringType()),
    StructField("table_name", StringType()),
    StructField("file_date", DateType()),
    StructField("load_id", StringType()),
    StructField("rejected_at", TimestampType()),
    StructField("reason", StringType()),
    StructField("expected", ArrayType(StringType())),
    StructField("received", ArrayType(StringType())),
    StructField("bad_rows", LongType()),
    StructField("first_bad_line", StringType()),
])

# What a reader puts into column _bad of a row it could not read: where it stood, why, and its text.
BAD_TYPE = StructType([
    StructField("block", LongType()), StructField("place", LongType()), StructField("reason", StringType()), StructField("line", StringType()),
])
