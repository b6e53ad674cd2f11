"""Mapping tables that operations maintains by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from harborline.functions.text import quote
from harborline.schemas import text_schema

SOURCE_SEED_COLUMNS = ["utm_source_variant", "platform"]
CAMPAIGN_SEED_COLUMNS = ["platform", "campaign_name", "canonical"]

# Spellings of a traffic source and the platform they mean.
UTM_SOURCES = [
    ("facebook", "facebook"),
    ("Facebook", "facebook"),
    ("fb", "facebook"),
    ("FB_ads", "facebook"),
    ("google", "google"),
    ("Google", "google"),
    ("adwords", "google"),
    ("tiktok", "tiktok"),
    ("TikTok", "tiktok"),
    ("tt", "tiktok"),
]

# Campaign names per platform and the campaign they belong to.
CAMPAIGNS = [
    ("facebook", "Mega Sale 6.6", "mega-sale-66"),
    ("google", "mega_sale_6.6_TH", "mega-sale-66"),
    ("tiktok", "MEGA SALE 66", "mega-sale-66"),
    ("facebook", "Payday Blast!", "payday-blast"),
    ("google", "payday_blast_search", "payday-blast"),
    ("tiktok", "Payday Blast", "payday-blast"),
    ("facebook", "New Arrivals TH", "new-arrivals"),
    ("google", "new-arrivals-th", "new-arrivals"),
    ("facebook", "Free Shipping Promo", "free-shipping"),
    ("google", "free_shipping_promo", "free-shipping"),
    ("tiktok", "FREE SHIPPING promo", "free-shipping"),
    ("facebook", "Brand Awareness Q2", "brand-awareness"),
    ("tiktok", "brand awareness q2", "brand-awareness"),
    ("facebook", "Flash Friday", "flash-friday"),
    ("google", "flash_friday_TH", "flash-friday"),
    ("tiktok", "FlashFriday", "flash-friday"),
    ("google", "app_install_upa", "app-install"),
    ("tiktok", "App Install TH", "app-install"),
    ("facebook", "Retargeting - Cart", "retargeting-cart"),
    ("google", "retargeting_cart", "retargeting-cart"),
    ("facebook", "Midyear Clearance", "midyear-clearance"),
    ("google", "midyear-clearance-th", "midyear-clearance"),
    ("tiktok", "MIDYEAR clearance", "midyear-clearance"),
    ("tiktok", "KOL Collab June", "kol-collab"),
]


def _values(spark: SparkSession, rows: list[tuple[str, ...]], columns: list[str]) -> DataFrame:
    """Literal rows; the optimizer knows their size and broadcasts them on its own."""
    literals = ", ".join("(" + ", ".join(quote(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {literals} AS seed({', '.join(columns)})")


def utm_sources(spark: SparkSession) -> DataFrame:
    return _values(spark, UTM_SOURCES, SOURCE_SEED_COLUMNS)


def campaigns(spark: SparkSession) -> DataFrame:
    return _values(spark, CAMPAIGNS, CAMPAIGN_SEED_COLUMNS)


def read_seed(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A seed kept as a CSV file instead of the built-in values."""
    return (
        spark.read.schema(text_schema(columns))
        .option("header", True).option("enforceSchema", False).option("escape", '"')
        .csv(path)
    )
