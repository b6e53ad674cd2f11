"""Landing tables derived from the star-schema test tables.

The test tables are clean, so untyped landing rows with their usual dirt are
derived from them by fixed formulas on the keys: offsets, resends, late refunds,
bad amounts, orphans, mismatching ledger entries and dirty ad exports.  Each
derivation is one pass over its input; everything that follows treats the result
like rows that came from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from harborline.functions.text import quote
from harborline.operators.cleaning import money_moved, money_orders
from harborline.schemas import AD_PLATFORMS
from harborline.sources import seeds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _plus(ts: str, seconds: str) -> str:
    return f"TIMESTAMP_SECONDS(UNIX_SECONDS({ts}) + {seconds})"


def _with_offset(ts: str, east: str) -> str:
    """Instant as text, in +07:00 where ``east`` holds, else in +00:00."""
    pattern = "'yyyy-MM-dd HH:mm:ss'"
    return (
        f"CASE WHEN {east} THEN DATE_FORMAT({ts} + INTERVAL '7' HOUR, {pattern}) || '+07:00' "
        f"ELSE DATE_FORMAT({ts}, {pattern}) || '+00:00' END"
    )


def _money_text(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(14,2)) AS STRING)"


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", "o_custkey AS cust",
        f"{_plus('CAST(o_orderdate AS TIMESTAMP)', 'o_orderkey * 7919 % 86400')} AS ts",
        """CASE WHEN o_orderstatus = 'F' THEN ' Delivered '
                WHEN o_orderstatus = 'O' THEN 'shipped'
                WHEN o_orderpriority = '1-URGENT' THEN 'pending'
                WHEN o_orderpriority = '2-HIGH' THEN 'cancelled'
                ELSE 'paid' END AS state""",
        f"""CASE WHEN o_orderkey % 200 = 3 THEN NULL
                 WHEN o_orderkey % 200 = 5 THEN '-' || {_money_text('o_totalprice')}
                 WHEN o_orderkey % 200 = 9 THEN 'N/A'
                 ELSE {_money_text('o_totalprice')} END AS total_amount""",
    )
    # The versions of an order come out of one scan, not out of a union of three:
    # 0 is the order as first sent, 1 a resend in the other offset, 2 a refund.
    versions = source.selectExpr("*", """EXPLODE(CASE
        WHEN k % 50 = 13 AND k % 33 = 4 THEN ARRAY(0, 1, 2)
        WHEN k % 50 = 13 THEN ARRAY(0, 1)
        WHEN k % 33 = 4 THEN ARRAY(0, 2)
        ELSE ARRAY(0) END) AS v""").selectExpr(
        "*",
        f"CASE WHEN v = 2 THEN {_plus('ts', '(1 + k % 7) * 86400 + 7200')} ELSE ts END AS event",
        f"""CASE WHEN v = 2 THEN {_plus('ts', '(1 + k % 7) * 86400 + 7200')}
                 ELSE {_plus('ts', 'k * 31 % 7200')} END AS changed""",
        "(k + CASE WHEN v = 1 THEN 1 ELSE 0 END) % 2 = 0 AS east",
    )
    return versions.selectExpr(
        "'O-' || k AS order_id",
        "IF(k % 100 = 7, 'CX', 'C') || cust AS customer_id",
        f"{_with_offset('ts', 'east')} AS order_ts",
        f"{_with_offset('changed', 'east')} AS updated_at",
        "CASE WHEN v = 2 THEN 'refunded' ELSE state END AS status",
        "total_amount",
        "CASE k % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'Shopee ' ELSE 'lazada' END AS channel",
        "'orders_' || DATE_ADD(TO_DATE(event), IF(k % 100 = 11, 1, 0)) || '.csv' AS _source_file",
        "TIMESTAMP '2024-01-01 00:00:00' AS _ingested_at",
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "'O-' || l_orderkey AS order_id",
        "'P' || l_partkey AS product_id",
        "CAST(CAST(l_quantity AS INT) AS STRING) AS qty",
        "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) AS unit_price",
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "'P' || p_partkey AS product_id", "p_name AS name", "p_type AS category",
        f"{_money_text('p_retailprice')} AS cost",
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey")
    )
    return table(spark, sf_dir, "customer").join(places, F.expr("c_nationkey = n_nationkey")).selectExpr(
        "'C' || c_custkey AS customer_id",
        """'customer' || c_custkey || CASE
               WHEN c_custkey % 33 != 5 THEN '@example.com'
               WHEN c_custkey % 4 = 0 THEN '@@gmail..com'
               WHEN c_custkey % 4 = 1 THEN '.gmail.com'
               WHEN c_custkey % 4 = 2 THEN '@'
               ELSE ' @hotmail.com' END AS email""",
        "CAST(DATE_ADD(DATE '1994-01-01', CAST(c_custkey % 365 AS INT)) AS STRING) AS signup_date",
        "r_name AS region",
    )


def _payments(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """What transactions and entries are derived from; ``base`` is a written order_base of the raw orders."""
    money = money_orders(raw_orders(spark, sf_dir)) if base is None else money_moved(base)
    keyed = money.selectExpr(
        "order_id", "order_ts", "total_amount AS amount", "CAST(SUBSTRING_INDEX(order_id, '-', -1) AS BIGINT) AS k"
    )
    return keyed.selectExpr(
        "order_id", "k", "k % 1000 AS b", "amount",
        "CAST(ROUND(amount * 0.029, 2) AS DECIMAL(14,2)) AS fee",
        f"{_plus('order_ts', 'k * 17 % 1800')} AS created",
    )


def raw_gateway_txns(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    return _payments(spark, sf_dir, base).selectExpr(
        "'T-' || k AS txn_id", "'GW-' || order_id AS gateway_ref",
        "CAST(amount AS STRING) AS amount", "'THB' AS currency", "CAST(fee AS STRING) AS fee",
        "'captured' AS status", f"{_with_offset('created', 'FALSE')} AS created_at",
        "'M001' AS merchant_id", "'card' AS payment_method",
    )


def raw_ledger_entries(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    # L is the regular entry, LD a second posting of it, LX one without a transaction
    entries = _payments(spark, sf_dir, base).selectExpr("*", """EXPLODE(CASE
        WHEN b <= 14 THEN CAST(ARRAY() AS ARRAY<STRING>)
        WHEN b BETWEEN 98 AND 102 THEN ARRAY('L-', 'LD-')
        WHEN b BETWEEN 103 AND 112 THEN ARRAY('L-', 'LX-')
        ELSE ARRAY('L-') END) AS kind""").selectExpr(
        "*", "kind || k AS entry_id",
        """CASE WHEN kind = 'LX-' THEN 'GW-X-' || (k * 7919)
                WHEN b BETWEEN 48 AND 97 THEN order_id
                WHEN b BETWEEN 113 AND 115 THEN SUBSTRING('GW-' || order_id, 1, LENGTH(order_id) + 2)
                ELSE 'GW-' || order_id END AS external_ref""",
    )
    amount = """CASE WHEN b BETWEEN 15 AND 34 THEN amount + (1 + k % 5) * 0.01
                     WHEN b BETWEEN 35 AND 44 THEN amount - fee
                     WHEN b BETWEEN 116 AND 118 THEN amount - 100
                     ELSE amount END"""
    return entries.selectExpr(
        "entry_id", "external_ref", f"{_money_text(amount)} AS amount",
        "IF(b BETWEEN 45 AND 47, ' thb', 'THB') AS currency",
        f"{_with_offset(_plus('created', '60 + k * 13 % 3540'), 'TRUE')} AS posted_at",
        "'1102' AS account_code", "'debit' AS entry_type",
    )


def _names_by_platform() -> str:
    """Map from platform to its campaign names in seed order."""
    return "MAP(" + ", ".join(
        f"'{p}', ARRAY(" + ", ".join(quote(name) for owner, name, _ in seeds.CAMPAIGNS if owner == p) + ")"
        for p in AD_PLATFORMS
    ) + ")"


_SHIFTED_DAY = "DATE_SUB(TO_DATE(ts), 9496)"  # puts the event days among the order dates


def raw_ad_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = (
        table(spark, sf_dir, "events")
        .selectExpr(
            f"{_SHIFTED_DAY} AS day",
            "CASE user_id % 3 WHEN 0 THEN 'facebook' WHEN 1 THEN 'google' ELSE 'tiktok' END AS platform",
            "CAST(GET_JSON_OBJECT(props, '$.k') AS BIGINT) % 8 AS campaign",
            "event_type",
            "CAST(value AS DECIMAL(12,2)) AS value",
        )
        .groupBy("day", "platform", "campaign")
        .agg(
            F.expr("CAST(SUM(value) * 100 AS DECIMAL(18,2)) AS spend"),
            F.expr("COUNT_IF(event_type = 'view') * 100 AS views"),
            F.expr("COUNT_IF(event_type = 'click') * 10 AS clicks"),
            F.expr("COUNT_IF(event_type = 'purchase') AS purchases"),
        )
    )
    return daily.selectExpr(
        "CAST(day AS STRING) AS report_date", "platform",
        "CAST(NULL AS STRING) AS campaign_id", "CAST(NULL AS STRING) AS ad_id",
        f"{_names_by_platform()}[platform][CAST(campaign AS INT)] AS campaign_name",
        "IF(platform = 'google', FORMAT_NUMBER(spend, 2), CAST(spend AS STRING)) AS spend",
        "IF(platform = 'google', 'THB', 'USD') AS currency",
        "IF(platform = 'facebook' AND campaign = 5 AND DAY(day) % 9 = 0, '0', CAST(views AS STRING)) AS impressions",
        "CAST(clicks AS STRING) AS clicks",
        """IF(platform != 'facebook' AND campaign = 3 AND DAY(day) % 7 = 0, 'N/A', CAST(purchases AS STRING))
           AS conversions""",
        "EXPLODE(ARRAY_REPEAT(1, IF(platform = 'google' AND DAY(day) % 10 = 0, 2, 1))) AS _copy",
    ).drop("_copy")


# Exports that come late: they are not in the inbox at first.
LATE_EXPORT = "platform = 'tiktok' AND DAY(CAST(report_date AS DATE)) = 30"


def raw_utm_touches(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = ", ".join(f"STRUCT({quote(v)} AS variant, {quote(p)} AS platform)" for v, p in seeds.UTM_SOURCES)
    keyed = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", f"ARRAY({variants})[CAST(o_orderkey % 10 AS INT)] AS seed"
    )
    return keyed.selectExpr(
        "'O-' || k AS order_id",
        "CASE WHEN k % 4 = 0 THEN NULL WHEN k % 97 = 0 THEN 'bing' ELSE seed.variant END AS utm_source",
        f"IF(k % 4 = 0, NULL, {_names_by_platform()}[seed.platform][CAST(k DIV 10 % 8 AS INT)]) AS utm_campaign",
    )


def raw_fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").selectExpr(f"{_SHIFTED_DAY} AS day").distinct()
    return days.selectExpr(
        "CAST(day AS STRING) AS `date`",
        "CAST(CAST(35.5 + (DAY(day) % 15) * 0.1 AS DECIMAL(10,4)) AS STRING) AS usd_thb",
    )


_FILE_DATE = r"REGEXP_EXTRACT(_source_file, '(\\d{4}-\\d{2}-\\d{2})', 1)"


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load log those order files would have left behind."""
    files = raw_orders(spark, sf_dir).groupBy("_source_file").agg(F.expr("COUNT(*) AS row_count"))
    return files.selectExpr(
        "_source_file AS file_name", "'orders' AS table_name", f"CAST({_FILE_DATE} AS DATE) AS file_date", "row_count"
    )


# ------------------------------------------------------------------- manifest

def injected_order_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(case, id) of all dirt the formulas above put into orders and customers."""
    bad_amount, refunded = "k % 200 IN (3, 5, 9)", "k % 33 = 4"
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS k").selectExpr(
        f"""EXPLODE(ARRAY_COMPACT(ARRAY(
            IF(k % 50 = 13, 'duplicate', NULL),
            IF({refunded}, 'late_refund', NULL),
            IF(k % 100 = 11 AND NOT {bad_amount} AND NOT {refunded}, 'late_arrival', NULL),
            IF({bad_amount}, 'bad_amount', NULL),
            IF(k % 100 = 7 AND NOT {bad_amount}, 'orphan_customer', NULL)))) AS case""",
        "'O-' || k AS id",
    )
    customers = table(spark, sf_dir, "customer").selectExpr(
        "IF(c_custkey % 33 = 5, 'invalid_email', NULL) AS case", "'C' || c_custkey AS id"
    ).where("case IS NOT NULL")
    return orders.unionByName(customers)


def injected_payment_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(case, id) of the ledger mismatches; the id is the reference without prefix."""
    return _payments(spark, sf_dir).selectExpr(
        """CASE WHEN b <= 14 THEN 'missing_in_ledger'
                WHEN b BETWEEN 15 AND 34 THEN 'rounding'
                WHEN b BETWEEN 35 AND 44 THEN 'fee_timing'
                WHEN b BETWEEN 98 AND 102 THEN 'duplicate_posting'
                WHEN b BETWEEN 103 AND 112 THEN 'missing_in_gateway' END AS case""",
        "IF(b BETWEEN 103 AND 112, 'X-' || (k * 7919), order_id) AS id",
    ).where("case IS NOT NULL")
