"""Data-quality checks as aggregations; a check is a row with a violation count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from harborline.functions import casts
from harborline.functions.text import one_of
from harborline.operators.sales import IS_NET, IS_REFUND
from harborline.schemas import (
    AD_PLATFORMS, CHANNELS, MART_PLATFORMS, ORDER_STATUSES, REJECT_REASONS,
)


@dataclass(frozen=True)
class Rules:
    """Column rules of one table."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)


# The rules every build is held to.
RULES: dict[str, Rules] = {
    "stg_orders": Rules(
        not_null=("order_id", "order_ts", "updated_at", "total_amount", "status", "channel"),
        unique=("order_id",),
        accepted={"status": ORDER_STATUSES, "channel": CHANNELS},
    ),
    "rejected_orders": Rules(not_null=("reject_reason",), accepted={"reject_reason": REJECT_REASONS}),
    "stg_order_items": Rules(not_null=("order_id", "qty", "unit_price")),
    "stg_customers": Rules(not_null=("customer_id",), unique=("customer_id",)),
    "stg_products": Rules(not_null=("product_id",), unique=("product_id",)),
    "stg_ad_performance": Rules(
        not_null=("report_date", "platform", "spend_thb", "campaign_name"),
        accepted={"platform": AD_PLATFORMS},
    ),
    "stg_utm_touches": Rules(not_null=("order_id",), unique=("order_id",)),
    "stg_fx_rates": Rules(not_null=("fx_date", "usd_thb"), unique=("fx_date",)),
    "order_status_history": Rules(not_null=("order_id", "valid_from")),
    "orders_enriched": Rules(not_null=("order_id", "business_date", "customer_id"), unique=("order_id",)),
    "daily_sales": Rules(not_null=("business_date", "gross_amount", "net_amount")),
    "daily_orders": Rules(not_null=("business_date", "net_orders")),
    "dim_customers": Rules(not_null=("customer_id",), unique=("customer_id",)),
    "dim_products": Rules(not_null=("product_id",), unique=("product_id",)),
    "refund_analysis": Rules(not_null=("category",), unique=("category",)),
    "channel_performance": Rules(
        not_null=("activity_date", "platform", "spend_thb"), accepted={"platform": MART_PLATFORMS},
    ),
    "campaign_performance": Rules(not_null=("canonical",), unique=("canonical",)),
}


def _count(df: DataFrame, expression: str) -> DataFrame:
    return df.agg(F.expr(f"{expression} AS violations"))


def _row_rules(rules: Rules) -> dict[str, str]:
    """Name of a rule that one row can break, and when it does."""
    return {
        **{f"not_null:{c}": f"{c} IS NULL" for c in rules.not_null},
        **{f"accepted_values:{c}": f"NOT ({one_of(c, values)})" for c, values in rules.accepted.items()},
    }


def rule_metrics(table: str) -> dict[str, Column]:
    """Violations per rule as aggregates that can ride on the write of the table."""
    rules = RULES.get(table, Rules())
    return {name: F.expr(f"COUNT_IF({condition})") for name, condition in _row_rules(rules).items()}


def observed_checks(counted: Mapping[str, Mapping[str, int]], tables: Mapping[str, DataFrame]) -> DataFrame:
    """All rules of stored tables: those of single rows as counted by the write, repeats by a keyed count."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(table, name, n) for table, found in counted.items() if table in tables for name, n in found.items()]
    checks = spark.createDataFrame(rows, "table_name string, `check` string, violations long")
    for table, df in tables.items():
        for column in RULES.get(table, Rules()).unique:
            checks = checks.unionByName(unique_check(table, df, column))
    return checks


def column_checks(table: str, df: DataFrame, rules: Rules) -> DataFrame:
    """All rules of a table in ONE pass over it.

    With a unique column, the other rules are counted per value of that column
    first: the aggregation that finds repeats carries them along, and map-side
    partial counts keep a hot value small.
    """
    counts = list(_row_rules(rules).items())
    broken = [f"COUNT_IF({condition}) AS c{i}" for i, (_, condition) in enumerate(counts)]
    names = [name for name, _ in counts]
    if rules.unique:
        key, *others = rules.unique
        per_value = df.groupBy(key).agg(F.expr("COUNT(*) AS _n"), *map(F.expr, broken))
        one_row = per_value.agg(
            *[F.expr(f"COALESCE(SUM(c{i}), 0) AS c{i}") for i in range(len(names))],
            F.expr(f"COUNT_IF(_n > 1 AND {key} IS NOT NULL) AS c{len(names)}"),
        )
        names.append(f"unique:{key}")
    else:
        others = []
        one_row = df.agg(*map(F.expr, broken))
    rows = ", ".join(f"NAMED_STRUCT('check', '{name}', 'violations', c{i})" for i, name in enumerate(names))
    result = one_row.selectExpr(f"'{table}' AS table_name", f"INLINE(ARRAY({rows}))")
    for column in others:
        result = result.unionByName(unique_check(table, df, column))
    return result


def unique_check(table: str, df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs do not count."""
    repeated = df.where(f"{column} IS NOT NULL").groupBy(column).count().where("count > 1")
    return _count(repeated, "COUNT(*)").selectExpr(
        f"'{table}' AS table_name", f"'unique:{column}' AS check", "violations"
    )


def relationship_check(table: str, df: DataFrame, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Rows whose value has no partner in the target.

    Counted per value first: a hot value reaches the join as one row.
    """
    used = df.where(f"{column} IS NOT NULL").groupBy(column).agg(F.expr("COUNT(*) AS n"))
    known = target.selectExpr(f"{target_column} AS {column}")
    return _count(used.join(known, column, "left_anti"), "COALESCE(SUM(n), 0)").selectExpr(
        f"'{table}' AS table_name", f"'relationships:{column}' AS check", "violations"
    )


def as_check(table: str, name: str, broken: DataFrame) -> DataFrame:
    """A check whose violations are the rows of ``broken``."""
    return _count(broken, "COUNT(*)").selectExpr(f"'{table}' AS table_name", f"'{name}' AS check", "violations")


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether two tables of equal columns hold the same rows as often, by one aggregation over both."""
    both = left.withColumn("_n", F.lit(1)).unionByName(right.withColumn("_n", F.lit(-1)))
    return both.groupBy(*left.columns).agg(F.sum("_n").alias("_n")).where("_n != 0").isEmpty()


def check_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All rules of the given tables in long form."""
    return reduce(DataFrame.unionByName, [column_checks(name, df, RULES[name]) for name, df in tables.items()])


def failed(checks: DataFrame) -> DataFrame:
    """The checks that found something, worst first."""
    return checks.where("violations > 0").orderBy("violations", ascending=False)


class QualityError(RuntimeError):
    """A build broke a rule it is held to."""


def require(checks: DataFrame) -> DataFrame:
    """Raise when a check of a build failed, else hand the checks back."""
    broken = failed(checks).collect()  # at most one row per rule
    if broken:
        raise QualityError("; ".join(f"{r.table_name} {r.check}: {r.violations}" for r in broken))
    return checks


# ----------------------------------------------------------- money and counts

_CENT = "0.01"


def _line_money(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.expr("SUM(qty * unit_price) AS line_total"))


def net_is_gross_minus_refund(sales: DataFrame) -> DataFrame:
    return _count(sales, "COUNT_IF(net_amount != gross_amount - refund_amount)")


def net_money_by_layer(sales: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Net money in the fact and recomputed from the clean tables: (layer, net_amount)."""
    staging = orders.where(IS_NET).select("order_id").join(_line_money(items), "order_id")
    return sales.agg(F.expr("COALESCE(SUM(net_amount), 0) AS net_amount")).selectExpr(
        "'mart' AS layer", "net_amount"
    ).unionByName(
        staging.agg(F.expr("COALESCE(SUM(line_total), 0) AS net_amount")).selectExpr("'staging' AS layer", "net_amount")
    )


def header_differs_from_lines(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders whose header total is not the sum of their lines."""
    joined = orders.select("order_id", "total_amount").join(_line_money(items), "order_id")
    return _count(joined, f"COUNT_IF(ABS(total_amount - line_total) > {_CENT})")


def order_count_by_layer(daily: DataFrame, orders: DataFrame) -> DataFrame:
    """Net orders in the fact and in the clean table; a line-grain count would differ."""
    return daily.agg(F.expr("SUM(net_orders) AS net_orders")).selectExpr("'mart' AS layer", "net_orders").unionByName(
        orders.agg(F.expr(f"COUNT_IF({IS_NET}) AS net_orders")).selectExpr("'staging' AS layer", "net_orders")
    )


def order_accounting(raw: DataFrame, clean: DataFrame, rejected: DataFrame) -> DataFrame:
    """Distinct raw ids against clean plus rejected orders.

    Rows without an id count as one group and end as one reject, which the
    distinct count does not see; it is reported on its own.
    """
    ids = raw.groupBy("order_id").count().agg(
        F.expr("COUNT(order_id) AS raw_ids"), F.expr("COUNT_IF(order_id IS NULL) AS without_id"), F.expr("1 AS _one")
    )
    kept = clean.agg(F.expr("COUNT(*) AS clean"), F.expr("1 AS _one"))
    dropped = rejected.agg(F.expr("COUNT(*) AS rejected"), F.expr("1 AS _one"))
    # three global aggregates of one row each
    return ids.join(kept, "_one").join(dropped, "_one").selectExpr(
        "raw_ids", "without_id", "clean", "rejected", "clean + rejected - raw_ids - without_id AS violations"
    )


def refund_money_mismatch(lines: DataFrame, analysis: DataFrame) -> DataFrame:
    """Categories whose refunded money is not what their lines say: (category, in_lines, in_fact, off_by).

    One signed sum per category over lines and facts together, so neither side has to find the other.
    """
    money = lines.where(IS_REFUND).selectExpr("category", "line_amount AS in_lines", "0 AS in_fact").unionByName(
        analysis.selectExpr("category", "0 AS in_lines", "refunded_amount AS in_fact"))
    per_category = money.groupBy("category").agg(F.expr("SUM(in_lines) AS in_lines"), F.expr("SUM(in_fact) AS in_fact"))
    return per_category.selectExpr("*", "in_lines - in_fact AS off_by").where(f"ABS(off_by) > {_CENT}")


def restated_refund_mismatch(sales: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Business dates whose refunds differ from a recount on the order's own date.

    ``orders`` carries business_date.
    """
    refunds = orders.where(IS_REFUND).select("order_id", "business_date").join(_line_money(items), "order_id")
    expected = refunds.groupBy("business_date").agg(F.expr("SUM(line_total) AS expected"))
    actual = sales.groupBy("business_date").agg(F.expr("SUM(refund_amount) AS actual"))
    return _count(
        expected.join(actual, "business_date", "full"),
        f"COUNT_IF(ABS(COALESCE(expected, 0) - COALESCE(actual, 0)) > {_CENT})",
    )


def spend_by_layer(ads: DataFrame, channels: DataFrame) -> DataFrame:
    """Ad spend before and after the fact: (layer, spend_thb)."""
    def total(df: DataFrame, layer: str) -> DataFrame:
        return df.agg(F.expr("COALESCE(SUM(spend_thb), 0) AS spend_thb")).selectExpr(f"'{layer}' AS layer", "spend_thb")

    return total(ads, "staging").unionByName(total(channels, "mart"))


def collapsed_resends(raw_ads: DataFrame, ads: DataFrame) -> DataFrame:
    """Per platform: delivered rows, rows kept, rows collapsed as resends."""
    raw = raw_ads.groupBy("platform").agg(F.expr("COUNT(*) AS delivered"))
    kept = ads.groupBy("platform").agg(F.expr("COUNT(*) AS kept")).withColumnRenamed("platform", "_platform")
    return raw.join(kept, F.expr("platform <=> _platform"), "left").selectExpr(
        "platform", "delivered", "COALESCE(kept, 0) AS kept", "delivered - COALESCE(kept, 0) AS collapsed"
    )


def undefined_ratios(channels: DataFrame) -> DataFrame:
    """Ratio cells that are not finite; the guarded decimal ratios never are."""
    def broken(name: str) -> str:
        value = f"CAST(COALESCE({name}, 0) AS DOUBLE)"
        return f"ISNAN({value}) OR ABS({value}) = DOUBLE('Infinity')"

    return _count(channels, f"COUNT_IF({' OR '.join(map(broken, ('roas', 'cpc_thb', 'cpa_thb', 'ctr_pct')))})")


def attribution_completeness(touches: DataFrame, orders: DataFrame, attributed: DataFrame) -> DataFrame:
    """Touches of net orders, attributed rows, and the organic share."""
    per_order = touches.groupBy("order_id").agg(F.expr("COUNT(*) AS n"))
    expected = orders.where(IS_NET).select("order_id").join(per_order, "order_id").agg(
        F.expr("COALESCE(SUM(n), 0) AS expected"), F.expr("1 AS _one")
    )
    actual = attributed.agg(
        F.expr("COUNT(*) AS attributed"), F.expr("COUNT_IF(platform = 'organic') AS organic"), F.expr("1 AS _one")
    )
    return expected.join(actual, "_one").drop("_one")


def waterfall_completeness(gateway: DataFrame, ledger: DataFrame, results: DataFrame) -> DataFrame:
    """Rows in and rows placed per side: (side, received, placed)."""
    def received(df: DataFrame, side: str) -> DataFrame:
        return df.agg(F.expr("COUNT(*) AS received")).selectExpr(f"'{side}' AS side", "received")

    placed = results.agg(F.expr("COUNT(txn_id) AS g"), F.expr("COUNT(entry_id) AS l")).selectExpr(
        "INLINE(ARRAY(NAMED_STRUCT('side', 'gateway', 'placed', g), NAMED_STRUCT('side', 'ledger', 'placed', l)))"
    )
    return received(gateway, "gateway").unionByName(received(ledger, "ledger")).join(placed, "side")


def bucket_sum_mismatch(summary: DataFrame) -> DataFrame:
    """Days whose gateway buckets do not add up to the gateway count."""
    return _count(summary, """COUNT_IF(
        matched + fee_timing + rounding + amount_other + possible_ref_issue + missing_in_ledger != gateway_count)""")


# ------------------------------------------------------- volume and freshness

def freshness(log: DataFrame) -> DataFrame:
    """Newest file date per table."""
    return log.groupBy("table_name").agg(F.expr("MAX(file_date) AS latest_file_date"))


def daily_volume(log: DataFrame) -> DataFrame:
    return log.where("file_date IS NOT NULL").groupBy("table_name", "file_date").agg(
        F.expr("SUM(row_count) AS rows")
    )


def volume_anomalies(volume: DataFrame, days: int = 7) -> DataFrame:
    """Days that deviate from the average of the days before by more than half of it.

    The input is the daily rollup of the load log: one row per table and day.
    """
    before = f"OVER (PARTITION BY table_name ORDER BY file_date ROWS BETWEEN {days} PRECEDING AND 1 PRECEDING)"
    profile = volume.selectExpr(
        "table_name", "file_date", "rows",
        f"CAST(SUM(rows) {before} AS DECIMAL(20,2)) / COUNT(rows) {before} AS trailing",
    )
    return profile.where("ABS(rows - trailing) * 2 > trailing").selectExpr(
        "table_name", "file_date", "rows", "CAST(ROUND(trailing, 0) AS BIGINT) AS trailing_avg"
    )


_FILE_DATE = r"REGEXP_EXTRACT(_source_file, '(\\d{4}-\\d{2}-\\d{2})', 1)"


def off_schedule_files(orders: DataFrame) -> DataFrame:
    """Orders by the distance in days from their UTC date to their file's date."""
    late = f"DATEDIFF({casts.calendar_date(_FILE_DATE)}, {casts.utc_date('order_ts')}) AS days_late"
    return orders.selectExpr(late).groupBy("days_late").agg(F.expr("COUNT(*) AS orders"))


# ---------------------------------------------------------- checksums, recall

VOLATILE = ("_ingested_at",)


def checksum(table: str, df: DataFrame) -> DataFrame:
    """Order-independent fingerprint that any engine can compute: row count and sum of row digests.

    A row's digest is the leading 60 bits of the MD5 of its values as text, in the
    alphabetical order of their columns, with a unit separator between them and
    a record separator for NULL.
    """
    columns = sorted(c for c in df.columns if c not in VOLATILE)
    values = ", ".join(f"COALESCE(CAST(`{c}` AS STRING), CHR(30))" for c in columns)
    digest = f"CAST(CONV(LEFT(MD5(CONCAT_WS(CHR(31), {values})), 15), 16, 10) AS DECIMAL(20,0))"
    return df.agg(
        F.expr("COUNT(*) AS rows"), F.expr(f"COALESCE(SUM(CAST({digest} AS DECIMAL(38,0))), 0) AS fingerprint")
    ).selectExpr(f"'{table}' AS table_name", "rows", "CAST(fingerprint AS DECIMAL(38,0)) AS fingerprint")


def checksums(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [checksum(name, df) for name, df in tables.items()])


def only_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a list of ids, given as a DataFrame of any size."""
    return df.join(ids.select(key), key, "left_semi")


def recall(expected: DataFrame, caught: DataFrame) -> DataFrame:
    """Per case: how many of the expected (case, id) were caught."""
    hits = caught.distinct().selectExpr("case", "id", "1 AS _hit")
    return expected.distinct().join(hits, ["case", "id"], "left").groupBy("case").agg(
        F.expr("COUNT(*) AS injected"), F.expr("COUNT(_hit) AS caught")
    )
