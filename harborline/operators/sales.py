"""Order enrichment, dimensions and the additive sales facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from harborline.functions.ratios import ratio
from harborline.functions.text import one_of
from harborline.operators.cleaning import typed_items, with_business_date
from harborline.operators.skew import hot_keys, join_hot, only_keys
from harborline.schemas import GROSS_STATUSES, NET_STATUSES, UNKNOWN_CUSTOMER

IS_NET = one_of("status", NET_STATUSES)
IS_GROSS = one_of("status", GROSS_STATUSES)
IS_REFUND = "status = 'refunded'"


def sum_where(condition: str, value: str, out: str):
    return F.expr(f"COALESCE(SUM(CASE WHEN {condition} THEN {value} END), 0) AS {out}")


def line_totals(items: DataFrame) -> DataFrame:
    """Lines and money per order; partial sums shrink a hot order before the shuffle."""
    return items.groupBy("order_id").agg(
        F.expr("COUNT(*) AS n_lines"), F.expr("SUM(qty * unit_price) AS items_amount")
    )


def with_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Add the known customer and region; an orphan becomes ``unknown``, never dropped.

    The id as sent stays in source_customer_id.  No broadcast is forced: the
    customer table grows, so its measured size decides, and a customer with a
    third of all orders is split by the adaptive skew join.
    """
    known = customers.selectExpr("customer_id AS _known_id", "region")
    others = [c for c in orders.columns if c != "customer_id"]
    return orders.join(known, F.expr("customer_id = _known_id"), "left").selectExpr(
        *others,
        f"COALESCE(_known_id, '{UNKNOWN_CUSTOMER}') AS customer_id",
        "customer_id AS source_customer_id",
        "region",
    )


def enriched_orders(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """Current orders with business date, customer and line totals."""
    # line totals first: both sides are already spread by order_id
    totalled = with_business_date(orders).join(line_totals(items), "order_id", "left")
    return with_customer(totalled, customers).selectExpr(
        "order_id", "order_ts", "updated_at", "status", "total_amount", "channel", "business_date",
        "customer_id", "source_customer_id", "region",
        "COALESCE(n_lines, 0) AS n_lines",
        "COALESCE(items_amount, 0) AS items_amount",
    )


def customer_dimension(customers: DataFrame) -> DataFrame:
    """Customers plus one member that orphan orders can point to."""
    unknown = customers.sparkSession.range(1).selectExpr(
        f"'{UNKNOWN_CUSTOMER}' AS customer_id", "CAST(NULL AS STRING) AS email", "FALSE AS email_is_valid",
        "CAST(NULL AS DATE) AS signup_date", "CAST(NULL AS STRING) AS region",
    )
    return customers.select(*unknown.columns).unionByName(unknown)


def product_dimension(products: DataFrame) -> DataFrame:
    return products.select("product_id", "name", "category", "cost")


def daily_orders(orders: DataFrame) -> DataFrame:
    """Order counts and header money per business date and channel.

    Needs only the order columns; enrichment keeps one row per order, so the
    narrower frame gives the same fact without its joins.
    """
    return orders.groupBy("business_date", "channel").agg(
        F.expr(f"COUNT_IF({IS_NET}) AS net_orders"),
        F.expr(f"COUNT_IF({IS_REFUND}) AS refunded_orders"),
        sum_where(IS_NET, "total_amount", "net_amount"),
    )


def order_lines(orders: DataFrame, raw_items: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct clean lines with their order's date, channel, status and category.

    One shuffle of the lines by order_id serves both the distinct and the join.
    Orders with too many lines for one task take another way: their distinct
    spreads over all columns with a map-side pass, and their few header rows are
    broadcast, so their lines are never gathered by order.
    """
    header = orders.select("order_id", "business_date", "channel", "status")
    hot = hot_keys(raw_items, ["order_id"])
    ordinary = raw_items if hot is None else only_keys(raw_items, hot, ["order_id"], "left_anti")
    lines = typed_items(ordinary).repartition("order_id").distinct().join(header, "order_id")
    if hot is not None:
        hot_lines = typed_items(only_keys(raw_items, hot, ["order_id"])).distinct()
        lines = lines.unionByName(join_hot(hot_lines, header, hot, "order_id"))
    return priced_lines(lines, products)


def priced_lines(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Lines that carry their order's date, channel and status, with category and money."""
    return lines.join(products.select("product_id", "category"), "product_id").selectExpr(
        "order_id", "business_date", "channel", "status", "category", "qty * unit_price AS line_amount"
    )


def daily_sales(lines: DataFrame) -> DataFrame:
    """Gross, refunded and net money per date, channel and category.

    Status is the order's current status, so a late refund moves money on the
    order's original business date.  Money only: counts are not additive here.
    """
    return lines.groupBy("business_date", "channel", "category").agg(
        sum_where(IS_GROSS, "line_amount", "gross_amount"),
        sum_where(IS_REFUND, "line_amount", "refund_amount"),
        sum_where(IS_NET, "line_amount", "net_amount"),
    )


def daily_refunds(lines: DataFrame) -> DataFrame:
    """Distinct orders and refunded money per business date and category.

    An order has one business date, so these counts add up over dates.  Collapsing
    to (date, category, order) first turns two distinct counts into plain ones; a
    status belongs to the order, so it is constant within the group.
    """
    per_order = lines.where(IS_GROSS).groupBy("business_date", "category", "order_id", "status").agg(
        F.expr("SUM(line_amount) AS amount")
    )
    return per_order.groupBy("business_date", "category").agg(
        F.expr("COUNT(*) AS paid_orders"),
        F.expr(f"COUNT_IF({IS_REFUND}) AS refunded_orders"),
        sum_where(IS_REFUND, "amount", "refunded_amount"),
    )


def refund_rates(refunds: DataFrame) -> DataFrame:
    """Refund rate per category over all dates of :func:`daily_refunds`."""
    facts = refunds.groupBy("category").agg(
        F.expr("SUM(paid_orders) AS paid_orders"), F.expr("SUM(refunded_orders) AS refunded_orders"),
        F.expr("SUM(refunded_amount) AS refunded_amount"),
    )
    return facts.selectExpr(
        "category", "paid_orders", "refunded_orders",
        f"{ratio('refunded_orders', 'paid_orders', times=100)} AS refund_rate_pct",
        "refunded_amount",
    )


def refund_analysis(lines: DataFrame) -> DataFrame:
    """Distinct orders, refund rate and refunded money per category."""
    return refund_rates(daily_refunds(lines))
