"""Restatement by change sets: from the rows a load brought to the days they touch.

A load changes the orders it mentions, an order changes the days it was and is
booked on, and only the parts of those days are read and written again.  Orders
and lines are kept by business date, the status history by a hash of the order.
Facts that are additive over days are kept per day; what is not, refund rates, is
derived from daily counts that are.

Rows that a repeated load withdrew cannot be taken back out of a maximum, so the
orders they mention are computed again from all their landing rows; all others
from their stored row and what arrived.  Where an order is booked is found in two
columns of the stored orders.

Every function takes a :class:`~harborline.sources.published.Build` and leaves
publishing to its caller, so several tables switch at once.

Reconciliation is restated by closure.  Tiers 1-3 pair within a lane (a
reference), so a lane that got or lost a row is settled again as a whole.  What it
leaves open before and after names the (amount, day) groups of tier 4 that change,
and all open rows of those groups, whatever their lane, are ranked again.  Tier 4
never feeds back into tiers 1-3, so nothing further can change.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from harborline.operators import cleaning, history, reconciliation, sales
from harborline.operators.quality import rule_metrics
from harborline.operators.skew import split_hot
from harborline.session import TIGHT, materialize
from harborline.sources.published import NO_VALUE, Build, Snapshot

HISTORY_BUCKETS = 64
RECON_BUCKETS = 64
BOOKED = "business_date"


@dataclass(frozen=True)
class Change:
    """Landing rows that came, rows that a repeated load took back, and all current rows."""

    arrived: DataFrame
    withdrawn: DataFrame | None = None
    current: DataFrame | None = None

    def keys(self, column: str) -> DataFrame:
        rows = self.arrived.select(column)
        return (rows if self.withdrawn is None else rows.union(self.withdrawn.select(column))).distinct()

    def redone(self, column: str) -> DataFrame | None:
        """Keys whose rows must be taken from all current rows, None if there are none."""
        if self.withdrawn is None:
            return None
        keys = materialize(self.withdrawn.select(column).distinct(), "redone")
        return None if keys.isEmpty() else keys


def _of(rows: DataFrame, keys: DataFrame, how: str, column: str = "order_id") -> DataFrame:
    """Rows whose key is (not) among the keys; NULL is a key like any other."""
    other = keys.select(F.col(column).alias("_key"))
    return rows.join(other, F.col(column).eqNullSafe(F.col("_key")), how)


def _parts(build: Build, rows: DataFrame) -> set[str]:
    """Parts the rows belong to: days or longer, so few."""
    return {r.p for r in rows.select(build.store.part_of(BOOKED).alias("p")).distinct().collect()}


# ------------------------------------------------------------------- full build

@dataclass(frozen=True)
class Dimensions:
    """Clean customers and products as of the build."""

    customers: DataFrame
    products: DataFrame


# Tables kept by business date without carrying the column.
UNDATED = ("stg_orders", "rejected_orders", "stg_order_items")


def build_orders(build: Build, raw_orders: DataFrame, raw_items: DataFrame, dimensions: Dimensions) -> None:
    """All tables of this module from scratch."""
    base = cleaning.with_business_date(cleaning.order_base(raw_orders))
    base = build.replace("order_base", base, by=BOOKED)
    items = _placed_landing(raw_items, base)
    items = build.replace("stg_order_items", items, by=BOOKED, hidden=True, metrics=rule_metrics("stg_order_items"))
    _book(base, items, dimensions, lambda name, rows, gathered=False: build.replace(
        name, rows, by=BOOKED, hidden=name in UNDATED, metrics=rule_metrics(name), gathered=gathered))
    build.replace("refund_analysis", sales.refund_rates(build.table("daily_refunds")), metrics=rule_metrics("refund_analysis"))


def build_history(build: Build, raw_orders: DataFrame, buckets: int = HISTORY_BUCKETS) -> None:
    build.replace("order_status_history", _bucketed(history.status_history(raw_orders), buckets), by="bucket", hidden=True,
                  metrics=rule_metrics("order_status_history"))


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64("order_id"), F.lit(buckets)).cast("int"))


def _placed(items: DataFrame, base: DataFrame) -> DataFrame:
    """Lines with their order's date; NULL while the order is unknown."""
    return items.join(base.where("order_id IS NOT NULL").select("order_id", BOOKED), "order_id", "left")


def _marked(items: DataFrame, base: DataFrame, touched: DataFrame) -> DataFrame:
    """Lines with their order's date and ``_touched``, true for touched orders; the lines are shuffled once for both."""
    dates = base.where("order_id IS NOT NULL").select("order_id", BOOKED)
    marks = touched.where("order_id IS NOT NULL").selectExpr("order_id", "TRUE AS _touched")
    return items.join(dates.join(marks, "order_id", "full"), "order_id", "left")


def _placed_landing(raw_items: DataFrame, base: DataFrame) -> DataFrame:
    """The same from landing lines: one shuffle by order serves the distinct and the join.

    Orders with too many lines for one task are made distinct by map tasks first, and their lines spread over all columns.
    """
    ordinary, hot = split_hot(raw_items, ["order_id"])
    placed = _placed(cleaning.typed_items(ordinary).repartition("order_id").distinct(), base)
    return placed if hot is None else placed.unionByName(_placed(cleaning.clean_items(hot), base))


def _book(base: DataFrame, items: DataFrame, dimensions: Dimensions, put: Callable[..., DataFrame]) -> None:
    """Hand the tables of whole days to ``put``, which stores them; lines are read back for the facts over them.

    ``base`` is a stored table, so what follows from it row by row is gathered in its parts already.
    """
    orders = cleaning.clean_orders(base, BOOKED)
    put("stg_orders", orders, gathered=True)
    put("rejected_orders", cleaning.rejected_orders(base, BOOKED), gathered=True)
    put("orders_enriched", sales.enriched_orders(orders.drop(BOOKED), dimensions.customers, items))
    put("daily_orders", sales.daily_orders(orders))
    booked = items.join(orders.select("order_id", BOOKED, "channel", "status"), "order_id")
    lines = put("order_lines", sales.priced_lines(booked, dimensions.products))
    put("daily_sales", sales.daily_sales(lines))
    put("daily_refunds", sales.daily_refunds(lines))


# ------------------------------------------------------------------ restatement

def restate_orders(build: Build, orders: Change, items: Change, dimensions: Dimensions) -> set[str]:
    """Apply changes of orders and lines to the tables of :func:`build_orders`; returns the touched days.

    The dimensions must be those the tables were built with; their change is a full build.
    """
    touched = materialize(orders.keys("order_id").union(items.keys("order_id")).distinct(), "touched", TIGHT)
    before = materialize(_of(build.table("order_base").select("order_id", BOOKED), touched, "left_semi"), "booked_before", TIGHT)
    days_before = _parts(build, before)

    # orders: the newest of what is stored and what arrived
    stored = _of(build.table("order_base", days_before), touched, "left_semi").drop(BOOKED)
    versions = stored.unionByName(cleaning.parse_orders(orders.arrived))
    redone = orders.redone("order_id")
    if redone is not None:
        versions = _of(versions, redone, "left_anti").unionByName(cleaning.parse_orders(_of(orders.current, redone, "left_semi")))
    newest = materialize(cleaning.with_business_date(cleaning.latest_versions(versions)), "newest", TIGHT)
    days = days_before | _parts(build, newest)
    kept = _of(build.table("order_base", days), touched, "left_anti")
    base = build.replace_parts("order_base", kept.unionByName(newest), BOOKED, days)

    # lines: those of touched orders move with them; lines without an order wait in a part of their own
    places = days | {NO_VALUE}
    held = materialize(_marked(build.table("stg_order_items", places), build.table("order_base", days), touched), "held_lines", TIGHT)
    lines = held.where("_touched").drop(BOOKED, "_touched")
    again = items.redone("order_id")
    if again is not None:
        lines = _of(lines, again, "left_anti").unionByName(cleaning.typed_items(_of(items.current, again, "left_semi")))
    lines = lines.unionByName(cleaning.typed_items(items.arrived)).distinct()
    kept = held.where("_touched IS NULL").drop("_touched")
    build.replace_parts("stg_order_items", kept.unionByName(_placed(lines, newest)), BOOKED, places, hidden=True)

    def put(name: str, rows: DataFrame, gathered: bool = False) -> DataFrame:
        build.replace_parts(name, rows, BOOKED, days, hidden=name in UNDATED, metrics=rule_metrics(name), gathered=gathered)
        return build.table(name, days)

    _book(build.table("order_base", days), build.table("stg_order_items", days), dimensions, put)
    build.replace("refund_analysis", sales.refund_rates(build.table("daily_refunds")), metrics=rule_metrics("refund_analysis"))
    return days


def restate_history(build: Build, orders: Change, buckets: int = HISTORY_BUCKETS) -> set[str]:
    """Merge new versions into the intervals of their orders; returns the touched buckets."""
    touched = materialize(_bucketed(orders.keys("order_id").where("order_id IS NOT NULL"), buckets), "touched")
    places = _buckets_of(touched)
    # a merge gives orders without new versions the intervals they have, so the others need not be told apart
    old, arrived = build.table("order_status_history", places), orders.arrived
    redone = orders.redone("order_id")
    if redone is not None:
        old = _of(old, redone, "left_anti")
        arrived = _of(arrived, redone, "left_anti").unionByName(_of(orders.current, redone, "left_semi").select(arrived.columns))
    merged = history.merged_history(old, arrived)
    build.replace_parts("order_status_history", _bucketed(merged, buckets), "bucket", places, hidden=True)
    return places


# --------------------------------------------------------------- reconciliation

_GROUP = {"_amount": "COALESCE(gateway_amount, ledger_amount)", "_day": "txn_date"}


def _by_lane(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64("lane"), F.lit(buckets)).cast("int"))


def _by_money(rows: DataFrame, buckets: int) -> DataFrame:
    key = F.xxhash64(*[F.expr(e) for e in _GROUP.values()])
    return rows.withColumn("bucket", F.pmod(key, F.lit(buckets)).cast("int"))


def _in_groups(rows: DataFrame, groups: DataFrame, how: str) -> DataFrame:
    keyed = rows.withColumns({f"{name}_of": F.expr(e) for name, e in _GROUP.items()})
    same = [F.col(f"{name}_of").eqNullSafe(F.col(name)) for name in _GROUP]
    return keyed.join(groups, same[0] & same[1], how).select(rows.columns)


def _buckets_of(rows: DataFrame) -> set[str]:
    return {str(r.bucket) for r in rows.select("bucket").distinct().collect()}


def build_recon(build: Build, raw_gateway: DataFrame, raw_ledger: DataFrame, buckets: int = RECON_BUCKETS) -> None:
    """The reconciliation in a form that can be restated; :func:`recon_results` reads it."""
    sides = build.replace("recon_sides", _by_lane(reconciliation.both_sides(raw_gateway, raw_ledger), buckets), by="bucket", hidden=True)
    state = build.replace("recon_state", _by_lane(reconciliation.tier_state(sides), buckets), by="bucket", hidden=True)
    open_rows = build.replace("recon_open", _by_money(state.where("tier IS NULL"), buckets), by="bucket", hidden=True)
    build.replace("recon_money", _by_money(reconciliation.money_results(open_rows), buckets), by="bucket", hidden=True)


def recon_results(tables: Build | Snapshot) -> DataFrame:
    """Every transaction and every entry in exactly one result row."""
    return reconciliation.settled_results(tables.table("recon_state")).unionByName(tables.table("recon_money"))


def restate_recon(build: Build, gateway: Change, ledger: Change, buckets: int = RECON_BUCKETS) -> int:
    """Apply changes of both sides to the tables of :func:`build_recon`; returns the number of lanes settled again."""
    arrived = reconciliation.both_sides(gateway.arrived, ledger.arrived)
    lanes, redone = arrived.select("lane"), None
    if gateway.withdrawn is not None or ledger.withdrawn is not None:
        gone = reconciliation.both_sides(*(
            change.withdrawn if change.withdrawn is not None else change.arrived.limit(0) for change in (gateway, ledger)))
        redone = materialize(gone.select("lane").distinct(), "redone")
        redone = None if redone.isEmpty() else redone
        lanes = lanes if redone is None else lanes.union(redone)
    lanes = materialize(_by_lane(lanes.distinct(), buckets), "lanes")
    places = _buckets_of(lanes)

    held = build.table("recon_sides", places)
    rows = _of(held, lanes, "left_semi", "lane").unionByName(arrived)
    if redone is not None:
        current = reconciliation.both_sides(gateway.current, ledger.current)
        rows = _of(rows, redone, "left_anti", "lane").unionByName(_of(current, redone, "left_semi", "lane"))
    rows = materialize(rows, "lane_rows")
    state = reconciliation.tier_state(rows)
    before = build.table("recon_state", places)
    old_open = _of(before.where("tier IS NULL"), lanes, "left_semi", "lane")
    new_open = state.where("tier IS NULL")
    groups = materialize(_by_money(old_open.unionByName(new_open), buckets).selectExpr(
        *[f"{e} AS {name}" for name, e in _GROUP.items()], "bucket").distinct(), "groups")
    money_places = _buckets_of(groups)

    build.replace_parts("recon_sides", _by_lane(_of(held, lanes, "left_anti", "lane").unionByName(rows), buckets), "bucket", places, hidden=True)
    build.replace_parts("recon_state", _by_lane(_of(before, lanes, "left_anti", "lane").unionByName(state), buckets), "bucket", places, hidden=True)
    open_rows = _of(build.table("recon_open", money_places), lanes, "left_anti", "lane").unionByName(new_open)
    money = build.table("recon_money", money_places)
    build.replace_parts("recon_open", _by_money(open_rows, buckets), "bucket", money_places, hidden=True)
    again = _in_groups(build.table("recon_open", money_places), groups, "left_semi")
    kept = _in_groups(money, groups, "left_anti").unionByName(reconciliation.money_results(again))
    build.replace_parts("recon_money", _by_money(kept, buckets), "bucket", money_places, hidden=True)
    return lanes.count()
