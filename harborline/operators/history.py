"""Status history: every version of an order as a half-open validity interval."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from harborline.functions import casts, text
from harborline.operators.skew import ranked_sliced, split_hot


def _typed_versions(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "order_id",
        f"{text.tidy_lower('status')} AS status",
        f"{casts.instant('updated_at')} AS valid_from",
    ).where("order_id IS NOT NULL AND valid_from IS NOT NULL")


def _versions(raw: DataFrame) -> DataFrame:
    return _typed_versions(raw).distinct()


# Two statuses at one instant are put in alphabetical order.
_IN_TIME = ("valid_from ASC NULLS LAST", "status ASC NULLS LAST")


def status_history(raw: DataFrame) -> DataFrame:
    """(order_id, status, valid_from, valid_to, is_current) per distinct version."""
    ordinary, hot = split_hot(raw, ["order_id"])
    following = f"LEAD(valid_from) OVER (PARTITION BY order_id ORDER BY {', '.join(_IN_TIME)}) AS valid_to"
    # one shuffle by order serves the distinct and the window
    history = _typed_versions(ordinary).repartition("order_id").distinct().selectExpr("*", following)
    if hot is not None:
        history = history.unionByName(_hot_history(hot))
    return history.selectExpr("*", "valid_to IS NULL AS is_current")


def merged_history(old: DataFrame, arrived: DataFrame) -> DataFrame:
    """The intervals of the orders in ``old`` and ``arrived`` raw versions, after those versions.

    A version later than all others reopens its order's last interval; a late one
    splits the interval it falls into.  A version that is known already changes nothing.
    """
    versions = old.select("order_id", "status", "valid_from").union(_versions(arrived)).repartition("order_id").distinct()
    following = f"LEAD(valid_from) OVER (PARTITION BY order_id ORDER BY {', '.join(_IN_TIME)}) AS valid_to"
    return versions.selectExpr("*", following).selectExpr("*", "valid_to IS NULL AS is_current")


def _hot_history(raw: DataFrame) -> DataFrame:
    """The same for orders with too many versions for one task.

    Number the versions in slices, then join each with its successor: the key
    (order_id, number) is unique, so no task sees more than its share.
    """
    numbered = ranked_sliced(_versions(raw), ["order_id"], _IN_TIME, "_n")
    successor = numbered.selectExpr("order_id", "_n - 1 AS _n", "valid_from AS valid_to")
    return numbered.join(successor, ["order_id", "_n"], "left").select(
        "order_id", "status", "valid_from", "valid_to"
    )


def days_to_refund(history: DataFrame) -> DataFrame:
    """How many midnights lie between an order's first version and its refund.

    Only the dates matter, so refunds shrink to one row per order and day before
    they meet the order's first version.
    """
    first_seen = history.groupBy("order_id").agg(F.expr("TO_DATE(MIN(valid_from)) AS first_day"))
    refunds = (
        history.where("status = 'refunded'")
        .selectExpr("order_id", "TO_DATE(valid_from) AS refund_day")
        .groupBy("order_id", "refund_day").agg(F.expr("COUNT(*) AS n"))
    )
    return (
        refunds.join(first_seen, "order_id")
        .selectExpr("DATEDIFF(refund_day, first_day) AS days_to_refund", "n")
        .groupBy("days_to_refund").agg(F.expr("SUM(n) AS orders"))
    )
