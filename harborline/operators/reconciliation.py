"""One-to-one reconciliation of gateway transactions with ledger entries.

The tiers, from strict to loose:

1. same reference, amount and UTC day           exact
2. same reference and amount                    date_boundary
3. same reference                               fee_timing / rounding / amount_other
4. same amount and day, references look alike   possible_ref_issue
5. the rest                                     missing_in_ledger / missing_in_gateway

A ledger entry that repeats an earlier (reference, amount text) is set aside
first as duplicate_posting.

How it runs.  Both sides go into one frame that is shuffled once by reference.
Tiers 1-3 are windows over keys that contain the reference, so they only sort:
within a group, row n of one side belongs to row n of the other, and a row is
taken when the other side has at least n rows.  No pairs are generated and no
anti joins are needed - a row that is taken simply stops being eligible.  After
tier 3 the state is written once; what is still open (a few percent) is all that
tier 4 shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import DataFrame, functions as F

from harborline.functions import casts, text
from harborline.functions.ratios import ratio
from harborline.operators.skew import by_key, ranked, ranked_sliced, split_hot
from harborline.schemas import FOLLOW_UP_TYPES
from harborline.session import materialize

# Tolerances, confidences and alert thresholds.
FEE_TOLERANCE = "0.005"
ROUNDING_TOLERANCE = "0.05"
CONFIDENCE = {
    "exact": "1.00",
    "date_boundary": "0.95",
    "fee_timing": "0.80",
    "rounding": "0.80",
    "amount_other": "0.80",
    "possible_ref_issue": "0.50",
    "missing_in_ledger": "1.00",
    "missing_in_gateway": "1.00",
    "duplicate_posting": "1.00",
}
MATCH_RATE_FLOOR = "97.0"
NET_DIFFERENCE_CEILING = "10000.0"

_DUPLICATE = 0  # in the tier column; NULL means still open
# The side column is 'G' or 'L'; gateway rows sort first.


class ReconciliationError(RuntimeError):
    """A reconciliation result broke one of its own guarantees."""


# ---------------------------------------------------------------- normalising

def normalize_gateway(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "txn_id",
        f"{text.payment_ref('gateway_ref')} AS ref",
        f"{casts.money('amount')} AS amount",
        f"{text.tidy_upper('currency')} AS currency",
        f"{casts.money('fee')} AS fee",
        f"{casts.utc_date(casts.instant('created_at'))} AS txn_date",
    )


def ledger_columns(raw: DataFrame) -> DataFrame:
    """Typed ledger entries without the posting sequence."""
    return raw.selectExpr(
        "entry_id",
        f"{text.payment_ref('external_ref')} AS ref",
        f"{casts.money('amount')} AS amount",
        f"{text.tidy_upper('currency')} AS currency",
        f"{casts.utc_date(casts.instant('posted_at'))} AS entry_date",
        # repeats are recognised on the text as delivered: 1000.0 is not 1000.00
        "amount AS amount_text",
    )


def normalize_ledger(raw: DataFrame) -> DataFrame:
    """Typed ledger entries; posting_seq > 1 marks a repeated posting."""
    return ranked(
        ledger_columns(raw), ["ref", "amount_text"], ["entry_id ASC NULLS LAST"], "posting_seq"
    ).drop("amount_text")


# ------------------------------------------------------------------ tiers 1-3

_TIERS: tuple[tuple[int, tuple[str, ...], tuple[str, ...]], ...] = (
    # tier, keys, order within the key
    (1, ("ref", "amount", "day"), ("id",)),
    (2, ("ref", "amount"), ("day", "id")),
    (3, ("ref",), ("amount", "day", "id")),
)

# What tiers 1-3 carry per row besides tier and pair_no.
_CARRIED = ("lane", "side", "id", "ref", "amount", "fee", "day")


def both_sides(raw_gateway: DataFrame, raw_ledger: DataFrame) -> DataFrame:
    """One frame with all transactions and entries.

    The lane decides the task.  It is the reference.  Rows without one match
    nobody in tiers 1-3 and spread out instead: entries by the amount text that
    decides about repeats, transactions by their id.
    """
    gateway = normalize_gateway(raw_gateway).selectExpr(
        "COALESCE(ref, '|' || txn_id, '|') AS lane", "'G' AS side", "txn_id AS id", "ref", "amount", "fee",
        "txn_date AS day", "CAST(NULL AS STRING) AS amount_text",
    )
    ledger = ledger_columns(raw_ledger).selectExpr(
        "COALESCE(ref, '|' || amount_text, '|') AS lane", "'L' AS side", "entry_id AS id", "ref", "amount",
        "CAST(NULL AS DECIMAL(14,2)) AS fee", "entry_date AS day", "amount_text",
    )
    return gateway.unionByName(ledger)


_both_sides = both_sides   # its earlier name


def _in_order(columns: Sequence[str]) -> list[str]:
    return [f"{c} ASC NULLS LAST" for c in columns]


def _eligible(keys: Sequence[str]) -> str:
    return " AND ".join(["tier IS NULL", *[f"{k} IS NOT NULL" for k in keys]])


def _mark_duplicates(rows: DataFrame, seq: str) -> DataFrame:
    return rows.selectExpr(
        *_CARRIED,
        f"CASE WHEN side = 'L' AND {seq} > 1 THEN {_DUPLICATE} END AS tier",
        "CAST(NULL AS BIGINT) AS pair_no",
    )


def _take_ordinary(rows: DataFrame, tier: int, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One tier for ordinary references: windows on the existing partitioning."""
    group = f"PARTITION BY lane, {', '.join(keys)}, _ok ORDER BY side, {', '.join(_in_order(order))}"
    whole = f"{group} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    numbered = rows.selectExpr("*", f"{_eligible(keys)} AS _ok").selectExpr(
        "*",
        f"ROW_NUMBER() OVER ({group}) AS _pos",
        f"COUNT_IF(side = 'G') OVER ({whole}) AS _gateways",
        f"COUNT(*) OVER ({whole}) AS _all",
    )
    # gateway rows sort first, so an entry's number starts after them
    number = "CASE WHEN side = 'G' THEN _pos ELSE _pos - _gateways END"
    return numbered.selectExpr("*", f"{number} AS _n").selectExpr(
        "*", "_ok AND _n <= LEAST(_gateways, _all - _gateways) AS _taken"
    ).selectExpr(
        *_CARRIED,
        f"CASE WHEN _taken THEN {tier} ELSE tier END AS tier",
        "CASE WHEN _taken THEN _n ELSE pair_no END AS pair_no",
    )


def _take_hot(rows: DataFrame, tier: int, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One tier for references too large for one task.

    Rows get their number in slices; then each looks up the row with the same
    number on the other side.  (keys, number) is unique per side, so the join
    has no hot key.
    """
    ok = _eligible(keys)
    numbered = ranked_sliced(rows.where(ok), ["side", *keys], _in_order(order), "_n")
    other = numbered.selectExpr(*keys, "_n", "CASE WHEN side = 'G' THEN 'L' ELSE 'G' END AS side", "TRUE AS _met")
    met = numbered.join(other, ["side", *keys, "_n"], "left").selectExpr(
        *_CARRIED,
        f"CASE WHEN _met THEN {tier} ELSE tier END AS tier",
        "CASE WHEN _met THEN _n ELSE pair_no END AS pair_no",
    )
    return rows.where(f"NOT ({ok})").unionByName(met)


def _join_pairs(rows: DataFrame) -> DataFrame:
    """Put the two rows of a pair side by side; single rows pass unchanged."""
    pair = (
        "PARTITION BY lane, tier, ref, CASE WHEN tier <= 2 THEN amount END, CASE WHEN tier = 1 THEN day END, pair_no "
        "ORDER BY side"
    )
    return rows.selectExpr(
        "*",
        f"CASE WHEN tier > {_DUPLICATE} THEN LEAD(id) OVER ({pair}) END AS _entry_id",
        f"CASE WHEN tier > {_DUPLICATE} THEN LEAD(amount) OVER ({pair}) END AS _entry_amount",
    ).where(f"tier IS NULL OR tier = {_DUPLICATE} OR side = 'G'").transform(_as_state)


def _as_state(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        "CASE WHEN side = 'G' THEN id END AS txn_id",
        "CASE WHEN side = 'G' THEN _entry_id ELSE id END AS entry_id",
        "ref",
        "CASE WHEN side = 'G' THEN amount END AS gateway_amount",
        "CASE WHEN side = 'G' THEN _entry_amount ELSE amount END AS ledger_amount",
        "fee", "day AS txn_date", "tier", "side", "lane",
    )


def _settle_ordinary(rows: DataFrame) -> DataFrame:
    seq = "ROW_NUMBER() OVER (PARTITION BY lane, side, ref, amount_text ORDER BY id ASC NULLS LAST)"
    state = _mark_duplicates(by_key(rows, "lane"), seq)
    for tier, keys, order in _TIERS:
        state = _take_ordinary(state, tier, keys, order)
    return _join_pairs(state)


def _settle_hot(rows: DataFrame) -> DataFrame:
    gateway = rows.where("side = 'G'").selectExpr("*", "CAST(1 AS BIGINT) AS _seq")
    ledger = ranked_sliced(rows.where("side = 'L'"), ["ref", "amount_text"], _in_order(["id"]), "_seq")
    state = _mark_duplicates(gateway.unionByName(ledger), "_seq")
    for tier, keys, order in _TIERS:
        state = materialize(_take_hot(state, tier, keys, order), f"tier{tier}")
    # open rows stay out of the pairing window: they would form one large group
    alone = state.where(f"tier IS NULL OR tier = {_DUPLICATE}").selectExpr(
        "*", "CAST(NULL AS STRING) AS _entry_id", "CAST(NULL AS DECIMAL(14,2)) AS _entry_amount"
    )
    return _join_pairs(state.where(f"tier > {_DUPLICATE}")).unionByName(_as_state(alone))


# --------------------------------------------------------------------- tier 4

def _settle_by_money(open_rows: DataFrame) -> DataFrame:
    """Tier 4 and the residuals: rank within (amount, day), then compare refs.

    Only rows with the same number meet; a look-alike at another number stays
    unmatched, which keeps the pairing one to one without comparing all pairs.
    """
    rows = open_rows.selectExpr(
        "side", "COALESCE(txn_id, entry_id) AS id", "ref",
        "COALESCE(gateway_amount, ledger_amount) AS amount", "txn_date AS day",
    )
    comparable = "amount IS NOT NULL AND day IS NOT NULL"
    numbered = ranked(rows.where(comparable), ["side", "amount", "day"], _in_order(["id"]), "_n")
    met = numbered.groupBy("amount", "day", "_n").agg(
        F.expr("MAX(CASE WHEN side = 'G' THEN STRUCT(id, ref) END) AS g"),
        F.expr("MAX(CASE WHEN side = 'L' THEN STRUCT(id, ref) END) AS l"),
    )

    def row(txn: str, entry: str, ref: str, left: str, right: str, label: str) -> str:
        return (
            f"NAMED_STRUCT('txn_id', {txn}, 'entry_id', {entry}, 'ref', {ref}, 'gateway_amount', {left}, "
            f"'ledger_amount', {right}, 'txn_date', day, 'match_type', '{label}')"
        )

    no_id, no_money = "CAST(NULL AS STRING)", "CAST(NULL AS DECIMAL(14,2))"
    paired = row("g.id", "l.id", "g.ref", "amount", "amount", "possible_ref_issue")
    lone_gateway = row("g.id", no_id, "g.ref", "amount", no_money, "missing_in_ledger")
    lone_ledger = row(no_id, "l.id", "l.ref", no_money, "amount", "missing_in_gateway")
    settled = met.selectExpr(f"""INLINE(CASE
        WHEN g IS NULL THEN ARRAY({lone_ledger})
        WHEN l IS NULL THEN ARRAY({lone_gateway})
        WHEN {text.refs_look_related('g.ref', 'l.ref')} THEN ARRAY({paired})
        ELSE ARRAY({lone_gateway}, {lone_ledger}) END)""")
    incomparable = rows.where(f"NOT ({comparable})").selectExpr(
        "CASE WHEN side = 'G' THEN id END AS txn_id",
        "CASE WHEN side = 'L' THEN id END AS entry_id",
        "ref",
        "CASE WHEN side = 'G' THEN amount END AS gateway_amount",
        "CASE WHEN side = 'L' THEN amount END AS ledger_amount",
        "day AS txn_date",
        "CASE WHEN side = 'G' THEN 'missing_in_ledger' ELSE 'missing_in_gateway' END AS match_type",
    )
    return settled.unionByName(incomparable)


# -------------------------------------------------------------------- results

_LABEL = f"""CASE
    WHEN tier = {_DUPLICATE} THEN 'duplicate_posting'
    WHEN tier = 1 THEN 'exact'
    WHEN tier = 2 THEN 'date_boundary'
    WHEN ABS(gateway_amount - ledger_amount - fee) < {FEE_TOLERANCE} THEN 'fee_timing'
    WHEN ABS(gateway_amount - ledger_amount) <= {ROUNDING_TOLERANCE} THEN 'rounding'
    ELSE 'amount_other'
END"""

_CONFIDENCE = "CASE match_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in CONFIDENCE.items()) + " END"


def stored_sides(raw_gateway: DataFrame, raw_ledger: DataFrame) -> DataFrame:
    """Both sides, typed and written once.

    The check for hot lanes and the daily totals then read a few narrow columns
    instead of parsing all text again.
    """
    return materialize(both_sides(raw_gateway, raw_ledger), "recon-sides")


def reconcile(raw_gateway: DataFrame, raw_ledger: DataFrame) -> DataFrame:
    """Every transaction and every entry in exactly one result row."""
    return reconcile_sides(stored_sides(raw_gateway, raw_ledger))


def tier_state(sides: DataFrame) -> DataFrame:
    """The rows after tiers 1-3, written once: settled pairs and duplicates with their tier, the rest open (NULL)."""
    ordinary, hot = split_hot(sides, ["lane"])
    state = _settle_ordinary(ordinary)
    if hot is not None:
        state = state.unionByName(_settle_hot(hot))
    return materialize(state, "recon-state")


_RESULT = ("txn_id", "entry_id", "ref", "gateway_amount", "ledger_amount", "txn_date")


def _as_results(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        "txn_id", "entry_id", "ref", "gateway_amount", "ledger_amount",
        "COALESCE(gateway_amount, 0) - COALESCE(ledger_amount, 0) AS amount_diff",
        "txn_date", "match_type",
        f"CAST({_CONFIDENCE} AS DECIMAL(3,2)) AS match_confidence",
    )


def settled_results(state: DataFrame) -> DataFrame:
    """Results of what tiers 1-3 settled."""
    return _as_results(state.where("tier IS NOT NULL").selectExpr(*_RESULT, f"{_LABEL} AS match_type"))


def money_results(open_rows: DataFrame) -> DataFrame:
    """Results of whole (amount, day) groups of open rows: tier 4 and what remains."""
    return _as_results(_settle_by_money(open_rows))


def reconcile_sides(sides: DataFrame) -> DataFrame:
    state = tier_state(sides)
    return settled_results(state).unionByName(money_results(state.where("tier IS NULL")))


def follow_ups(results: DataFrame) -> DataFrame:
    """The rows a person has to look at."""
    return results.where(text.one_of("match_type", FOLLOW_UP_TYPES))


def invariant_violations(results: DataFrame) -> DataFrame:
    """Guarantees of a result as (rule, violations); all counts should be zero.

    ``assigned_twice``: ids in more than one row.  ``matchable_left``: pairs with
    one reference that are still open on both sides, counted as a product per
    reference instead of being listed.
    """
    def repeated(id_column: str) -> DataFrame:
        return (
            results.where(f"{id_column} IS NOT NULL").groupBy(id_column).count().where("count > 1")
            .agg(F.expr("COUNT(*) AS violations"))
        )

    twice = repeated("txn_id").unionByName(repeated("entry_id")).agg(F.expr("SUM(violations) AS violations"))
    left = (
        results.where("ref IS NOT NULL AND match_type IN ('missing_in_ledger', 'missing_in_gateway')")
        .groupBy("ref").agg(
            F.expr("COUNT_IF(match_type = 'missing_in_ledger') AS g"),
            F.expr("COUNT_IF(match_type = 'missing_in_gateway') AS l"),
        )
        .agg(F.expr("COALESCE(SUM(CAST(g AS DECIMAL(19,0)) * l), 0) AS violations"))
    )
    return twice.selectExpr("'assigned_twice' AS rule", "violations").unionByName(
        left.selectExpr("'matchable_left' AS rule", "CAST(violations AS BIGINT) AS violations")
    )


def check_invariants(results: DataFrame) -> DataFrame:
    """Raise when a guarantee is broken, else hand the results back."""
    broken = invariant_violations(results).where("violations > 0").collect()  # two rows at most
    if broken:
        raise ReconciliationError("; ".join(f"{r.rule}: {r.violations}" for r in broken))
    return results


# ------------------------------------------------------------ summary, alerts

_SUMMARY_BUCKETS = (
    "fee_timing", "rounding", "amount_other", "possible_ref_issue",
    "missing_in_ledger", "missing_in_gateway", "duplicate_posting",
)


def gateway_daily(gateway: DataFrame) -> DataFrame:
    return gateway.groupBy("txn_date").agg(
        F.expr("COUNT(*) AS gateway_count"), F.expr("SUM(amount) AS gateway_amount")
    )


def ledger_daily(ledger: DataFrame) -> DataFrame:
    return ledger.withColumnRenamed("entry_date", "txn_date").groupBy("txn_date").agg(
        F.expr("COUNT(*) AS ledger_count"), F.expr("SUM(amount) AS ledger_amount")
    )


def bucket_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("txn_date").agg(
        F.expr("COUNT_IF(match_type IN ('exact', 'date_boundary')) AS matched"),
        *[F.expr(f"COUNT_IF(match_type = '{name}') AS {name}") for name in _SUMMARY_BUCKETS],
    )


def daily_summary(gateway: DataFrame, ledger: DataFrame, results: DataFrame) -> DataFrame:
    """One row per gateway day; days only the ledger knows do not appear."""
    joined = (
        gateway_daily(gateway)
        .join(ledger_daily(ledger), "txn_date", "left")
        .join(bucket_counts(results), "txn_date", "left")
    )
    explained = "matched + fee_timing + rounding + possible_ref_issue"
    return joined.selectExpr(
        "txn_date", "gateway_count", "gateway_amount",
        "COALESCE(ledger_count, 0) AS ledger_count",
        "COALESCE(ledger_amount, 0) AS ledger_amount",
        "matched", *_SUMMARY_BUCKETS,
        f"{ratio(explained, 'gateway_count', times=100)} AS match_rate_pct",
        "gateway_amount - COALESCE(ledger_amount, 0) AS net_difference",
    )


def alerts(summary: DataFrame) -> DataFrame:
    """(txn_date, severity, rule, detail) for every threshold a day crosses."""
    def alert(condition: str, severity: str, rule: str, detail: str) -> str:
        return (
            f"CASE WHEN {condition} THEN "
            f"NAMED_STRUCT('severity', '{severity}', 'rule', '{rule}', 'detail', {detail}) END"
        )

    net = "CAST(net_difference AS DECIMAL(38,2))"
    raised = ", ".join([
        alert(f"match_rate_pct < {MATCH_RATE_FLOOR}", "CRITICAL", "match_rate",
              "CONCAT('match rate ', match_rate_pct, '% below threshold')"),
        alert(f"ABS({net}) > {NET_DIFFERENCE_CEILING}", "CRITICAL", "net_difference",
              f"CONCAT('net difference ', {net}, ' THB exceeds threshold')"),
        alert("duplicate_posting > 0", "WARNING", "duplicate_posting",
              "CONCAT(duplicate_posting, ' duplicate ledger postings')"),
    ])
    # one pass over the summary instead of a union of three filtered scans
    return summary.selectExpr("txn_date", f"INLINE(ARRAY_COMPACT(ARRAY({raised})))")
