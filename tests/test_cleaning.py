"""Casts, dedup, quarantine and the cleaning of every landing table."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest

from harborline.functions import casts, text
from harborline.functions.ratios import ratio
from harborline.operators import advertising, cleaning


def o(order_id="O1", customer="C1", ts="2026-06-10 10:00:00+00:00", updated="2026-06-10 11:00:00+00:00",
      status="paid", amount="100.00", channel="web"):
    return (order_id, customer, ts, updated, status, amount, channel)


def evaluate(spark, expression, value):
    return spark.createDataFrame([(value,)], "x string").selectExpr(f"{expression} AS y").first().y


@pytest.mark.parametrize("value, expected", [
    ("2.5", 3), ("-2.5", -3), ("2.4999999", 2), ("1e3", 1000), (" 7 ", 7), ("+5", 5), ("", None), ("1,000", None),
    ("N/A", None), (None, None), ("99999999999", None),
])
def test_whole_number(spark, value, expected):
    assert evaluate(spark, casts.whole_number("x", "INT"), value) == expected


@pytest.mark.parametrize("value, expected", [
    ("10.005", Decimal("10.01")), ("-3.10", Decimal("-3.10")), ("1000000000000", None), ("N/A", None), ("", None),
])
def test_money(spark, value, expected):
    assert evaluate(spark, casts.money("x"), value) == expected


@pytest.mark.parametrize("value, expected", [
    ("2026-06-28 17:30:00+07:00", datetime(2026, 6, 28, 10, 30)),
    ("2026-06-28", datetime(2026, 6, 28)),
    ("2026", None), ("17:30:00", None), ("2026-06-28 25:00:00", None), ("soon", None), (None, None),
])
def test_instant(spark, value, expected):
    assert evaluate(spark, f"CAST({casts.instant('x')} AS TIMESTAMP_NTZ)", value) == expected


@pytest.mark.parametrize("value, expected", [
    ("2026-06-28", date(2026, 6, 28)), (" 2026-6-8 ", date(2026, 6, 8)),
    ("2026-06-28 10:00:00", date(2026, 6, 28)), ("2026-06-28 25:00:00", None), ("2026-06-28 x", None),
])
def test_calendar_date(spark, value, expected):
    assert evaluate(spark, casts.calendar_date("x"), value) == expected


def test_reporting_date_moves_late_evening_to_the_next_day(spark):
    df = spark.createDataFrame([("2026-06-28 17:30:00+00:00",)], "x string").selectExpr(f"{casts.instant('x')} AS t")
    assert df.selectExpr(f"{casts.reporting_date('t', 'Asia/Bangkok')} AS d").first().d == date(2026, 6, 29)


@pytest.mark.parametrize("value, expected", [
    ("a@b.co", True), ("a@@gmail..com", False), ("a.gmail.com", False), ("a@", False), ("a @hotmail.com", False),
    ("a@b.co\n", False), (None, None),
])
def test_email_flag(spark, value, expected):
    assert evaluate(spark, f"x RLIKE '{text.EMAIL_PATTERN}'", value) is expected


def test_ratio_rounds_half_up_and_guards_zero(spark):
    rows = spark.sql("SELECT * FROM VALUES (201, 200), (1, 0), (-201, 200), (NULL, 3) t(a, b)")
    values = [r.q for r in rows.selectExpr(f"{ratio('a', 'b')} AS q").collect()]
    assert values == [Decimal("1.01"), None, Decimal("-1.01"), None]


def test_latest_version_wins(spark, raw):
    base = cleaning.order_base(raw("orders", [
        o(status="paid"), o(status=" Refunded ", updated="2026-06-12 09:00:00+07:00"),
        o(status="shipped", updated=None),
    ]))
    assert [r.status for r in base.collect()] == ["refunded"]


def test_one_instant_in_two_offsets_has_one_stable_survivor(spark, raw):
    rows = [
        o(ts="2026-06-10 10:00:00+00:00", updated="2026-06-10 11:00:00+00:00"),
        o(ts="2026-06-10 17:00:00+07:00", updated="2026-06-10 18:00:00+07:00"),
    ]
    for order in (rows, rows[::-1]):
        assert [r.order_ts_raw for r in cleaning.order_base(raw("orders", order)).collect()] == [
            "2026-06-10 17:00:00+07:00"
        ]


def test_later_ingest_breaks_a_tie(spark, raw):
    first = raw("orders", [o(amount="1.00")], ingested="2026-07-01 00:00:00")
    second = raw("orders", [o(amount="0.50")], ingested="2026-07-02 00:00:00")
    assert cleaning.order_base(first.unionByName(second)).first().total_amount == Decimal("0.50")


def test_rows_without_id_form_one_group(spark, raw):
    base = cleaning.order_base(raw("orders", [o(order_id=None), o(order_id=None, status="shipped"), o()]))
    rejected = cleaning.rejected_orders(base).collect()
    assert [r.reject_reason for r in rejected] == ["missing_order_id"]
    assert cleaning.clean_orders(base).count() == 1


def test_reasons_in_order_and_partition_of_the_base(spark, raw):
    base = cleaning.order_base(raw("orders", [
        o("A", ts="bad", amount="-1"), o("B", amount="N/A"), o("C", amount="-1.00"), o("D", amount="0.00"),
        o("E", amount=None), o("F", updated="2026"),
    ]))
    reasons = {r.order_id: r.reject_reason for r in cleaning.rejected_orders(base).collect()}
    assert reasons == {
        "A": "unparseable_timestamp", "B": "amount_null_or_invalid", "C": "amount_negative",
        "E": "amount_null_or_invalid", "F": "unparseable_timestamp",
    }
    assert [r.order_id for r in cleaning.clean_orders(base).collect()] == ["D"]


def test_a_bad_latest_version_rejects_the_order(spark, raw):
    base = cleaning.order_base(raw("orders", [o(), o(amount="N/A", updated="2026-06-11 00:00:00+00:00")]))
    assert cleaning.clean_orders(base).count() == 0
    assert cleaning.rejected_orders(base).first().total_amount_raw == "N/A"


def test_dedup_drops_copies_before_the_shuffle(spark, raw):
    plan = cleaning.order_base(raw("orders", [o()]))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_money_orders_window(spark, raw):
    source = raw("orders", [
        o("A", ts="2026-06-10 00:00:00+00:00"), o("B", ts="2026-06-10 23:59:59+00:00"),
        o("C", ts="2026-06-11 06:00:00+07:00"), o("D", status="pending"), o("E", amount="0.00"),
        o("F", ts="2026-06-11 00:00:00+00:00"),
    ])
    kept = cleaning.money_orders(source, "2026-06-10", "2026-06-10").collect()
    assert sorted(r.order_id for r in kept) == ["A", "B", "C"]


def test_items_distinct_and_positive(spark, raw):
    items = cleaning.clean_items(raw("order_items", [
        ("O1", "P1", "2", "10.00"), ("O1", "P1", "2", "10.0"), ("O1", "P1", "0", "10.00"), (None, "P1", "1", "1"),
        ("O1", "P2", "1", "-1"), ("O1", "P3", "x", "1"), ("O1", "P4", "1", "0"),
    ])).collect()
    assert sorted((r.product_id, r.qty) for r in items) == [("P1", 2), ("P4", 1)]


def test_customers_kept_with_flag(spark, raw):
    rows = cleaning.clean_customers(raw("customers", [
        ("C1", "a@b.co", "2025-01-01", "North"), ("C2", "bad", "x", None), (None, "a@b.co", "2025-01-01", "North"),
    ])).collect()
    assert {(r.customer_id, r.email_is_valid, r.signup_date) for r in rows} == {
        ("C1", True, date(2025, 1, 1)), ("C2", False, None),
    }


def test_ads_collapse_flag_and_convert(spark, raw):
    ad = ("2026-06-05", "google", None, None, " Sale ", "12,450.00", " thb", "10", "5", "N/A")
    usd = ("2026-06-05", "tiktok", "1", None, "Sale", "10.00", "USD", "0", "0", "3")
    other = ("2026-06-05", "tiktok", "1", None, "Gift", "10.00", None, "0", "0", None)
    no_rate = ("2026-06-06", "tiktok", "1", None, "Sale", "10.00", "USD", "0", "0", "3")
    unnamed = ("2026-06-05", "google", None, None, None, "1", "THB", "1", "1", "1")
    ads = raw("ad_performance", [ad, usd, other, no_rate, unnamed], "a.csv").unionByName(
        raw("ad_performance", [ad], "b.csv"))
    rates = cleaning.clean_fx_rates(raw("fx_rates", [("2026-06-05", "35.1234")]))
    rows = {(r.campaign_name, r.currency, str(r.report_date)): r for r in advertising.clean_ads(ads, rates).collect()}
    assert len(rows) == 4
    google = rows[("Sale", "THB", "2026-06-05")]
    assert google.spend_thb == Decimal("12450.00") and google.conversions is None and google.conversions_missing
    assert rows[("Sale", "USD", "2026-06-05")].spend_thb == Decimal("351.23")
    unknown = rows[("Gift", None, "2026-06-05")]
    assert unknown.spend_thb == Decimal("351.23") and not unknown.conversions_missing
    assert rows[("Sale", "USD", "2026-06-06")].spend_thb is None


def test_touch_sources(spark, raw):
    from harborline.sources import seeds

    touches = advertising.clean_touches(raw("utm_touches", [
        ("O1", " fb ", "X"), ("O2", None, None), ("O3", "  ", None), ("O4", "bing", "X"), ("O1", " fb ", "X"),
        (None, "fb", "X"),
    ]), seeds.utm_sources(spark))
    assert {(r.order_id, r.platform) for r in touches.collect()} == {
        ("O1", "facebook"), ("O2", "organic"), ("O3", "organic"), ("O4", None),
    }
    assert touches.count() == 4
