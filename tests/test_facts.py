"""History, sales facts, attribution - and their paths for very large groups."""

from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal

import pytest

from harborline.operators import advertising, attribution, cleaning, history, reports, sales, skew
from harborline.sources import seeds


def o(order_id="O1", customer="C1", ts="2026-06-10 10:00:00+00:00", updated="2026-06-10 11:00:00+00:00",
      status="paid", amount="100.00", channel="web"):
    return (order_id, customer, ts, updated, status, amount, channel)


VERSIONS = [
    o(), o(), o(status=" Refunded", updated="2026-06-13 00:10:00+07:00"),
    o("O2", updated="2026-06-10 10:00:00+00:00", status="paid"),
    o("O2", updated="2026-06-10 10:00:00+00:00", status="shipped", amount="N/A"),
    o("O3", updated="bad"), o(None),
]


def _history_rows(df):
    return sorted(
        (r.order_id, r.status, r.valid_from.replace(tzinfo=None), r.valid_to, r.is_current)
        for r in df.selectExpr(
            "order_id", "status", "CAST(valid_from AS TIMESTAMP_NTZ) AS valid_from",
            "CAST(valid_to AS TIMESTAMP_NTZ) AS valid_to", "is_current",
        ).collect()
    )


HISTORY = sorted([
    ("O1", "paid", datetime(2026, 6, 10, 11), datetime(2026, 6, 12, 17, 10), False),
    ("O1", "refunded", datetime(2026, 6, 12, 17, 10), None, True),
    ("O2", "paid", datetime(2026, 6, 10, 10), datetime(2026, 6, 10, 10), False),
    ("O2", "shipped", datetime(2026, 6, 10, 10), None, True),
])


def test_status_history(spark, raw):
    assert _history_rows(history.status_history(raw("orders", VERSIONS))) == HISTORY


def test_status_history_of_large_orders(spark, raw, every_group_is_hot):
    assert _history_rows(history.status_history(raw("orders", VERSIONS))) == HISTORY


def test_days_to_refund_counts_midnights(spark, raw):
    rows = history.days_to_refund(history.status_history(raw("orders", VERSIONS))).collect()
    assert [(r.days_to_refund, r.orders) for r in rows] == [(2, 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_ranked_equals_the_window_on_both_paths(spark, every_group_is_hot, seed):
    pick = random.Random(seed)
    rows = [(pick.choice(["a", "b", None]), pick.choice([1, 2, None]), i) for i in range(400)]
    pick.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v int, id int")
    order = ["v DESC NULLS LAST", "id ASC NULLS LAST"]
    expected = df.selectExpr("*", "ROW_NUMBER() OVER (PARTITION BY k ORDER BY v DESC NULLS LAST, id) AS n")
    actual = skew.ranked(df, ["k"], order, "n")
    assert sorted(map(tuple, actual.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_hot_keys_finds_nothing_in_ordinary_data(spark):
    assert skew.hot_keys(spark.range(1000), ["id"]) is None


def _sales(spark, raw):
    orders = raw("orders", [
        o("A"), o("B", status="refunded", ts="2026-06-10 18:00:00+00:00"), o("C", status="pending"),
        o("D", channel=" Shopee "), o("E", customer="CX"),
    ])
    items = raw("order_items", [
        ("A", "P1", "2", "10.00"), ("A", "P2", "1", "5.00"), ("A", "P1", "2", "10.00"), ("B", "P1", "1", "7.00"),
        ("B", "P2", "1", "3.00"), ("C", "P1", "1", "9.00"), ("D", "P1", "3", "1.00"), ("D", "P9", "1", "99.00"),
        ("Z", "P1", "1", "1.00"),
    ])
    products = cleaning.clean_products(raw("products", [("P1", "x", "toys", "1"), ("P2", "y", "food", "1")]))
    clean = cleaning.clean_orders(cleaning.order_base(orders))
    return clean, items, products


def _check_sales(spark, raw):
    clean, items, products = _sales(spark, raw)
    dated = cleaning.with_business_date(clean)
    lines = sales.order_lines(dated, items, products)
    facts = {(str(r.business_date), r.channel, r.category): (r.gross_amount, r.refund_amount, r.net_amount)
             for r in sales.daily_sales(lines).collect()}
    d = Decimal
    assert facts == {
        ("2026-06-10", "web", "toys"): (d("20.00"), d("0"), d("20.00")),
        ("2026-06-10", "web", "food"): (d("5.00"), d("0"), d("5.00")),
        ("2026-06-11", "web", "toys"): (d("7.00"), d("7.00"), d("0")),
        ("2026-06-11", "web", "food"): (d("3.00"), d("3.00"), d("0")),
        ("2026-06-10", "shopee", "toys"): (d("3.00"), d("0"), d("3.00")),
    }
    refunds = {r.category: (r.paid_orders, r.refunded_orders, r.refund_rate_pct, r.refunded_amount)
               for r in sales.refund_analysis(lines).collect()}
    assert refunds == {"toys": (3, 1, d("33.33"), d("7.00")), "food": (2, 1, d("50.00"), d("3.00"))}


def test_sales_facts(spark, raw):
    _check_sales(spark, raw)


def test_sales_facts_with_large_orders(spark, raw, every_group_is_hot):
    _check_sales(spark, raw)


def test_lines_are_shuffled_once_for_distinct_and_join(spark, raw):
    clean, items, products = _sales(spark, raw)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = sales.order_lines(cleaning.with_business_date(clean), items, products)
        plan = lines.select("order_id")._jdf.queryExecution().executedPlan().toString()
        # orders by order_id, lines by order_id, then both sides of the product join
        assert plan.count("Exchange hashpartitioning(order_id") == 2, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_enriched_orders_keep_orphans_and_empty_orders(spark, raw):
    clean, items, _ = _sales(spark, raw)
    customers = cleaning.clean_customers(raw("customers", [("C1", "a@b.co", "2025-01-01", "North")]))
    rows = {r.order_id: r for r in sales.enriched_orders(clean, customers, cleaning.clean_items(items)).collect()}
    assert len(rows) == 5
    assert rows["E"].customer_id == "unknown" and rows["E"].source_customer_id == "CX" and rows["E"].region is None
    assert (rows["E"].n_lines, rows["E"].items_amount) == (0, Decimal("0"))
    assert (rows["A"].n_lines, rows["A"].items_amount, rows["A"].region) == (2, Decimal("25.00"), "North")
    assert rows["B"].business_date == date(2026, 6, 11)
    dim = {r.customer_id: r.email_is_valid for r in sales.customer_dimension(customers).collect()}
    assert dim == {"C1": True, "unknown": False}


def test_daily_orders_at_order_grain(spark, raw):
    clean, _, _ = _sales(spark, raw)
    rows = {(str(r.business_date), r.channel): (r.net_orders, r.refunded_orders, r.net_amount)
            for r in sales.daily_orders(cleaning.with_business_date(clean)).collect()}
    assert rows == {
        ("2026-06-10", "web"): (2, 0, Decimal("200.00")), ("2026-06-11", "web"): (0, 1, Decimal("0")),
        ("2026-06-10", "shopee"): (1, 0, Decimal("100.00")),
    }


def test_weekday_compare_and_top_categories(spark):
    facts = spark.sql("""SELECT DATE(d) AS business_date, c AS channel, g AS category, CAST(n AS DECIMAL(10,2)) AS net_amount,
        CAST(r AS DECIMAL(10,2)) AS refund_amount, CAST(n + r AS DECIMAL(10,2)) AS gross_amount FROM VALUES
        ('2026-06-30', 'web', 'toys', 110, 0), ('2026-06-23', 'web', 'toys', 100, 25), ('2026-06-29', 'web', 'food', 7, 0),
        ('2026-06-30', 'app', 'food', 5, 0) t(d, c, g, n, r)""")
    rows = {r.channel: (r.yesterday, r.same_day_last_week, r.pct_change) for r in reports.weekday_compare(facts).collect()}
    d = Decimal
    assert rows == {"web": (d("110"), d("100"), d("10.0")), "app": (d("5"), None, None)}
    top = reports.top_categories(facts, 1).collect()
    assert [(r.category, r.net_revenue, r.refund_pct_of_gross) for r in top] == [("toys", d("210"), d("10.64"))]


def _attribution(spark, raw):
    touches = advertising.clean_touches(raw("utm_touches", [
        ("A", "fb", "Mega Sale 6.6"), ("B", "google", "mega_sale_6.6_TH"), ("D", None, None), ("E", "tt", "แคมเปญ"),
        ("Z", "fb", "Mega Sale 6.6"), ("C", "fb", "Mega Sale 6.6"),
    ]), seeds.utm_sources(spark))
    clean, _, _ = _sales(spark, raw)
    return touches, cleaning.with_business_date(clean)


def _check_attribution(spark, raw):
    touches, dated = _attribution(spark, raw)
    rows = {r.order_id: (r.platform, r.campaign_canonical, r.revenue_thb)
            for r in attribution.attributed_revenue(touches, dated, seeds.campaigns(spark)).collect()}
    d = Decimal("100.00")
    # B is refunded, C pending, Z unknown: none of them earns
    assert rows == {
        "A": ("facebook", "mega-sale-66", d), "D": ("organic", "organic", d), "E": ("tiktok", "", d),
    }


def test_attribution(spark, raw):
    _check_attribution(spark, raw)


def test_attribution_with_hot_orders(spark, raw, every_group_is_hot):
    _check_attribution(spark, raw)


def test_a_probe_only_chooses_the_path(spark, raw, every_group_is_hot):
    touches, dated = _attribution(spark, raw)
    hot_everywhere = touches.unionByName(touches).unionByName(touches)
    nowhere = touches.where("order_id = 'none'")
    expected = sorted(attribution.attributed_revenue(touches, dated, seeds.campaigns(spark)).collect())
    for probe in (hot_everywhere, nowhere):
        rows = attribution.attributed_revenue(touches, dated, seeds.campaigns(spark), probe).collect()
        assert sorted(rows) == expected and len(rows) == 3


def test_channel_performance_full_join_and_guards(spark):
    ads = spark.sql("""SELECT DATE(d) AS report_date, p AS platform, n AS campaign_name, CAST(s AS DECIMAL(14,2)) AS spend_thb,
        CAST(i AS BIGINT) AS impressions, CAST(c AS BIGINT) AS clicks, CAST(v AS BIGINT) AS conversions FROM VALUES
        ('2026-06-10', 'facebook', 'Mega Sale 6.6', 50, 0, 0, NULL),
        ('2026-06-10', 'google', 'mega_sale_6.6_TH', 30, 100, 3, 2),
        ('2026-06-10', CAST(NULL AS STRING), 'x', 1, 1, 1, 1) t(d, p, n, s, i, c, v)""")
    revenue = spark.sql("""SELECT DATE(d) AS business_date, p AS platform, c AS campaign_canonical, o AS order_id,
        CAST(r AS DECIMAL(14,2)) AS revenue_thb FROM VALUES
        ('2026-06-10', 'facebook', 'mega-sale-66', 'A', 100), ('2026-06-11', 'organic', 'organic', 'D', 70),
        ('2026-06-10', CAST(NULL AS STRING), CAST(NULL AS STRING), 'E', 5) t(d, p, c, o, r)""")
    rows = attribution.channel_performance(ads, revenue).collect()
    assert len(rows) == 5, "NULL platforms never match each other"
    by_key = {(str(r.activity_date), r.platform): r for r in rows if r.platform}
    fb = by_key[("2026-06-10", "facebook")]
    assert (fb.roas, fb.cpc_thb, fb.ctr_pct, fb.platform_conversions) == (Decimal("2.00"), None, None, 0)
    google = by_key[("2026-06-10", "google")]
    assert (google.roas, google.cpc_thb, google.cpa_thb, google.ctr_pct) == (
        None, Decimal("10.00"), None, Decimal("3.00"))
    assert by_key[("2026-06-11", "organic")].spend_thb == 0
    campaigns = {r.canonical: (r.n_platforms, r.spend_thb, r.attributed_orders, r.roas)
                 for r in attribution.campaign_performance(ads, revenue, seeds.campaigns(spark)).collect()}
    assert campaigns == {
        "mega-sale-66": (2, Decimal("80.00"), 1, Decimal("1.25")), "organic": (0, Decimal("0"), 1, None),
    }
    blended = reports.blended_roas(attribution.channel_performance(ads, revenue)).first()
    assert (blended.spend_thb, blended.blended_roas) == (Decimal("80.00"), Decimal("1.25"))


def test_missing_deliveries(spark):
    ads = spark.sql("""SELECT DATE(d) AS report_date, p AS platform FROM VALUES ('2026-06-10', 'facebook'),
        ('2026-06-10', 'google'), ('2026-06-11', 'facebook'), ('2026-06-11', 'google'), ('2026-06-11', 'tiktok') t(d, p)""")
    assert [tuple(r) for r in advertising.missing_deliveries(ads).collect()] == [(date(2026, 6, 10), "tiktok")]
