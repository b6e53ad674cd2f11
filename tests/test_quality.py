"""Every check must find planted violations, and only those."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from harborline.operators import quality


def violations(df):
    return df.first().violations


def test_column_rules_in_one_pass(spark):
    df = spark.sql("""SELECT * FROM VALUES ('A', 'paid', 'web'), ('A', 'odd', NULL), (NULL, NULL, 'fax')
        t(order_id, status, channel)""")
    rules = quality.Rules(
        not_null=("order_id", "status"), unique=("order_id",), accepted={"status": ("paid",), "channel": ("web",)})
    checks = quality.column_checks("t", df, rules)
    expected = {
        "not_null:order_id": 1, "not_null:status": 1, "accepted_values:status": 1, "accepted_values:channel": 1,
        "unique:order_id": 1,
    }
    assert {r.check: r.violations for r in checks.collect()} == expected
    assert violations(quality.unique_check("t", df, "order_id")) == 1
    two_keys = quality.column_checks("t", df, quality.Rules(unique=("order_id", "channel")))
    assert {r.check: r.violations for r in two_keys.collect()} == {"unique:order_id": 1, "unique:channel": 0}
    # a plan that has not run yet: a finished one prints its first version as well
    plan = quality.column_checks("t", df, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1, "one pass over the table"


def test_relationship_counts_rows(spark):
    df = spark.sql("SELECT * FROM VALUES ('A'), ('X'), ('X'), (NULL) t(customer_id)")
    target = spark.sql("SELECT 'A' AS id")
    assert violations(quality.relationship_check("t", df, "customer_id", target, "id")) == 2


def test_money_identities(spark):
    sales = spark.sql("""SELECT CAST(g AS DECIMAL(10,2)) AS gross_amount, CAST(r AS DECIMAL(10,2)) AS refund_amount,
        CAST(n AS DECIMAL(10,2)) AS net_amount, DATE'2026-06-10' AS business_date FROM VALUES (10, 2, 8), (5, 1, 5) t(g, r, n)""")
    assert violations(quality.net_is_gross_minus_refund(sales)) == 1
    orders = spark.sql("""SELECT id AS order_id, s AS status, CAST(t AS DECIMAL(10,2)) AS total_amount,
        DATE'2026-06-10' AS business_date FROM VALUES ('A', 'paid', 13), ('B', 'refunded', 4) v(id, s, t)""")
    items = spark.sql("""SELECT id AS order_id, q AS qty, CAST(p AS DECIMAL(10,2)) AS unit_price
        FROM VALUES ('A', 1, 6), ('A', 1, 7), ('B', 1, 3) v(id, q, p)""")
    layers = {r.layer: r.net_amount for r in quality.net_money_by_layer(sales, orders, items).collect()}
    assert layers == {"mart": Decimal("13.00"), "staging": Decimal("13.00")}
    assert violations(quality.header_differs_from_lines(orders, items)) == 1
    assert violations(quality.restated_refund_mismatch(sales, orders, items)) == 0


def test_refund_money_guard(spark):
    lines = spark.sql("""SELECT c AS category, s AS status, CAST(a AS DECIMAL(10,2)) AS line_amount
        FROM VALUES ('toys', 'refunded', 5), ('toys', 'paid', 9), ('food', 'refunded', 2) t(c, s, a)""")
    wrong = spark.sql("SELECT 'toys' AS category, CAST(14 AS DECIMAL(10,2)) AS refunded_amount")
    rows = {r.category: (r.in_lines, r.in_fact, r.off_by) for r in quality.refund_money_mismatch(lines, wrong).collect()}
    assert rows == {"toys": (5, 14, -9), "food": (2, 0, 2)}


def test_order_accounting_names_rows_without_id(spark):
    ids = spark.sql("SELECT * FROM VALUES ('A'), ('A'), ('B'), (NULL), (NULL) t(order_id)")
    one, two = spark.range(1), spark.range(2)
    row = quality.order_accounting(ids, one, two).first()
    assert (row.raw_ids, row.without_id, row.clean, row.rejected, row.violations) == (2, 1, 1, 2, 0)
    assert quality.order_accounting(ids, one, one).first().violations == -1


def test_volume_anomaly_needs_history_and_half_deviation(spark):
    log = spark.sql("""SELECT 'orders' AS table_name, DATE_ADD(DATE'2026-06-01', CAST(id AS INT)) AS file_date,
        CASE id WHEN 8 THEN 151L WHEN 9 THEN 100L ELSE 100L END AS row_count FROM RANGE(10)""")
    rows = quality.volume_anomalies(quality.daily_volume(log)).collect()
    assert [(r.file_date, r.rows, r.trailing_avg) for r in rows] == [(date(2026, 6, 9), 151, 100)]
    assert quality.freshness(log).first().latest_file_date == date(2026, 6, 10)


def test_checksum_sees_values_and_places_but_not_order(spark):
    def mark(rows):
        return quality.checksum("t", spark.createDataFrame(rows, "a string, b string, _ingested_at string")).first()

    base = mark([("x", None, "1"), ("y", "z", "1")])
    assert mark([("y", "z", "2"), ("x", None, "2")]) == base, "row order and audit columns do not count"
    assert mark([(None, "x", "1"), ("y", "z", "1")]) != base, "a value in another column counts"
    assert mark([("x", None, "1"), ("y", "z", "1"), ("y", "z", "1")]) != base


def test_recall(spark):
    expected = spark.sql("SELECT * FROM VALUES ('dup', 'A'), ('dup', 'B'), ('bad', 'A') t(case, id)")
    caught = spark.sql("SELECT * FROM VALUES ('dup', 'A'), ('dup', 'A'), ('bad', 'Z') t(case, id)")
    rows = {r.case: (r.injected, r.caught) for r in quality.recall(expected, caught).collect()}
    assert rows == {"dup": (2, 1), "bad": (1, 0)}


def test_only_ids_keeps_each_row_once(spark):
    df = spark.sql("SELECT * FROM VALUES ('A', 1), ('A', 2), ('B', 3), (NULL, 4) t(order_id, v)")
    ids = spark.sql("SELECT * FROM VALUES ('A'), ('A'), ('Z'), (NULL) t(order_id)")
    assert sorted(r.v for r in quality.only_ids(df, ids, "order_id").collect()) == [1, 2]
