"""What one task or one shuffle takes must not grow faster than the input."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from harborline.operators import cleaning, history, reconciliation as recon, skew
from harborline.plans import bridge, deliveries, registry
from tests.conftest import SF_SMALL


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_landed_halves_of_the_stream_are_written_by_many_tasks(spark, monkeypatch, tmp_path):
    """one file a half put all rows into one task, and the first steps of its batch with it."""
    w = registry.bridged(spark, SF_SMALL)
    spread = {name: w.landing(name).repartition(4) for name in ("orders", "order_items", "customers", "products")}
    w.landing = spread.__getitem__

    class Drained:
        def awaitTermination(self):
            pass

        def exception(self):
            return None

    monkeypatch.setattr(deliveries, "new_folder", lambda spark, label: str(tmp_path / label))
    monkeypatch.setattr(deliveries, "maintain_orders", lambda *given: Drained())
    monkeypatch.setattr(deliveries, "_made", {})
    deliveries.streamed(w)
    assert len(list(Path(tmp_path / "landed").glob("part-*.parquet"))) > 2
    assert spark.read.parquet(str(tmp_path / "landed")).count() == w.landing("orders").count()


def test_history_and_its_merge_shuffle_versions_once_by_order(spark, raw, no_broadcast):
    """the distinct and the window over an order had a shuffle each."""
    rows = raw("orders", [("O1", "C1", "2031-03-01 10:00:00+00:00", f"2031-03-0{d} 10:00:00+00:00", "paid", "1", "web") for d in (1, 2, 2)])
    whole = history.status_history(rows)
    assert shuffles(whole) == 1
    merged = history.merged_history(whole.limit(0), rows)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect())) and merged.count() == 2


def test_partners_of_hot_keys_are_repeated_by_the_rows_they_meet(spark, every_group_is_hot):
    """each partner was repeated 64 times, whatever the size of its key."""
    many = spark.range(200).selectExpr("id % 100 AS k", "id AS v").unionByName(spark.range(1000).selectExpr("7L AS k", "id + 1000 AS v"))
    hot = skew.hot_keys(many, ["k"])
    assert {r.k: r._tasks for r in hot.where("k IN (3, 7)").collect()} == {3: 1, 7: 501}
    assert hot.agg(F.sum("_tasks")).first()[0] <= many.count()
    one = spark.range(100).selectExpr("id AS k", "id * 10 AS w")
    joined = skew.join_unique(many, one, "k")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, many.join(one, "k").collect()))


def test_tasks_of_the_first_tiers_grow_with_the_rows(spark, raw):
    """F9 to F19: a fixed number of partitions let the rows that a task sorts grow with the input."""
    sides = recon.both_sides(raw("gateway_txns", [(f"P{i}", f"R{i}", "1.00", "THB", "0", "captured", "2026-03-01 10:00:00+00:00", "M", "card")
                                                  for i in range(40)]), raw("ledger_entries", []))
    spark.conf.set(skew.STORED_ROWS_CONF, "4")
    try:
        assert skew.by_key(sides, "lane").rdd.getNumPartitions() == 10
    finally:
        spark.conf.unset(skew.STORED_ROWS_CONF)
    assert skew.by_key(sides, "lane").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_a_task_of_the_first_tiers_holds_as_much_of_a_small_input_as_of_a_large_one(spark):
    """F10 to F18: tasks took 500,000 rows, so up to some million rows a task's share and memory still grew."""
    for rows in (1_200_000, 12_000_000):
        assert skew.by_key(spark.range(rows).selectExpr("id AS lane"), "lane").rdd.getNumPartitions() == rows // 100_000


def test_slices_count_only_the_groups_at_their_ends(spark):
    """offsets came from a count of every group; ranks must stay those of a plain window, nulls included."""
    rows = spark.range(3000).selectExpr("IF(id % 11 = 0, NULL, CAST(id % 5 AS STRING)) AS a", "id % 2 AS b", "id AS o")
    order = ["o ASC NULLS LAST"]
    sliced = skew.ranked_sliced(rows.repartition(3), ["a", "b"], order, "n")
    plain = rows.selectExpr("*", "CAST(ROW_NUMBER() OVER (PARTITION BY a, b ORDER BY o) AS BIGINT) AS n")
    assert sorted(map(str, sliced.collect())) == sorted(map(str, plain.collect()))


def test_checksums_read_shared_tables_once(spark):
    """Only the status history still reads the raw orders; the rest starts from tables written once."""
    df = registry.queries()["table_checksums"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("/orders.parquet") == 1
    assert plan.count("/lineitem.parquet") == 1
    assert plan.count("/events.parquet") == 0


def test_payments_from_a_written_base_are_the_same(spark):
    base = cleaning.order_base(bridge.raw_orders(spark, SF_SMALL))
    for derive in (bridge.raw_gateway_txns, bridge.raw_ledger_entries):
        plain, shared = derive(spark, SF_SMALL), derive(spark, SF_SMALL, base)
        assert plain.count() and plain.schema == shared.schema and plain.exceptAll(shared).isEmpty() and shared.exceptAll(plain).isEmpty()
