"""Incremental restatement, history, reconciliation and stream against a build from scratch."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date

import pytest

from harborline.operators import cleaning, history, quality, reconciliation, sales
from harborline.plans import increments, jobs
from harborline.plans.warehouse import Warehouse
from harborline.schemas import LINEAGE, RAW_COLUMNS, text_schema
from harborline.sources.landing import Lake
from harborline.sources.published import Published
from harborline.streaming.orders import apply_batch, maintain_orders

ORDER_SCHEMA = text_schema([*RAW_COLUMNS["orders"], "_source_file"]).add("_ingested_at", "timestamp")
ORDER_TABLES = (
    "order_base", "stg_orders", "rejected_orders", "stg_order_items", "orders_enriched", "order_lines", "daily_orders", "daily_sales",
    "daily_refunds", "refund_analysis", "order_status_history")


def bag(df):
    columns = sorted(df.columns)
    return Counter(tuple(repr(r[c]) for c in columns) for r in df.collect())


def order_versions(seed, orders=40):
    """Versions with resends, refunds, other days, bad amounts and dates, missing ids, and exact copies."""
    rng = random.Random(seed)
    rows = []
    for k in range(orders):
        day = rng.randrange(1, 6)
        for v in range(rng.choice([1, 1, 2, 3, 5])):
            at = f"2031-03-{day if rng.random() < 0.8 else rng.randrange(1, 9):02} {rng.randrange(24):02}:15:00+00:00"
            changed = f"2031-03-{min(28, day + v + rng.randrange(3)):02} {rng.randrange(24):02}:30:00+00:00"
            rows.append((
                None if rng.random() < 0.04 else f"O{k}", f"C{rng.randrange(6)}", rng.choice([at] * 9 + ["soon", None]),
                rng.choice([changed] * 12 + [None]), rng.choice([" Paid", "shipped", "refunded", "cancelled", "delivered"]),
                rng.choice(["10.50", "20.00", "-3", "N/A", None] if rng.random() < 0.2 else ["10.50", "7.25"]),
                rng.choice(["web", "Shopee "]), f"orders_2031-03-{min(28, day + v):02}.csv", None))
    rows += rng.sample(rows, 5)
    rng.shuffle(rows)
    return rows


def order_lines(seed, orders=44):
    rng = random.Random(seed)
    rows = [(f"O{rng.randrange(orders)}", f"P{rng.randrange(7)}", rng.choice(["1", "2", "0", "2.5", "x"]), rng.choice(["3.10", "4", "-1"]))
            for _ in range(150)]
    return rows + rng.sample(rows, 10)


@pytest.fixture
def dimensions(spark):
    return increments.Dimensions(
        cleaning.clean_customers(spark.createDataFrame([(f"C{i}", "a@b.co", "2030-01-01", "North") for i in range(5)],
                                                       text_schema(RAW_COLUMNS["customers"]))),
        cleaning.clean_products(spark.createDataFrame([(f"P{i}", "n", f"cat{i % 3}", "1") for i in range(6)],
                                                      text_schema(RAW_COLUMNS["products"]))))


def full(spark, orders, items, dimensions):
    """The same tables by the plain operators, without increments or stored parts."""
    landing = {"orders": orders, "order_items": items}
    w = Warehouse(landing.__getitem__, None, None)
    w.__dict__.update(stg_customers=dimensions.customers, stg_products=dimensions.products)
    made = {name: getattr(w, name) for name in ORDER_TABLES if name not in ("order_base", "daily_refunds")}
    made["order_base"] = cleaning.with_business_date(w.order_base)
    made["daily_refunds"] = sales.daily_refunds(w.order_lines)
    return {name: bag(df) for name, df in made.items()}


@pytest.mark.parametrize("seed", [1])
def test_restating_is_building_from_scratch(spark, tmp_path, dimensions, seed):
    """A load that brings rows and takes others back, then one that changes nothing."""
    orders, lines = order_versions(seed), order_lines(seed)
    frame = lambda rows: spark.createDataFrame(rows, ORDER_SCHEMA)
    line_frame = lambda rows: spark.createDataFrame(rows, text_schema(RAW_COLUMNS["order_items"]))
    store = Published(spark, str(tmp_path / "t"))
    build = store.begin()
    increments.build_orders(build, frame(orders[:40]), line_frame(lines[:60]), dimensions)
    increments.build_history(build, frame(orders[:40]))
    build.publish()

    back = [*orders[40:], *((*r[:4], "refunded", *r[5:]) for r in orders[::12])]
    taken, now = orders[:40:6], [r for i, r in enumerate(orders) if i >= 40 or i % 6] + back[len(orders[40:]):]
    gone_lines, now_lines = lines[:60:7], [r for i, r in enumerate(lines) if i >= 60 or i % 7]
    build = store.begin()
    change = increments.Change(frame(back), frame(taken), frame(now))
    days = increments.restate_orders(
        build, change, increments.Change(line_frame(lines[60:]), line_frame(gone_lines), line_frame(now_lines)), dimensions)
    increments.restate_history(build, change)
    build.publish()
    assert days
    got = {n: bag(store.snapshot().table(n)) for n in ORDER_TABLES}
    assert got == full(spark, frame(now), line_frame(now_lines), dimensions)

    build = store.begin()
    nothing = increments.Change(frame([]))
    assert increments.restate_orders(build, nothing, increments.Change(line_frame([])), dimensions) == set()
    assert increments.restate_history(build, nothing) == set()
    for name in ("order_base", "order_lines", "daily_sales", "order_status_history"):
        assert build.tables[name].parts == store.snapshot().tables[name].parts


def test_a_late_refund_touches_the_day_of_its_order_only(spark, tmp_path, dimensions):
    day = lambda n: f"2031-03-{n:02} 05:00:00+00:00"
    orders = [(f"O{n}", "C1", day(n), day(n), "paid", "5.00", "web", "f", None) for n in range(1, 21)]
    lines = [(f"O{n}", "P1", "1", "5.00") for n in range(1, 21)]
    store = Published(spark, str(tmp_path / "t"))
    build = store.begin()
    increments.build_orders(build, spark.createDataFrame(orders, ORDER_SCHEMA),
                            spark.createDataFrame(lines, text_schema(RAW_COLUMNS["order_items"])), dimensions)
    before = build.publish()
    refund = [("O7", "C1", day(7), day(25), "refunded", "5.00", "web", "g", None)]
    build = store.begin()
    none = increments.Change(spark.createDataFrame([], text_schema(RAW_COLUMNS["order_items"])))
    assert increments.restate_orders(build, increments.Change(spark.createDataFrame(refund, ORDER_SCHEMA)), none, dimensions) == {"2031-03-07"}
    after = build.publish()
    for name in ("order_base", "stg_orders", "order_lines", "daily_sales", "daily_orders"):
        old, new = before.tables[name].parts, after.tables[name].parts
        assert {p for p in new if new[p] != old[p]} == {"2031-03-07"}, name
    moved = after.table("daily_sales").where("refund_amount > 0").collect()
    assert [(r.business_date, float(r.refund_amount), float(r.net_amount)) for r in moved] == [(date(2031, 3, 7), 5.0, 0.0)]


def test_merged_intervals(spark):
    """A late version splits an interval, a newer one reopens the last, a known one changes nothing."""
    def raw(*rows):
        return spark.createDataFrame([(o, None, None, f"2031-03-{d:02} 00:00:00+00:00", s, None, None) for o, d, s in rows],
                                     text_schema(RAW_COLUMNS["orders"]))

    first, more = [("A", 2, "paid"), ("A", 8, "shipped"), ("B", 3, "paid")], [("A", 5, "pending"), ("A", 8, "shipped"), ("B", 9, "refunded")]
    merged = history.merged_history(history.status_history(raw(*first)), raw(*more))
    assert bag(merged) == bag(history.status_history(raw(*first, *more)))
    a = [(r.status, r.valid_from.day, r.valid_to and r.valid_to.day, r.is_current) for r in merged.where("order_id = 'A'").orderBy("valid_from").collect()]
    assert a == [("paid", 2, 5, False), ("pending", 5, 8, False), ("shipped", 8, None, True)]


def payments(seed, n=60):
    rng = random.Random(seed)
    stamp = lambda d: f"2031-03-{d:02} 10:00:00+00:00"
    gateway, ledger = [], []
    for k in range(n):
        ref, amount, day = rng.choice([f"GW-{rng.randrange(25)}", f"GW-{rng.randrange(25)}", None]), rng.choice(["5.00", "7.50", "x"]), rng.randrange(1, 4)
        gateway.append((f"T{k}", ref, amount, "THB", "0.20", "captured", stamp(day), "M", "card"))
        if rng.random() < 0.8:
            ref = rng.choice([ref, ref, f"GW-{rng.randrange(25)}0", None])
            ledger.append((f"L{k}", ref, rng.choice([amount, amount, "4.80", "7.51"]), "THB", stamp(rng.choice([day, day, 5])), "1102", "debit"))
            if rng.random() < 0.2:
                ledger.append((f"D{k}", *ledger[-1][1:]))
    rng.shuffle(gateway)
    rng.shuffle(ledger)
    return gateway, ledger


@pytest.mark.parametrize("seed", [1])
def test_rematching_is_reconciling_from_scratch(spark, tmp_path, seed):
    gateway, ledger = payments(seed)
    g = lambda rows: spark.createDataFrame(rows, text_schema(RAW_COLUMNS["gateway_txns"]))
    e = lambda rows: spark.createDataFrame(rows, text_schema(RAW_COLUMNS["ledger_entries"]))
    store = Published(spark, str(tmp_path / "t"))
    build = store.begin()
    increments.build_recon(build, g(gateway[:40]), e(ledger[:20]), buckets=4)
    build.publish()
    build = store.begin()
    assert increments.restate_recon(build, increments.Change(g(gateway[40:])), increments.Change(e(ledger[20:])), buckets=4) > 0
    build.publish()
    assert bag(increments.recon_results(store.snapshot())) == bag(reconciliation.reconcile(g(gateway), e(ledger)))
    # files sent again: some rows of both sides are gone, some new
    now_g, now_l = gateway[:-7], [*ledger[5:], ("L999", "GW-3", "5.00", "THB", "2031-03-02 10:00:00+00:00", "1102", "debit")]
    build = store.begin()
    increments.restate_recon(build, increments.Change(g([]), g(gateway[-7:]), g(now_g)), increments.Change(e(now_l[-1:]), e(ledger[:5]), e(now_l)), buckets=4)
    build.publish()
    assert bag(increments.recon_results(store.snapshot())) == bag(reconciliation.reconcile(g(now_g), e(now_l)))


@pytest.mark.parametrize("seed,cuts", [(1, (30,))])
def test_any_split_into_batches_and_a_replay_give_the_batch_result(spark, tmp_path, dimensions, seed, cuts):
    orders, lines = order_versions(seed, 25), spark.createDataFrame(order_lines(seed, 30), text_schema(RAW_COLUMNS["order_items"]))
    store = Published(spark, str(tmp_path / "t"))
    edges = [0, *cuts, len(orders)]
    for number, (lo, hi) in enumerate(zip(edges, edges[1:])):
        batch = spark.createDataFrame(orders[lo:hi], ORDER_SCHEMA)
        assert apply_batch(store, batch, number, dimensions, lines)
        assert not apply_batch(store, batch, number, dimensions, lines), "a replay changes nothing"
    got = {name: bag(store.snapshot().table(name)) for name in ORDER_TABLES}
    assert got == full(spark, spark.createDataFrame(orders, ORDER_SCHEMA), lines, dimensions)


def test_the_stream_keeps_tables_up_to_date(spark, tmp_path, dimensions):
    orders, folder = order_versions(5, 25), str(tmp_path / "landed")
    lines = spark.createDataFrame(order_lines(5, 30), text_schema(RAW_COLUMNS["order_items"]))
    store = Published(spark, str(tmp_path / "t"))
    for lo in (0, 25):
        spark.createDataFrame(orders[lo:lo + 25] if lo == 0 else orders[lo:], ORDER_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(ORDER_SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
        query = maintain_orders(stream, store, dimensions, str(tmp_path / "progress"), lines)
        query.awaitTermination(300)
        assert query.exception() is None
    got = {name: bag(store.snapshot().table(name)) for name in ORDER_TABLES}
    assert got == full(spark, spark.createDataFrame(orders, ORDER_SCHEMA), lines, dimensions)
    assert store.snapshot().properties["stream_batch"] == "1" and LINEAGE


HEADS = {name: ",".join(RAW_COLUMNS[name]) for name in ("orders", "order_items", "customers", "products")}


def test_the_job_refreshes_what_loads_touched(spark, tmp_path):
    """A late refund, a resend with a correction to rejected, a late line; then a broken rule and a changed dimension."""
    inbox, out = tmp_path / "inbox", str(tmp_path / "out")
    inbox.mkdir()

    def send(name, *rows):
        table = name.split("_2031")[0].removesuffix(".csv")
        (inbox / name).write_text("\n".join([HEADS[table], *rows, ""]))

    def stamp(d):
        return f"2031-03-{d:02} 03:00:00+00:00"

    send("customers.csv", "C1,a@b.co,2030-01-01,North")
    send("products.csv", "P1,a,toys,1", "P2,b,food,1")
    for d in (1, 2, 3):
        send(f"orders_2031-03-0{d}.csv", *(f"O{d}{n},C1,{stamp(d)},{stamp(d)},paid,9.00,web" for n in range(3)))
        send(f"order_items_2031-03-0{d}.csv", *(f"O{d}{n},P{1 + n % 2},1,9.00" for n in range(3)))
    lake = Lake(spark, str(tmp_path / "lake"))
    days = [date(2031, 3, d) for d in range(1, 6)]
    jobs.ingest_orders(lake, str(inbox), days)
    jobs.refresh_orders(lake, out)
    store = jobs.store(lake, out)
    assert store.snapshot().number == 1

    def compare():
        expected = full(spark, lake.table("orders"), lake.table("order_items"), increments.Dimensions(
            cleaning.clean_customers(lake.table("customers")), cleaning.clean_products(lake.table("products"))))
        assert {n: bag(store.snapshot().table(n)) for n in ORDER_TABLES} == expected

    send("orders_2031-03-04.csv", f"O10,C1,{stamp(1)},{stamp(4)},refunded,9.00,web", f"O40,C9,{stamp(4)},{stamp(4)},paid,4.00,web")
    send("order_items_2031-03-04.csv", "O40,P1,1,4.00", "O99,P1,1,1.00")
    jobs.ingest_orders(lake, str(inbox), days[3:4])
    before = store.snapshot()
    report = jobs.refresh_orders(lake, out)
    assert report["checks"].where("violations > 0").count() == 0
    after = store.snapshot()
    changed = {p for p, at in after.tables["daily_sales"].parts.items() if before.tables["daily_sales"].parts.get(p) != at}
    assert changed == {"2031-03-01", "2031-03-04"}

    # file of day 2 again: one order less, one with a bad amount; the order of a waiting line arrives
    send("orders_2031-03-02.csv", f"O20,C1,{stamp(2)},{stamp(2)},paid,-9.00,web", f"O21,C1,{stamp(2)},{stamp(2)},paid,9.00,web",
         f"O99,C1,{stamp(2)},{stamp(2)},paid,1.00,web")
    jobs.ingest_orders(lake, str(inbox), days[1:2])
    jobs.refresh_orders(lake, out)
    compare()
    assert [r.order_id for r in store.snapshot().table("rejected_orders").collect()] == ["O20"]

    # a status nobody knows breaks a rule: nothing is published, all old tables can be read
    number = store.snapshot().number
    send("orders_2031-03-05.csv", f"O50,C1,{stamp(5)},{stamp(5)},teleported,5.00,web")
    jobs.ingest_orders(lake, str(inbox), days[4:5])
    with pytest.raises(quality.QualityError, match="accepted_values:status: 1"):
        jobs.refresh_orders(lake, out)
    assert store.snapshot().number == number
    assert all(store.snapshot().table(name).count() >= 0 for name in jobs.ORDER_TABLES)

    send("products.csv", "P1,a,games,1", "P2,b,food,1")
    jobs.ingest_orders(lake, str(inbox), [])
    assert jobs._dimensions_changed(lake, store.begin()), "a changed product is a full build"


def test_a_refund_that_its_lines_do_not_show_stops_the_build(spark):
    lines = spark.sql("SELECT 'toys' AS category, 'refunded' AS status, CAST(5 AS DECIMAL(10,2)) AS line_amount")
    enriched = spark.sql("SELECT 'O1' AS order_id, 'C1' AS customer_id UNION ALL SELECT 'O2', 'C2'")
    customers = spark.sql("SELECT 'C1' AS customer_id")
    checks = jobs.order_gate(enriched, customers, lines, spark.sql("SELECT 'toys' AS category, CAST(4 AS DECIMAL(10,2)) AS refunded_amount"))
    assert {(r.table_name, r.check): r.violations for r in checks.collect()} == {
        ("orders_enriched", "relationships:customer_id"): 1, ("refund_analysis", "refunds_match_lines"): 1}
