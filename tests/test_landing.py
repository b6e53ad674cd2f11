"""File sources: contracts, replacement, failures, late files, ad exports."""

from __future__ import annotations

import json
import re
from datetime import date
from pathlib import Path
from unittest.mock import Mock

import pytest

from harborline.operators import cleaning, quality
from harborline.plans import jobs
from harborline.schemas import RAW_COLUMNS
from harborline.sources import ad_exports, discovery, seeds, sinks
from harborline.sources.landing import Lake, RejectedFiles, SchemaMismatch, read_text_csv
from harborline.streaming.landing import land_new_files

ORDERS = "order_id,customer_id,order_ts,updated_at,status,total_amount,channel"
DAY = date(2031, 3, 8)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()
    return folder


def load(lake, inbox, table, *days):
    found = discovery.find_deliveries(lake.spark, [str(inbox)], table, discovery.DAILY_PATTERNS[table], list(days or [DAY]))
    return lake.load_daily(table, found)


def order(order_id, amount="64.10"):
    return f"{order_id},buyer-7,2031-03-08,2031-03-08,shipped,{amount},lazada"


@pytest.mark.parametrize("table", ["order_items", "gateway_txns"])
def test_a_refused_delivery_changes_nothing(lake, inbox, table):
    """Of three loaded files the middle one is sent again with every kind of wrong head."""
    columns, days = list(RAW_COLUMNS[table]), [date(2026, 3, n) for n in (2, 3, 4)]

    def send(day, head, rows):
        lines = [head, *([f"{name}-{i}" for name in head] for i in range(rows))]
        (inbox / f"{table}_{day}.csv").write_text("".join(",".join(line) + "\n" for line in lines))

    def state():
        rows = lake.table(table).select(*columns, "_source_file").collect()
        return sorted(map(tuple, rows)), sorted((r.file_name, r.load_id, r.row_count) for r in lake.load_log().collect())

    for n, day in enumerate(days, start=1):
        send(day, columns, n)
    load(lake, inbox, table, *days)
    before = state()
    assert [entry[-1] for entry in before[1]] == [1, 2, 3] and len(before[0]) == 6
    for head in (columns[1:], [*columns, "note"], columns[::-1], [c.upper() for c in columns], [*columns[:-1], "other"]):
        send(days[1], head, 5)
        with pytest.raises(SchemaMismatch):
            load(lake, inbox, table, days[1])
        assert state() == before, head


@pytest.mark.parametrize("header", [
    ORDERS.replace("order_id,customer_id", "customer_id,order_id"), ORDERS.replace("status", "STATUS"), ORDERS + ",extra",
])
def test_names_and_order_are_the_contract(lake, inbox, header):
    (inbox / "orders_2031-03-08.csv").write_text(f"{header}\n{order('O1')}\n")
    with pytest.raises(ValueError, match="schema mismatch"):
        load(lake, inbox, "orders")
    assert lake.table("orders").count() == 0


def test_rows_without_a_log_entry_stay_invisible(lake, inbox, monkeypatch):
    days = [date(2026, 3, 2), date(2026, 3, 3)]

    def send(amount):
        for n, day in enumerate(days, start=1):
            rows = [order(f"{day}/{i}", amount) for i in range(n)]
            (inbox / f"orders_{day}.csv").write_text("\n".join([ORDERS, *rows, ""]))

    def amounts():
        return sorted(r.total_amount for r in lake.table("orders").collect())

    send("7.50")
    load(lake, inbox, "orders", *days)
    send("8.25")
    with monkeypatch.context() as patch:
        patch.setattr(lake, "commit", Mock(side_effect=OSError("disk full")))
        with pytest.raises(OSError, match="disk full"):
            load(lake, inbox, "orders", *days)
    assert amounts() == ["7.50"] * 3
    load(lake, inbox, "orders", *days)
    assert amounts() == ["8.25"] * 3
    # of each file the first load and the one that was never logged
    assert lake.superseded("orders").count() == 4


def test_reload_replaces_one_file_and_leaves_others(lake, inbox):
    (inbox / "orders_2031-03-08.csv").write_text(f'{ORDERS}\n{order("A")}\n{order("B")}\n')
    (inbox / "orders_2031-03-09.csv").write_text(f"{ORDERS}\n{order('C')}\n")
    load(lake, inbox, "orders")
    load(lake, inbox, "orders", date(2031, 3, 9))
    (inbox / "orders_2031-03-08.csv").write_text(f'{ORDERS}\n{order("A", "")}\n')
    load(lake, inbox, "orders")
    rows = {r.order_id: (r.total_amount, r._source_file) for r in lake.table("orders").collect()}
    assert rows == {"A": (None, "orders_2031-03-08.csv"), "C": ("64.10", "orders_2031-03-09.csv")}
    log = {r.file_name: (r.row_count, r.file_date) for r in lake.load_log().collect()}
    assert log == {"orders_2031-03-08.csv": (1, DAY), "orders_2031-03-09.csv": (1, date(2031, 3, 9))}


def test_an_empty_file_replaces_with_nothing(lake, inbox):
    path = inbox / "orders_2031-03-08.csv"
    path.write_text(f"{ORDERS}\n{order('A')}\n")
    load(lake, inbox, "orders")
    path.write_text(f"{ORDERS}\n")
    assert load(lake, inbox, "orders") == {path.name: 0}
    assert lake.table("orders").count() == 0


def test_snapshot_is_replaced_and_must_exist(lake, inbox):
    with pytest.raises(FileNotFoundError):
        lake.load_snapshot("products", str(inbox))
    path = inbox / "products.csv"
    path.write_text('product_id,name,category,cost\nP1,"a, ""b""",toys,1.50\nP2,,food,x\n')
    assert lake.load_snapshot("products", str(inbox)) == 2
    path.write_text("product_id,name,category,cost\nP3,c,toys,2\n")
    lake.load_snapshot("products", str(inbox))
    assert [r.product_id for r in lake.table("products").collect()] == ["P3"]


def test_choosing_dates():
    some = [date(2026, 6, 2), date(2026, 6, 1)]
    assert discovery.choose_dates(every=True, available=some) == sorted(some)
    assert discovery.choose_dates(day=DAY) == [DAY]
    assert len(discovery.choose_dates(start=date(2026, 6, 1), end=date(2026, 6, 7))) == 7
    with pytest.raises(ValueError, match="reversed"):
        discovery.choose_dates(start=date(2026, 6, 7), end=date(2026, 6, 1))
    with pytest.raises(ValueError):
        discovery.choose_dates(start=DAY)


def test_available_dates_and_missing_files(spark, inbox):
    for name in ("orders_2031-03-08.csv", "orders_2031-03-10.csv", "orders_backup.csv", "order_items_2031-03-09.csv"):
        (inbox / name).write_text("x\n")
    assert discovery.available_dates(spark, str(inbox), "orders_{date}.csv") == [DAY, date(2031, 3, 10)]
    found = discovery.find_deliveries(spark, [str(inbox)], "orders", "orders_{date}.csv", [DAY, date(2031, 3, 9)])
    assert [d.path is None for d in found] == [False, True]
    assert [r.file_name for r in discovery.missing(spark, found).collect()] == ["orders_2031-03-09.csv"]


def fb_ads(*rows):
    return [dict(zip(("ad_id", "spend", "impressions", "clicks", "conversions"), row)) for row in rows]


FACEBOOK = {"account": "shop-th", "date_start": "2026-06-05", "timezone": "Asia/Bangkok", "campaigns": [
    {"campaign_id": "71", "campaign_name": "Payday Blast!", "adsets": [
        {"adset_id": "71-a", "adset_name": "lookalike, 18+", "ads": fb_ads(("a1", 0.1, 40, 3, 1), ("a2", 1200, 9000, 77, None))},
        {"adset_id": "71-b", "adset_name": "paused", "ads": []},
    ]},
    {"campaign_id": "72", "campaign_name": "Flash Friday", "adsets": [
        {"adset_id": "72-a", "adset_name": "all", "ads": fb_ads(("a3", 88.5, 610, 0, 0))},
    ]},
    {"campaign_id": "73", "campaign_name": "New Arrivals TH", "adsets": []},
]}
# Metadata with commas, and columns in another order than usual.
GOOGLE = (
    "All campaigns, one row a day\nJun 5, 2026 - Jun 5, 2026\n"
    "Day,Campaign,Clicks,Impr.,Cost,Conv.\n"
    '05/06/2026,payday_blast_search,12,3400,"1,050.75",3\n'
    "05/06/2026,flash_friday_TH,7,900,88.00,--\n"
)
TIKTOK = (
    "campaign_id,campaign_name,cost_usd,impressions,clicks,conversions,stat_date\n"
    "880,Payday Blast,410.20,52000,610,9,20260605\n881,FlashFriday,75.00,8100,95,0,20260605\n"
)


def write_ads(folder: Path, day: str = "2026-06-05") -> None:
    (folder / f"facebook_ads_{day}.json").write_text(json.dumps(FACEBOOK, indent=1))
    (folder / f"google_ads_{day}.csv").write_text(GOOGLE)
    (folder / f"tiktok_ads_{day}.csv").write_text(TIKTOK)


def test_facebook_is_flattened_to_ads(spark, inbox):
    write_ads(inbox)
    rows = {r.ad_id: r for r in ad_exports.read_facebook(spark, [str(inbox / "facebook_ads_2026-06-05.json")]).collect()}
    assert {k: (r.campaign_id, r.spend, r.impressions, r.conversions) for k, r in rows.items()} == {
        "a1": ("71", "0.1", "40", "1"), "a2": ("71", "1200", "9000", "None"), "a3": ("72", "88.5", "610", "0")}
    assert {(r.campaign_name, r.currency, r.report_date) for r in rows.values()} == {
        ("Payday Blast!", "USD", "2026-06-05"), ("Flash Friday", "USD", "2026-06-05")}


def test_google_finds_columns_by_name(spark, inbox):
    write_ads(inbox)
    # a data row may say what a line of the preamble says
    (inbox / "google_ads_2026-06-06.csv").write_text(
        '"Usual order"\n06/06/2026,a,1,2,3,4\nCampaign,Cost,Impr.,Clicks,Conv.,Day\n"quoted, ""name""",5.10,,1,2,06/06/2026\n\nbare,,,,,07/06/2026\n')
    (inbox / "google_ads_2026-06-08.csv").write_text(
        "06/06/2026,a,1,2,3,4\nx\nDay,Campaign,Clicks,Impr.,Cost,Conv.\n06/06/2026,a,1,2,3,4\n")
    rows = ad_exports.read_google(spark, [str(p) for p in sorted(inbox.glob("google*"))]).collect()
    assert sorted((r.report_date, r.campaign_name, r.spend, r.impressions, r.clicks, r.conversions) for r in rows) == sorted([
        ("2026-06-05", "payday_blast_search", "1,050.75", "3400", "12", "3"),
        ("2026-06-05", "flash_friday_TH", "88.00", "900", "7", "--"),
        ("2026-06-06", 'quoted, "name"', "5.10", None, "1", "2"),
        ("2026-06-07", "bare", None, None, None, None),
        ("2026-06-06", "a", "3", "2", "1", "4"),
    ])
    assert {(r.campaign_id, r.currency, r._bad) for r in rows} == {(None, "THB", None)}


def test_tiktok_finds_columns_by_name(spark, inbox):
    write_ads(inbox)
    (inbox / "tiktok_ads_2026-06-07.csv").write_text(
        "conversions,stat_date,clicks,campaign_name,campaign_id,impressions,cost_usd\r\n"
        '6,20260607,5,"a, b",882,4,3.5\r\n,20260608,,c,883,,\r\n'
    )
    rows = ad_exports.read_tiktok(spark, [str(p) for p in sorted(inbox.glob("tiktok*"))]).collect()
    assert sorted((r.campaign_id, r.report_date, r.campaign_name, r.spend, r.conversions) for r in rows) == [
        ("880", "2026-06-05", "Payday Blast", "410.20", "9"), ("881", "2026-06-05", "FlashFriday", "75.00", "0"),
        ("882", "2026-06-07", "a, b", "3.5", "6"), ("883", "2026-06-08", "c", None, None),
    ]
    assert {r._bad for r in rows} == {None}


GOOGLE_HEAD = "one\ntwo\nDay,Campaign,Clicks,Impr.,Cost,Conv.\n"
TIKTOK_HEAD = TIKTOK.splitlines()[0] + "\n"
BROKEN_ADS = {
    "google: a column less": ("google_ads_{}.csv", "one\ntwo\nDay,Campaign,Clicks,Impr.,Cost\n06/06/2026,x,1,2,3\n", "columns"),
    "google: a preamble line less": ("google_ads_{}.csv", "one\nDay,Campaign,Clicks,Impr.,Cost,Conv.\n06/06/2026,x,1,2,3,4\n", "columns"),
    "google: only a preamble": ("google_ads_{}.csv", "one\ntwo\n", "columns"),
    "google: short row": ("google_ads_{}.csv", GOOGLE_HEAD + "06/06/2026,x,1,2,3\n", "fields"),
    "google: long row": ("google_ads_{}.csv", GOOGLE_HEAD + "06/06/2026,x,1,2,3,4,5\n", "fields"),
    "google: open quote": ("google_ads_{}.csv", GOOGLE_HEAD + '06/06/2026,"x\n', "fields"),
    "google: no day": ("google_ads_{}.csv", GOOGLE_HEAD + ",x,1,2,3,4\n", "day"),
    "tiktok: another column": ("tiktok_ads_{}.csv", TIKTOK_HEAD.replace("clicks", "taps") + "1,a,2,3,4,5,20260606\n", "columns"),
    "tiktok: short row": ("tiktok_ads_{}.csv", TIKTOK_HEAD + "1,a,2,3,4,5,20260606\n9.9,x\n", "fields"),
    "tiktok: long row": ("tiktok_ads_{}.csv", TIKTOK_HEAD + "1,a,2,3,4,5,20260606,7\n", "fields"),
    "tiktok: junk day": ("tiktok_ads_{}.csv", TIKTOK_HEAD + "1,a,2,3,4,5,junk\n", "day"),
    "facebook: cut short": ("facebook_ads_{}.json", json.dumps(FACEBOOK)[:-40], "document"),
}


def load_ads(lake, inbox, *days, strict=True):
    found = [d for pattern in discovery.AD_PATTERNS.values()
             for d in discovery.find_deliveries(lake.spark, [str(inbox)], "ad_performance", pattern, days)]
    return lake.load_frame("ad_performance", found, ad_exports.read_deliveries, strict=strict)


@pytest.mark.parametrize("case", sorted(BROKEN_ADS))
def test_a_broken_export_is_refused_and_the_others_load(lake, inbox, case):
    """The broken file replaces a good one that was loaded: its old rows stay, and all files beside it load anew."""
    pattern, text, reason = BROKEN_ADS[case]
    day, name = date(2026, 6, 6), pattern.format("2026-06-06")
    write_ads(inbox, str(day))
    assert load_ads(lake, inbox, day).rejected == []
    before = {r._source_file: r.load_id for r in lake.load_log().withColumnRenamed("file_name", "_source_file").collect()}
    rows = sorted(map(str, lake.table("ad_performance").drop("_ingested_at").collect()))
    (inbox / name).write_text(text)
    with pytest.raises(RejectedFiles, match=name):
        load_ads(lake, inbox, day)
    after = {r.file_name: r.load_id for r in lake.load_log().collect()}
    assert after[name] == before[name]
    assert all(after[other] != before[other] for other in before if other != name) and len(before) == 3
    assert sorted(map(str, lake.table("ad_performance").drop("_ingested_at").collect())) == rows
    refused = lake.rejected_files().collect()
    assert [(r.file_name, r.reason, r.expected) for r in refused] == [(name, reason, RAW_COLUMNS["ad_performance"])]


def test_an_export_of_no_bytes_is_missing_and_refused_if_named(lake, inbox):
    day, name = date(2026, 6, 6), "tiktok_ads_2026-06-06.csv"
    write_ads(inbox, str(day))
    load_ads(lake, inbox, day)
    (inbox / name).write_text("")
    found = discovery.find_deliveries(lake.spark, [str(inbox)], "ad_performance", discovery.AD_PATTERNS["tiktok"], [day])
    assert [d.path for d in found] == [None]
    named = [discovery.Delivery("ad_performance", f"google_ads_{day}.csv", day, f"{inbox}/google_ads_{day}.csv"),
             discovery.Delivery("ad_performance", name, day, f"{inbox}/{name}")]
    with pytest.raises(RejectedFiles, match=name):
        lake.load_frame("ad_performance", named, ad_exports.read_deliveries)
    assert lake.table("ad_performance").where("platform = 'tiktok'").count() == 2


BROKEN_ROWS = {
    "short": "77,mail", "long": "78,mail,spring,extra", "line break in quotes": '79,mail,"two\nlines"', "open quote": '80,"mail,spring',
}


@pytest.mark.parametrize("case", sorted(BROKEN_ROWS))
def test_a_broken_daily_file_is_refused_and_the_others_load(lake, inbox, case):
    head, days = ",".join(RAW_COLUMNS["utm_touches"]) + "\n", [date(2031, 5, n) for n in (1, 2, 3)]
    for n, day in enumerate(days):
        (inbox / f"utm_touches_{day}.csv").write_text(head + f"{n},mail,spring\n")
    assert load(lake, inbox, "utm_touches", days[1]) == {"utm_touches_2031-05-02.csv": 1}
    (inbox / "utm_touches_2031-05-02.csv").write_text(head + f"9,mail,spring\n{BROKEN_ROWS[case]}\n")
    (inbox / "utm_touches_2031-05-03.csv").write_text("utm_source,order_id,utm_campaign\nmail,1,x\n")
    with pytest.raises(RejectedFiles) as raised:
        load(lake, inbox, "utm_touches", *days)
    assert sorted((r.order_id, r._source_file[-6:]) for r in lake.table("utm_touches").collect()) == [("0", "01.csv"), ("1", "02.csv")]
    by_name = {r.file_name: r for r in raised.value.rejected}
    assert sorted(by_name) == ["utm_touches_2031-05-02.csv", "utm_touches_2031-05-03.csv"]
    rows, names = by_name["utm_touches_2031-05-02.csv"], by_name["utm_touches_2031-05-03.csv"]
    assert rows.reason == "fields" and rows.bad_rows >= 1
    assert BROKEN_ROWS[case].split("\n")[-1 if "\n" in BROKEN_ROWS[case] else 0] == rows.first_bad_line
    assert (names.reason, names.received) == ("columns", ("utm_source", "order_id", "utm_campaign"))
    assert "expected ['order_id', 'utm_source', 'utm_campaign'], received ['utm_source'" in str(raised.value)
    stored = {r.file_name: (r.reason, r.first_bad_line, r.file_date) for r in lake.rejected_files().collect()}
    assert stored["utm_touches_2031-05-02.csv"] == ("fields", rows.first_bad_line, days[1])
    assert load(lake, inbox, "utm_touches", days[0]).rejected == []


def test_a_snapshot_has_its_columns_to_the_letter(lake, inbox):
    path = inbox / "products.csv"
    path.write_text("product_id,name,category,cost\nP1,a,toys,1.50\n")
    assert lake.load_snapshot("products", str(inbox)) == 1
    for text in ("PRODUCT_ID,name,category,cost\nP2,b,toys,1\n", "product_id,name,category,cost\nP2,b,toys\n", ""):
        path.write_text(text)
        with pytest.raises(SchemaMismatch):
            lake.load_snapshot("products", str(inbox))
        assert [r.product_id for r in lake.table("products").collect()] == ["P1"]


def test_commit_numbers_decide_not_the_clock(lake, inbox, monkeypatch):
    """Two loads of one file, the second by a clock an hour behind; then the log compacted and read as of earlier commits."""
    from datetime import datetime, timedelta, timezone

    from harborline.sources import landing

    class Behind(datetime):
        @classmethod
        def now(cls, tz=None):
            return datetime.now(tz) - timedelta(hours=1)

    path = inbox / "orders_2031-03-08.csv"
    for n, clock in enumerate((datetime, Behind, Behind), start=1):
        monkeypatch.setattr(landing, "datetime", clock)
        path.write_text(f"{ORDERS}\n{order(f'V{n}')}\n")
        load(lake, inbox, "orders")
        if n == 2:
            assert lake.compact_log() == lake.compact_log() == 2
    versions = [[r.order_id for r in lake.table("orders", as_of=n).collect()] for n in (0, 1, 2, 3, None)]
    assert versions == [[], ["V1"], ["V2"], ["V3"], ["V3"]]
    assert lake.last_commit() == 3
    arrived, withdrawn = lake.changes("orders", since=1)
    assert [r.order_id for r in arrived.collect()] == ["V3"] and [r.order_id for r in withdrawn.collect()] == ["V1"]
    assert all(df.isEmpty() for df in lake.changes("orders", since=3))
    # a read of the newest log opens the compacted file and the commits after it
    plan = lake.load_log()._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*commit_no#\d+L > 2", plan) and re.search(r"PartitionFilters: \[[^]]*upto#\d+L = 2", plan)
    assert datetime.now(timezone.utc) > max(r.loaded_at for r in lake.load_log().collect()).astimezone(timezone.utc)


def test_late_file_is_a_gap_until_backfilled(spark, lake, inbox):
    day = date(2026, 6, 5)
    write_ads(inbox)
    late = inbox / "late_arrivals"
    late.mkdir()
    # the late export waits in its own folder
    text = (inbox / "tiktok_ads_2026-06-05.csv").read_text()
    (inbox / "tiktok_ads_2026-06-05.csv").unlink()
    (late / "tiktok_ads_2026-06-05.csv").write_text(text)
    (inbox / "fx_rates.csv").write_text("date,usd_thb\n2026-06-05,35.5\n")
    (inbox / "utm_touches_2026-06-05.csv").write_text("order_id,utm_source,utm_campaign\nO1,fb,Mega Sale 6.6\n")
    for name, rows in {
        "customers.csv": "customer_id,email,signup_date,region\nC1,a@b.co,2025-01-01,North\n",
        "products.csv": "product_id,name,category,cost\nP1,a,toys,1\n",
        "orders_2026-06-05.csv": f"{ORDERS}\nO1,C1,2026-06-05 01:00:00+00:00,2026-06-05 01:00:00+00:00,paid,355.00,web\n",
        "order_items_2026-06-05.csv": "order_id,product_id,qty,unit_price\nO1,P1,1,355.00\n",
    }.items():
        (inbox / name).write_text(rows)
    absent = jobs.ingest_marketing(lake, str(inbox), [day]).collect()
    assert [r.file_name for r in absent] == ["tiktok_ads_2026-06-05.csv"]
    assert jobs.ingest_orders(lake, str(inbox), [day]).count() == 0

    report = jobs.run_marketing(lake, str(inbox.parent / "out"))
    assert [r.platform for r in report["gaps"].collect()] == ["tiktok"]
    assert report["missing_conversions"].first().rows == 2
    assert report["checks"].where("violations > 0").count() == 0

    assert jobs.ingest_marketing(lake, str(inbox), [day], include_late=True).count() == 0
    jobs.ingest_marketing(lake, str(inbox), [day], include_late=True)
    assert lake.table("ad_performance").count() == 7, "a repeated load replaces its rows"
    report = jobs.run_marketing(lake, str(inbox.parent / "out"))
    assert report["gaps"].count() == 0

    sales = jobs.run_orders(lake, str(inbox.parent / "out"))
    assert float(sales["headline"].first().net_revenue) == 355.0
    assert sales["checks"].where("violations > 0").count() == 0


def test_reconciliation_job_writes_the_follow_ups(spark, lake, inbox):
    day = date(2026, 6, 28)
    (inbox / "gateway_txns_2026-06-28.csv").write_text(
        "txn_id,gateway_ref,amount,currency,fee,status,created_at,merchant_id,payment_method\n"
        "T1,GW-A,10.00,THB,0.29,captured,2026-06-28 10:00:00+00:00,M,card\n"
        "T2,GW-B,20.00,THB,0.58,captured,2026-06-28 10:00:00+00:00,M,card\n"
    )
    (inbox / "ledger_entries_2026-06-28.csv").write_text(
        "entry_id,external_ref,amount,currency,posted_at,account_code,entry_type\n"
        "L1,GW-A,10.00,THB,2026-06-28 17:30:00+07:00,1102,debit\n"
    )
    assert jobs.ingest_payments(lake, str(inbox), [day]).count() == 0
    out = str(inbox.parent / "out")
    report = jobs.run_reconciliation(lake, out)
    assert report["follow_up_count"].first().rows == 1
    assert {a.rule for a in report["alerts"].collect()} == {"match_rate"}
    rows = spark.read.option("header", True).csv(f"{out}/reports/recon_follow_ups").collect()
    assert [(r.txn_id, r.match_type) for r in rows] == [("T2", "missing_in_ledger")]


def test_csv_is_sorted_across_parts(spark, tmp_path):
    df = spark.range(100).selectExpr("100 - id AS a", "id AS b")
    sinks.write_csv(df, str(tmp_path / "csv"), "a")
    parts = sorted((tmp_path / "csv").glob("part-*.csv"))
    values = [int(line.split(",")[0]) for p in parts for line in p.read_text().splitlines()[1:]]
    assert values == list(range(1, 101))


def test_partition_refresh_leaves_others_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.refresh_partitions(spark.sql("SELECT 1 AS v, 'a' AS p UNION ALL SELECT 2, 'b'"), path, "p")
    sinks.refresh_partitions(spark.sql("SELECT 9 AS v, 'b' AS p"), path, "p")
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]


def test_seed_from_file(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("utm_source_variant,platform\nx,facebook\n")
    assert seeds.read_seed(spark, str(path), seeds.SOURCE_SEED_COLUMNS).collect() == [("x", "facebook")]
    assert (seeds.utm_sources(spark).count(), seeds.campaigns(spark).count()) == (10, 24)


def test_stream_skips_strays_and_refuses_broken_files(lake, inbox, tmp_path):
    (inbox / "orders_2031-03-08.csv").write_text(f"{ORDERS}\n{order('A')}\n")
    (inbox / "orders_2031-03-09.csv").write_text(f"{ORDERS}\n{order('B')}\nC,only\n")
    (inbox / "orders_2031-03-10.csv").write_text(f"{ORDERS},more\n{order('D')},x\n")
    (inbox / "orders_backup.csv").write_text("anything\n")
    query = land_new_files(lake, "orders", str(inbox), str(tmp_path / "progress"))
    query.awaitTermination(120)
    assert query.exception() is None
    assert [r.order_id for r in lake.table("orders").collect()] == ["A"]
    assert sorted((r.file_name[-6:], r.reason) for r in lake.rejected_files().collect()) == [("09.csv", "fields"), ("10.csv", "columns")]


def test_only_the_wanted_days_are_listed(spark, inbox):
    for n in range(1, 29):
        (inbox / f"orders_2031-03-{n:02}.csv").write_text("x\n")
    wanted = ["orders_2031-03-05.csv", "orders_2031-03-30.csv", "orders_2031-03-07.csv"]
    found = discovery.find_files(spark, str(inbox), wanted)
    assert sorted(found) == ["orders_2031-03-05.csv", "orders_2031-03-07.csv"]
    assert discovery.find_files(spark, str(inbox), ["nothing.csv"]) == discovery.find_files(spark, str(inbox / "none"), wanted) == {}


def test_stream_lands_new_files_once(lake, inbox, tmp_path):
    def run():
        query = land_new_files(lake, "orders", str(inbox), str(tmp_path / "progress"))
        query.awaitTermination(120)

    (inbox / "orders_2031-03-08.csv").write_text(f"{ORDERS}\n{order('A')}\n")
    run()
    (inbox / "orders_2031-03-09.csv").write_text(f"{ORDERS}\n{order('B')}\n{order('C')}\n")
    run()
    run()
    assert sorted(r.order_id for r in lake.table("orders").collect()) == ["A", "B", "C"]
    assert {r.file_date: r.row_count for r in lake.load_log().collect()} == {DAY: 1, date(2031, 3, 9): 2}
    assert lake.log_entries().count() == 2


def test_money_orders_over_many_files(spark, inbox):
    newer = order("A").replace("2031-03-08,shipped", "2031-03-09,cancelled")
    for day, row in (("2031-03-08", order("A")), ("2031-03-09", newer), ("2031-03-10", order("B"))):
        (inbox / f"orders_{day}.csv").write_text(f"{ORDERS}\n{row}\n")
    raw = read_text_csv(spark, [f"{inbox}/orders_*.csv"], RAW_COLUMNS["orders"]).selectExpr(
        "*", "TIMESTAMP'2031-03-11 00:00:00' AS _ingested_at")
    kept = cleaning.money_orders(raw, "2031-03-08", "2031-03-08").collect()
    assert [r.order_id for r in kept] == ["B"], "the newest version of A was cancelled"


def test_a_strict_run_stops_on_a_broken_rule(spark):
    checks = spark.sql("SELECT 'stg_orders' AS table_name, 'unique:order_id' AS check, 0L AS violations")
    assert quality.require(checks).count() == 1
    with pytest.raises(quality.QualityError, match="unique:order_id: 2"):
        quality.require(checks.selectExpr("table_name", "check", "2L AS violations"))
