"""Seconds per headline query on the star-schema test tables; prints one JSON line.

    BENCH_SF_DIR   folder of the tables     (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores              (default 8)
    BENCH_ROUNDS   timed runs per query     (default 2; the fastest counts)

The untyped landing tables are derived from the test tables and stored once, as
a load of daily files would leave them ("land"); queries start from the stored
landing tables.  Every query runs in full: all columns of all rows are computed
and handed to a sink that discards them.  The rebuild_* entries write all tables
of a job to Parquet, each table once.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harborline.plans import jobs  # noqa: E402
from harborline.plans.deliveries import YEARLY  # noqa: E402
from harborline.plans.registry import BUILDERS, bridged, present  # noqa: E402
from harborline.plans.warehouse import Warehouse  # noqa: E402
from harborline.session import build_session  # noqa: E402
from harborline.sources import seeds  # noqa: E402
from harborline.sources.published import Published  # noqa: E402

LANDING = (
    "orders", "order_items", "products", "customers", "gateway_txns", "ledger_entries",
    "ad_performance", "utm_touches", "fx_rates",
)
HEADLINE = (
    "stg_orders", "rejected_orders", "stg_order_items", "order_status_history", "orders_enriched",
    "daily_orders", "daily_sales", "refund_analysis", "weekday_compare", "top_categories",
    "days_to_refund", "regional_revenue", "headline",
    "norm_ledger", "recon_results", "recon_summary", "recon_alerts", "recon_invariants",
    "stg_ad_performance", "stg_utm_touches", "campaign_mapping", "attributed_revenue",
    "channel_performance", "campaign_performance", "dq_relationships",
)
REBUILDS = {
    "rebuild_orders": (),  # in parts by day
    "rebuild_recon": jobs.RECON_TABLES,
    "rebuild_marketing": ("stg_orders", *jobs.MARKETING_TABLES),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "2"))
    spark = build_session(
        "harborline-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="harborline-bench-")
    first, best = {}, {}

    start = time.perf_counter()
    source = bridged(spark, sf_dir)
    for name in LANDING:
        # a load of many files arrives in as many parts
        source.landing(name).repartition(int(cpus)).write.parquet(f"{folder}/raw/{name}")
    first["land"] = best["land"] = round(time.perf_counter() - start, 3)

    def landed() -> Warehouse:
        return Warehouse(
            lambda name: spark.read.parquet(f"{folder}/raw/{name}"), seeds.utm_sources(spark), seeds.campaigns(spark)
        )

    def run(name: str) -> float:
        begin = time.perf_counter()
        present(BUILDERS[name](landed())).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    for name in HEADLINE:
        times = [run(name) for _ in range(rounds)]
        first[name], best[name] = round(times[0], 3), round(min(times), 3)
    for name, tables in REBUILDS.items():
        start = time.perf_counter()
        target = Published(spark, f"{folder}/{name}", YEARLY).begin()
        jobs.build(landed(), target, tables) if tables else jobs.build_orders(landed(), target)
        target.publish()
        first[name] = best[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "landing, headline queries and rebuilds, sum of best seconds",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": best,
        "first_run": first,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
