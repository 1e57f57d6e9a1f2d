"""Time the headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and print one JSON line.

Method: bronze tables are written once, silver and gold are published from them (timed as ``etl_*``), then every
query runs over the published tables, one warm-up and three timed runs, median reported. Streams run once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import COHORT_DAYS, MIN_SUPPORT  # noqa: E402
from tallyhouse.operators import changes, quality  # noqa: E402
from tallyhouse.plans import analytics, gold  # noqa: E402
from tallyhouse.plans.lake import LAYOUT, Lake, store  # noqa: E402
from tallyhouse.session import configure  # noqa: E402
from tallyhouse.sources import feed  # noqa: E402
from tallyhouse.streaming import clickstream as K  # noqa: E402
from tallyhouse.streaming import runner as R  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
WARM_UP = os.environ.get("BENCH_WARM_DIR", os.path.join(os.path.dirname(FOLDER.rstrip("/")), "sf0.001"))
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = configure(
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took: dict[str, float] = {}

    def clock(name, job):
        start = time.perf_counter()
        result = job()
        took[name] = round(time.perf_counter() - start, 3)
        return result

    # warm the JVM on the smallest data set, so that the one-off ETL timings are not class loading
    warm = f"{scratch}/warm"
    if os.path.isdir(WARM_UP):
        Lake(feed.materialise(spark, WARM_UP, warm), feed.AS_OF).publish(warm)

    bronze = clock("load_bronze", lambda: feed.materialise(spark, FOLDER, scratch))
    lake = Lake(bronze, feed.AS_OF)
    for name in LAYOUT:
        layer, table = name.split(".")
        if layer != "bronze":
            lake.__dict__[table] = clock(f"etl_{layer}_{table}", lambda: store(getattr(lake, table), scratch, name))
    sales, items, as_of = lake.sales_lines, bronze["transaction_line_items"], feed.AS_OF
    t = lake.transactions
    headline = {
        "bench_simple_agg": lambda: analytics.revenue_by_channel(t),
        "bench_date_range": lambda: analytics.revenue_by_recent_day(t, as_of),
        "bench_large_join": lambda: analytics.revenue_by_segment(t, lake.customers),
        "bench_multi_join": lambda: analytics.revenue_by_category_segment_channel(sales, lake.products, lake.customers, as_of),
        "sales_trend": lambda: analytics.sales_trend(t, as_of),
        "cohort_retention": lambda: analytics.cohort_retention(t, as_of, days=COHORT_DAYS),
        "market_basket": lambda: analytics.market_basket(sales, lake.products, MIN_SUPPORT),
        "inventory_optimization": lambda: analytics.inventory_optimization(lake.products, sales, bronze["inventory_snapshots"], as_of),
    }
    more = {
        "mix_count": lambda: t.groupBy().count(),
        "mix_valid_state_count": lambda: analytics.count_by(lake.customers.where("dq_valid_state"), "state", "n"),
        "mix_segment_avg_spend": lambda: analytics.average_spend_by_segment(lake.customer_360),
        "kpi_daily_revenue": lambda: analytics.kpi_daily_revenue(lake.daily_sales_summary, as_of),
        "kpi_segment_performance": lambda: analytics.kpi_segment_performance(lake.customer_360),
        "kpi_top_products": lambda: analytics.kpi_top_products(lake.product_performance),
        "kpi_store_by_state": lambda: analytics.kpi_store_by_state(lake.store_analytics),
        "sales_summary_day_product_store": lambda: gold.sales_by_day_product_store(sales),
        "dq_orphan_line_items": lambda: quality.orphans(items, bronze["transactions"], "transaction_id", "items"),
        "gdpr_delete": lambda: changes.delete_keys(
            {"t": (t, ["transaction_id"])}, bronze["customers"].where("NOT is_active"), "customer_id")["t"],
    }
    for name, build in {**headline, **more}.items():
        run(build())
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run(build())
            times.append(time.perf_counter() - start)
        took[name] = round(statistics.median(times), 3)

    def events():
        return feed.shape_events(R.read_events(spark, FOLDER))

    clock("stream_session_metrics", lambda: R.drain_complete(K.session_metrics(events())))
    clock("stream_product_trending", lambda: R.drain_complete(K.product_trending(events())))
    clock("stream_realtime_dashboard", lambda: R.drain_complete(K.realtime_dashboard(events())))
    clock("stream_session_metrics_append", lambda: K.session_metrics_of(R.drain_append(K.session_panes(events()))).count())
    clock("stream_product_trending_append", lambda: K.product_trending_of(R.drain_append(K.product_panes(events()))).count())
    clock("stream_realtime_dashboard_append", lambda: K.dashboard_of(R.drain_append(K.dashboard_panes(events()))).count())
    clock("stream_enriched", lambda: R.drain_append(K.enriched(events(), feed.customers(spark, FOLDER))))

    print(json.dumps({
        "metric": "headline queries over published tables, sum of medians",
        "value": round(sum(took[n] for n in headline), 3),
        "unit": "sec",
        "queries": took,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "line_items": items.count(),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
