"""The sales fact, its layout on disk, and the plans that profit from it."""

import re

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import analytics, gold, silver
from tallyhouse.plans.lake import Lake
from tallyhouse.sources import feed, tables

from conftest import rows


@pytest.fixture(scope="module")
def lake(spark, folder, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    return Lake(feed.materialise(spark, folder, root), feed.AS_OF).publish(root), root


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def filters(text, column):
    """Partition filters of all scans that read the column's folders."""
    return [x for x in re.findall(r"PartitionFilters: \[([^\]]*)\]", text) if column in x]


def test_line_items_are_dated_and_stored_by_month(lake):
    items = lake[0].bronze["transaction_line_items"]
    assert {"line_item_id", "transaction_date", "year_month"} <= set(items.columns)
    recent = analytics.since(items, feed.AS_OF, 30)
    assert filters(plan(recent), "year_month") and recent.count() == items.where(F.col("transaction_date") >= F.lit("2001-07-02")).count()


def test_recent_questions_read_recent_months_of_the_fact(lake):
    lake, _ = lake
    for df in (
        analytics.revenue_by_category_segment_channel(lake.sales_lines, lake.products, lake.customers, feed.AS_OF),
        analytics.inventory_optimization(lake.products, lake.sales_lines, lake.bronze["inventory_snapshots"], feed.AS_OF),
    ):
        months = filters(plan(df), "year_month")
        assert months and all(">= 2001-0" in m for m in months)


def test_newest_snapshot_is_a_partition_filter(lake):
    text = plan(gold.latest_snapshot(lake[0].bronze["inventory_snapshots"]))
    assert any("snapshot_date" in f and "ubquery" in f for f in filters(text, "snapshot_date"))


def test_transactions_meet_their_lines_without_an_exchange(lake, no_broadcast):
    lake, _ = lake
    built = silver.transactions(lake.bronze["transactions"], lake.sales_lines)
    text = plan(built)
    assert "SortMergeJoin" in text and "Exchange" not in text
    both = plan(lake.sales_lines.join(lake.transactions.select("transaction_id", "amount_bucket"), "transaction_id"))
    assert "SortMergeJoin" in both and "Exchange" not in both
    assert plan(gold.sales_by_day_product_store(lake.sales_lines)).count("Exchange") == 1
    assert plan(silver.product_metrics(lake.sales_lines)).count("Exchange") == 1
    assert "Join" not in plan(gold.product_performance_agg(lake.sales_lines))


def test_buckets_are_found_again_by_another_session(spark, lake, no_broadcast):
    built, root = lake
    path = f"{root}/silver/sales_lines"
    spark.sql(f"DROP TABLE {tables.bucketed_name(path)}")
    again = tables.load_bucketed(spark, path, "transaction_id", ["year_month"])
    assert rows(again.drop("processed_at").select(built.sales_lines.columns)) == rows(Lake(built.bronze, feed.AS_OF).sales_lines.select(built.sales_lines.columns))
    assert "Exchange" not in plan(again.groupBy("transaction_id").count())
    assert filters(plan(again.where("year_month >= '2001-07'")), "year_month")


def test_fact_keeps_null_keys_orphans_and_repeated_lines(spark):
    lines = spark.createDataFrame(
        [(1, 7, 2, "1.00"), (1, 7, 3, "1.00"), (1, None, 1, "4.00"), (None, 7, 5, "2.00"), (9, 7, 1, None)], "transaction_id bigint, product_id bigint, quantity int, p string"
    ).selectExpr("*", "CAST(p AS decimal(10,2)) AS unit_price", "CAST(NULL AS decimal(5,2)) AS discount_percent", "CAST(10 AS decimal(12,2)) AS line_total", "'clash' AS channel")
    known = spark.createDataFrame([(1, "purchase")], "transaction_id bigint, transaction_type string").selectExpr(
        "*", "DATE'2001-07-30' AS transaction_date", "'online' AS channel", "1 AS store_id", "CAST(NULL AS bigint) AS customer_id", "'2001-07' AS year_month")
    fact = silver.sales_lines(lines, known)
    assert rows(fact, "transaction_id", "product_id", "lines", "units", "has_transaction") == sorted(
        [(1, 7, 2, 5, True), (1, None, 1, 1, True), (None, 7, 1, 5, False), (9, 7, 1, 1, False)], key=lambda t: tuple((v is not None, v) for v in t))
    metrics = {r.product_id: r for r in silver.product_metrics(fact).collect()}
    assert (metrics[7].times_sold, metrics[7].units_sold, metrics[7].unique_transactions) == (4, 11, 2)
    assert metrics[7].avg_selling_price == 4 / 3 and metrics[7].avg_discount_given is None
    sold = {r.product_id: r for r in gold.product_performance_agg(fact).collect()}
    assert (sold[7].unique_transactions, sold[7].unique_customers, sold[7].times_purchased) == (1, 0, 2)


def test_figures_per_product_come_from_one_pass_and_few_rows(spark, folder, no_broadcast):
    fresh = Lake(feed.Bronze(spark, folder), feed.AS_OF)
    text = plan(fresh.sales_lines)
    # lines meet their orders, are summed and meet their transactions in one deal by transaction; parts, orders and transactions are the other exchanges
    assert text.count("Exchange") == 5
    figures = gold.product_sales(fresh.sales_lines)
    assert rows(gold.metrics_of(figures)) == rows(silver.product_metrics(fresh.sales_lines))
    assert len(re.findall(r"Exchange hashpartitioning\(product_id", plan(gold.product_performance_agg(fresh.sales_lines)))) == 2
    # the day a line was sold is looked up as before
    items = feed.line_items(spark, folder)
    orders = feed.raw(spark, folder, "orders").selectExpr("o_orderkey AS k", "CAST(o_orderdate AS date) AS day")
    key = F.floor(F.col("line_item_id") / 100)
    assert items.count() == feed.raw(spark, folder, "lineitem").count()
    assert items.join(orders, key == F.col("k"), "left").where(~F.col("day").eqNullSafe(F.col("transaction_date"))).isEmpty()


def test_counting_days_of_sales_reads_no_amounts(spark, folder, no_broadcast):
    counted = Lake(feed.Bronze(spark, folder), feed.AS_OF).daily_sales_summary.groupBy().count()
    assert "lineitem" not in plan(counted)


def test_products_with_and_without_transactions_are_apart(spark):
    fact = spark.createDataFrame(
        [(1, 7, True, 5, "online"), (2, 7, True, 5, "in_store"), (3, 7, True, None, None), (4, 7, False, None, None), (5, 8, False, None, None), (None, 8, False, None, None), (6, None, True, 9, "mobile_app")],
        "transaction_id bigint, product_id bigint, has_transaction boolean, customer_id bigint, channel string",
    ).selectExpr("*", "DATE'2001-07-30' AS transaction_date", "2L AS lines", "3L AS units", "CAST(10 AS decimal(22,2)) AS revenue", "CAST(4 AS decimal(20,2)) AS price_sum", "2L AS price_count",
                 "CAST(NULL AS decimal(15,2)) AS discount_sum", "0L AS discount_count")
    figures = gold.product_sales(fact)
    assert rows(gold.metrics_of(figures)) == rows(silver.product_metrics(fact))
    sold = {r.product_id: r for r in gold.performance_of(figures).collect()}
    assert set(sold) == {7, None}
    assert (sold[7].unique_customers, sold[7].unique_transactions, sold[7].times_purchased, sold[7].total_units_sold) == (1, 3, 6, 9)
    assert (sold[7].total_revenue, sold[7].online_revenue, sold[7].instore_revenue, sold[7].mobile_revenue, sold[7].avg_discount) == (30, 10, 10, 0, None)
