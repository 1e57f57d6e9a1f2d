"""Bitmaps: exact distinct counts that merge, and plans that do not multiply rows for them."""

import datetime as dt

from pyspark.sql import functions as F

from tallyhouse.operators import distinct as D
from tallyhouse.plans import gold, silver
from tallyhouse.plans.lake import Lake
from tallyhouse.sources import feed

from conftest import rows
from test_gold import tx


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_equal_count_distinct_and_roll_up(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("g"),
        F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 49 == 0, F.pmod(F.hash("id"), F.lit(40)) + 10**12)
        .when(F.col("id") % 47 == 0, -F.pmod(F.hash("id"), F.lit(70_000))).otherwise(F.pmod(F.hash("id"), F.lit(70_000))).cast("bigint").alias("k"))
    fine = D.key_bitmaps(df.withColumn("half", F.spark_partition_id() % 2), ["g", "half"], "k", [F.count(F.lit(1)).alias("n")])
    coarse = D.unite(fine, ["g"], [F.sum("n").alias("n")])
    assert rows(D.count_keys(coarse, ["g"])) == rows(df.groupBy("g").agg(F.countDistinct("k")))
    assert coarse.agg(F.sum("n")).first()[0] == 30_000
    assert rows(D.count_keys(D.unite(fine, []), [])) == rows(df.agg(F.countDistinct("k")))


def test_no_row_is_multiplied(spark, folder):
    lake = Lake(feed.Bronze(spark, folder), feed.AS_OF)
    for df in (gold.customer_transactions(lake.transactions), gold.store_metrics(lake.transactions), gold.sales_by_day_product_store(lake.sales_lines),
               gold.product_performance_agg(lake.sales_lines), silver.product_metrics(lake.sales_lines)):
        assert "Expand" not in plan(df)


def test_store_counts_with_odd_days_and_keys(spark):
    days = [dt.date(1950, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(2059, 9, 18), dt.date(2059, 9, 19), dt.date(2200, 1, 1), None]
    t = tx(spark, *[{"transaction_date": d, "customer_id": c} for d in days for c in (1, 1, None, -5, 32_768, 32_769, 10**12)])
    got = gold.store_metrics(t).first()
    assert (got.active_days, got.unique_customers, got.total_transactions) == (6, 5, 49)
    many = tx(spark, {"customer_id": None, "transaction_date": None})
    assert [(r.active_days, r.unique_customers) for r in gold.store_metrics(many).collect()] == [(0, 0)]
    assert gold.store_metrics(t.limit(0)).count() == 0


def test_a_customer_counts_once_a_week(spark):
    monday = dt.date(2001, 7, 30)
    t = tx(spark, *[{"transaction_date": monday + dt.timedelta(days=i), "customer_id": c} for i in range(7) for c in (1, 2, 40_000)],
           {"transaction_date": monday, "customer_id": None}, {"transaction_date": monday, "customer_id": 9, "transaction_type": "return"})
    daily = gold.daily_customer_bitmaps(t)
    assert rows(gold.unique_customers(daily), "unique_customers", "transaction_count") == [(3, 22)]
    assert sum(r.unique_customers for r in gold.unique_customers(daily, "month", []).collect()) == 6


def test_sparse_days_are_not_sorted_in_wide_bitmaps(spark, folder):
    lake = Lake(feed.Bronze(spark, folder), feed.AS_OF)
    for unit, groups in (("week", ["channel"]), ("month", [])):
        assert "SortAggregate" not in plan(gold.unique_customers(gold.daily_customer_bitmaps(lake.transactions), unit, groups))


def test_words_count_odd_keys_and_roll_up(spark):
    keys = [None, 0, 63, 64, -1, -64, -65, 2**63 - 1, -(2**63), 10**12, 5]
    df = spark.createDataFrame([(g, h, k) for g in ("a", "b", None) for h in (0, 1) for k in keys * 2 if not (g == "b" and k == 5)] + [("c", 0, None)], "g string, h int, k bigint")
    fine = D.key_words(df, ["g", "h"], "k", [F.count(F.lit(1)).alias("n")])
    assert rows(D.count_keys(D.unite(fine, ["g"]), ["g"])) == rows(df.groupBy("g").agg(F.countDistinct("k")))
    assert rows(D.unite(fine, [], [F.sum("n").alias("n")]).agg(F.sum("n"), F.sum(F.bit_count("bitmap").cast("bigint")))) == rows(df.agg(F.count(F.lit(1)), F.countDistinct("k")))
    assert fine.count() == fine.where("bucket IS NULL OR bitmap <> 0").count()
