"""Scores, rates, ranks and NULL paths of the gold tables and the analytic queries."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhouse.functions import values as V
from tallyhouse.functions.columns import at_least, at_most
from tallyhouse.operators.ranking import ranked
from tallyhouse.plans import analytics, gold, silver

from conftest import rows

AS_OF = dt.date(2001, 8, 1)
TX = ("transaction_id bigint, customer_id bigint, store_id int, transaction_date date, transaction_type string, payment_method string, "
      "channel string, calculated_total_items bigint, transaction_amount decimal(18,2), is_weekend boolean, year_month string")


def tx(spark, *entries):
    """Entries are dicts over a plain purchase."""
    out = []
    for i, e in enumerate(entries):
        base = dict(transaction_id=i, customer_id=1, store_id=1, transaction_date=AS_OF, transaction_type="purchase", payment_method="cash",
                    channel="online", calculated_total_items=1, transaction_amount=Decimal("10.00"), is_weekend=False, year_month="2001-08")
        base.update(e)
        out.append(tuple(base.values()))
    return spark.createDataFrame(out, TX)


@pytest.mark.parametrize("days, score", [(30, 5), (31, 4), (60, 4), (61, 3), (90, 3), (91, 2), (180, 2), (181, 1), (None, 1)])
def test_recency_score(spark, days, score):
    df = spark.createDataFrame([(days,)], "d int")
    assert df.select(at_most(F.col("d"), V.RECENCY_SCORES, 1)).first()[0] == score


@pytest.mark.parametrize("steps, cases", [
    (V.FREQUENCY_SCORES, [(20, 5), (19, 4), (10, 4), (9, 3), (5, 3), (4, 2), (2, 2), (1, 1), (None, 1)]),
    (V.MONETARY_SCORES, [(5000, 5), (4999, 4), (2000, 4), (1999, 3), (500, 3), (499, 2), (100, 2), (99, 1)]),
])
def test_scores(spark, steps, cases):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, v int")
    got = [r[0] for r in df.orderBy("i").select(at_least(F.col("v"), steps, 1)).collect()]
    assert got == [s for _, s in cases]


def profiles(spark, n):
    return spark.createDataFrame([(i, 10) for i in range(n)], "customer_id bigint, days_since_purchase int")


def test_customer_360_channels_rates_and_missing_history(spark):
    t = tx(
        spark,
        {"customer_id": 0, "channel": "online"}, {"customer_id": 0, "channel": "in_store"},
        {"customer_id": 1, "channel": "in_store"}, {"customer_id": 1, "channel": "mobile_app"},
        {"customer_id": 2, "channel": "mobile_app"}, {"customer_id": 2, "channel": "mobile_app", "transaction_type": "return"},
        {"customer_id": 3, "channel": "phone"},
        {"customer_id": 4, "transaction_type": "return"},
        {"customer_id": None},
    )
    got = {r.customer_id: r for r in gold.customer_360(profiles(spark, 6), t).collect()}
    assert [got[i].preferred_channel for i in range(6)] == ["Online", "In-Store", "Mobile", "Online", "Online", "Unknown"]
    assert got[2].return_rate == Decimal("100.00") and got[4].return_rate == 0
    assert got[4].predicted_ltv is None and got[4].avg_order_value is None and got[4].total_spend == 0
    assert got[0].predicted_ltv == Decimal("240.00")
    assert got[5].online_orders is None and got[5].total_transactions == 0 and got[5].value_segment == "Potential"


def test_return_rate_over_limit_is_null(spark):
    t = tx(spark, {}, *[{"transaction_type": "return"}] * 10)
    row = gold.customer_360(profiles(spark, 2), t).where("customer_id = 1").first()
    assert row.return_count == 10 and row.return_rate is None


@pytest.mark.parametrize("score, segment", [(13, "Champions"), (12, "Loyal"), (10, "Loyal"), (9, "Potential"), (7, "Potential"), (6, "At Risk"), (4, "At Risk"), (3, "Lost")])
def test_value_segment(spark, score, segment):
    assert spark.createDataFrame([(score,)], "s int").select(at_least(F.col("s"), V.VALUE_SEGMENTS, V.VALUE_ELSE)).first()[0] == segment


def test_daily_summary_equals_join_of_sales_and_returns(spark):
    t = tx(
        spark,
        {"payment_method": "credit_card", "transaction_amount": Decimal("7.00")},
        {"payment_method": "digital_wallet", "customer_id": 2, "calculated_total_items": None},
        {"transaction_type": "return", "transaction_amount": Decimal("3.00")},
        {"transaction_type": "return", "channel": "in_store"},
        {"transaction_type": "exchange", "store_id": 9},
        {"store_id": 5, "calculated_total_items": None},
    )
    key = gold.SALES_KEY
    joined = gold.daily_sales(t).join(gold.daily_returns(t), key, "left").na.fill(0, ["return_count", "return_amount"])
    summary = gold.daily_sales_summary(t)
    assert rows(summary.select(joined.columns)) == rows(joined)
    busy = summary.where("store_id = 1").first()
    assert (busy.net_sales, busy.return_rate, busy.items_per_transaction) == (Decimal("14.00"), Decimal("50.00"), Decimal("0.50"))
    assert busy.credit_card_sales == 7 and busy.digital_wallet_sales == 10 and busy.unique_customers == 2
    quiet = summary.where("store_id = 5").first()
    assert quiet.items_sold is None and quiet.items_per_transaction is None and quiet.return_rate == 0


def test_store_divisors(spark):
    stores = spark.createDataFrame([(1, "A", 100), (2, "B", 0), (3, "C", None), (4, "D", 50)], "store_id int, state string, square_footage int")
    t = tx(spark, {"is_weekend": True}, {}, {"store_id": 2}, {"store_id": 3})
    got = {r.store_id: r for r in gold.store_analytics(stores, t).collect()}
    assert (got[1].revenue_per_sqft, got[1].weekend_ratio, got[1].avg_daily_revenue) == (0.2, 50.0, 20.0)
    assert got[2].revenue_per_sqft == 0 and got[3].revenue_per_sqft == 0 and got[3].customers_per_sqft == 0
    assert got[4].avg_daily_revenue == 0 and got[4].weekend_ratio == 0
    assert [got[i].revenue_rank for i in (1, 2, 3, 4)] == [1, 2, 3, 4]


@pytest.mark.parametrize("rank, tier", [(50, "Top Performer"), (51, "Above Average"), (200, "Above Average"), (201, "Average"), (350, "Average"), (351, "Below Average")])
def test_store_tier(spark, rank, tier):
    assert spark.createDataFrame([(rank,)], "r int").select(at_most(F.col("r"), V.STORE_TIERS, V.STORE_TIER_ELSE)).first()[0] == tier


def test_product_classes_and_ties(spark):
    n = 70
    t = tx(spark, *[{"transaction_date": AS_OF - dt.timedelta(days=10)}] * 2, {"transaction_date": AS_OF})
    lines = spark.range(65).select(
        (F.col("id") % 3).alias("transaction_id"), F.col("id").alias("product_id"), F.lit(20).alias("quantity"),
        F.lit(1).cast("decimal(10,2)").alias("unit_price"), F.lit(0).cast("decimal(5,2)").alias("discount_percent"),
        F.when(F.col("id") < 5, 100).otherwise(50).cast("decimal(12,2)").alias("line_total"))
    sales = silver.sales_lines(lines, t)
    catalogue = silver.products(
        spark.range(n).select(F.col("id").alias("product_id"), F.lit("c").alias("category"), F.lit(10).cast("decimal(10,2)").alias("base_price"),
                              F.lit(4).cast("decimal(10,2)").alias("cost_price")),
        sales,
    )
    got = {r.product_id: r for r in gold.product_performance(catalogue, sales, AS_OF).collect()}
    assert [got[i].category_revenue_rank for i in range(n)] == list(range(1, n + 1))
    assert got[0].performance_class == "Star" and got[0].sales_velocity == 2.0
    assert got[2].performance_class == "Strong" and got[2].days_since_first_sale == 0 and got[2].sales_velocity == 0
    assert got[9].performance_class == "Star" and got[10].performance_class == "Strong" and got[49].performance_class == "Strong"
    assert got[50].performance_class == "Average" and got[69].performance_class == "Underperformer"
    assert got[69].unique_customers == 0 and got[69].sales_velocity == 0


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_ranked_in_ranges_equals_window(spark, groups):
    df = spark.range(5000).select(
        "id", F.when(F.col("id") % 11 == 0, None).otherwise((F.col("id") % 3).cast("string")).alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 50 == 1, None).otherwise(F.hash("id") % 1000).cast("decimal(18,2)").alias("v"))
    for ascending in (False, True):
        small = ranked(df, "r", "v", "id", groups, ascending=ascending)
        order = F.col("v").asc_nulls_last() if ascending else F.col("v").desc_nulls_last()
        large = df.withColumn("r", F.row_number().over(Window.partitionBy(*groups).orderBy(order, "id")).cast("bigint"))
        assert small.dtypes == large.dtypes
        assert rows(small) == rows(large)


# --- analytic queries -------------------------------------------------------------------------------

def test_sales_trend_counts_rows_not_days(spark):
    first = AS_OF - dt.timedelta(days=800)
    t = tx(spark, *[{"transaction_date": first + dt.timedelta(days=2 * i), "transaction_amount": Decimal(i + 1)} for i in range(400)])
    got = analytics.sales_trend(t, AS_OF, days=90, limit=None).collect()
    last = got[0]
    assert last.transaction_date == first + dt.timedelta(days=798)
    assert last.revenue_7day_avg == sum(range(394, 401)) / 7 and last.revenue_30day_avg == sum(range(371, 401)) / 30
    assert last.revenue_yoy == 35 and last.yoy_growth_pct == Decimal("1042.86")
    assert analytics.sales_trend(t, AS_OF, days=90, limit=3).count() == 3


def test_cohorts(spark):
    t = tx(
        spark,
        {"customer_id": 1, "transaction_date": dt.date(2001, 1, 31)}, {"customer_id": 1, "transaction_date": dt.date(2001, 2, 1)},
        {"customer_id": 1, "transaction_date": dt.date(2001, 2, 20)}, {"customer_id": 2, "transaction_date": dt.date(2001, 1, 1)},
        {"customer_id": None, "transaction_date": dt.date(2001, 1, 1)},
        {"customer_id": 3, "transaction_date": dt.date(2001, 1, 1), "transaction_type": "return"},
    )
    assert [tuple(r) for r in analytics.cohort_retention(t, AS_OF).collect()] == [
        (dt.date(2001, 1, 1), 2, 0.0, 2, 100.0), (dt.date(2001, 1, 1), 2, 1.0, 1, 50.0)]


def inventory(spark, *entries):
    return spark.createDataFrame(
        [(p, w, d, a, a, 0, r) for p, w, d, a, r in entries],
        "product_id bigint, warehouse_id int, snapshot_date date, quantity_on_hand int, quantity_available int, quantity_reserved int, reorder_point int")


def test_inventory_status_paths(spark):
    products = spark.range(6).select(F.col("id").alias("product_id"), F.lit("n").alias("product_name"), F.lit("c").alias("category"),
                                     F.lit(10).cast("decimal(10,2)").alias("base_price"), (F.col("id") != 5).alias("is_active"))
    stock = inventory(
        spark, (0, 1, AS_OF, 0, 5), (1, 1, AS_OF, 4, 5), (2, 1, AS_OF, 5, 5), (2, 1, dt.date(2001, 7, 1), 99, 5), (3, 1, AS_OF, 50, 5))
    lines = spark.createDataFrame([(0, 2, 30), (0, 3, 50), (1, 3, 99)], "transaction_id bigint, product_id bigint, quantity int").selectExpr(
        "*", "CAST(1 AS decimal(10,2)) AS unit_price", "CAST(0 AS decimal(5,2)) AS discount_percent", "CAST(1 AS decimal(12,2)) AS line_total")
    t = tx(spark, {}, {"transaction_date": AS_OF - dt.timedelta(days=31), "year_month": "2001-07"})
    got = {r.product_id: r for r in analytics.inventory_optimization(products, silver.sales_lines(lines, t), stock, AS_OF).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4]
    assert [got[i].stock_status for i in range(5)] == ["OUT_OF_STOCK", "LOW_STOCK", "REORDER_SOON", "HEALTHY", "OUT_OF_STOCK"]
    assert [got[i].days_of_inventory for i in range(5)] == [999, 999, 5.0, 30.0, 999]
    assert got[3].units_sold_30d == 50 and got[3].weekly_revenue_at_risk == Decimal("116.67")
    assert got[4].warehouse_count is None and got[4].inventory_available == 0


def test_since_prunes_month_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    tx(spark, {}, {"transaction_date": dt.date(2001, 5, 1), "year_month": "2001-05"}).write.partitionBy("year_month").parquet(path)
    df = analytics.since(spark.read.parquet(path), AS_OF, 30)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan and "GreaterThanOrEqual(transaction_date" in plan
    assert df.count() == 1
    daily = str(tmp_path / "d")
    gold.daily_sales_summary(tx(spark, {}, {"transaction_date": dt.date(2000, 12, 31)})).write.partitionBy("year", "month").parquet(daily)
    recent = analytics.since(spark.read.parquet(daily), AS_OF, 30)
    assert recent.count() == 1 and "PartitionFilters: [((year" in recent._jdf.queryExecution().executedPlan().toString()
