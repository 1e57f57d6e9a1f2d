"""Analytic questions, dashboards and KPIs over silver and gold tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.columns import FINE, MONEY, mean
from tallyhouse.operators.baskets import pair_support
from tallyhouse.plans.gold import PURCHASE, latest_snapshot
from tallyhouse.session import workspace


def since(df: DataFrame, as_of: dt.date, days: int, day: str = "transaction_date") -> DataFrame:
    """Rows of the last ``days`` days; a table partitioned by ``year_month`` or ``year, month`` reads those months only."""
    first = as_of - dt.timedelta(days=days)
    recent = df.where(F.col(day) >= F.lit(first))
    if "year_month" in df.columns:
        recent = recent.where(F.col("year_month") >= first.strftime("%Y-%m"))
    elif {"year", "month"} <= set(df.columns):
        year, month = F.col("year"), F.col("month")
        recent = recent.where((year > first.year) | ((year == first.year) & (month >= first.month)))
    return recent


def _fine_mean(c: Column) -> Column:
    """Average of inexact values, summed as fixed-point so that row order cannot change it."""
    return mean(c.cast(FINE))


def _rounded_mean(c: Column, type_: str = FINE) -> Column:
    exact = c.cast(type_)
    return F.round(F.try_divide(F.sum(exact), F.count(exact).cast("decimal(20,0)")), 2)


def sales_trend(transactions: DataFrame, as_of: dt.date, days: int = 90, limit: int | None = 100) -> DataFrame:
    """Daily revenue per channel with 7- and 30-row moving averages and the change against 365 rows before.

    Frames count rows, not days: a day without sales shifts them. The window partitions hold one row per day.
    """
    daily = transactions.where(PURCHASE).groupBy("transaction_date", "channel").agg(
        F.sum("transaction_amount").cast(MONEY).alias("daily_revenue")
    )
    order = Window.partitionBy("channel").orderBy("transaction_date")
    revenue, year_ago = F.col("daily_revenue"), F.col("revenue_yoy")

    def moving(rows: int) -> Column:
        frame = order.rowsBetween(1 - rows, 0)
        return F.sum(revenue).over(frame).cast("double") / F.count(revenue).over(frame)

    growth = F.try_divide((revenue - year_ago).cast("decimal(20,2)") * 100, F.nullif(year_ago, F.lit(0)).cast("decimal(20,2)"))
    trend = daily.withColumns({
        "revenue_7day_avg": moving(7),
        "revenue_30day_avg": moving(30),
        "revenue_yoy": F.lag("daily_revenue", 365).over(order),
    }).withColumn("yoy_growth_pct", F.round(growth, 2))
    recent = trend.where(F.col("transaction_date") >= F.lit(as_of - dt.timedelta(days=days)))
    recent = recent.orderBy(F.desc("transaction_date"), "channel")
    return recent if limit is None else recent.limit(limit)


def cohort_retention(transactions: DataFrame, as_of: dt.date, days: int = 365, months: int = 12) -> DataFrame:
    """Share of each first-purchase month's customers who buy again 0 to ``months`` months later.

    Activity shrinks to distinct (customer, month) rows first. Every customer is active in month 0
    exactly once, so the cohort size is the month-0 count and no self-join is needed.
    """
    activity = (
        transactions.where(PURCHASE).where("customer_id IS NOT NULL")
        .select("customer_id", F.trunc("transaction_date", "month").alias("activity_month")).distinct()
    )
    first = F.min("activity_month").over(Window.partitionBy("customer_id"))
    retained = (
        activity.withColumn("cohort_month", first)
        .withColumn("months_since_cohort", F.months_between("activity_month", "cohort_month"))
        .groupBy("cohort_month", "months_since_cohort")
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )
    size = F.max(F.when(F.col("months_since_cohort") == 0, F.col("active_customers"))).over(Window.partitionBy("cohort_month"))
    rate = F.round(F.col("active_customers") * F.lit(100.0) / F.col("cohort_customers"), 2)
    return (
        retained.withColumn("cohort_customers", size)
        .where((F.col("months_since_cohort") <= months) & (F.col("cohort_month") >= F.lit(as_of - dt.timedelta(days=days))))
        .select("cohort_month", "cohort_customers", "months_since_cohort", "active_customers", rate.alias("retention_rate"))
        .orderBy("cohort_month", "months_since_cohort")
    )


def market_basket(
    sales: DataFrame, products: DataFrame, min_support: int = 100, limit: int | None = 50
) -> DataFrame:
    """Products bought together in ``min_support`` transactions or more, by descending lift.

    ``confidence`` divides by the smaller product count and ``lift`` is scaled by a million and leaves out the number of
    transactions: both follow the reporting rules, not the textbook. Products below the threshold cannot be
    part of a result and are dropped before pairing. The sales fact has one row per transaction and product; these rows and the
    product counts are written once to the shared working folder and read by all steps.
    """
    spark = sales.sparkSession
    staged = workspace(spark, "baskets")
    bought = sales.select(F.col("transaction_id").alias("basket"), F.col("product_id").alias("item"))
    bought.write.parquet(f"{staged}/rows")
    rows = spark.read.schema(bought.schema).parquet(f"{staged}/rows")
    counts = (
        rows.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_support)
        .join(products.select(F.col("product_id").alias("item")), "item", "left_semi")
    )
    counts.write.parquet(f"{staged}/counts")
    counts = spark.read.schema(counts.schema).parquet(f"{staged}/counts")
    baskets = rows.join(counts, "item", "left_semi")
    pairs = pair_support(baskets, min_support)

    na, nb, co = F.col("product_a_count"), F.col("product_b_count"), F.col("co_occurrence_count")
    scored = (
        pairs.select(F.col("item_a").alias("product_a"), F.col("item_b").alias("product_b"), F.col("support").alias("co_occurrence_count"))
        .join(counts.select(F.col("item").alias("product_a"), F.col("n").alias("product_a_count")), "product_a")
        .join(counts.select(F.col("item").alias("product_b"), F.col("n").alias("product_b_count")), "product_b")
        .withColumn("confidence", F.round(co * F.lit(100.0) / F.least(na, nb), 2))
        .withColumn("lift", F.round(co * F.lit(1e6) / (na.cast("double") * nb), 4))
    )
    order = [F.desc("lift"), F.col("product_a"), F.col("product_b")]
    top = scored.orderBy(*order).limit(limit) if limit is not None else scored
    label = products.select("product_id", "category")
    return (
        top.join(label.toDF("product_a", "category_a"), "product_a")
        .join(label.toDF("product_b", "category_b"), "product_b")
        .select("product_a", "category_a", "product_b", "category_b", co, na, nb, "confidence", "lift")
        .orderBy(*order)
    )


def inventory_optimization(
    products: DataFrame, sales: DataFrame, snapshots: DataFrame, as_of: dt.date, days: int = 30, limit: int | None = 100,
) -> DataFrame:
    """Active products with recent demand, stock at the latest snapshot, cover in days, status and revenue at risk."""
    recent = since(sales.where("has_transaction").where(PURCHASE), as_of, days)
    demand = recent.groupBy("product_id").agg(F.sum("units").alias("sold"))
    stock = latest_snapshot(snapshots).groupBy("product_id").agg(
        F.sum("quantity_available").alias("total_available"),
        F.avg("reorder_point").alias("avg_reorder_point"),
        F.countDistinct("warehouse_id").alias("warehouse_count"),
    )
    sold, available = F.col("sold"), F.col("total_available")
    units = F.coalesce(sold, F.lit(0)).cast("decimal(18,0)")
    cover = F.round(available.cast("decimal(18,0)") * 30 / F.nullif(units, F.lit(0)), 1)
    status = (
        F.when(available.isNull() | (available == 0), "OUT_OF_STOCK")
        .when(available < F.col("avg_reorder_point"), "LOW_STOCK")
        .when(available < sold, "REORDER_SOON")
        .otherwise("HEALTHY")
    )
    at_risk = F.round(units * F.col("base_price") * 7 / 30, 2)
    report = products.where("is_active").join(demand, "product_id", "left").join(stock, "product_id", "left").select(
        "product_id", "product_name", "category", "base_price",
        F.coalesce(sold, F.lit(0)).alias("units_sold_30d"),
        F.coalesce(available, F.lit(0)).alias("inventory_available"),
        "warehouse_count",
        F.when(sold > 0, cover).otherwise(F.lit(999)).cast("double").alias("days_of_inventory"),
        status.alias("stock_status"),
        at_risk.alias("weekly_revenue_at_risk"),
    ).orderBy(F.desc("weekly_revenue_at_risk"), "product_id")
    return report if limit is None else report.limit(limit)


# --- precomputed summaries -----------------------------------------------------------------------

def executive_summary(daily: DataFrame) -> DataFrame:
    """Weekly figures from the daily summary. Customer sums count a customer once per day, channel and store."""
    return daily.groupBy(F.trunc("transaction_date", "week").alias("week_start")).agg(
        F.sum("net_sales").cast(MONEY).alias("weekly_revenue"),
        F.sum("transaction_count").alias("weekly_transactions"),
        F.sum("unique_customers").alias("weekly_customers"),
        _fine_mean(F.col("avg_transaction_value")).alias("avg_order_value"),
        F.sum("return_amount").cast(MONEY).alias("weekly_returns"),
        mean(F.col("return_rate")).alias("avg_return_rate"),
    )


def category_performance(performance: DataFrame) -> DataFrame:
    """Product figures per category. Customers are counted once per product."""
    return performance.groupBy("category").agg(
        F.count(F.lit(1)).alias("product_count"),
        F.sum("total_units_sold").alias("total_units"),
        F.sum("total_revenue").cast(MONEY).alias("total_revenue"),
        _fine_mean(F.col("avg_selling_price")).alias("avg_price"),
        F.sum("unique_customers").alias("total_customers"),
    )


# --- benchmark and dashboard queries -------------------------------------------------------------

def revenue_by_channel(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("channel").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("transaction_amount").cast(MONEY).alias("revenue")
    )


def revenue_by_recent_day(transactions: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    return since(transactions, as_of, days).groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("transaction_amount").cast(MONEY).alias("revenue")
    )


def revenue_by_segment(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Buyers and revenue per customer segment; purchases are summed per customer before the join."""
    spend = transactions.where(PURCHASE).where("customer_id IS NOT NULL").groupBy("customer_id").agg(
        F.sum("transaction_amount").alias("spend")
    )
    return spend.join(customers.select("customer_id", "customer_segment"), "customer_id").groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("unique_customers"), F.sum("spend").cast(MONEY).alias("revenue")
    )


def revenue_by_category_segment_channel(
    sales: DataFrame, products: DataFrame, customers: DataFrame, as_of: dt.date, days: int = 90
) -> DataFrame:
    """Lines and revenue of the last ``days`` days by product category, customer segment and channel.

    Sums per (category, customer, channel) are formed before customers are joined, so a hot customer, or the many lines
    of one product, enter that join as few rows. A hot product in the product join is split by AQE.
    """
    recent = since(sales.where("has_transaction"), as_of, days).where("customer_id IS NOT NULL")
    by_category = (
        recent.join(products.select("product_id", "category"), "product_id")
        .groupBy("category", "customer_id", "channel")
        .agg(F.sum("lines").alias("lines"), F.sum("revenue").cast(MONEY).alias("revenue"))
    )
    return (
        by_category.join(customers.select("customer_id", "customer_segment"), "customer_id")
        .groupBy("category", "customer_segment", "channel")
        .agg(F.sum("lines").alias("transactions"), F.sum("revenue").cast(MONEY).alias("revenue"))
    )


def count_by(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def average_spend_by_segment(customer_360: DataFrame) -> DataFrame:
    return customer_360.groupBy("value_segment").agg(
        F.count(F.lit(1)).alias("customer_count"), mean(F.col("total_spend")).alias("avg_spend")
    )


# --- KPIs -----------------------------------------------------------------------------------------

def kpi_daily_revenue(daily: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    net, count = F.sum("net_sales"), F.sum("transaction_count")
    return since(daily, as_of, days).groupBy("transaction_date").agg(
        net.cast(MONEY).alias("total_revenue"),
        count.alias("total_transactions"),
        F.sum("unique_customers").alias("unique_customers"),
        F.round(F.try_divide(net.cast("decimal(20,2)"), count.cast("decimal(18,0)")), 2).alias("avg_order_value"),
    ).orderBy(F.desc("transaction_date"))


def kpi_segment_performance(customer_360: DataFrame) -> DataFrame:
    return customer_360.groupBy("value_segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        _rounded_mean(F.col("total_spend")).alias("avg_spend"),
        _rounded_mean(F.col("avg_order_value")).alias("avg_order_value"),
        _rounded_mean(F.col("rfm_score")).alias("avg_rfm_score"),
        _rounded_mean(F.col("return_rate")).alias("avg_return_rate"),
    ).orderBy(F.desc("avg_spend"))


def kpi_top_products(performance: DataFrame, limit: int = 100) -> DataFrame:
    return (
        performance.where(F.col("performance_class").isin("Star", "Strong"))
        .select("product_id", "product_name", "category", "total_revenue", "total_units_sold", "unique_customers",
                "performance_class", "category_revenue_rank")
        .orderBy(F.desc("total_revenue"), "product_id").limit(limit)
    )


def kpi_store_by_state(store_analytics: DataFrame) -> DataFrame:
    return store_analytics.groupBy("state").agg(
        F.count(F.lit(1)).alias("store_count"),
        F.round(F.sum("total_revenue"), 2).cast(MONEY).alias("total_revenue"),
        _rounded_mean(F.col("revenue_per_sqft")).alias("avg_revenue_per_sqft"),
        _rounded_mean(F.col("avg_daily_revenue")).alias("avg_daily_revenue"),
    ).orderBy(F.desc("total_revenue"))
