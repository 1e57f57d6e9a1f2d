"""Gold tables: daily sales, customer 360, product performance, store analytics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import values as V
from tallyhouse.functions.columns import (
    MONEY,
    at_least,
    at_most,
    calendar,
    mean,
    on_weekend,
    per,
    percent,
    ratio,
    sum_where,
)
from tallyhouse.operators.distinct import KEYS, key_bitmaps, key_words, keys_in, unite
from tallyhouse.operators.ranking import ranked

SALES_KEY = ["transaction_date", "channel", "store_id"]
PURCHASE = "transaction_type = 'purchase'"
RETURN = "transaction_type = 'return'"
SALES_SUMS = ("lines", "units", "revenue", "price_sum", "price_count", "discount_sum", "discount_count")
#: Slots of customers over which the sales of one product are dealt out.
SLOTS = 4


def _sales_measures(when=lambda c: c):
    amount = when(F.col("transaction_amount"))
    pay = F.col("payment_method")
    return [
        F.count(amount).alias("transaction_count"),
        F.sum(amount).cast(MONEY).alias("gross_sales"),
        F.sum(when(F.col("calculated_total_items"))).alias("items_sold"),
        F.countDistinct(when(F.col("customer_id"))).alias("unique_customers"),
        mean(amount).alias("avg_transaction_value"),
        F.max(amount).alias("max_transaction_value"),
        F.coalesce(F.sum(F.when(pay == "credit_card", amount)), F.lit(0)).cast(MONEY).alias("credit_card_sales"),
        F.coalesce(F.sum(F.when(pay == "digital_wallet", amount)), F.lit(0)).cast(MONEY).alias("digital_wallet_sales"),
    ]


def daily_sales(transactions: DataFrame) -> DataFrame:
    """Purchases per day, channel and store. ``transaction_amount`` is never NULL, so counting it counts rows."""
    return transactions.where(PURCHASE).groupBy(*SALES_KEY).agg(*_sales_measures())


def daily_returns(transactions: DataFrame) -> DataFrame:
    """Returns per day, channel and store."""
    return transactions.where(RETURN).groupBy(*SALES_KEY).agg(
        F.count(F.lit(1)).alias("return_count"), F.sum("transaction_amount").cast(MONEY).alias("return_amount")
    )


def daily_sales_summary(transactions: DataFrame) -> DataFrame:
    """Sales and returns per day, channel and store, with rates and calendar attributes.

    Sales and returns share their key, so one conditional aggregation over one scan replaces two
    aggregations and a join. A key with returns but no purchase gives no row, as in the left join of
    :func:`daily_sales` with :func:`daily_returns` this equals.
    """
    purchase, returned = F.expr(PURCHASE), F.expr(RETURN)
    day = F.col("transaction_date")
    both = (
        transactions.where(purchase | returned).groupBy(*SALES_KEY)
        .agg(
            F.count_if(purchase).alias("transaction_count"),  # as amounts are never NULL; who only counts rows then needs no amounts
            *_sales_measures(lambda c: F.when(purchase, c))[1:],
            F.count_if(returned).alias("return_count"),
            sum_where(returned, F.col("transaction_amount")).cast(MONEY).alias("return_amount"),
        )
        .where("transaction_count > 0")
    )
    cal = calendar(day)
    cal["week_of_year"] = cal.pop("week")
    return both.withColumns({
        "net_sales": (F.col("gross_sales") - F.col("return_amount")).cast(MONEY),
        "return_rate": percent(F.col("return_count"), F.col("transaction_count")),
        "items_per_transaction": ratio(F.col("items_sold"), F.col("transaction_count"), "decimal(5,2)"),
        **cal,
        "is_weekend": on_weekend(day),
    })


def customer_transactions(transactions: DataFrame) -> DataFrame:
    """Order history per customer.

    Stores and channels are counted as the sizes of sets, which are bounded by the number of stores: two distinct counts would
    multiply every row.
    """
    purchase, returned = F.expr(PURCHASE), F.expr(RETURN)
    spent = F.when(purchase, F.col("transaction_amount"))
    channel, pay = F.col("channel"), F.col("payment_method")
    return transactions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(purchase).alias("purchase_count"),
        F.count_if(returned).alias("return_count"),
        F.coalesce(F.sum(spent), F.lit(0)).cast(MONEY).alias("total_spend"),
        mean(spent).alias("avg_order_value"),
        F.max(spent).alias("max_order_value"),
        F.sum("calculated_total_items").alias("total_items_purchased"),
        F.min("transaction_date").alias("first_transaction_date"),
        F.max("transaction_date").alias("last_transaction_date"),
        F.size(F.collect_set("store_id")).cast("bigint").alias("stores_visited"),
        F.size(F.collect_set("channel")).cast("bigint").alias("channels_used"),
        F.count_if(channel == "online").alias("online_orders"),
        F.count_if(channel == "in_store").alias("instore_orders"),
        F.count_if(channel == "mobile_app").alias("mobile_orders"),
        F.count_if(pay == "credit_card").alias("credit_card_transactions"),
        F.count_if(pay == "digital_wallet").alias("digital_wallet_transactions"),
    )


def customer_360(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Customer profile with order history, RFM scores and segment, channel preference and value forecast.

    Customers without orders keep NULL channel counts; no comparison with them is true, so they
    end up with channel ``Unknown``.
    """
    history = customer_transactions(transactions.where("customer_id IS NOT NULL"))
    joined = customers.join(history, "customer_id", "left").na.fill(
        0, ["total_transactions", "purchase_count", "return_count", "total_spend", "total_items_purchased"]
    )
    scored = joined.withColumns({
        "recency_score": at_most(F.col("days_since_purchase"), V.RECENCY_SCORES, 1),
        "frequency_score": at_least(F.col("purchase_count"), V.FREQUENCY_SCORES, 1),
        "monetary_score": at_least(F.col("total_spend"), V.MONETARY_SCORES, 1),
    }).withColumn("rfm_score", F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score"))
    online, instore, mobile = F.col("online_orders"), F.col("instore_orders"), F.col("mobile_orders")
    leading = (
        F.when(online >= F.greatest(instore, mobile), "Online")
        .when(instore >= F.greatest(online, mobile), "In-Store")
        .when(mobile > 0, "Mobile")
        .otherwise("Unknown")
    )
    rate = percent(F.col("return_count"), F.col("purchase_count"))
    # average order value = spend / purchases; kept exact up to the last rounding
    yearly = F.col("total_spend").cast("decimal(20,2)") * F.col("frequency_score") * 12
    return scored.withColumns({
        "value_segment": at_least(F.col("rfm_score"), V.VALUE_SEGMENTS, V.VALUE_ELSE),
        "preferred_channel": leading,
        "return_rate": F.when(F.col("purchase_count") > 0, rate).otherwise(F.lit(0)).cast("decimal(5,2)"),
        "predicted_ltv": F.try_divide(yearly, F.col("purchase_count").cast("decimal(20,0)")).try_cast("decimal(12,2)"),
    })


def product_sales(sales: DataFrame) -> DataFrame:
    """Sums per product, apart for lines with and without a transaction, from one exchange of the sales fact.

    The products of a task would hardly repeat before an exchange, and sums are wider than the rows they are made of. So rows are dealt
    out by product and by a slot of the customer, unsummed; a customer is in one slot, so the distinct customers of a product are
    the sum over its slots. What is exchanged after that are few rows per product, however many tasks there are.
    """
    tasks = int(sales.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slot = F.pmod(F.xxhash64("customer_id"), F.lit(SLOTS)).cast("int")
    kind = F.when(F.col("channel") == "online", 1).when(F.col("channel") == "in_store", 2).when(F.col("channel") == "mobile_app", 3)
    dealt = sales.select(
        "product_id", slot.alias("_slot"), "has_transaction", "customer_id", F.col("transaction_id").isNotNull().alias("has_id"), kind.alias("channel"),
        "transaction_date", *SALES_SUMS,
    ).repartition(tasks, "product_id", "_slot")
    channel, revenue = F.col("channel"), F.col("revenue")
    by_slot = dealt.groupBy("product_id", "_slot", "has_transaction").agg(
        *[F.sum(c).alias(c) for c in SALES_SUMS],
        F.count(F.lit(1)).alias("rows"),
        F.count_if("has_id").alias("orders"),
        F.countDistinct("customer_id").alias("customers"),
        sum_where(channel == 1, revenue).alias("online"),
        sum_where(channel == 2, revenue).alias("instore"),
        sum_where(channel == 3, revenue).alias("mobile"),
        F.min("transaction_date").alias("first_date"),
        F.max("transaction_date").alias("last_date"),
    )
    return by_slot.groupBy("product_id", "has_transaction").agg(
        *[F.sum(c).alias(c) for c in (*SALES_SUMS, "rows", "orders", "customers", "online", "instore", "mobile")],
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )


def metrics_of(figures: DataFrame) -> DataFrame:
    """:func:`silver.product_metrics` from :func:`product_sales`."""
    return figures.groupBy("product_id").agg(
        F.sum("lines").alias("times_sold"),
        F.sum("units").alias("units_sold"),
        F.sum("revenue").cast(MONEY).alias("total_revenue"),
        F.try_divide(F.sum("price_sum").cast("double"), F.sum("price_count")).alias("avg_selling_price"),
        F.try_divide(F.sum("discount_sum").cast("double"), F.sum("discount_count")).alias("avg_discount_given"),
        F.sum("orders").alias("unique_transactions"),
    )


def performance_of(figures: DataFrame) -> DataFrame:
    """:func:`product_performance_agg` from :func:`product_sales`."""
    return figures.where("has_transaction").select(
        "product_id",
        F.col("units").alias("total_units_sold"),
        F.col("revenue").cast(MONEY).alias("total_revenue"),
        F.try_divide(F.col("price_sum").cast("double"), F.col("price_count")).alias("avg_selling_price"),
        F.try_divide(F.col("discount_sum").cast("double"), F.col("discount_count")).alias("avg_discount"),
        F.col("lines").alias("times_purchased"),
        F.col("rows").alias("unique_transactions"),
        F.col("customers").alias("unique_customers"),
        F.col("online").cast(MONEY).alias("online_revenue"),
        F.col("instore").cast(MONEY).alias("instore_revenue"),
        F.col("mobile").cast(MONEY).alias("mobile_revenue"),
        F.col("first_date").alias("first_sale_date"),
        F.col("last_date").alias("last_sale_date"),
    )


def product_performance_agg(sales: DataFrame) -> DataFrame:
    """Sales per product with buyers, channel split and sale dates, from the sales fact.

    The fact has one row per transaction and product: distinct transactions are a plain count, and one distinct
    aggregate remains (two would make Spark multiply the rows).
    """
    return performance_of(product_sales(sales.where("has_transaction")))


def product_performance(products: DataFrame, sales: DataFrame, as_of: dt.date) -> DataFrame:
    """Products with their sales, velocity, ranks within the category and performance class."""
    return product_performance_with(products, product_performance_agg(sales), as_of)


def product_performance_with(products: DataFrame, sold: DataFrame, as_of: dt.date) -> DataFrame:
    """As :func:`product_performance`, from figures per product as :func:`product_performance_agg` gives them."""
    catalogue = products.drop("total_revenue", "avg_selling_price", "avg_discount_given", "unique_transactions")
    joined = catalogue.join(sold, "product_id", "left").na.fill(
        0, ["total_units_sold", "total_revenue", "unique_customers"]
    )
    measured = joined.withColumns({
        "revenue_per_customer": per(F.col("total_revenue"), F.col("unique_customers")),
        "days_since_first_sale": F.datediff(F.lit(as_of), "first_sale_date"),
    }).withColumn("sales_velocity", per(F.col("total_units_sold"), F.col("days_since_first_sale")))
    by_revenue = ranked(measured, "category_revenue_rank", "total_revenue", "product_id", ["category"])
    both = ranked(by_revenue, "category_units_rank", "total_units_sold", "product_id", ["category"])
    rank = F.col("category_revenue_rank")
    return both.withColumn(
        "performance_class",
        F.when((rank <= 10) & (F.col("sales_velocity") > 1), "Star")
        .when(rank <= 50, "Strong")
        .when(F.col("total_units_sold") > 0, "Average")
        .otherwise("Underperformer"),
    )


def store_metrics(transactions: DataFrame) -> DataFrame:
    """Trade per store.

    Customers and days are counted exactly in bitmaps, by store and block of customer keys first, so no row is multiplied for
    the two counts and a hot store is spread over its blocks. Days since 1970 have a bit each for 89 years; others, if any, are
    kept as a set.
    """
    channel, amount = F.col("channel"), F.col("transaction_amount")
    day = F.unix_date("transaction_date")
    usual = day.between(0, KEYS - 1)
    counts = {
        "total_transactions": F.count(F.lit(1)),
        "total_revenue": sum_where(F.expr(PURCHASE), amount),
        "_amount": F.sum(amount),
        "_amounts": F.count(amount),
        "weekend_transactions": F.count_if("is_weekend"),
        "weekday_transactions": F.count_if(~F.col("is_weekend")),
        "online_transactions": F.count_if(channel == "online"),
        "instore_transactions": F.count_if(channel == "in_store"),
    }
    parts = key_bitmaps(transactions, ["store_id"], "customer_id", [
        F.bitmap_construct_agg(F.bitmap_bit_position(F.when(usual, day + 1).cast("bigint"))).alias("_days"),
        F.collect_set(F.when(~usual, day)).alias("_other_days"),
        *[c.alias(name) for name, c in counts.items()],
    ])
    other_days = F.size(F.array_distinct(F.flatten(F.collect_list("_other_days"))))
    return parts.groupBy("store_id").agg(
        F.sum("total_transactions").alias("total_transactions"),
        F.sum("total_revenue").cast(MONEY).alias("total_revenue"),
        F.sum(F.bitmap_count("bitmap")).alias("unique_customers"),
        F.try_divide(F.sum("_amount").cast("double"), F.sum("_amounts")).alias("avg_transaction_value"),
        (F.bitmap_count(F.bitmap_or_agg("_days")) + other_days).alias("active_days"),
        *[F.sum(c).alias(c) for c in ("weekend_transactions", "weekday_transactions", "online_transactions", "instore_transactions")],
    )


def daily_customer_bitmaps(transactions: DataFrame) -> DataFrame:
    """Purchases and a bitmap of their customers per day, channel and block of 64 customer keys."""
    return key_words(
        transactions.where(PURCHASE), ["transaction_date", "channel"], "customer_id",
        [F.count(F.lit(1)).alias("transaction_count"), F.sum("transaction_amount").cast(MONEY).alias("revenue")],
    )


def unique_customers(daily: DataFrame, unit: str = "week", groups: Sequence[str] = ("channel",)) -> DataFrame:
    """Distinct customers, purchases and revenue per week (or month, quarter, year) and group, united from the bitmaps of days.

    Unlike the sum of daily distinct counts, a customer counts once per period.
    """
    sums = [F.sum("transaction_count").alias("transaction_count"), F.sum("revenue").alias("revenue")]
    coarse = unite(daily.withColumn("period_start", F.trunc("transaction_date", unit)), ["period_start", *groups], sums)
    return coarse.groupBy("period_start", *groups).agg(
        F.sum(keys_in(coarse)).alias("unique_customers"), F.sum("transaction_count").alias("transaction_count"),
        F.sum("revenue").cast(MONEY).alias("revenue"),
    )


def store_analytics(
    stores: DataFrame, transactions: DataFrame
) -> DataFrame:
    """Stores with trade figures per area and day, two ranks and a performance tier."""
    joined = stores.join(store_metrics(transactions), "store_id", "left").na.fill(
        0, ["total_transactions", "total_revenue", "unique_customers"]
    )
    revenue, area, trades = F.col("total_revenue"), F.col("square_footage"), F.col("total_transactions")
    measured = joined.withColumns({
        "revenue_per_sqft": per(revenue, area),
        "customers_per_sqft": per(F.col("unique_customers"), area),
        "avg_daily_revenue": per(revenue, F.col("active_days")),
        "weekend_ratio": F.when(trades > 0, F.col("weekend_transactions") * F.lit(100.0) / trades).otherwise(F.lit(0.0)),
    })
    by_revenue = ranked(measured, "revenue_rank", "total_revenue", "store_id")
    both = ranked(by_revenue, "efficiency_rank", "revenue_per_sqft", "store_id")
    return both.withColumn("performance_tier", at_most(F.col("revenue_rank"), V.STORE_TIERS, V.STORE_TIER_ELSE))


def sales_by_day_product_store(sales: DataFrame) -> DataFrame:
    """Purchased units, revenue and transactions per day, product and store."""
    bought = sales.where("has_transaction").where(PURCHASE)
    return bought.groupBy("transaction_date", "product_id", "store_id").agg(
        F.sum("units").alias("units_sold"),
        F.sum("revenue").cast(MONEY).alias("revenue"),
        F.count("transaction_id").alias("transaction_count"),
    )


def inventory_status(snapshots: DataFrame) -> DataFrame:
    """Stock per product and site at the latest snapshot, with a reorder flag."""
    return latest_snapshot(snapshots).select(
        "product_id", "warehouse_id", "snapshot_date", "quantity_on_hand", "quantity_reserved", "quantity_available",
        "reorder_point", (F.col("quantity_available") <= F.col("reorder_point")).alias("needs_reorder"),
    )


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """Rows of the most recent snapshot date, found by a scalar subquery.

    Stored by ``snapshot_date``, the subquery reads no column of any file and its result is a partition filter of the scan.
    """
    newest = snapshots.agg(F.max("snapshot_date")).scalar()
    return snapshots.where(F.col("snapshot_date") == newest)
