"""Silver tables: cleansed, typed and enriched rows, one output row per bronze row."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import values as V
from tallyhouse.functions.columns import MONEY, at_least, below, calendar, on_weekend, per, percent


def standard_phone(phone: Column) -> Column:
    """Eleven digits starting with the country code, NULL for anything else."""
    digits = F.regexp_replace(phone, "[^0-9]", "")
    return F.when(F.length(digits) == 11, digits).when(F.length(digits) == 10, F.concat(F.lit("1"), digits))


def customers(bronze: DataFrame, as_of: dt.date) -> DataFrame:
    """Standardised contact data, quality flags and score, tenure and recency bands at ``as_of``."""
    today = F.lit(as_of)
    cleaned = bronze.withColumns({
        "email": F.lower(F.trim("email")),
        "first_name": F.initcap(F.trim("first_name")),
        "last_name": F.initcap(F.trim("last_name")),
        "state": F.upper(F.trim("state")),
        "phone": standard_phone(F.col("phone")),
        "tenure_days": F.datediff(today, "registration_date"),
        "days_since_purchase": F.datediff(today, "last_purchase_date"),
    })
    flagged = cleaned.withColumns({
        "dq_valid_email": F.col("email").rlike(V.EMAIL_PATTERN),
        "dq_valid_state": F.col("state").isin(V.US_STATES),
        "tenure_category": below(F.col("tenure_days"), V.TENURE_DAYS, V.TENURE_BEYOND),
        "recency_category": below(F.col("days_since_purchase"), V.RECENCY_DAYS, V.RECENCY_BEYOND),
    })
    points = F.col("dq_valid_email").cast("int") + F.col("dq_valid_state").cast("int")
    return flagged.withColumn("dq_score", points * F.lit(50.0))


def sales_lines(line_items: DataFrame, transactions: DataFrame) -> DataFrame:
    """The sales fact: one row per transaction and product with sums over its lines and the facts of the transaction.

    Lines meet their transactions here and nowhere else. They are summed before that, so a transaction with very many lines enters
    the join with one row per product, and (transaction, product) is unique: distinct transactions of a product are a
    plain count of rows. Lines of an unknown transaction stay, with ``has_transaction`` false. Stored partitioned by month
    and bucketed by ``transaction_id``, the fact needs no exchange for anything that is grouped or joined by transaction.
    """
    lines = line_items.groupBy("transaction_id", "product_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").alias("units"),
        F.sum("line_total").alias("revenue"),
        F.sum("unit_price").alias("price_sum"),
        F.count("unit_price").alias("price_count"),
        F.sum("discount_percent").alias("discount_sum"),
        F.count("discount_percent").alias("discount_count"),
        F.max("discount_percent").alias("discount_max"),
    )
    known = transactions.select(
        "transaction_id", "transaction_date", "transaction_type", "channel", "store_id", "customer_id",
        *[c for c in ("year_month",) if c in transactions.columns], F.lit(True).alias("has_transaction"),
    )
    return lines.join(known, "transaction_id", "left").withColumn("has_transaction", F.coalesce("has_transaction", F.lit(False)))


def _mean_of_sums(total: str, count: str) -> Column:
    return F.try_divide(F.sum(total).cast("double"), F.sum(count))


def transaction_totals(sales: DataFrame) -> DataFrame:
    """Amount, units, lines and discounts per transaction."""
    return sales.groupBy("transaction_id").agg(
        F.sum("revenue").cast(MONEY).alias("calculated_total"),
        F.sum("units").alias("calculated_total_items"),
        F.sum("lines").alias("calculated_line_items"),
        _mean_of_sums("discount_sum", "discount_count").alias("calculated_avg_discount"),
        F.max("discount_max").alias("calculated_max_discount"),
    )


def _day_part(hour: Column) -> Column:
    branches = reduce(lambda acc, p: acc.when(hour.between(p[0], p[1]), p[2]), V.DAY_PARTS[1:],
                      F.when(hour.between(*V.DAY_PARTS[0][:2]), V.DAY_PARTS[0][2]))
    return branches.otherwise(V.DAY_PART_ELSE)


def transactions(bronze: DataFrame, sales: DataFrame) -> DataFrame:
    """Transactions with their line totals, calendar attributes, bands and quality flags.

    Both join sides have one row per transaction, and where both tables are bucketed by transaction, neither is
    exchanged. Flags that compare a missing line count stay NULL.
    """
    day, amount, lines = F.col("transaction_date"), F.col("transaction_amount"), F.col("calculated_line_items")
    joined = bronze.join(transaction_totals(sales), "transaction_id", "left")
    derived = joined.withColumns({
        "transaction_amount": F.coalesce("calculated_total", F.lit(0).cast(MONEY)),
        "transaction_hour": F.hour("transaction_timestamp"),
        **calendar(day, "transaction_"),
        "is_weekend": on_weekend(day),
    })
    return derived.withColumns({
        "time_of_day": _day_part(F.col("transaction_hour")),
        "amount_bucket": below(amount, V.AMOUNT_BUCKETS, V.AMOUNT_BEYOND),
        "dq_has_items": lines > 0,
        "dq_valid_amount": amount > 0,
        "dq_consistent_items": lines == F.col("num_items"),
    }).drop("calculated_total")


def product_metrics(sales: DataFrame) -> DataFrame:
    """Sales figures per product, lines of unknown transactions included."""
    return sales.groupBy("product_id").agg(
        F.sum("lines").alias("times_sold"),
        F.sum("units").alias("units_sold"),
        F.sum("revenue").cast(MONEY).alias("total_revenue"),
        _mean_of_sums("price_sum", "price_count").alias("avg_selling_price"),
        _mean_of_sums("discount_sum", "discount_count").alias("avg_discount_given"),
        F.count("transaction_id").alias("unique_transactions"),
    )


def products(bronze: DataFrame, sales: DataFrame) -> DataFrame:
    """Catalogue with sales figures, margin and the revenue and price tiers."""
    return products_with(bronze, product_metrics(sales))


def products_with(bronze: DataFrame, metrics: DataFrame) -> DataFrame:
    """As :func:`products`, from figures per product as :func:`product_metrics` gives them."""
    revenue, orders = F.col("total_revenue"), F.col("unique_transactions")
    joined = bronze.join(metrics, "product_id", "left").na.fill(
        0, ["times_sold", "units_sold", "total_revenue", "unique_transactions"]
    )
    return joined.withColumns({
        "profit_margin": percent(F.col("base_price") - F.col("cost_price"), F.col("base_price")),
        "revenue_per_transaction": per(revenue, orders),
        "avg_units_per_transaction": per(F.col("units_sold"), orders),
        "revenue_tier": F.when(revenue <= 0, F.lit("New")).otherwise(at_least(revenue, V.REVENUE_TIERS, "Bronze")),
        "price_tier": at_least(F.col("base_price"), V.PRICE_TIERS, V.PRICE_BEYOND),
    })
