"""Retail bronze tables derived from the generic test tables (customer, orders, lineitem, part, ...).

Only used for tests, checks and benchmarks; production code gets its bronze tables from
:func:`tallyhouse.sources.tables.load`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.columns import below
from tallyhouse.functions.values import US_STATES
from tallyhouse.plans.lake import store

AS_OF = dt.date(2001, 8, 1)
MOST_SITES = 10_000
EVENTS_AS_OF = dt.datetime(2024, 1, 31)
#: Added to a key so that it matches no row: every raw row stays, as a sale to a stranger, an orphan line and so on.
STRANGER = 10**12
#: Lines that a task takes at most, in the mean.
TASK_LINES = 500_000
SNAPSHOT_DAYS = ("2001-07-30", "2001-07-31", "2001-08-01")


def raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def _state(position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in US_STATES]), position.cast("int"))


def _stranger(key: Column, when: Column) -> Column:
    return F.when(when, key + F.lit(STRANGER)).otherwise(key)


def transactions(spark: SparkSession, root: str) -> DataFrame:
    o = raw(spark, root, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    priority = F.substring("o_orderpriority", 1, 1)
    return o.select(
        key.alias("transaction_id"),
        F.when(key % 97 != 0, _stranger(cust, cust % 19 == 0)).alias("customer_id"),
        (key % 100).cast("int").alias("store_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.expr("timestampadd(HOUR, cast(o_orderkey % 24 as int), o_orderdate)").alias("transaction_timestamp"),
        below((key + cust) % 20, [(17, "purchase"), (19, "return")], "exchange").alias("transaction_type"),
        below(
            F.floor("o_totalprice").cast("bigint") % 20,
            [(9, "credit_card"), (14, "debit_card"), (17, "digital_wallet"), (19, "cash")],
            "gift_card",
        ).alias("payment_method"),
        F.when(priority.isin("1", "2", "3"), "online").when(priority == "4", "in_store").otherwise("mobile_app").alias("channel"),
        (1 + key % 7).cast("int").alias("num_items"),
        F.date_format("o_orderdate", "yyyy-MM").alias("year_month"),
    )


def line_items(spark: SparkSession, root: str) -> DataFrame:
    """Lines with the day of their order.

    Days are looked up last and by ``transaction_id`` (and the raw key, which no other order shares), so rows come dealt out by
    transaction and what is grouped or joined by it needs no further exchange. Tasks follow the number of rows, which the files tell, as
    sums and joins of one transaction then share a task.
    """
    lines = raw(spark, root, "lineitem")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), lines.count() // TASK_LINES + 1)
    part = raw(spark, root, "part").select("p_partkey", F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"))
    day, known = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    dates = raw(spark, root, "orders").select("o_orderkey", _stranger(known, known % 23 == 0).alias("_sold_in"), day.alias("transaction_date"))
    order, product = F.col("l_orderkey"), F.col("l_partkey")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    items = lines.join(part, product == F.col("p_partkey")).withColumn("transaction_id", _stranger(order, order % 23 == 0)).repartition(tasks, "transaction_id")
    same = (F.col("transaction_id") == F.col("_sold_in")) & (order >= known) & (order <= known)
    return items.join(dates, same, "left").select(
        (order * 100 + F.col("l_linenumber")).alias("line_item_id"),
        "transaction_id",
        _stranger(product, product % 17 == 0).alias("product_id"),
        F.col("l_linenumber").alias("item_seq"),
        F.col("l_quantity").cast("int").alias("quantity"),
        "unit_price",
        (F.col("l_discount") * 100).cast("decimal(5,2)").alias("discount_percent"),
        (price * (1 - F.col("l_discount").cast("decimal(3,2)"))).cast("decimal(12,2)").alias("line_total"),
        "transaction_date",
        F.date_format("transaction_date", "yyyy-MM").alias("year_month"),
    )


def products(spark: SparkSession, root: str) -> DataFrame:
    key = F.col("p_partkey")
    base = (F.col("p_retailprice").cast("decimal(10,2)") * F.col("p_size") * F.lit("0.02").cast("decimal(3,2)")).cast("decimal(10,2)")
    cost_share = (F.lit(0.30) + F.lit(0.10) * (key % 5)).cast("decimal(3,2)")
    return raw(spark, root, "part").select(
        key.alias("product_id"),
        F.concat(F.lit("SKU-"), F.upper(F.substring("p_type", 1, 3)), F.lit("-"), F.lpad(key.cast("string"), 8, "0")).alias("product_sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_name").alias("subcategory"),
        F.col("p_brand").alias("brand"),
        base.alias("base_price"),
        (base * cost_share).cast("decimal(10,2)").alias("cost_price"),
        (key % 20 != 0).alias("is_active"),
    )


def customers(spark: SparkSession, root: str) -> DataFrame:
    key = F.col("c_custkey")
    text = key.cast("string")
    digit, quarter = key % 10, key % 4
    as_of = F.lit(AS_OF)
    return raw(spark, root, "customer").select(
        key.alias("customer_id"),
        F.when(digit == 3, F.concat(F.lit("  CUST_"), text, F.lit("@EXAMPLE.COM ")))
        .when(digit == 7, F.concat(F.lit("bad-"), text))
        .otherwise(F.concat(F.lit("customer_"), text, F.lit("@example.com"))).alias("email"),
        F.concat(F.lit(" first_"), (key % 1000).cast("string")).alias("first_name"),
        F.concat(F.lit("LAST_"), (key % 5000).cast("string"), F.lit(" ")).alias("last_name"),
        F.when(F.col("c_nationkey") == 24, F.lit("zz")).otherwise(F.lower(_state(2 * F.col("c_nationkey") + 1))).alias("state"),
        F.when(quarter == 0, F.concat(F.lit("+1"), (2000000000 + key).cast("string")))
        .when(quarter == 1, F.concat(F.lit("(555) "), F.lpad((key % 1000).cast("string"), 3, "0"), F.lit("-0199")))
        .when(quarter == 2, text).alias("phone"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("c_acctbal").cast("decimal(10,2)").alias("lifetime_value"),
        F.date_add(F.lit(dt.date(1995, 1, 1)), ((key * 7) % 2400).cast("int")).alias("registration_date"),
        F.date_sub(as_of, ((key * 11) % 365).cast("int")).alias("last_purchase_date"),
        (digit != 0).alias("is_active"),
    )


def stores(spark: SparkSession, root: str) -> DataFrame:
    key = F.col("s_suppkey")
    return raw(spark, root, "supplier").select(
        key.cast("int").alias("store_id"),
        F.concat(F.lit("Store #"), key.cast("string")).alias("store_name"),
        _state(key % 50 + 1).alias("state"),
        F.when(key % 50 == 49, F.lit(0)).otherwise((5000 + (key * 997) % 50000).cast("int")).alias("square_footage"),
        (key % 20 != 0).alias("is_active"),
    )


def warehouses(spark: SparkSession, root: str) -> DataFrame:
    return raw(spark, root, "region").select(
        F.col("r_regionkey").alias("warehouse_id"), F.col("r_name").alias("warehouse_name")
    )


def inventory_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Each product, warehouse and snapshot day. Warehouses are a dimension of at most ``MOST_SITES`` rows, which is checked."""
    key, site, day = F.col("p_partkey"), F.col("warehouse_id"), F.col("dn")
    on_hand = F.when(key % 11 == 0, F.lit(0)).otherwise(((key * 31 + site * 17 + day * 7) % 1000).cast("int"))
    sites = [r[0] for r in warehouses(spark, root).select("warehouse_id").limit(MOST_SITES + 1).collect()]
    if len(sites) > MOST_SITES:
        raise ValueError(f"more than {MOST_SITES} warehouses")
    slots = (
        raw(spark, root, "part").select("p_partkey")
        .withColumn("warehouse_id", F.explode(F.array(*[F.lit(s) for s in sites])))
        .select("*", F.posexplode(F.array(*[F.lit(d) for d in SNAPSHOT_DAYS])).alias("dn", "snapshot_text"))
        .withColumn("quantity_on_hand", on_hand)
        .withColumn("quantity_reserved", F.expr("quantity_on_hand * 3 div 10").cast("int"))
    )
    return slots.select(
        _stranger(key, key % 13 == 0).alias("product_id"),
        "warehouse_id",
        F.col("snapshot_text").cast("date").alias("snapshot_date"),
        "quantity_on_hand",
        "quantity_reserved",
        (F.col("quantity_on_hand") - F.col("quantity_reserved")).alias("quantity_available"),
        (20 + (key * 13 + site) % 100).cast("int").alias("reorder_point"),
    )


def shape_events(events: DataFrame) -> DataFrame:
    """Clickstream rows from raw event rows; works on batch and streaming frames alike."""
    key, user = F.col("event_id"), F.col("user_id")
    ts = F.col("ts").cast("timestamp")
    slot = key % 20
    kind = F.create_map(*[F.lit(x) for pair in (
        ("view", "product_view"), ("click", "add_to_cart"), ("purchase", "checkout_complete"),
        ("signup", "search"), ("error", "page_view"),
    ) for x in pair])
    return events.select(
        F.concat(F.lit("evt_"), key.cast("string")).alias("event_id"),
        F.concat(F.lit("sess_"), user.cast("string"), F.lit("_"), F.date_format(ts, "yyyyMMdd")).alias("session_id"),
        F.when(key % 10 >= 3, user).alias("customer_id"),
        F.try_element_at(kind, F.col("event_type")).alias("event_type"),
        F.when(key % 5 >= 2, F.get_json_object("props", "$.k").cast("bigint")).alias("product_id"),
        F.concat(F.lit("/page/"), (key % 1000).cast("string")).alias("page_url"),
        below(slot, [(6, "google"), (10, "facebook"), (14, "direct"), (17, "email")], "other").alias("referrer"),
        below(slot, [(11, "mobile"), (17, "desktop")], "tablet").alias("device_type"),
        ts.alias("event_timestamp"),
        F.col("props").alias("event_properties"),
    )


def clickstream(spark: SparkSession, root: str) -> DataFrame:
    return shape_events(raw(spark, root, "events"))


class Bronze(Mapping):
    """All bronze tables by name; a table is planned when first asked for."""

    BUILDERS = {
        "customers": customers,
        "products": products,
        "stores": stores,
        "warehouses": warehouses,
        "transactions": transactions,
        "transaction_line_items": line_items,
        "inventory_snapshots": inventory_snapshots,
    }

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root, self._plans = spark, root, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._plans:
            self._plans[name] = self.BUILDERS[name](self._spark, self._root)
        return self._plans[name]

    def __iter__(self):
        return iter(self.BUILDERS)

    def __len__(self) -> int:
        return len(self.BUILDERS)


def materialise(spark: SparkSession, folder: str, root: str) -> dict[str, DataFrame]:
    """Write all bronze tables under ``root/bronze``, laid out as the lake lays them out, and return them as table scans."""
    return {name: store(frame, root, f"bronze.{name}") for name, frame in Bronze(spark, folder).items()}
