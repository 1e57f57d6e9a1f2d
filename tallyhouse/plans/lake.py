"""The medallion layers as one object: lazy plans over bronze frames, or tables published to a folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators import layout
from tallyhouse.plans import analytics, gold, silver
from tallyhouse.session import workspace
from tallyhouse.sources import tables as T

#: how published tables are laid out: partition columns and sort columns inside the files
LAYOUT = {
    "bronze.transactions": (["year_month"], ["transaction_date"]),
    "bronze.transaction_line_items": (["year_month"], ["transaction_date"]),
    "bronze.inventory_snapshots": (["snapshot_date"], []),
    "silver.sales_lines": (["year_month"], ["transaction_date"]),
    "silver.customers": ([], []),
    "silver.transactions": (["year_month"], ["transaction_date"]),
    "silver.products": ([], []),
    "gold.daily_sales_summary": (["year", "month"], ["transaction_date"]),
    "gold.customer_360": ([], []),
    "gold.product_performance": ([], []),
    "gold.store_analytics": ([], []),
    "gold.mv_executive_summary": ([], []),
    "gold.mv_category_performance": ([], []),
}

#: unpartitioned tables whose files are clustered by several columns at once
CLUSTERS = {
    "silver.customers": ["state", "customer_segment", "tenure_category"],
    "silver.products": ["category", "subcategory"],
    "gold.customer_360": ["value_segment", "customer_segment"],
    "gold.product_performance": ["category", "performance_class"],
    "gold.store_analytics": ["state", "performance_tier"],
}
#: tables in buckets of a key: grouped or joined by it, they are not exchanged
BUCKETS = {"bronze.transactions": "transaction_id", "silver.sales_lines": "transaction_id", "silver.transactions": "transaction_id"}

#: most files of a clustered table
FILES = 4096


def store(df: DataFrame, root: str, name: str) -> DataFrame:
    """Write ``layer.table`` under ``root`` in its layout and return a scan of it."""
    layer, table = name.split(".")
    partition_by, sort_by = LAYOUT.get(name, ([], []))
    path = f"{root}/{layer}/{table}"
    partition_by = [c for c in partition_by if c in df.columns]
    if name in BUCKETS:
        return T.overwrite_bucketed(df, path, BUCKETS[name], partition_by)
    if name in CLUSTERS:  # written once as it comes and then rewritten, as its quantiles need a pass of their own
        staged = workspace(df.sparkSession, table)
        df.write.parquet(staged)
        plain = df.sparkSession.read.schema(df.schema).parquet(staged)
        files = min(len(plain.inputFiles()), FILES)
        if files > 1:
            layout.cluster_write(plain, path, CLUSTERS[name], files)
        else:  # one file has no order of files
            T.overwrite(plain, path)
    else:
        T.overwrite(df, path, partition_by, sort_by)
    return T.load(df.sparkSession, root, layer, table)


class Lake:
    """Bronze tables in, every derived table as an attribute out.

    Attributes are query plans. Most run nothing before an action; ranks (in ``product_performance`` and ``store_analytics``)
    and market baskets write a staged table while the plan is built. ``as_of`` is the business date used in place of the clock.
    """

    def __init__(self, bronze: Mapping[str, DataFrame], as_of: dt.date):
        self.bronze = bronze
        self.as_of = as_of
        self.stored: set[str] = set()  # tables that are read from a folder

    @cached_property
    def customers(self) -> DataFrame:
        return silver.customers(self.bronze["customers"], self.as_of)

    @cached_property
    def sales_lines(self) -> DataFrame:
        return silver.sales_lines(self.bronze["transaction_line_items"], self.bronze["transactions"])

    @cached_property
    def transactions(self) -> DataFrame:
        return silver.transactions(self.bronze["transactions"], self.sales_lines)

    @cached_property
    def products(self) -> DataFrame:
        return silver.products(self.bronze["products"], self.sales_lines)

    @cached_property
    def daily_sales_summary(self) -> DataFrame:
        return gold.daily_sales_summary(self.transactions)

    @cached_property
    def customer_360(self) -> DataFrame:
        return gold.customer_360(self.customers, self.transactions)

    @cached_property
    def product_performance(self) -> DataFrame:
        """From the stored products where there are any; else products and performance share one pass over the sales fact, whose figures per product are staged."""
        if "products" in self.stored:
            return gold.product_performance(self.products, self.sales_lines, self.as_of)
        figures = gold.product_sales(self.sales_lines)
        staged = workspace(figures.sparkSession, "product-sales")
        figures.write.parquet(staged)
        figures = figures.sparkSession.read.schema(figures.schema).parquet(staged)
        products = silver.products_with(self.bronze["products"], gold.metrics_of(figures))
        return gold.product_performance_with(products, gold.performance_of(figures), self.as_of)

    @cached_property
    def store_analytics(self) -> DataFrame:
        return gold.store_analytics(self.bronze["stores"], self.transactions)

    @cached_property
    def mv_executive_summary(self) -> DataFrame:
        return analytics.executive_summary(self.daily_sales_summary)

    @cached_property
    def mv_category_performance(self) -> DataFrame:
        return analytics.category_performance(self.product_performance)

    def tables(self) -> dict[str, DataFrame]:
        """Silver and gold tables by ``layer.name``, in build order."""
        return {name: getattr(self, name.split(".")[1]) for name in LAYOUT if not name.startswith("bronze")}

    def publish(self, root: str) -> "Lake":
        """Write all silver and gold tables under ``root`` and return a lake that reads them.

        Each table is written from the written tables below it, so silver is computed once however many gold
        tables use it. Written rows carry the time of writing in ``processed_at``.
        """
        out = Lake(self.bronze, self.as_of)
        for name in LAYOUT:
            layer, table = name.split(".")
            if layer != "bronze":
                out.__dict__[table] = store(getattr(out, table).withColumn("processed_at", F.current_timestamp()), root, name).drop("processed_at")
                out.stored.add(table)
        return out

    @classmethod
    def open(cls, spark: SparkSession, root: str, bronze: Mapping[str, DataFrame], as_of: dt.date) -> "Lake":
        """A lake whose silver and gold tables were published under ``root`` before; bucketed tables are found in their buckets again."""
        out = cls(bronze, as_of)
        for name in LAYOUT:
            layer, table = name.split(".")
            if layer != "bronze":
                scan = T.load_bucketed(spark, f"{root}/{layer}/{table}", BUCKETS[name], LAYOUT[name][0]) if name in BUCKETS else T.load(spark, root, layer, table)
                out.__dict__[table] = scan.drop("processed_at")
                out.stored.add(table)
        return out

    def refresh_summaries(self, root: str) -> None:
        """Rebuild the two precomputed summaries under ``root`` from the current gold tables."""
        T.overwrite(analytics.executive_summary(self.daily_sales_summary), f"{root}/gold/mv_executive_summary")
        T.overwrite(analytics.category_performance(self.product_performance), f"{root}/gold/mv_category_performance")
