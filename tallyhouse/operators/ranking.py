"""Row numbers over groups that may be too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.session import workspace


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order_by``.

    The ``row_number = 1`` filter lets Spark keep only the leading row of each key in every map task
    (window group limit), so a key with a third of all rows still shuffles one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def ranked(
    df: DataFrame, name: str, value: str, unique_key: str, partition_by: Sequence[str] = (), *, ascending: bool = False
) -> DataFrame:
    """Add ``name``, the row number (long) ordered by ``value`` (NULLs last), ties by ``unique_key``.

    Spark deals the rows out in ranges of (groups, value, key), as many as there are shuffle partitions, and they are
    written once to the shared working folder with the number of their range. Rows are numbered inside each (group, range)
    in parallel; the sizes of the ranges before it give each range its offset. Where the ranges are cut only decides how
    work is divided. No group, however large, has to fit one task.
    """
    value_order = F.col(value).asc_nulls_last() if ascending else F.col(value).desc_nulls_last()
    order, groups = [value_order, F.col(unique_key)], list(partition_by)
    spark, staged = df.sparkSession, workspace(df.sparkSession, "ranking")
    dealt = df.repartitionByRange(*groups, *order).withColumn("_range", F.spark_partition_id())
    dealt.write.parquet(staged)
    ranged = spark.read.schema(dealt.schema).parquet(staged)
    sizes = ranged.groupBy(*groups, "_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*groups, "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    local = Window.partitionBy(*groups, "_range").orderBy(*order)
    numbered = ranged.withColumn("_local", F.row_number().over(local))
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in [*groups, "_range"]]
    joined = numbered.alias("n").join(offsets.alias("o"), same)
    return joined.select(*[F.col(f"n.{c}") for c in df.columns], (F.col("n._local") + F.col("o._offset")).alias(name))
