"""Clustering by quantiles: an odd value far off does not undo it."""

import random

from pyspark.sql import functions as F

from tallyhouse.operators import layout
from tallyhouse.plans.lake import Lake
from tallyhouse.sources import feed, tables

from conftest import rows


def table(spark, n=20_000):
    return spark.range(n).select(
        F.col("id"), F.when(F.col("id") == 77, F.lit(10**12)).otherwise(F.pmod(F.hash("id"), F.lit(5000))).cast("bigint").alias("k"),
        F.when(F.col("id") == 78, "\U0001f600 odd").otherwise(F.concat(F.lit("a common start "), F.lpad(F.pmod(F.hash("id", F.lit(1)), F.lit(900)).cast("string"), 4, "0"))).alias("s"))


def test_bounds_split_ordinary_values(spark):
    bounds = layout.quantile_bounds(table(spark), ["k", "s"])
    assert len(bounds["k"]) == 255 and max(bounds["k"]) < 5000
    assert len(bounds["s"]) > 200 and all(b.startswith("a common start") for b in bounds["s"])
    sizes = [r["count"] for r in table(spark).groupBy(layout.bucket_by(F.col("k"), bounds["k"], "bigint").alias("b")).count().collect()]
    assert len(sizes) == 256 and max(sizes) < 3 * 20_000 / 256


def test_bucket_counts_bounds_at_or_below_the_value(spark):
    rng = random.Random(1)
    for size in (0, 1, 2, 3, 5, 8, 31):
        bounds = sorted(rng.sample(range(100), size))
        values = [None, -1, 0, 50, 99, 100, *bounds]
        df = spark.createDataFrame([(v,) for v in values], "v bigint")
        got = {r.v: r.b for r in df.select("v", layout.bucket_by(F.col("v"), bounds, "bigint").alias("b")).collect()}
        assert got == {v: sum(b <= v for b in bounds) if v is not None else 0 for v in values}


def test_hot_value_null_and_empty(spark):
    df = spark.createDataFrame([(None, None)] * 5 + [(7, "x")] * 50 + [(i, f"y{i}") for i in range(20)], "k int, s string")
    bounds = layout.quantile_bounds(df, ["k", "s"], 3)
    assert len(set(bounds["k"])) == len(bounds["k"]) <= 7 and 7 in bounds["k"]
    assert rows(layout.quantile_key(df, ["k", "s"], 3).drop("z_key")) == rows(df)
    empty = df.limit(0)
    assert layout.quantile_bounds(empty, ["k", "s"], 3) == {"k": [], "s": []}
    assert layout.quantile_key(empty, ["k", "s"], 3).count() == 0
    assert layout.quantile_key(df.where("k IS NULL"), ["k", "s"], 3).select("z_key").distinct().collect()[0][0] == 0


def test_filters_read_few_files_though_one_value_is_odd(spark, tmp_path):
    df, path = table(spark), str(tmp_path / "c")
    layout.cluster_write(df, path, ["k", "s"], files=64)
    scan = spark.read.parquet(path)
    assert rows(scan) == rows(df)
    assert layout.files_to_read(scan, "k", 0, 10**13) == (64, 64)
    hit, files = layout.files_to_read(scan, "k", 100, 200)
    assert files == 64 and hit <= 24
    assert layout.files_to_read(scan, "s", "a common start 0100", "a common start 0110")[0] <= 24
    equal = layout.zorder_key(df, ["k"])  # equal widths put all ordinary values into one bucket
    assert equal.where("k < 5000").select("z_key").distinct().count() == 1


def test_published_tables_are_clustered(spark, folder, tmp_path):
    lake = Lake(feed.materialise(spark, folder, str(tmp_path)), feed.AS_OF)
    lake.publish(str(tmp_path))
    for name in ("silver.customers", "gold.customer_360"):
        assert rows(tables.load(spark, str(tmp_path), *name.split(".")).drop("processed_at")) == rows(lake.tables()[name])
