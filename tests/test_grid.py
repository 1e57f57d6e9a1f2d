"""Grids: what an explode multiplies is not sent to every executor."""

from pyspark.sql import functions as F

from tallyhouse.operators import grid

from conftest import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_the_sites_are_sent(spark, tmp_path):
    products = spark.createDataFrame([(1,), (2,), (2,), (None,)], "product_id bigint")
    sites = spark.createDataFrame([(7,), (8,), (None,)], "warehouse_id int")
    slots = spark.createDataFrame([(1, 7, 3), (2, 8, 4), (None, 7, 9)], "product_id bigint, warehouse_id int, q int")
    slots.write.parquet(f"{tmp_path}/slots")
    facts = spark.read.parquet(f"{tmp_path}/slots").select("*", F.explode(F.expr("array(DATE'2001-07-30', DATE'2001-07-31')")).alias("snapshot_date"))
    found = grid.product_site_day_grid(products, sites, facts, ["q"])
    text = plan(found)
    assert text.count("SortMergeJoin") >= 1 and "LeftOuter, BuildRight" not in text
    assert "Inner, BuildLeft" not in text
    got = rows(found.groupBy("product_id", "warehouse_id").agg(F.sum("q").alias("q"), F.count(F.lit(1)).alias("n")))
    assert got == sorted([(p, s, (3 if (p, s) == (1, 7) else 8 * 2 if (p, s) == (2, 8) else 0) * (1 if p == 2 else 2), 4 if p == 2 else 2)
                          for p in (1, 2, None) for s in (7, 8, None)], key=lambda t: tuple((v is not None, v) for v in t))
