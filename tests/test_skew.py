"""Paths taken for hot keys and oversized groups give what the plain ones give."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.baskets import pair_support
from tallyhouse.operators.changes import dedup_latest, delete_keys
from tallyhouse.operators.skew import spread_join
from tallyhouse.sources.tables import overwrite

from conftest import rows


def brute_pairs(baskets, support):
    seen = Counter()
    for items in baskets.values():
        seen.update(itertools.combinations(sorted(items), 2))
    return sorted((a, b, n) for (a, b), n in seen.items() if n >= support)


@pytest.mark.parametrize("seed, items_per_block, support", [(1, 3, 2), (2, 3, 3), (3, 5, 4), (4, 1, 2), (5, 1000, 3), (6, 2, 3)])
def test_pair_support_with_huge_baskets(spark, seed, items_per_block, support):
    rng = random.Random(seed)
    baskets = {b: set(rng.choices(range(25), k=rng.randint(1, 4))) for b in range(60)}
    baskets |= {100 + b: set(rng.sample(range(25), rng.randint(6, 20))) for b in range(5)}
    baskets[999] = set(range(25))
    counts = Counter(i for items in baskets.values() for i in items)
    kept = [(b, i) for b, items in baskets.items() for i in items if counts[i] >= support]
    frame = spark.createDataFrame(kept, "basket bigint, item bigint")
    got = pair_support(frame, support, items_per_block=items_per_block)
    assert sorted((r.item_a, r.item_b, r.support) for r in got.collect()) == brute_pairs(baskets, support)


def facts(spark):
    return spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 40).cast("bigint").alias("k"))


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_spread_join_equals_plain_join(spark, how, threshold):
    keyed = spark.range(20).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plain = facts(spark).join(keyed, "k", how)
        spread = spread_join(facts(spark), keyed, "k", ["id"], how)
        assert sorted(spread.columns) == sorted(plain.columns)
        assert rows(spread.select(plain.columns)) == rows(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_dedup_keeps_one_row_per_task_before_the_shuffle(spark):
    df = dedup_latest(facts(spark), ["k"], [F.desc("id")])
    assert df._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert rows(df.where("k = 7"), "id") == [(2997,)]
    assert df.where("k IS NULL").first().id == 2998


def test_delete_keeps_rows_without_key(spark):
    doomed = spark.createDataFrame([(7,), (7,), (None,)], "k bigint")
    left = delete_keys({"t": (facts(spark), ["id"])}, doomed, "k")["t"]
    want = facts(spark).where("k IS NULL OR k <> 7")
    assert rows(left.select("id", "k")) == rows(want)


def test_hot_folder_is_written_by_many_tasks(spark, tmp_path):
    df = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"),
                                     F.when(F.col("id") % 10 < 9, "2001-08").otherwise("2001-07").alias("year_month"))
    path, key = str(tmp_path / "t"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "1MB")
    try:
        overwrite(df.repartition(8), path, ["year_month"], ["id"])
    finally:
        spark.conf.unset(key)
    files = {m: n for m, n in 
             spark.read.parquet(path).select("year_month", F.input_file_name().alias("f")).groupBy("year_month").agg(F.countDistinct("f")).collect()}
    assert files["2001-08"] > 4
    assert spark.read.parquet(path).count() == 200_000


def test_pairs_are_dealt_out_by_their_number(spark, monkeypatch):
    from tallyhouse.operators import baskets as B

    df = spark.range(400).selectExpr("id div 20 AS basket", "id % 20 AS item")
    monkeypatch.setattr(B, "TASK_ROWS", 100, raising=False)
    found = B.pair_support(df, 20)
    text = found._jdf.queryExecution().executedPlan().toString()
    pairs = 20 * 20 * 19 // 2
    assert f", {pairs // 100}), REPARTITION_BY_NUM" in text
    assert found.count() == 190 and found.agg({"support": "sum"}).first()[0] == pairs
    assert B.pair_support(df.limit(0), 1).count() == 0
