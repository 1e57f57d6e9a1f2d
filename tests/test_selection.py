"""Exact percentiles without ranking, sessions in two levels."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import reports
from tallyhouse.streaming import clickstream as K

from conftest import rows
from test_streams import CLICK, click


@pytest.mark.parametrize("share", [(95, 100), (1, 2), (0, 1), (999, 1000)])
def test_value_at_share_equals_the_sorted_list(spark, share):
    rng = random.Random(4)
    groups = {
        "many": [rng.random() for _ in range(60_000)], "ties": [float(rng.choice([1, 2, 2, 2, 9])) for _ in range(50_000)], "odd": [1.0] * 40_000 + [1e12],
        "few": [3.0, 1.0], "one": [7.0], "nulls": [None] * 5 + [4.0, 2.0], "nothing": [None, None], None: [2.0, 1.0, 5.0],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double").repartition(8)
    got = {r.g: r.p for r in reports.value_at_share(df, "g", "v", share, "p").collect()}
    order = lambda v: (v is None, v)
    want = {g: (sorted(vs, key=order) + [None])[math.floor(len(vs) * share[0] / share[1])] for g, vs in groups.items()}
    assert got == want


def test_no_row_is_ranked_or_staged(spark):
    df = spark.range(100).select("id", F.lit("q").alias("query"), F.rand(1).alias("elapsed"))
    text = reports.latency_summary(df)._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in text and "FileScan" not in text
    assert reports.latency_summary(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_sessions_by_slot_equal_session_windows(spark, seed):
    rng = random.Random(seed)
    clicks, n = [], 0
    for customer in [None, 1, 2, 3, 4]:
        at = 0.0
        for _ in range(400 if customer == 1 else 60):  # a hot customer
            at += rng.choice([0, 0.5, 1, 5, 29, 29.5, 30, 30.5, 31, 59, 60, 90, 200, 360, 1000])
            clicks.append(click(n, at, rng.choice(["product_view", "checkout_complete"]), customer=customer))
            n += 1
    df = spark.createDataFrame(clicks, CLICK)
    for hours in (1, 2, 6):
        assert rows(K.sessions_by_slot(df, slot_hours=hours)) == rows(K.session_windows(df))
    with pytest.raises(ValueError, match="two gaps"):
        K.sessions_by_slot(df, 31, 1)
    assert K.sessions_by_slot(df.limit(0)).count() == 0
