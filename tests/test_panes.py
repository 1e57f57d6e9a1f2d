"""Panes with sketches: sliding windows in append mode, released state, replaced versions."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tallyhouse.sources import feed, tables
from tallyhouse.streaming import clickstream as K
from tallyhouse.streaming import runner as R

from conftest import rows
from test_streams import T0, arrive, click, stream


@pytest.mark.parametrize("build, parts, of", [
    (K.session_metrics, K.session_panes, K.session_metrics_of),
    (K.product_trending, K.product_panes, K.product_trending_of),
    (K.realtime_dashboard, K.dashboard_panes, K.dashboard_of),
])
def test_windows_from_panes_equal_windows_from_events(spark, folder, build, parts, of):
    events = feed.clickstream(spark, folder)
    whole, made = build(events), of(parts(events))
    assert made.columns == whole.columns
    exact = [c for c in whole.columns if not c.startswith(("unique_", "active_")) and c != "conversion_rate"]
    assert rows(made, *exact) == rows(whole, *exact)


def test_sketches_of_panes_count_a_session_once_and_stay_close(spark):
    events = spark.range(40_000).select(
        F.concat(F.lit("s"), F.pmod(F.hash("id"), F.lit(9000)).cast("string")).alias("session_id"), F.lit(None).cast("bigint").alias("customer_id"),
        F.lit("product_view").alias("event_type"), F.lit("mobile").alias("device_type"), F.lit("google").alias("referrer"),
        (F.lit(T0).cast("timestamp") + F.make_dt_interval(secs=F.pmod(F.col("id"), F.lit(300)).cast("decimal(18,6)"))).alias("event_timestamp"))
    exact = events.select("session_id").distinct().count()
    window = K.session_metrics_of(K.session_panes(events)).where(F.col("window_start") == F.lit(T0)).first()
    assert window.event_count == 40_000 and window.unique_customers == 0
    assert abs(window.unique_sessions - exact) < 0.05 * exact  # three standard deviations of the sketch
    week = K.distinct_over(K.session_panes(events), "week", "sessions").first()
    assert week.distinct_values == window.unique_sessions


def test_a_window_must_be_whole_panes(spark, folder):
    with pytest.raises(ValueError, match="whole number of panes"):
        K.slide(K.session_panes(feed.clickstream(spark, folder)), ["device_type", "referrer"], 5, 2, {})


def test_closed_panes_are_written_once_and_state_stays_small(spark, tmp_path):
    path, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    for day in range(8):
        arrive(spark, path, *(click(100 * day + i, 1440 * day + i) for i in range(10)))
    query = R.start_append(K.session_panes(stream(spark, path)), out, ck, state_partitions=2)
    query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in map(dict, query.recentProgress) if p["stateOperators"]]
    assert max(kept) <= 20 and kept[-1] <= 10  # a day or two of panes, not eight
    panes = spark.read.parquet(out)
    assert panes.count() == 70 == panes.select("pane_start", "device_type", "referrer").distinct().count()
    arrive(spark, path, click(999, 3))  # far behind the watermark: dropped, its pane is closed
    arrive(spark, path, click(1000, 1440 * 9))
    R.start_append(K.session_panes(stream(spark, path)), out, ck, state_partitions=2).awaitTermination()
    again = spark.read.parquet(out)
    assert again.count() == 80 and again.agg(F.sum("event_count")).first()[0] == 80
    batch = K.session_metrics(spark.read.parquet(path).where("event_id NOT IN ('e999', 'e1000')"))
    assert rows(K.session_metrics_of(again), "window_start", "event_count", "product_views") == rows(batch, "window_start", "event_count", "product_views")


def test_replaced_versions_are_deleted(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    for n in range(5):
        arrive(spark, src, click(n, n))
    R.start_complete(K.realtime_dashboard(stream(spark, src)), out, ck).awaitTermination()
    assert tables.marks(spark, f"{out}/committed") == [3, 4]
    assert sorted(os.listdir(f"{out}/data")) == ["version=3", "version=4"]
    assert R.latest_version(spark, out).count() == 5
    os.makedirs(f"{out}/data/version=5")  # written, never committed
    assert R.latest_version(spark, out).count() == 5
    assert tables.marks(spark, str(tmp_path / "none")) == []


def test_empty_stream_and_null_keys(spark, tmp_path):
    empty = spark.createDataFrame([], stream(spark, str(tmp_path)).schema)
    assert K.session_metrics_of(K.session_panes(empty)).count() == 0
    odd = spark.createDataFrame([(None,) * 8 + (T0, None)] * 3, empty.schema)
    assert [(r.event_count, r.unique_sessions, r.conversion_rate) for r in K.session_metrics_of(K.session_panes(odd)).collect()] == [(3, 0, None)] * 5
    assert K.dashboard_of(K.dashboard_panes(odd)).first().timestamp == T0 + dt.timedelta(minutes=1)
