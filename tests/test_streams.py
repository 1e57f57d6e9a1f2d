"""Streams against batch, late rows, restarts, duplicates and joins."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallyhouse.sources import feed
from tallyhouse.streaming import clickstream as K
from tallyhouse.streaming import runner as R

from conftest import rows

T0 = dt.datetime(2024, 1, 1, 12, 0)
CLICK = ("event_id string, session_id string, customer_id bigint, event_type string, product_id bigint, page_url string, referrer string, "
         "device_type string, event_timestamp timestamp, event_properties string")


def click(i, minutes, kind="product_view", session="s", customer=1, product=1):
    return (f"e{i}", session, customer, kind, product, "/p", "google", "mobile", T0 + dt.timedelta(minutes=minutes), "{}")


def arrive(spark, path, *clicks):
    """One more file of events in the landing folder."""
    spark.createDataFrame(list(clicks), CLICK).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, max_files=1):
    return R.read_table(spark, path, spark.createDataFrame([], CLICK).schema, max_files)


@pytest.mark.parametrize("build", [K.session_metrics, K.product_trending, K.realtime_dashboard])
def test_complete_stream_equals_batch(spark, folder, build):
    batch = build(feed.clickstream(spark, folder))
    live = R.drain_complete(build(feed.shape_events(R.read_events(spark, folder))))
    exact = [c for c in batch.columns if not c.startswith(("unique_", "active_")) and c != "conversion_rate"]
    assert rows(live, *exact) == rows(batch, *exact)


def test_approximate_counts_stay_close(spark, folder):
    events = feed.clickstream(spark, folder)
    window = F.window("event_timestamp", "1 minute")
    exact = events.groupBy(window).agg(F.countDistinct("session_id").alias("s"), F.countDistinct("customer_id").alias("c"))
    both = K.realtime_dashboard(events).join(exact.select(F.col("window.end").alias("timestamp"), "s", "c"), "timestamp")
    for r in both.collect():
        assert abs(r.active_sessions - r.s) <= max(1, 0.15 * r.s) and abs(r.active_customers - r.c) <= max(1, 0.15 * r.c)


def test_conversion_rate_overflow_is_null_and_rounds_half_up(spark):
    df = spark.createDataFrame([click(i, 0, "checkout_complete") for i in range(20)], CLICK)
    got = K.session_metrics(df).first()
    assert got.unique_sessions == 1 and got.checkouts == 20 and got.conversion_rate is None


def test_late_rows_are_dropped_in_append_mode_only(spark, tmp_path):
    path = str(tmp_path / "in")
    for n, minutes in enumerate((0, 300, 600, 900)):
        arrive(spark, path, click(n, minutes))
    arrive(spark, path, click(9, 5))  # far behind the watermark by now
    arrive(spark, path, click(10, 1200))
    closed = R.drain_append(K.closed_windows(stream(spark, path)))
    first = closed.where(F.col("window_start") == F.lit(T0)).first()
    assert first.event_count == 1
    complete = R.drain_complete(K.closed_windows(stream(spark, path)))
    assert complete.where(F.col("window_start") == F.lit(T0)).first().event_count == 2


def test_restart_continues_exactly_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    arrive(spark, src, click(1, 0), click(2, 1))
    R.start_append(K.bronze(stream(spark, src)), out, ck, ["event_date", "event_hour"]).awaitTermination()
    arrive(spark, src, click(3, 2))
    for _ in range(2):  # the second run finds nothing new
        R.start_append(K.bronze(stream(spark, src)), out, ck, ["event_date", "event_hour"]).awaitTermination()
    got = spark.read.parquet(out)
    assert rows(got, "event_id") == [("e1",), ("e2",), ("e3",)]
    assert {"event_date", "event_hour"} <= set(got.columns)


def test_complete_versions_and_restart(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    arrive(spark, src, click(1, 0))
    R.start_complete(K.realtime_dashboard(stream(spark, src)), out, ck).awaitTermination()
    arrive(spark, src, click(2, 0))
    R.start_complete(K.realtime_dashboard(stream(spark, src)), out, ck).awaitTermination()
    assert rows(R.latest_version(spark, out), "events_per_minute") == [(2,)]


def test_stream_settings_are_put_back(spark, folder):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    R.drain_append(K.closed_windows(feed.shape_events(R.read_events(spark, folder))))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_redelivered_events_are_kept_once(spark, tmp_path):
    path = str(tmp_path / "in")
    arrive(spark, path, click(1, 0), click(2, 1))
    arrive(spark, path, click(1, 0), click(3, 2))
    arrive(spark, path, click(2, 1))
    assert rows(R.drain_append(K.deduplicated(stream(spark, path))), "event_id") == [("e1",), ("e2",), ("e3",)]


def test_enrichment_keeps_anonymous_and_unknown_customers(spark, tmp_path):
    path = str(tmp_path / "in")
    arrive(spark, path, click(1, 0, customer=1), click(2, 0, customer=None), click(3, 0, customer=99))
    customers = spark.createDataFrame([(1, "VIP", "CA", 5.0)], "customer_id bigint, customer_segment string, state string, lifetime_value double")
    got = R.drain_append(K.enriched(K.bronze(stream(spark, path)), customers), ["event_date"])
    assert rows(got, "event_id", "customer_segment", "customer_state") == [("e1", "VIP", "CA"), ("e2", None, None), ("e3", None, None)]


def test_view_to_purchase_pairs_lie_within_the_interval(spark, tmp_path):
    path = str(tmp_path / "in")
    arrive(
        spark, path, click(1, 0), click(2, 59), click(3, 61, "checkout_complete"), click(4, 60, "checkout_complete"),
        click(5, 120, "checkout_complete"), click(6, 30, "checkout_complete", session="other"), click(7, 0, "add_to_cart"),
    )
    got = R.drain_append(K.view_to_purchase(stream(spark, path), stream(spark, path), hours=1))
    assert rows(got, "view_id", "purchase_id") == [("e1", "e4"), ("e2", "e3"), ("e2", "e4")]


def test_sessions_end_after_a_pause(spark):
    df = spark.createDataFrame([click(1, 0), click(2, 29), click(3, 58, "checkout_complete"), click(4, 100), click(5, 0, customer=None)], CLICK)
    got = K.session_windows(df)
    assert rows(got, "event_count", "checkouts") == [(1, 0), (3, 1)]


def test_anomalies_cross_midnight_and_need_history(spark):
    start = dt.datetime(2024, 1, 1, 23, 30)
    steady = [(start + dt.timedelta(minutes=i), 10 + i % 2) for i in range(60)]
    spike = [(start + dt.timedelta(minutes=60), 50), (start + dt.timedelta(minutes=61), 11)]
    far = [(start + dt.timedelta(days=3), 500)]
    df = spark.createDataFrame(steady + spike + far, "timestamp timestamp, events_per_minute bigint")
    got = {r.timestamp: r for r in K.metric_anomalies(df).collect()}
    assert len(got) == 63
    assert [t for t, r in got.items() if r.is_anomaly] == [spike[0][0]]
    assert got[spike[0][0]].mean_before == 10.5
    assert got[far[0][0]].mean_before is None and got[start].mean_before is None


def test_json_orders_follow_the_declared_schema(spark, tmp_path):
    docs = [
        {"order_id": "o1", "customer_id": 1, "order_date": "2024-01-01", "items": [{"product_id": 1, "quantity": 2, "price": 1.5}, {"product_id": 2}],
         "total_amount": 3.0, "status": "new", "shipping_address": {"city": "Springfield", "zip": "01234"}, "unexpected": True},
        {"order_id": "o2", "customer_id": 2, "order_date": "2024-01-02"},
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, docs)))
    got = R.drain_append(K.flatten_orders(R.read_orders_json(spark, str(tmp_path / "in"))))
    assert rows(got, "order_id", "product_id", "quantity", "price", "city", "zip") == [
        ("o1", 1, 2, 1.5, "Springfield", "01234"), ("o1", 2, None, None, "Springfield", "01234"), ("o2", None, None, None, None, None)]


def test_orders_land_compressed(spark, folder, tmp_path, monkeypatch):
    from checks import registry

    monkeypatch.setattr(registry, "workspace", lambda spark, label: str(tmp_path / label))
    registry.REGISTRY["orders_json_flatten"](spark, folder)
    landed = [f.name for f in tmp_path.glob("landing/part-*")]
    assert landed and all(n.endswith(".json.gz") for n in landed)
