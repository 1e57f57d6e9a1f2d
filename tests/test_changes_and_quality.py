"""Upserts, change feeds, states, quality rules, layout, governance, sinks."""

import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse import session
from tallyhouse.functions.columns import bucket_of, surrogate_key
from tallyhouse.operators import changes, governance, grid, layout, quality, reports
from tallyhouse.sources import feed, tables
from tallyhouse.plans.lake import Lake

from conftest import rows

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
TABLE = st.dictionaries(st.integers(0, 12), st.one_of(st.none(), st.integers(0, 3)), max_size=10)
KV = "k bigint, v bigint"


def frame(spark, table):
    return spark.createDataFrame(list(table.items()), KV)


@FEW
@given(base=TABLE, updates=TABLE)
def test_merge_replaces_and_adds(spark, base, updates):
    merged = changes.merge_upsert(frame(spark, base), frame(spark, updates), ["k"])
    assert dict(rows(merged)) == {**base, **updates} and merged.count() == len({**base, **updates})


def test_merge_refuses_two_rows_for_a_key(spark):
    twice = spark.createDataFrame([(1, 1), (1, 2)], KV)
    with pytest.raises(ValueError):
        changes.merge_upsert(frame(spark, {1: 0}), twice, ["k"])


@FEW
@given(old=TABLE, new=TABLE)
def test_feed_turns_old_into_new(spark, old, new):
    feed_rows = [tuple(r) for r in changes.change_feed(frame(spark, old), frame(spark, new), ["k"]).collect()]
    state = dict(old)
    for k, v, kind in feed_rows:
        if kind in ("delete", "update_preimage"):
            assert state.pop(k) == v
    for k, v, kind in feed_rows:
        if kind in ("insert", "update_postimage"):
            state[k] = v
    assert state == new
    changed = sum(k in old and k in new and old[k] != new[k] for k in {**old, **new})
    assert Counter(kind for *_, kind in feed_rows)["update_preimage"] == changed


@FEW
@given(log=st.lists(st.tuples(st.integers(0, 4), st.booleans()), max_size=15), cut=st.integers(0, 15))
def test_state_as_of_replays_the_log(spark, log, cut):
    entries = [(k, i, "delete" if gone else "upsert") for i, (k, gone) in enumerate(log)]
    df = spark.createDataFrame(entries, "k bigint, version bigint, op string")
    want = {}
    for k, i, op in entries:
        if i <= cut:
            want[k] = (i, op)
    got = changes.state_as_of(df, ["k"], "version", cut, F.col("op") == "delete")
    assert rows(got, "k", "version") == sorted((k, i) for k, (i, op) in want.items() if op == "upsert")


@FEW
@given(values=st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=1, max_size=12))
def test_quarantine_splits_the_input(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i bigint, v bigint")
    rules = {"positive": F.col("v") > 0, "small": F.col("v") < 3}
    marked = quality.quarantine(df, rules)
    good, bad = marked.where("is_ok"), marked.where("NOT is_ok")
    assert rows(good, "i") == sorted((i,) for i, v in enumerate(values) if v is None or 0 < v < 3)
    assert good.count() + bad.count() == len(values)
    counted = {r.constraint: r.violations for r in quality.check_constraints(df, rules).collect()}
    assert counted == {"positive": sum(v is not None and v <= 0 for v in values), "small": sum(v is not None and v >= 3 for v in values)}
    assert quality.pass_rate(df, rules).first().passed_rows == good.count()


def test_violations_orphans_and_negative_amounts(spark):
    df = spark.createDataFrame([(1, -1), (2, 0), (None, 5)], KV)
    assert quality.violations(df, "t", "Negative", F.col("v") < 0).first().violation_count == 1
    assert quality.violations(df, "t", "NULL", F.col("k").isNull()).first().violation_count == 1
    parents = spark.createDataFrame([(1,)], "k bigint")
    assert quality.orphans(df, parents, "k", "t").first().violation_count == 2
    assert quality.orphans(df.limit(0), parents, "k", "t").first().violation_count == 0


def test_column_stats_with_distinct_estimate(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10).cast("string").alias("t"), F.when(F.col("id") < 5, 1).alias("n"))
    got = {r.column_name: r for r in quality.column_stats(df).collect()}
    assert got["t"].approx_distinct == 10 and abs(got["id"].approx_distinct - 1000) <= 100
    assert got["n"].null_count == 995 and (got["id"].min_value, got["id"].max_value) == ("0", "999") and got["t"].avg_length == 1.0


def test_timeliness(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "ts timestamp")
    for hours, late in ((24, False), (25, True)):
        got = quality.timeliness({"t": (df, "ts")}, dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)).first()
        assert (got.lag_hours, got.is_late) == (hours, late)
    assert quality.timeliness({"t": (df.limit(0), "ts")}, dt.datetime(2024, 1, 1)).first().is_late is None


# --- governance -------------------------------------------------------------------------------------

def secure(spark, groups):
    c = spark.createDataFrame(
        [(1, "anna@b.org", "15551234567"), (2, "bad-2", None), (3, None, "12")], "customer_id bigint, email string, phone string"
    ).withColumns({n: F.lit("x") for n in ("first_name", "last_name", "state", "customer_segment", "tenure_category")})
    g = c.select("customer_id", *[F.lit(1).alias(n) for n in ("total_transactions", "total_spend", "avg_order_value", "rfm_score", "value_segment", "preferred_channel")])
    return rows(governance.customer_360_secure(c, g.where("customer_id < 9"), groups), "customer_id", "email", "phone")


def test_contact_data_is_masked_for_all_but_admins(spark):
    assert secure(spark, {"data_admins"}) == [(1, "anna@b.org", "15551234567"), (2, "bad-2", None), (3, None, "12")]
    assert secure(spark, set()) == [(1, "ann***@b.org", "***-***-4567"), (2, None, None), (3, None, "***-***-12")]


def test_row_filter(spark):
    df = spark.createDataFrame([("CA",), ("NY",), (None,)], "state string")
    assert governance.store_analytics_secure(df, {"data_admins"}).count() == 3
    assert rows(governance.store_analytics_secure(df, {"region_ca", "x"})) == [("CA",)]
    assert governance.store_analytics_secure(df, set()).count() == 0


def test_encryption_round_trip_and_pseudonyms(spark):
    df = spark.createDataFrame([(1, "a@b.c"), (2, None)], "k bigint, email string")
    key = spark.createDataFrame([("0123456789abcdef",)], "key string").select("key").scalar()
    closed = governance.encrypt_columns(df, ["email"], key)
    assert "0123456789abcdef" not in closed._jdf.queryExecution().toString()
    assert closed.where("email = 'a@b.c'").count() == 0
    assert rows(governance.decrypt_columns(closed, ["email"], key)) == rows(df)
    p = df.select(governance.pseudonym(F.col("email"), "s").alias("p"), governance.pseudonym(F.col("email"), "t").alias("q")).collect()
    assert len(p[0].p) == 64 and p[0].p != p[0].q and p[1].p is None


def test_tag_lookups(spark):
    tags = governance.tag_catalog(spark)
    assert rows(governance.pii_tables(tags), "table_name") == [("customer_360",)]
    assert governance.pii_columns(tags).count() == 4
    assert [r.domain for r in governance.tables_by_domain(tags).collect()] == ["customer", "product", "sales", "store"]
    assert {r.table_count for r in governance.tag_summary(tags).collect()} == {4}


# --- layout, sinks, sources, reports ------------------------------------------------------------------

def test_clustered_files_skip_on_both_columns_and_split_equal_keys(spark, tmp_path):
    df = spark.range(8000).select(
        (F.xxhash64("id") % 1000).alias("a"), (F.xxhash64("id", F.lit(1)) % 1000).alias("b"), "id")
    path = str(tmp_path / "z")
    layout.cluster_write(df, path, ["a", "b"], files=16)
    back = spark.read.parquet(path)
    assert rows(back) == rows(df)
    spans = back.groupBy(F.input_file_name()).agg((F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b"))
    a, b = spans.agg(F.avg("a"), F.avg("b")).first()
    assert a < 1300 and b < 1300  # a whole file spans about 2000 when unclustered
    one = str(tmp_path / "same")
    layout.cluster_write(df.withColumns({"a": F.lit(1), "b": F.lit(1)}), one, ["a", "b"], files=8)
    sizes = [r[1] for r in spark.read.parquet(one).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 8000 / 8


def test_z_key_interleaves_bits_of_any_type(spark):
    df = spark.createDataFrame([(0, "a", dt.date(2001, 1, 1)), (255, "z", dt.date(2001, 9, 13)), (None, None, None)], "x int, s string, d date")
    assert [r[0] for r in layout.zorder_key(df, ["x", "d"]).select("z_key").collect()] == [0, 0xFFFF, 0]
    low, high, none = [r[0] for r in layout.zorder_key(df, ["s"]).select("z_key").collect()]
    assert low == 0 and high == 255 and none == 0


def test_sinks_merge_schema_and_replace(spark, tmp_path):
    path = f"{tmp_path}/bronze/t"
    tables.overwrite(spark.range(3).select("id", F.lit("m").alias("p")), path, ["p"], ["id"])
    tables.append(spark.range(2).select("id", F.lit(1.5).alias("extra"), F.lit("n").alias("p")), path, ["p"])
    merged = tables.load(spark, str(tmp_path), "bronze", "t", merge_schema=True)
    assert set(merged.columns) == {"id", "extra", "p"} and merged.where("extra IS NULL").count() == 3
    tables.overwrite(spark.range(1).select(F.col("id").alias("other")), path)
    assert tables.load(spark, str(tmp_path), "bronze", "t").columns == ["other"]


def test_declared_schema_splits_good_and_bad(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": "one"}',), ("not json",), ('{"b": null}',)], "line string")
    got = tables.split_by_schema(df, "line", "a int, b string")
    assert [r.is_valid for r in got.collect()] == [True, False, False, True]


def test_workspace_uses_the_shared_folder_of_the_cluster():
    class Conf:
        def __init__(self, root):
            self.root = root

        def get(self, key, default=None):
            assert key == "spark.checkpoint.dir"
            return self.root or default

    class Session:
        def __init__(self, root):
            self.conf = Conf(root)

    assert session.workspace(Session("s3a://bucket/tmp/"), "x").startswith("s3a://bucket/tmp/x-")
    assert "tallyhouse-" in session.workspace(Session(None), "x")


def test_grids(spark):
    df = spark.createDataFrame([(dt.date(2001, 1, 1), 5), (dt.date(2001, 1, 4), 7)], "d date, v int")
    spine = grid.calendar_spine(df, "d", {"n": F.count(F.lit(1)), "v": F.sum("v")})
    assert [tuple(r)[1:] for r in spine.orderBy("d").collect()] == [(1, 5), (0, 0), (0, 0), (1, 7)]
    times = spark.createDataFrame([(1, 2), (2, 0), (3, None), (4, -1)], "k int, n int")
    assert rows(grid.expand_rows(times, "n"), "k", "item_seq") == [(1, 1), (1, 2)]
    products = spark.range(3).select(F.col("id").alias("product_id"))
    sites = spark.createDataFrame([("w9",), ("w1",)], "warehouse_id string")
    facts = spark.createDataFrame([(0, "w9", dt.date(2001, 1, 1), 4), (1, "w1", dt.date(2001, 1, 2), 6)],
                                  "product_id bigint, warehouse_id string, snapshot_date date, q int")
    got = grid.product_site_day_grid(products, sites, facts, ["q"])
    assert got.count() == 12 and got.agg(F.sum("q")).first()[0] == 10
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert grid.product_site_day_grid(products, sites, facts.limit(0), ["q"]).count() == 0


def test_run_and_latency_reports(spark):
    runs = spark.createDataFrame([(1, "j", 0, 7_200_000, "SUCCESS"), (2, "j", 0, 7_200_001, "FAILED"), (3, "j", 0, None, None)],
                                 "run_id bigint, job string, start_time bigint, end_time bigint, result_state string")
    assert [(r.duration_seconds, r.sla_breach) for r in reports.run_sla_report(runs, 7200).orderBy("run_id").collect()] == [
        (7200.0, False), (7200.001, True), (None, None)]
    timings = spark.createDataFrame([(i, "a" if i < 40 else "b", float(i % 40)) for i in range(45)], "id bigint, query string, elapsed double")
    for _ in range(2):
        got = {r["query"]: r for r in reports.latency_summary(timings).collect()}
        assert (got["a"].p95_elapsed, got["a"].avg_elapsed, got["a"].max_elapsed) == (38.0, 19.5, 39.0)
        assert (got["b"].p95_elapsed, got["b"].min_elapsed) == (4.0, 0.0)


def test_session_catalogue(spark):
    tables.register_views({"silver.demo_a": spark.range(1), "gold.demo_b": spark.range(1)})
    assert reports.registered_tables(spark, "silver_demo").first().table_count == 1


def test_keys_and_buckets(spark):
    df = spark.createDataFrame([(5,), (105,), (-95,)], "k int")
    assert {r[0] for r in df.select(bucket_of(F.col("k"), [(5, "a"), (20, "b")], "c")).collect()} == {"b"}
    key = df.select(surrogate_key(F.col("k")).alias("s")).first().s
    assert key.startswith("evt_") and len(key) == 20


def test_published_lake_equals_the_lazy_one(spark, folder, tmp_path):
    lazy = Lake(feed.materialise(spark, folder, str(tmp_path)), feed.AS_OF)
    written = lazy.publish(str(tmp_path))
    opened = Lake.open(spark, str(tmp_path), lazy.bronze, feed.AS_OF)
    for name, df in lazy.tables().items():
        for other in (written, opened):
            assert rows(other.tables()[name].select(df.columns)) == rows(df), name
    opened.refresh_summaries(str(tmp_path))
    assert rows(tables.load(spark, str(tmp_path), "gold", "mv_executive_summary")) == rows(lazy.mv_executive_summary)


def test_merge_takes_null_keys_as_equal(spark):
    old, new = spark.createDataFrame([(None, 1), (2, 2)], KV), spark.createDataFrame([(None, 5)], KV)
    assert rows(changes.merge_upsert(old, new, ["k"])) == [(None, 5), (2, 2)]


def test_change_feed_sees_columns_of_both_tables(spark):
    old = spark.createDataFrame([(1, "a"), (3, "c"), (None, "n")], "k bigint, v string")
    new = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, "c", None), (None, "m", 7)], "k bigint, v string, extra bigint")
    got = sorted((tuple(r) for r in changes.change_feed(old, new, ["k"]).collect()), key=str)
    assert got == sorted([
        (1, "a", None, "update_preimage"), (1, "a", 5, "update_postimage"), (2, "b", 6, "insert"),
        (None, "n", None, "update_preimage"), (None, "m", 7, "update_postimage"),
    ], key=str)
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k bigint, v string")
    with pytest.raises(Exception, match="more than one row"):
        changes.change_feed(twice, new, ["k"]).collect()


def test_text_with_a_common_start_is_still_ordered(spark):
    from tallyhouse.operators.layout import zorder_key

    df = spark.createDataFrame([(f"SKU-ABC-{i:02d}", i / 100) for i in range(100)], "s string, x double")
    assert zorder_key(df, ["s"]).select("z_key").distinct().count() > 8
    assert zorder_key(df, ["x"]).select("z_key").distinct().count() > 90


def test_ranks_of_text_and_dates(spark):
    from tallyhouse.operators.ranking import ranked

    df = spark.createDataFrame([(1, "b"), (2, None), (3, "c"), (4, "c")], "id bigint, v string")
    assert [(r.id, r.r) for r in ranked(df, "r", "v", "id").orderBy("r").collect()] == [(3, 1), (4, 2), (1, 3), (2, 4)]
