"""Stored tables: touched partitions only, marks, versions, comparison by digests, states from snapshots."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import changes, stored

from conftest import rows


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def table(spark, tmp_path):
    df = spark.range(600).select(
        F.when(F.col("id") == 599, None).otherwise(F.col("id")).alias("k"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("x"),
        (F.lit(dt.datetime(2001, 1, 1)) + F.make_dt_interval(days=(F.col("id") / 100).cast("int"))).alias("ts"),
        F.when(F.col("id") >= 550, None).otherwise(F.concat(F.lit("2001-0"), (F.col("id") / 100).cast("int") + 1)).alias("year_month"))
    out = stored.StoredTable(spark, str(tmp_path / "t"), ["year_month"])
    assert out.overwrite(df) == 0
    return out, df


def test_delete_rewrites_touched_partitions_only(spark, table):
    t, df = table
    assert t.read().columns == df.columns and rows(t.read()) == rows(df)
    before = files(t.path + "/data")
    doomed = spark.createDataFrame([(5,), (7,), (5,), (None,), (777,)], "k bigint")
    assert t.delete(doomed, "k") == 1
    after = files(t.path + "/data")
    assert before.items() <= after.items()  # nothing was changed in place
    assert {f.split("/data/")[1].split("/part")[0] for f in after.keys() - before.keys()} == {"v=1/year_month=2001-01"}
    assert rows(t.read()) == rows(df.where("k IS NULL OR k NOT IN (5, 7)"))
    assert rows(t.read(0)) == rows(df)
    assert t.delete(spark.createDataFrame([(888,)], "k bigint"), "k") == 1 and t.versions() == [0, 1]


def test_deleted_partition_disappears(spark, table):
    t, df = table
    t.delete(df.where("year_month = '2001-02'").select("k"), "k")
    assert rows(t.read()) == rows(df.where("year_month IS NULL OR year_month <> '2001-02'"))
    t.delete(df.select("k"), "k")
    assert rows(t.read(), "k") == [(None,)]


def test_upsert_moves_rows_and_takes_null_keys_as_equal(spark, table):
    t, df = table
    new = spark.createDataFrame(
        [(1, "moved", None, "2001-05"), (None, "null key", None, None), (9000, "new", None, "2002-01"), (150, "same", None, "2001-02")], df.schema)
    before = files(t.path + "/data")
    assert t.upsert(new, ["k"]) == 1
    assert rows(t.read()) == rows(changes.merge_upsert(df, new, ["k"]))
    fresh = {f.split("/data/")[1].split("/part")[0] for f in files(t.path + "/data").keys() - before.keys()}
    assert fresh == {f"v=1/year_month={m}" for m in ("2001-01", "2001-02", "2001-05", "2002-01", "__HIVE_DEFAULT_PARTITION__")}
    with pytest.raises(ValueError, match="more than one row"):
        t.upsert(new.union(new), ["k"])
    assert t.upsert(spark.createDataFrame([(9001, "n", None, "2003-01")], df.schema), ["k"]) == 2
    assert t.read().count() == rows(changes.merge_upsert(df, new, ["k"])).__len__() + 1


def test_a_job_that_dies_before_its_mark_is_invisible(spark, table, monkeypatch):
    t, df = table

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(stored, "mark", die)
        with pytest.raises(RuntimeError):
            t.delete(spark.createDataFrame([(5,)], "k bigint"), "k")
    assert t.versions() == [0] and rows(t.read()) == rows(df)
    assert t.delete(spark.createDataFrame([(6,)], "k bigint"), "k") == 1
    assert rows(t.read()) == rows(df.where("k IS NULL OR k <> 6"))


def test_retention_and_vacuum(spark, table):
    t, df = table
    t.retain("ts", dt.datetime(2001, 1, 6), 72)
    assert rows(t.read()) == rows(df.where("ts >= TIMESTAMP'2001-01-03'"))
    t.delete(spark.createDataFrame([(250,)], "k bigint"), "k")
    want, held = rows(t.read()), rows(t.read(1))
    assert t.vacuum(keep=2) == 2 and t.versions() == [1, 2]
    assert rows(t.read()) == want and rows(t.read(1)) == held
    assert not os.path.exists(f"{t.path}/data/v=0/year_month=2001-01") and os.path.exists(f"{t.path}/data/v=0/year_month=2001-04")
    assert t.vacuum(keep=2) == 0


def test_changes_read_differing_partitions_only(spark, table):
    t, df = table
    t.upsert(spark.createDataFrame([(1, "changed", dt.datetime(2001, 1, 1), "2001-01"), (2, "v2", dt.datetime(2001, 1, 1), "2001-01")], df.schema), ["k"])
    t.upsert(df.where("k = 301"), ["k"])  # rewritten, but equal
    got = t.changes(0, 2, ["k"])
    assert rows(got, "k", "x", "_change_type") == [(1, "changed", "update_postimage"), (1, "v1", "update_preimage")]
    read = {f.split("/data/")[1].split("/part")[0] for f in got.inputFiles()}
    assert read == {"v=0/year_month=2001-01", "v=1/year_month=2001-01"}
    t.delete(spark.createDataFrame([(450,)], "k bigint"), "k")
    assert rows(t.changes(0, 3, ["k"])) == rows(changes.change_feed(t.read(0), t.read(3), ["k"]))
    assert t.changes(3, 3, ["k"]).count() == 0


def test_empty_table(spark, table, tmp_path):
    _, df = table
    t = stored.StoredTable(spark, str(tmp_path / "e"), ["year_month"])
    with pytest.raises(ValueError, match="no committed version"):
        t.read()
    t.overwrite(df.limit(0))
    assert t.read().count() == 0 and t.read().columns == df.columns
    assert t.delete(df.select("k"), "k") == 0
    t.upsert(df.where("k < 3"), ["k"])
    assert rows(t.read()) == rows(df.where("k < 3"))


def test_state_from_the_nearest_snapshot(spark, tmp_path):
    log = spark.range(400).select(
        F.when(F.col("id") % 37 == 0, None).otherwise(F.pmod(F.hash("id"), F.lit(60))).alias("k"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("x"),
        (F.col("id") % 7 == 0).alias("gone"), F.col("id").alias("seq"), (F.col("id") / 20).cast("int").alias("version"))
    log = log.dropDuplicates(["k", "version"])
    path, snaps = str(tmp_path / "log"), str(tmp_path / "snaps")
    log.write.partitionBy("version").parquet(path)
    scan = spark.read.parquet(path)
    for at in (5, 12):
        stored.write_snapshot(scan, snaps, ["k"], "version", at)
    for upto in (0, 4, 5, 6, 12, 15, 19, 99):
        state = stored.state_from_snapshot(scan, snaps, ["k"], "version", upto, F.col("gone"))
        assert rows(state) == rows(changes.state_as_of(scan, ["k"], "version", upto, F.col("gone")).select(state.columns)), upto
    state = stored.state_from_snapshot(scan, snaps, ["k"], "version", 15, F.col("gone"))
    text = state._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in text and "> 12)" in text and "<= 15)" in text
