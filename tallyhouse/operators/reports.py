"""Operational reports: counts, freshness, sizes, run durations, latency."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.functions.columns import FINE
from tallyhouse.operators.governance import table_rows

#: Approximate percentiles are off by a share of 1 / ACCURACY of the rows at most.
ACCURACY = 10_000


def layer_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each ``layer.table``."""
    return table_rows(tables).select(F.col("schema_name").alias("layer"), "table_name", "row_count")


def catalog_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Tables and rows per layer."""
    return layer_row_counts(tables).groupBy("layer").agg(
        F.count(F.lit(1)).alias("table_count"), F.sum("row_count").alias("total_rows")
    )


def registered_tables(spark: SparkSession, prefix: str = "") -> DataFrame:
    """Tables and views known to the session, counted per schema."""
    rows = [(".".join(t.namespace or []) or "session", t.name) for t in spark.catalog.listTables() if t.name.startswith(prefix)]
    return spark.createDataFrame(rows, "schema_name string, table_name string").groupBy("schema_name").agg(
        F.count(F.lit(1)).alias("table_count")
    )


def freshness_report(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Row count and latest value of the time column per table, as timestamp."""
    out = None
    for name, (df, ts) in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("row_count"), F.max(ts).cast("timestamp").alias("latest")).select(
            F.lit(name).alias("table_name"), "row_count", "latest"
        )
        out = part if out is None else out.unionByName(part)
    return out


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Files and bytes per table, largest first. Works on plain file scans."""
    out = None
    for name, df in tables.items():
        files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")).distinct()
        part = files.agg(F.count(F.lit(1)).alias("file_count"), F.sum("b").alias("size_bytes")).select(
            F.lit(name).alias("table_name"), "file_count", "size_bytes"
        )
        out = part if out is None else out.unionByName(part)
    return out.orderBy(F.desc("size_bytes"), "table_name")


def run_sla_report(runs: DataFrame, sla_seconds: float) -> DataFrame:
    """Duration of each run ``(run_id, job, start_time ms, end_time ms, result_state)`` and whether it broke the SLA."""
    seconds = (F.col("end_time") - F.col("start_time")) / F.lit(1000.0)
    return runs.withColumn("duration_seconds", seconds).withColumn("sla_breach", F.col("duration_seconds") > sla_seconds)


def value_at_share(df: DataFrame, group: str, value: str, share: tuple[int, int], name: str) -> DataFrame:
    """Exact value at index ``floor(n * share)`` (from 0) of each group's sorted values, NULLs last, without sorting the rows.

    Approximate percentiles on both sides of the index bracket it; their error is bounded, so the wanted value lies between
    them. Rows are then counted in three bins: those below the bracket, those above, and those inside by value. Only the distinct values
    inside, some ten-thousandths of a group, are put in order. Counts are added up before they are shuffled, so a group or a
    value with a third of all rows is one row per task.
    """
    p = share[0] / share[1]
    slack = 4 / ACCURACY
    bracket = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("_n"), F.count(value).alias("_known"),
        F.percentile_approx(value, [max(0.0, p - slack), min(1.0, p + slack)], ACCURACY).alias("_b"), F.min(value).alias("_min"), F.max(value).alias("_max"),
    )
    index = F.floor(F.col("_n") * F.lit(share[0]) / F.lit(share[1]))
    # with NULLs the share of the known values is another one, so the whole range is the bracket then
    whole = F.col("_known") < F.col("_n")
    edges = bracket.select(
        F.col(group).alias("_g"), index.alias("_index"), "_known",
        F.when(whole | (F.col("_n") * slack < 4), F.col("_min")).otherwise(F.col("_b")[0]).alias("_low"),
        F.when(whole | (F.col("_n") * slack < 4), F.col("_max")).otherwise(F.col("_b")[1]).alias("_high"),
    )
    v = F.col(value)
    placed = df.where(v.isNotNull()).join(edges, F.col(group).eqNullSafe(F.col("_g")))
    inside = F.when((v >= F.col("_low")) & (v <= F.col("_high")), v)
    counted = placed.groupBy("_g", "_index", F.when(v < F.col("_low"), -1).when(inside.isNull(), 1).otherwise(0).alias("_bin"), inside.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy("_g").orderBy("_bin", "_v"))
    found = counted.withColumn("_upto", upto).where((F.col("_bin") == 0) & (F.col("_upto") > F.col("_index")) & (F.col("_upto") - F.col("_c") <= F.col("_index")))
    return edges.join(found.select(F.col("_g").alias("_f"), "_v"), F.col("_g").eqNullSafe(F.col("_f")), "left").select(F.col("_g").alias(group), F.col("_v").alias(name))


def latency_summary(timings: DataFrame, share: tuple[int, int] = (95, 100)) -> DataFrame:
    """Average, minimum, maximum and 95th percentile of ``elapsed`` per ``query``.

    The percentile is the value at index ``floor(n * share)`` of the sorted list, see :func:`value_at_share`.
    """
    exact = F.col("elapsed").cast(FINE)
    stats = timings.groupBy("query").agg(
        F.count(F.lit(1)).alias("runs"),
        (F.sum(exact).cast("double") / F.count(exact)).alias("avg_elapsed"),
        F.min("elapsed").alias("min_elapsed"),
        F.max("elapsed").alias("max_elapsed"),
    )
    return stats.join(value_at_share(timings, "query", "elapsed", share, "p95_elapsed"), "query")
