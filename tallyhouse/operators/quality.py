"""Data-quality checks: violations, constraints, quarantine, pass rate, timeliness, column statistics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def violations(df: DataFrame, table: str, check: str, broken: Column) -> DataFrame:
    """One row: how many rows break a rule."""
    return df.where(broken).agg(F.count(F.lit(1)).alias("violation_count")).select(
        F.lit(table).alias("table_name"), F.lit(check).alias("check_type"), "violation_count"
    )


def orphans(child: DataFrame, parent: DataFrame, key: str, table: str) -> DataFrame:
    """How many child rows have no parent. Counted per key before the join, so no key is hot in it."""
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    lost = per_key.join(parent.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violation_count")).select(
        F.lit(table).alias("table_name"), F.lit("Orphaned records").alias("check_type"), "violation_count"
    )


def check_constraints(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows ``(constraint, checked_rows, violations)`` from one pass; as in SQL, NULL does not violate a CHECK."""
    counts = df.agg(
        F.count(F.lit(1)).alias("checked_rows"),
        *[F.count_if(~rule).alias(f"v{i}") for i, rule in enumerate(rules.values())],
    )
    rows = F.array(*[
        F.struct(F.lit(name).alias("constraint"), F.col("checked_rows"), F.col(f"v{i}").alias("violations"))
        for i, name in enumerate(rules)
    ])
    return counts.select(F.inline(rows))


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``failed_rules`` and ``is_ok``; a rule that is NULL counts as met. Filter on ``is_ok`` to split."""
    failed = F.array_compact(F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()]))
    return df.withColumn("failed_rules", failed).withColumn("is_ok", F.size("failed_rules") == 0)


def pass_rate(df: DataFrame, rules: Mapping[str, Column], target: float = 99.0) -> DataFrame:
    """Share of rows that meet all rules, in percent, against a target."""
    checked = quarantine(df, rules).agg(F.count(F.lit(1)).alias("total_rows"), F.count_if("is_ok").alias("passed_rows"))
    rate = F.try_divide(F.col("passed_rows") * F.lit(100.0), F.col("total_rows"))
    return checked.withColumn("pass_rate", rate).withColumn("meets_target", F.col("pass_rate") >= target)


def timeliness(tables: Mapping[str, tuple[DataFrame, str]], as_of: dt.datetime, max_hours: int = 24) -> DataFrame:
    """Latest timestamp per table, its age in hours at ``as_of`` and whether that exceeds the limit."""
    parts = [
        df.agg(F.max(F.col(ts).cast("timestamp")).alias("latest")).select(F.lit(name).alias("table_name"), "latest")
        for name, (df, ts) in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    lag = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("latest")) / F.lit(3_600_000_000.0)
    return out.withColumn("lag_hours", lag).withColumn("is_late", F.col("lag_hours") > max_hours)


def column_stats(df: DataFrame, approximate: bool = True) -> DataFrame:
    """One row per column: row and NULL counts, min, max, text lengths and, on request, distinct count.

    All columns are measured in one aggregation.
    """
    fields = [f for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        size = F.length(c.cast("string"))
        aggs += [
            F.count(c).alias(f"c{i}"),
            F.min(c).cast("string").alias(f"lo{i}"),
            F.max(c).cast("string").alias(f"hi{i}"),
            F.max(size).cast("bigint").alias(f"ml{i}"),
            F.try_divide(F.sum(size).cast("double"), F.count(c)).alias(f"al{i}"),
        ]
        if approximate:
            aggs.append(F.approx_count_distinct(c).alias(f"d{i}"))
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.col("n").alias("row_count"),
            (F.col("n") - F.col(f"c{i}")).alias("null_count"),
            F.col(f"lo{i}").alias("min_value"),
            F.col(f"hi{i}").alias("max_value"),
            F.col(f"al{i}").alias("avg_length"),
            F.col(f"ml{i}").alias("max_length"),
            *([F.col(f"d{i}").alias("approx_distinct")] if approximate else []),
        )
        for i, f in enumerate(fields)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))
