"""Joins of a fact table with a keyed table where one key, or NULL, may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def default_salts(df: DataFrame) -> int:
    """Slots for a hot key: they grow with the shuffle partitions, which the submitter sizes by the data."""
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16)


def spread_join(
    facts: DataFrame, keyed: DataFrame, key: str, row_key: Sequence[str], how: str = "left", salts: int | None = None
) -> DataFrame:
    """Join ``facts`` to ``keyed`` (one row per ``key``) with every key spread over ``salts`` slots.

    A fact row takes the slot of its hashed ``row_key``; each keyed row is repeated once per slot. A hot
    key, and the NULL key that a left or anti join must carry along, therefore fills ``salts``
    tasks, also in streams, where no skew handling happens at run time. When ``keyed`` is small
    Spark's own size check turns the join into a broadcast and nothing is shuffled.
    """
    salts = salts or default_salts(facts)
    slot = F.pmod(F.xxhash64(*row_key), F.lit(salts)).cast("int")
    spread = keyed.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return facts.withColumn("_slot", slot).join(spread, [key, "_slot"], how).drop("_slot")
