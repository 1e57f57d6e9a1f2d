"""Row changes between tables: upsert, change feed, state as of a version, deletes, retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.ranking import first_per_key
from tallyhouse.operators.skew import spread_join


def dedup_latest(df: DataFrame, keys: Sequence[str], latest: Sequence[Column]) -> DataFrame:
    """Keep one row per key, the first in the ``latest`` order."""
    return first_per_key(df, keys, latest)


def merge_upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``base`` replaced by those of ``updates`` with the same key, new keys added. NULL keys equal one another.

    A key that occurs twice in ``updates`` has no defined result and is refused at once; that check reads the key columns only.
    """
    once = updates.select(*[F.col(k).alias(f"_u_{k}") for k in keys])
    if not once.groupBy(*once.columns).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).isEmpty():
        raise ValueError(f"merge source holds more than one row for a key of {list(keys)}")
    kept = base.join(once, [F.col(k).eqNullSafe(F.col(f"_u_{k}")) for k in keys], "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes that turn ``old`` into ``new``: insert, delete, update_preimage and update_postimage rows.

    Rows are compared null-safe over the columns of both tables; one that a table lacks is NULL there. Each key, NULL
    included, occurs once on either side: the query fails on a repeated one. Both sides are brought together by one
    aggregation on the key, two rows per key, so it shuffles once.
    """
    kinds = {**{f.name: f.dataType for f in old.schema.fields}, **{f.name: f.dataType for f in new.schema.fields}}
    columns = list(kinds)

    def side(df: DataFrame, mine: str, other: str) -> DataFrame:
        row = F.struct(*[(F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in columns])
        return df.select(*[F.col(k).alias(f"_k_{k}") for k in keys], row.alias(mine), F.lit(None).cast(T.StructType([T.StructField(c, kinds[c]) for c in columns])).alias(other))

    union = side(old, "_old", "_new").unionByName(side(new, "_new", "_old"))
    both = union.groupBy(*[f"_k_{k}" for k in keys]).agg(
        F.count("_old").alias("_a"), F.count("_new").alias("_b"), F.first("_old", ignorenulls=True).alias("_old"), F.first("_new", ignorenulls=True).alias("_new")
    )
    both = both.where(
        F.when(F.greatest("_a", "_b") == 1, F.lit(True)).otherwise(F.raise_error(F.lit(f"more than one row for a key of {list(keys)}")).cast("boolean"))
    )

    def image(row: str, kind: str) -> Column:
        return F.struct(F.lit(kind).alias("change_type"), F.col(row).alias("row"))

    changes = (
        F.when(F.col("_old").isNull(), F.array(image("_new", "insert")))
        .when(F.col("_new").isNull(), F.array(image("_old", "delete")))
        .when(
            ~F.col("_old").eqNullSafe(F.col("_new")),
            F.array(image("_old", "update_preimage"), image("_new", "update_postimage")),
        )
    )
    return both.select(F.explode(changes).alias("c")).select("c.row.*", F.col("c.change_type").alias("_change_type"))


def state_as_of(log: DataFrame, keys: Sequence[str], version: str, upto: object, is_delete: Column) -> DataFrame:
    """Table state after all log entries up to ``upto``: the latest entry per key, deleted keys left out."""
    seen = log.where(F.col(version) <= F.lit(upto))
    return first_per_key(seen, keys, [F.col(version).desc()]).where(~is_delete)


def delete_keys(
    tables: Mapping[str, tuple[DataFrame, Sequence[str]]], doomed: DataFrame, key: str
) -> dict[str, DataFrame]:
    """Each table without the rows whose ``key`` is on the delete list (rows with a NULL key stay).

    ``tables`` maps a name to the frame and the columns that identify a row, by which its hot keys are spread.
    """
    listed = doomed.select(key).where(F.col(key).isNotNull()).distinct()
    return {name: spread_join(df, listed, key, row_key, "left_anti") for name, (df, row_key) in tables.items()}


def retain(df: DataFrame, ts: str, as_of: dt.datetime, hours: int) -> DataFrame:
    """Rows not older than ``hours`` at ``as_of``."""
    return df.where(F.col(ts) >= F.lit(as_of - dt.timedelta(hours=hours)))
