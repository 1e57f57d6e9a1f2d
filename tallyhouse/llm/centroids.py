"""Centroid clustering on an incremental distance matrix.

Every vector keeps its exact integer dot products with all centroids in a table. A round does not multiply vectors by
centroids again: the driver knows which components of which centroids have changed and by how much, and each vector adds only
``component * change`` for those to its stored products. Squared distances, and with them the nearest centroid, follow from the
products and the squared lengths. The first products are the same update, from centroids of zeros.

Only sums by cluster (``k`` rows of 64 numbers) ever reach the driver. A round reads the table of the round before and writes its
own, so a lost executor repeats tasks of one round; the table before last is deleted.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.base import batches, discard, stage

DIMENSIONS = 64
#: Components of greater size would not leave room for squared distances in 64 bits.
LIMIT = 1 << 27
_SPARK = "id bigint, v array<int>, dots array<bigint>, cluster int, distance bigint"
_SCHEMA = pa.schema([("id", pa.int64()), ("v", pa.list_(pa.int32())), ("dots", pa.list_(pa.int64())), ("cluster", pa.int32()), ("distance", pa.int64())])


def integers(vector: Column, scale: int = 1024, dimensions: int = DIMENSIONS) -> Column:
    """Components as ``floor(scale * x)``; NULL for a vector that has another number of components, or one that is NULL, not finite or
    of a size of ``LIMIT`` or more after scaling."""
    scaled = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float(LIMIT // scale)))
    return F.when((F.size(vector) == dimensions) & fits, scaled.cast("array<int>"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64).reshape(len(column), width)


def advance(state: DataFrame, changes: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """The table after centroids moved by ``changes`` to ``centroids``: products are updated by the nonzero changes, then the nearest is chosen."""
    k, width = centroids.shape
    moved = [(j, np.flatnonzero(changes[j]), changes[j][np.flatnonzero(changes[j])]) for j in range(k) if changes[j].any()]
    squares = (centroids**2).sum(axis=1)

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        v, dots = _matrix(batch.column(1), width), _matrix(batch.column(2), k)
        for j, at, by in moved:
            dots[:, j] += v[:, at] @ by
        apart = (v * v).sum(axis=1)[:, None] - 2 * dots + squares
        nearest = apart.argmin(axis=1) if len(v) else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(np.arange(0, k * len(v) + 1, k, dtype=np.int32), dots.ravel())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), lists, pa.array(nearest.astype(np.int32)), pa.array(apart[np.arange(len(v)), nearest])], schema=_SCHEMA
        )

    return state.mapInArrow(batches(convert), _SPARK)


def sums(state: DataFrame, width: int) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sums of every cluster that has vectors; tasks add up their own rows first."""

    def add(rows):
        total: dict[int, np.ndarray] = {}
        for batch in rows:
            v, cluster = _matrix(batch.column(1), width), np.asarray(batch.column(0))
            for j in np.unique(cluster).tolist():
                mine = v[cluster == j]
                total[j] = total.get(j, 0) + np.r_[len(mine), mine.sum(axis=0)]
        for j, x in total.items():
            yield pa.RecordBatch.from_pydict({"cluster": pa.array([j], pa.int32()), "x": pa.array([x.tolist()], pa.list_(pa.int64()))})

    partial = state.select("cluster", "v").mapInArrow(add, "cluster int, x array<bigint>")
    whole = partial.groupBy("cluster").agg(*[F.sum(F.col("x")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width + 1)])
    return {r[0]: (int(r[1]), [int(x) for x in r[2:]]) for r in whole.collect()}


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, key: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """One row per kept vector: ``key``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Centroids start as the ``k`` vectors with the smallest SHA-256 of ``seed:key``; there are fewer if fewer vectors are kept. Each
    round assigns every vector to the nearest centroid (ties: smaller number) and moves each centroid that has vectors to the
    componentwise floor of their mean; vectors are assigned once more at the end.

    Vectors with another number of components, or any that is NULL, NaN, infinite or 131,072 or more in size, are not kept: squared
    distances of such would not fit a long. Repeated rows count as often as they are given, keys are not required to be unique, a
    NULL key hashes as empty text and stays NULL, equal hashes start in the order of their vectors, extra columns are not read, and
    no vectors give no rows.
    """
    kept = vectors.select(F.col(key).cast("bigint").alias("id"), integers(F.col(vector), scale).alias("v")).where("v is not null")
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = kept.select(mark.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    centroids = np.array([r["v"] for r in first], dtype=np.int64).reshape(len(first), DIMENSIONS)
    made = max(1, len(first))
    before = np.zeros_like(centroids)
    none = F.array_repeat(F.lit(0).cast("bigint"), made)
    state, tables = kept.select("id", "v", none.alias("dots"), F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), []
    for done in range(rounds + 1 if len(first) else 0):
        state = stage(advance(state, centroids - before, centroids), "centroids")
        tables.append(state)
        if len(tables) > 1:
            discard(tables.pop(0))
        if done < rounds:
            before, centroids = centroids, centroids.copy()
            for j, (count, total) in sums(state, DIMENSIONS).items():
                centroids[j] = [x // count for x in total]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    inertia = {r[0]: int(r[1]) for r in state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()} if names else {}
    facts = F.array(*[F.struct(F.lit(inertia.get(j, 0)).cast("bigint").alias("i"), F.lit(n).alias("c")) for j, n in enumerate(names)] or [F.struct(F.lit(0).cast("bigint").alias("i"), F.lit("").alias("c"))])
    mine = F.get(facts, F.col("cluster"))
    return state.select(
        F.col("id").alias(key), "cluster", "distance", mine["i"].alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("bigint").alias("inertia"), mine["c"].alias("centroid_sha256")
    )
