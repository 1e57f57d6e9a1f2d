import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import types as T
from tallyhouse.llm import centroids

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("id", T.StringType()), T.StructField("v", T.StringType()), T.StructField("cluster", T.StringType())])


def brute(rows, k=8, rounds=10, seed=3):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) and abs(x) < 131072 for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [v for _, v in first]
    for step in range(rounds + 1):
        apart = [[sum((a - b) ** 2 for a, b in zip(v, x)) for x in c] for _, v in kept]
        mine = [d.index(min(d)) for d in apart]
        if step < rounds:
            c = [[sum(col) // len(g) for col in zip(*g)] if (g := [v for (_, v), m in zip(kept, mine) if m == j]) else x for j, x in enumerate(c)]
    inertia = [sum(d[m] for d, m in zip(apart, mine) if m == j) for j in range(len(c))]
    return [(i, m, d[m], inertia[m], sum(inertia), hashlib.sha256(",".join(map(str, c[m])).encode()).hexdigest()) for (i, _), d, m in zip(kept, apart, mine)]


def check(spark, rows):
    got = centroids.cluster(spark.createDataFrame([(i, v, "x", None, "y") for i, v in rows], SCHEMA))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    order = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(brute(rows), key=order)


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    middle = rng.normal(0, 1, (5, 64))
    rows = [(int(i), (middle[i % 5] + rng.normal(0, 0.4, 64)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(150)]  # a hot vector
    check(spark, rows)


def test_odd_vectors(spark):
    good = [0.5, -0.25] * 32
    odd = [None, [], good[:63], good + [1.0], [None] + good[1:], [math.nan] + good[1:], [math.inf] + good[1:], [-math.inf] + good[1:], [131072.0] + good[1:]]
    rows = [(i, v) for i, v in enumerate(odd)] + [(100, good), (100, good), (None, good), (101, [0.0] * 64), (102, [-131071.9] * 64), (103, [1e-9, -1e-9] * 32)]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.1] * 64)]])
def test_few_vectors(spark, rows):
    check(spark, rows)


def test_products_are_only_touched_by_changed_components(spark):
    state = spark.createDataFrame([(1, [1, 2, 3], [10, 20], 0, 0)], "id bigint, v array<int>, dots array<bigint>, cluster int, distance bigint")
    after = centroids.advance(state, np.array([[0, 0, 0], [0, 5, 0]]), np.array([[3, 2, 1], [0, 5, 0]])).first()
    assert after.dots == [10, 30]
