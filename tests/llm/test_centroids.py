import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm import centroids

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])


def brute(rows, dim, k, rounds, scale=64, seed="1"):
    """(rows as (id, cluster, distance), sorted; centroids), one step at a time."""
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)
    ]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centers = [list(v) for _, v in first]

    def assign():
        out = []
        for i, v in kept:
            d, c = min((sum((x - y) ** 2 for x, y in zip(v, m)), c) for c, m in enumerate(centers))
            out.append((i, c, d))
        return out

    for _ in range(rounds):
        own = assign()
        for c in range(len(centers)):
            mine = [v for (_, v), (_, o, _) in zip(kept, own) if o == c]
            if mine:
                centers[c] = [sum(col) // len(mine) for col in zip(*mine)]
    key = lambda r: (r[0] is None, r)
    return sorted(assign(), key=key), centers


@pytest.mark.parametrize("dim,k,rounds,block,n", [(6, 4, 3, 2, 150), (7, 5, 2, 3, 90), (5, 3, 0, 8, 30), (4, 9, 3, 1, 6)])
def test_equals_brute_force(spark, dim, k, rounds, block, n):
    rng = random.Random(dim)
    rows = [(i * 3 - 20, [rng.choice([-2, 0, 1.5]) + rng.gauss(0, 0.4) for _ in range(dim)]) for i in range(n)]
    rows += rows[:5]  # repeated rows
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    got, centers = centroids.lloyd(df, dim=dim, k=k, rounds=rounds, block=block)
    assert (sorted(map(tuple, got.collect())), centers) == brute(rows, dim, k, rounds)


def test_tiles_and_ties(spark, monkeypatch):
    monkeypatch.setattr(centroids, "TILE", 4)
    rows = [(i, [float(i % 3), 0.5, -0.25]) for i in range(40)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    got, centers = centroids.lloyd(df, dim=3, k=7, rounds=2, block=2)  # equal centroids: ties
    assert (sorted(map(tuple, got.collect())), centers) == brute(rows, 3, 7, 2)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [1.0, -inf]), (7, [1.0, 2.0]), (8, [-1.0, -0.3]),
        (8, [-1.0, 0.3]), (None, [5.0, 5.0]), (9, [1.0, 2.0, 3.0]), (10, [1e4, -1e4]), (11, [0.0, -0.0]),
    ]
    df = spark.createDataFrame(rows, VECTORS)
    for name in ("id", "tile", "cluster", "data", "distance"):
        df = df.withColumn(name, F.lit("mine"))
    got, centers = centroids.lloyd(df, dim=2, k=3, rounds=3)
    assert got.columns == ["vec_id", "cluster", "distance"]
    key = lambda r: (r[0] is None, r)
    assert (sorted(map(tuple, got.collect()), key=key), centers) == brute(rows, 2, 3, 3)
    whole = centroids.with_inertia(got, centers).collect()
    assert {r["inertia"] for r in whole} == {sum(r["distance"] for r in whole)}
    for r in whole:
        assert r["cluster_inertia"] == sum(x["distance"] for x in whole if x["cluster"] == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centers[r["cluster"]])).encode()).hexdigest()


@pytest.mark.parametrize("rows", [[], [(1, None), (2, [1.0])]])
def test_nothing_kept(spark, rows):
    got, centers = centroids.lloyd(spark.createDataFrame(rows, VECTORS), dim=2, k=3)
    assert centers == [] and centroids.with_inertia(got, centers).collect() == []
    assert got.schema["distance"].dataType == T.LongType()


def test_components_beyond_a_byte_or_two(spark):
    rows = [(i, [i * 1000.25, -(i**3) * 1.0]) for i in range(60)]
    got, centers = centroids.lloyd(spark.createDataFrame(rows, VECTORS).repartition(2), dim=2, k=4, rounds=3, block=1)
    assert (sorted(map(tuple, got.collect())), centers) == brute(rows, 2, 4, 3)
