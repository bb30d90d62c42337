"""Comparing two copies by a tree of hash sums."""

import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import fingerprint as P
from sluice.plans.inspect import plan_text
from tests.conftest import SF_SMALL


def _orders(spark):
    return spark.read.parquet(f"{SF_SMALL}/orders.parquet")


def brute(left, right, n_keys):
    """key -> (status, changed, n_left, n_right), rows as tuples with the keys first."""
    from collections import Counter, defaultdict

    sides = []
    for rows in (left, right):
        by = defaultdict(list)
        for r in rows:
            by[r[:n_keys]].append(r[n_keys:])
        sides.append(by)
    out = {}
    for k in set(sides[0]) | set(sides[1]):
        x, y = sides[0].get(k, []), sides[1].get(k, [])
        if Counter(map(repr, x)) == Counter(map(repr, y)):
            continue
        if not x:
            out[k] = ("missing_left", "", 0, len(y))
        elif not y:
            out[k] = ("missing_right", "", len(x), 0)
        elif len(x) == len(y) == 1:
            out[k] = ("changed", ",".join(f"v{i}" for i, (a, b) in enumerate(zip(x[0], y[0])) if a != b), 1, 1)
        else:
            out[k] = ("duplicate", "", len(x), len(y))
    return out


@pytest.mark.parametrize("bits,levels,join_rows", [(12, 3, 1_000_000), (2, 3, 0), (3, 1, 0), (1, 4, 40)])
def test_equals_brute_force(spark, bits, levels, join_rows):
    rng = random.Random(bits)
    value = lambda: rng.choice([None, "a", "b", "", "null"])
    left = [(rng.choice([None, *range(150)]), rng.choice([None, "x", "y"]), value(), value()) for _ in range(200)]
    right = [r for r in left if rng.random() < 0.9]
    right += [r for r in right if rng.random() < 0.05]
    right = [(*r[:2], value(), r[3]) if rng.random() < 0.1 else r for r in right]
    right += [(900 + i, None, "new", None) for i in range(4)]
    schema = "k INT, s STRING, v0 STRING, v1 STRING"
    frames = [spark.createDataFrame(rows, schema).repartition(3) for rows in (left, right)]
    got = P.compare_tables(*frames, ["k", "s"], bits=bits, levels=levels, join_rows=join_rows)
    assert got.columns == ["k", "s", "status", "changed", "n_left", "n_right"]
    rows = got.collect()
    assert {tuple(r[:2]): tuple(r[2:]) for r in rows} == brute(left, right, 2) and len(rows) == len(brute(left, right, 2))


def test_equal_copies_shuffle_sums_and_no_rows(spark):
    orders = _orders(spark)
    again = orders.repartition(7).select(*reversed(orders.columns))
    got = P.compare_tables(orders, again, ["o_orderkey"])
    assert got.schema.names == ["o_orderkey", "status", "changed", "n_left", "n_right"] and got.isEmpty()
    assert "Join" not in plan_text(got)
    entries = P.hash_sums(P._hashed(orders, ["o_orderkey"], ["o_totalprice"], 12, 1), ["d0"])
    text = plan_text(entries)
    shuffle = text.index("Exchange")
    assert "HashAggregate" in text[shuffle:] and "partial_sum" in text  # added before the shuffle


def test_rows_of_equal_buckets_are_not_joined(spark):
    orders = _orders(spark)
    other = orders.withColumn("o_totalprice", F.expr("IF(o_orderkey = 77, 0D, o_totalprice)"))
    got = P.compare_tables(orders, other, ["o_orderkey"], bits=8, levels=1, join_rows=0)
    assert [tuple(r) for r in got.collect()] == [(77, "changed", "o_totalprice", 1, 1)]
    assert "LeftSemi" in plan_text(got)


def test_nulls_are_not_confused(spark):
    left = spark.createDataFrame([(1, "a", None)], "k INT, x STRING, y STRING")
    right = spark.createDataFrame([(1, None, "a")], "k INT, x STRING, y STRING")
    assert [tuple(r) for r in P.compare_tables(left, right, ["k"]).collect()] == [(1, "changed", "x,y", 1, 1)]


def test_nested_columns(spark):
    schema = "k STRUCT<a: INT, b: STRING>, l ARRAY<STRING>, m MAP<STRING, INT>, z DOUBLE"
    left = [((1, "x"), ["a", None], {"p": 1, "q": 2}, 0.0), ((2, None), None, None, float("nan")), ((3, "y"), ["null"], {}, 1.0)]
    right = [((1, "x"), ["a", None], {"q": 2, "p": 1}, -0.0), ((2, None), None, None, float("nan")), ((3, "y"), [None], {}, 1.0)]
    got = P.compare_tables(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k"]).collect()
    assert [(tuple(r.k), r.status, r.changed) for r in got] == [((3, "y"), "changed", "l")]


def test_columns_must_agree(spark):
    a, b = spark.createDataFrame([(1, 2)], "k INT, v INT"), spark.createDataFrame([(1, "2")], "k INT, v STRING")
    with pytest.raises(TypeError):
        P.compare_tables(a, b, ["k"])
    with pytest.raises(ValueError):
        P.compare_tables(a, a, [])


def test_empty_sides(spark):
    some, none = spark.createDataFrame([(1, 2)], "k INT, v INT"), spark.createDataFrame([], "k INT, v INT")
    assert P.compare_tables(none, none, ["k"]).isEmpty()
    assert [tuple(r) for r in P.compare_tables(some, none, ["k"]).collect()] == [(1, "missing_right", "", 1, 0)]
    assert [tuple(r) for r in P.compare_tables(none, some, ["k"]).collect()] == [(1, "missing_left", "", 0, 1)]
