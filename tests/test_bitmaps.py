"""Key checks by bitmaps against the checks by grouping and joining."""

import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import bitmaps as B
from sluice.operators import quality as Q
from sluice.plans.inspect import plan_text
from tests.conftest import SF_SMALL

LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1
EDGES = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, LONG_MIN, LONG_MIN + 1, LONG_MAX, LONG_MAX - 1]


def _table(spark, name):
    return spark.read.parquet(f"{SF_SMALL}/{name}.parquet")


def _rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("dense", [True, False, None])
def test_unique(spark, dense):
    rng = random.Random(1)
    keys = EDGES + [rng.choice(EDGES) for _ in range(6)] + [rng.randrange(-100_000, 100_000) for _ in range(300)] + [None, None]
    df = spark.createDataFrame([(k,) for k in keys], "k LONG").repartition(3)
    assert _rows(B.unique_violations(df, ["k"], dense=dense)) == _rows(Q.check_unique(df, ["k"]))
    once = df.where("k IS NOT NULL").distinct()
    assert B.unique_violations(once, ["k"], dense=dense).isEmpty()


def test_every_edge_has_a_bit_of_its_own(spark):
    df = spark.createDataFrame([(k,) for k in EDGES], "k LONG")
    assert B.unique_violations(df, ["k"], dense=True).isEmpty()
    found = df.select(F.bitmap_bucket_number("k").alias("b"), F.bitmap_bit_position("k").alias("p"))
    assert found.distinct().count() == len(EDGES)


@pytest.mark.parametrize("dense", [True, False, None])
def test_foreign_key(spark, dense):
    rng = random.Random(2)
    parent = spark.createDataFrame([(k,) for k in [*EDGES[:9], *range(200)]], "id LONG")
    child = spark.createDataFrame([(rng.choice([None, *EDGES, *range(-20, 220)]),) for _ in range(500)], "pid LONG").repartition(4)
    expected = _rows(Q.check_foreign_key(child, parent, ["pid"], ["id"]))
    assert expected and _rows(B.foreign_key_violations(child, parent, ["pid"], ["id"], dense=dense)) == expected
    fine = child.join(parent, child.pid == parent.id, "left_semi")
    assert B.foreign_key_violations(fine, parent, ["pid"], ["id"], dense=dense).isEmpty()
    assert _rows(B.foreign_key_violations(child, parent.where("false"), ["pid"], ["id"], dense=dense)) == _rows(
        child.where("pid IS NOT NULL").groupBy("pid").count()
    )


@pytest.mark.parametrize("dense", [True, False])
def test_composite_keys(spark, dense):
    rng = random.Random(3)
    pair = lambda: (rng.choice([None, *range(-5, 9)]), rng.randrange(-3, 4))
    child = spark.createDataFrame([pair() for _ in range(200)], "a INT, b SHORT")
    parent = spark.createDataFrame([pair() for _ in range(60)], "x LONG, y INT")
    assert _rows(B.unique_violations(child, ["a", "b"], dense=dense)) == _rows(Q.check_unique(child, ["a", "b"]))
    got = B.foreign_key_violations(child, parent, ["a", "b"], ["x", "y"], dense=dense)
    assert _rows(got) == _rows(Q.check_foreign_key(child, parent, ["a", "b"], ["x", "y"]))


def test_keys_that_do_not_fit(spark):
    df = spark.createDataFrame([(LONG_MIN, 1), (LONG_MAX, 2)], "a LONG, b LONG")
    with pytest.raises(OverflowError):
        B.unique_violations(df, ["a", "b"])
    with pytest.raises(TypeError):
        B.distinct_counts(df.withColumn("s", F.lit("x")), ["a"], "s")


@pytest.mark.parametrize("dense", [True, False, None])
def test_distinct_counts(spark, dense):
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, *EDGES, *range(50)])) for _ in range(400)] + [("only null", None)]
    df = spark.createDataFrame(rows, "g STRING, v LONG").repartition(3)
    expected = df.groupBy("g").agg(F.countDistinct("v").alias("n_distinct"))
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, B.distinct_counts(df, ["g"], "v", dense=dense).collect()), key=key) == sorted(map(tuple, expected.collect()), key=key)
    assert B.distinct_counts(df, [], "v", dense=dense).collect()[0][0] == df.select("v").where("v IS NOT NULL").distinct().count()


def test_passing_checks_shuffle_bitmaps_only(spark):
    lineitem, orders = _table(spark, "lineitem"), _table(spark, "orders")
    got = B.foreign_key_violations(lineitem, orders, ["l_orderkey"], ["o_orderkey"])
    assert got.isEmpty() and "Join" not in plan_text(got)
    n, runs = B.runs_met(lineitem.select(F.bitmap_bucket_number("l_orderkey").alias("run")))
    assert n == lineitem.count() and runs * B.BITMAP_BYTES <= 16 * n  # dense: bitmaps travel
    text = plan_text(B.key_bitmaps(lineitem, F.col("l_orderkey"), dense=True))
    assert text.count("Exchange hashpartitioning(run") <= 1 and "partial_bitmap_construct_agg" in text


def test_nothing_to_check(spark):
    none = spark.createDataFrame([], "k LONG, j INT")
    assert B.unique_violations(none, ["k"]).isEmpty() and B.unique_violations(none, ["k", "j"]).isEmpty()
    assert B.foreign_key_violations(none, none, ["k"]).isEmpty()
    assert B.distinct_counts(none, ["j"], "k").isEmpty()
