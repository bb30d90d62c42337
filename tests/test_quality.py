"""Transfer checks against brute force on small inputs."""

from pyspark.sql import functions as F

from sluice.operators import quality as Q
from tests.conftest import SF_SMALL


def test_not_null_counts(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, "b"), (3, 2.0, None)], "a INT, b DOUBLE, c STRING")
    got = {r.column_name: r.null_count for r in Q.check_not_null(df).collect()}
    assert got == {"a": 1, "b": 2, "c": 1}


def test_unique_finds_duplicates(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (2, 1), (2, 1)], "k INT, n INT")
    got = {(r.k, r.n, r.n_rows) for r in Q.check_unique(df, ["k", "n"]).collect()}
    assert got == {(1, 1, 2), (2, 1, 3)}


def test_foreign_key_ignores_null_and_counts(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,), (9,)], "pid INT")
    parent = spark.createDataFrame([(1,), (3,)], "id INT")
    got = {(r.pid, r.n_rows) for r in Q.check_foreign_key(child, parent, ["pid"], ["id"]).collect()}
    assert got == {(2, 2), (9, 1)}


def test_foreign_key_composite(spark):
    child = spark.createDataFrame([(1, 1), (1, 2)], "a INT, b INT")
    parent = spark.createDataFrame([(1, 1)], "x INT, y INT")
    got = [tuple(r) for r in Q.check_foreign_key(child, parent, ["a", "b"], ["x", "y"]).collect()]
    assert got == [(1, 2, 1)]


def test_reconcile_statuses(spark):
    left = spark.createDataFrame([(1, "h", 5), (2, "h", 6), (3, "x", None), (4, "d", 1), (4, "d", 1)], "k INT, host STRING, port INT")
    right = spark.createDataFrame([(1, "h", 5), (2, "g", 6), (3, "x", None), (5, "z", 0)], "k INT, host STRING, port INT")
    out = {r.key: (r.host_status, r.port_status) for r in Q.reconcile(left, right, "k", "k", [("host", "host", "host"), ("port", "port", "port")]).collect()}
    assert out == {
        1: ("match", "match"),
        2: ("mismatch", "match"),
        3: ("match", "match"),  # NULL = NULL is a match (null-safe)
        4: ("missing_right", "missing_right"),
        5: ("missing_left", "missing_left"),
    }


def test_reconcile_duplicate_key(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b")], "k INT, v STRING")
    right = spark.createDataFrame([(1, "a")], "k INT, v STRING")
    out = Q.reconcile(left, right, "k", "k", [("v", "v", "v")]).collect()
    assert [(r.key, r.v_status) for r in out] == [(1, "duplicate")]


def test_check_plans_pre_aggregate(spark):
    from sluice.plans.inspect import plan_text

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    text = plan_text(Q.check_foreign_key(li, o, ["l_orderkey"], ["o_orderkey"]))
    assert "partial_count" in text  # map-side combine before the shuffle
    assert "ReadSchema: struct<l_orderkey:bigint>" in text


def test_completeness_and_emptiness(spark):
    df = spark.range(7)
    assert Q.compare_counts(7, df) == (True, 7)
    assert Q.is_empty(df.filter(F.col("id") < 0))


def test_unique_null_semantics(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, 1), (1, 1)], "a INT, b INT")
    assert {tuple(r) for r in Q.check_unique(df, ["a", "b"]).collect()} == {(1, 1, 2)}
    assert {tuple(r) for r in Q.check_unique(df, ["a", "b"], nulls_distinct=False).collect()} == {
        (1, 1, 2), (None, 1, 2)
    }
