"""Exports behind a pointer; inventories in few queries; counts of increments."""

import threading

import pytest
from pyspark.sql import functions as F

from sluice.sinks import exports as X
from sluice.sinks import jdbc as JW
from sluice.sources import jdbc as JR
from sluice.streaming.incremental import load_increment, read_loaded
from tests.conftest import SF_SMALL


def _orders(spark):
    return spark.read.parquet(f"{SF_SMALL}/orders.parquet")


def test_readers_see_one_whole_version(spark, tmp_path):
    path, errors, seen, stop = str(tmp_path / "x"), [], [], threading.Event()
    X.export_version(_orders(spark).withColumn("v", F.lit(0)), path)

    def reader():
        while not stop.is_set():
            try:
                seen.append(tuple(X.read_export(spark, path).agg(F.min("v"), F.max("v"), F.count(F.lit(1))).first()))
            except Exception as e:  # noqa: BLE001
                errors.append(str(e)[:300])

    thread = threading.Thread(target=reader)
    thread.start()
    try:
        for v in range(1, 4):
            X.export_version(X.read_export(spark, path).withColumn("v", F.lit(v)), path)  # reads what it replaces
    finally:
        stop.set()
        thread.join()
    assert not errors and seen and all(lo == hi and n == 1500 for lo, hi, n in seen)
    assert X.read_export(spark, path, version=1).first().v == 0
    assert len(X.expire_exports(spark, path, keep=1)) == 3 and X.read_export(spark, path).first().v == 3


def test_partitions_empty_and_missing(spark, tmp_path):
    path = str(tmp_path / "x")
    with pytest.raises(ValueError):
        X.read_export(spark, path)
    orders = _orders(spark).withColumn("p", F.lit("001"))
    X.export_version(orders, path, partition_by=["p"])
    assert X.read_export(spark, path).exceptAll(orders).isEmpty()
    X.export_version(orders.limit(0), path)
    assert X.read_export(spark, path).columns == orders.columns and X.read_export(spark, path).isEmpty()


def test_inventory_counts_many_tables_in_one_query(spark, derby, monkeypatch):
    for i in range(5):
        JW.write_jdbc(spark.range(i).selectExpr("cast(id AS INT) AS k"), derby, f"INV{i}", mode="overwrite")
    asked, real = [], JR.read_subquery
    monkeypatch.setattr(JR, "read_subquery", lambda spark, cfg, sql, *a, **b: asked.append(sql) or real(spark, cfg, sql, *a, **b))
    found = JR.source_inventory(spark, derby, "APP", key_columns={"inv3": "k"})
    assert {(r.table_name, r.row_count, r.min_key, r.max_key) for r in found.collect()} == {
        ("INV0", 0, None, None), ("INV1", 1, None, None), ("INV2", 2, None, None), ("INV3", 3, "0", "2"), ("INV4", 4, None, None)
    }
    assert sum("UNION ALL" in sql for sql in asked) == 1 and len(asked) == 3  # the list, the keyed table, the others
    monkeypatch.setattr(JR, "_TABLES_A_QUERY", 2)
    assert JR.source_inventory(spark, derby, "APP").count() == 5


def test_an_increment_counts_its_own_partitions(spark, tmp_path):
    """Marks that need escaping in paths; history is not read."""
    orders = _orders(spark).withColumn("at", F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, o_orderkey)"))
    target, state = str(tmp_path / "t"), str(tmp_path / "s")
    done = 0
    for upto in (300, 800, 800, 1500):
        res = load_increment(orders.where(f"o_orderkey < {upto}"), target, "at", state, source="s", table="o")
        assert res.rows == upto - done
        done = upto
    assert read_loaded(spark, target).exceptAll(orders).isEmpty() and read_loaded(spark, target).count() == 1500
