"""Extracts that go on where a failed run stopped."""

import os

import pytest
from pyspark.sql import functions as F

from sluice.operators.ranges import key_ranges
from sluice.sinks import jdbc as JW
from sluice.sinks import resumable as R
from sluice.sinks.parquet import IncompleteWrite
from tests.conftest import SF_SMALL


class Stop(Exception):
    pass


def stop_after(n):
    def on_commit(done):
        if done >= n:
            raise Stop

    return on_commit


def _orders(spark):
    return spark.read.parquet(f"{SF_SMALL}/orders.parquet")


def _same(a, b):
    assert a.schema.simpleString() == b.schema.simpleString()
    assert a.count() == b.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_a_killed_run_is_taken_up(spark, tmp_path):
    orders, path = _orders(spark), str(tmp_path / "x")
    with pytest.raises(Stop):
        R.extract_frame_resumable(orders, path, "o_orderkey", 8, source="orders", on_commit=stop_after(3))
    with pytest.raises(R.IncompleteExtract):
        R.read_extract(spark, path)
    first = R.read_extract(spark, path, partial=True).count()
    res = R.extract_frame_resumable(orders, path, "o_orderkey", 8, source="orders")
    assert (res.ranges, res.ranges_read) == (8, 5)
    assert res.rows_read == res.rows - first and res.rows == orders.count()
    _same(R.read_extract(spark, path), orders)
    again = R.extract_frame_resumable(orders, path, "o_orderkey", 8, source="orders")
    assert (again.ranges_read, again.rows_read) == (0, 0)


def test_only_missing_ranges_are_read(spark, tmp_path):
    orders, path, read = _orders(spark), str(tmp_path / "x"), []
    predicates = [("o_orderkey < 500", None), ("o_orderkey >= 500 AND o_orderkey < 900", None), ("o_orderkey >= 900", None)]
    plan = [(p, orders.where(p).count()) for p, _ in predicates]

    def reader(ranges):
        read.append([r.range_id for r in ranges])
        which = F.expr("CASE " + " ".join(f"WHEN {r.predicate} THEN {r.range_id}" for r in ranges) + " END")
        return orders.where(" OR ".join(f"({r.predicate})" for r in ranges)).withColumn(R.RANGE, which.cast("int"))

    with pytest.raises(Stop):
        R.extract_ranges(spark, path, "o", lambda: plan, reader, on_commit=stop_after(1))
    read.clear()
    R.extract_ranges(spark, path, "o", lambda: pytest.fail("planned again"), reader, ranges_per_job=2)
    assert read == [[1, 2]]
    _same(R.read_extract(spark, path), orders)


def test_a_job_that_dies_while_writing_leaves_nothing(spark, tmp_path, monkeypatch):
    orders, path = _orders(spark), str(tmp_path / "x")
    real, calls = R.append_rows, []

    def dies(spark, where, rows, schema):
        calls.append(where)
        if where.endswith("_ledger") and len(calls) == 3:
            raise Stop  # the rows are written, the ledger isn't
        real(spark, where, rows, schema)

    monkeypatch.setattr(R, "append_rows", dies)
    with pytest.raises(Stop):
        R.extract_frame_resumable(orders, path, "o_orderkey", 4, source="orders")
    assert len(os.listdir(f"{path}/data")) == 2 and len(R.committed(spark, path)) == 1
    monkeypatch.setattr(R, "append_rows", real)
    assert R.extract_frame_resumable(orders, path, "o_orderkey", 4, source="orders").ranges_read == 3
    _same(R.read_extract(spark, path), orders)
    assert len(R.discard_leftovers(spark, path)) == 1 and R.discard_leftovers(spark, path) == []
    _same(R.read_extract(spark, path), orders)


def test_a_range_committed_twice_counts_once(spark, tmp_path):
    orders, path = _orders(spark), str(tmp_path / "x")
    R.extract_frame_resumable(orders, path, "o_orderkey", 3, source="orders")
    folder, rows = R.committed(spark, path)[1]
    R.append_rows(spark, f"{path}/_ledger", [(1, folder, rows, "other", R.now())], R._LEDGER)
    _same(R.read_extract(spark, path), orders)


def test_null_keys_hot_values_and_several_ranges_a_job(spark, tmp_path):
    keyed = _orders(spark).withColumn("k", F.expr("CASE WHEN o_custkey % 7 = 0 THEN NULL WHEN o_custkey % 3 = 0 THEN 3 ELSE o_custkey END"))
    path = str(tmp_path / "x")
    res = R.extract_frame_resumable(keyed, path, "k", 6, source="keyed", spread="o_orderkey", ranges_per_job=4)
    assert res.ranges == len(key_ranges(keyed, "k", 6, spread="o_orderkey"))
    _same(R.read_extract(spark, path), keyed)


def test_a_changed_source_is_noticed(spark, tmp_path):
    orders, path = _orders(spark), str(tmp_path / "x")
    with pytest.raises(Stop):
        R.extract_frame_resumable(orders, path, "o_orderkey", 4, source="orders", on_commit=stop_after(2))
    with pytest.raises(R.SourceChanged):
        R.extract_frame_resumable(orders.where("o_orderkey % 50 <> 1"), path, "o_orderkey", 4, source="orders")
    with pytest.raises(ValueError, match="not of lineitem"):
        R.extract_frame_resumable(orders, path, "o_orderkey", 4, source="lineitem")


def test_empty_source(spark, tmp_path):
    path = str(tmp_path / "x")
    none = _orders(spark).where("false")
    assert R.extract_frame_resumable(none, path, "o_orderkey", 4, source="none").rows == 0
    _same(R.read_extract(spark, path), none)


@pytest.mark.parametrize("key", ["o_orderkey", "o_orderpriority"])
def test_jdbc_table(spark, derby, tmp_path, key):
    orders, path = _orders(spark), str(tmp_path / key)
    types = JW.column_types(orders.schema, string_length=20)  # Derby compares only strings that have a length
    JW.write_jdbc(orders, derby, f"RES_{key}", mode="overwrite", create_column_types=types)
    with pytest.raises(Stop):
        R.extract_table_resumable(spark, derby, f"RES_{key}", path, key, 6, ranges_per_job=2, on_commit=stop_after(2))
    done = len(R.committed(spark, path))
    res = R.extract_table_resumable(spark, derby, f"RES_{key}", path, key, 6, ranges_per_job=3)
    assert done == 2 and res.ranges_read == res.ranges - 2
    _same(R.read_extract(spark, path), orders)


def test_jdbc_ranges_that_overlap_are_refused(spark, derby, tmp_path):
    JW.write_jdbc(_orders(spark), derby, "RES_BAD", mode="overwrite")
    k = derby.quote("o_orderkey")
    for bad in ([f"{k} < 600", f"{k} >= 500"], [f"{k} < 500", f"{k} > 500"]):
        with pytest.raises(IncompleteWrite):
            R.extract_table_resumable(spark, derby, "RES_BAD", str(tmp_path / "x"), "o_orderkey", 2, predicates=bad)
    assert not (tmp_path / "x").exists()
