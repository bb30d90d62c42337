"""Keyed merges of updates, deletes, ties, replays and late versions."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from sluice.sinks import merge as M
from tests.conftest import SF_SMALL

SCHEMA = "k INT, s STRING, at LONG, v STRING"


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA + ", gone BOOLEAN").repartition(3)


def brute(state, rows):
    """state: key -> (at, deleted, v); the merge rules one row at a time."""
    best = {}
    rank = lambda at, gone, v: (at is not None, at or 0, gone, v is not None, v or "")
    for k, s, at, v, gone in rows:
        gone = bool(gone)
        if (k, s) not in best or rank(at, gone, v) > rank(*best[k, s]):
            best[k, s] = (at, gone, v)
    applied = 0
    for key, (at, gone, v) in best.items():
        old = state.get(key)
        order = lambda x: (x is not None, x or 0)
        if old is None or order(at) > order(old[0]) or (at == old[0] and (not old[1] or gone)):
            state[key] = (at, gone, None if gone else v)
            applied += 1
    return applied


def _check(spark, table, state):
    got = sorted(map(tuple, M.read_merged(spark, table).collect()), key=str)
    assert got == sorted([(k, s, at, v) for (k, s), (at, gone, v) in state.items() if not gone], key=str)


def test_equals_brute_force(spark, tmp_path):
    rng = random.Random(1)
    schema = spark.createDataFrame([], SCHEMA).schema
    table = M.create(spark, str(tmp_path / "t"), schema, ["k", "s"], "at", buckets=5)
    state, batches = {}, []
    for step in range(4):
        rows = [
            (rng.choice([None, *range(25)]), rng.choice([None, "x"]), rng.choice([None, *range(step * 2, step * 2 + 4)]),
             rng.choice([None, "a", "b", "c"]), rng.choice([None, False, False, True]))
            for _ in range(60)
        ]
        batches.append(rows)
        res = M.merge(spark, table, _frame(spark, rows), F.col("gone"))
        assert res.applied == brute(state, rows) and res.version == step + 1
        _check(spark, table, state)
    for rows in batches:  # replays, late ones too
        brute(state, rows)
        M.merge(spark, table, _frame(spark, rows), F.col("gone"))
        _check(spark, table, state)


def _files(table):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(f"{table.path}/data") for f in fs if f.endswith(".parquet")}


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    table = M.create(spark, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema, ["k"], "at", buckets=8)
    M.merge(spark, table, _frame(spark, [(i, "x", 1, "v", False) for i in range(200)]), F.col("gone"))
    before, (_, first) = _files(table), M.manifest(spark, table)
    res = M.merge(spark, table, _frame(spark, [(7, "x", 2, "new", False), (7, "x", 3, "newer", False), (500, "x", 1, "in", False)]), F.col("gone"))
    version, second = M.manifest(spark, table)
    touched = {b for b in second if second[b] != first.get(b)}
    assert res.buckets_written == len(touched) <= 2 and version == 2
    assert all(_files(table)[f] == t for f, t in before.items())
    assert M.read_merged(spark, table).where("k = 7").collect()[0].v == "newer"
    assert M.read_merged(spark, table, version=1).where("k = 7").collect()[0].v == "v"


def test_a_merge_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    table = M.create(spark, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema, ["k"], "at", buckets=3)
    M.merge(spark, table, _frame(spark, [(i, "x", 1, "v", False) for i in range(20)]))
    real = M.append_rows

    def dies(*a):
        raise OSError("killed")

    monkeypatch.setattr(M, "append_rows", dies)
    change = _frame(spark, [(3, "x", 2, "new", False)])
    with pytest.raises(OSError):
        M.merge(spark, table, change)
    assert M.read_merged(spark, table).where("v = 'new'").isEmpty()
    monkeypatch.setattr(M, "append_rows", real)
    M.merge(spark, table, change)
    assert M.read_merged(spark, table).where("v = 'new'").count() == 1 and M.read_merged(spark, table).count() == 20


def test_compaction_drops_old_deletes(spark, tmp_path):
    table = M.create(spark, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema, ["k"], "at", buckets=4)
    rows = [(i, "x", i, "v", i % 3 == 0) for i in range(30)]
    M.merge(spark, table, _frame(spark, rows), F.col("gone"))
    live = M.read_merged(spark, table).count()
    res = M.compact(spark, table, 20)
    assert res.applied == sum(1 for i in range(20) if i % 3 == 0)
    assert M.read_merged(spark, table).count() == live == 20
    M.merge(spark, table, _frame(spark, [(3, "x", 0, "late", False), (24, "x", 0, "late", False)]))
    late = {r.k for r in M.read_merged(spark, table).where("v = 'late'").collect()}
    assert late == {3}  # the delete of 24 was young enough to stay
    assert M.compact(spark, table, 0).buckets_written == 0


def test_other_types_and_reopening(spark, tmp_path):
    schema = spark.createDataFrame([], "id STRING, at TIMESTAMP, m MAP<STRING, INT>, l ARRAY<INT>").schema
    M.create(spark, str(tmp_path / "t"), schema, ["id"], "at", buckets=2)
    table = M.open_table(spark, str(tmp_path / "t"))
    day = lambda n: dt.datetime(2024, 1, n)
    rows = [("a", day(1), {"p": 1}, [1]), ("a", day(2), {"p": 2}, None), ("b", day(1), None, [2]), ("b", day(1), None, [2])]
    M.merge(spark, table, spark.createDataFrame(rows, schema))
    got = {r.id: (r.m, r.l) for r in M.read_merged(spark, table).collect()}
    assert got == {"a": ({"p": 2}, None), "b": (None, [2])}
    with pytest.raises(ValueError):
        M.create(spark, str(tmp_path / "t"), schema, ["id"], "at")
    with pytest.raises(ValueError):
        M.create(spark, str(tmp_path / "u"), schema, ["nope"], "at")


def test_empty_batches(spark, tmp_path):
    table = M.create(spark, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema, ["k"], "at")
    assert M.merge(spark, table, _frame(spark, [])).version == 0
    assert M.read_merged(spark, table).isEmpty()


def test_orders_in_batches(spark, tmp_path):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    table = M.create(spark, str(tmp_path / "t"), orders.schema, ["o_orderkey"], "o_orderdate", buckets=6)
    for part in range(3):
        M.merge(spark, table, orders.where(f"o_orderkey % 3 = {part}"))
    assert M.read_merged(spark, table).exceptAll(orders).isEmpty() and M.read_merged(spark, table).count() == orders.count()
