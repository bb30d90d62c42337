"""Ranges over several columns and in the source's own order."""

import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.config import JdbcConfig
from sluice.operators.ranges import lexicographic_ranges, row_ranges
from sluice.sinks import jdbc as JW
from sluice.sinks import resumable as R
from sluice.sources import jdbc as JR
from tests.conftest import SF_SMALL


def _hits(df, predicates):
    """(rows per number of predicates they lie in, rows of each predicate)."""
    n = sum((F.expr(f"coalesce({p}, false)").cast("int") for p in predicates[1:]), F.expr(f"coalesce({predicates[0]}, false)").cast("int"))
    hits = {r["n"]: r["count"] for r in df.groupBy(n.alias("n")).count().collect()}
    return hits, [df.where(p).count() for p in predicates]


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.sampled_from("ab")), max_size=6),
    st.lists(st.tuples(st.none() | st.integers(0, 3), st.none() | st.integers(0, 3), st.none() | st.sampled_from("ab")), max_size=30),
    st.integers(1, 3),
)
def test_every_row_lies_in_one_range(bounds, rows, width):
    """Evaluated by sqlite; bounds may be prefixes."""
    import sqlite3

    con = sqlite3.connect(":memory:")
    con.execute("CREATE TABLE t (a INT, b INT, c TEXT)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
    cuts = sorted({b[:width] for b in bounds})
    predicates = lexicographic_ranges(['"a"', '"b"', '"c"'], cuts, lambda v: f"'{v}'" if isinstance(v, str) else str(v))
    hits = " + ".join(f"(CASE WHEN {p} THEN 1 ELSE 0 END)" for p in predicates)
    assert con.execute(f"SELECT COUNT(*) FROM t WHERE {hits} <> 1").fetchone()[0] == 0


@pytest.mark.parametrize("keys", [["l_orderkey", "l_linenumber"], ["l_linenumber", "l_orderkey"], ["l_returnflag", "l_linestatus", "l_suppkey"], ["l_shipdate"]])
def test_ranges_of_a_frame_are_balanced(spark, keys):
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    keys = [k for k in keys if k in lines.columns]
    lines = lines.withColumn(keys[0], F.expr(f"CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE `{keys[0]}` END"))
    predicates = row_ranges(lines, keys, 12)
    hits, sizes = _hits(lines, predicates)
    assert hits == {1: lines.count()}
    if keys != ["l_shipdate"]:
        assert len(predicates) >= 12 and max(sizes[:-1]) <= 1.5 * lines.count() / 12


def test_small_and_hot_frames(spark):
    none = spark.createDataFrame([], "a INT, b STRING")
    assert _hits(none, row_ranges(none, ["a", "b"], 4))[0] == {}
    same = spark.createDataFrame([(1, "x")] * 50 + [(None, "x"), (2, None)], "a INT, b STRING")
    assert _hits(same, row_ranges(same, ["a", "b"], 4))[0] == {1: 52}
    assert _hits(same, row_ranges(same, ["a"], 4, sampled=3))[0] == {1: 52}
    odd = spark.createDataFrame([(i % 3, "it's \\ `" + str(i)) for i in range(60)], "a INT, `b``c` STRING")
    assert _hits(odd, row_ranges(odd, ["a", "b`c"], 6))[0] == {1: 60}


@pytest.fixture()
def folding(spark):
    """A database that orders and compares text without regard to case."""
    url = f"jdbc:derby:memory:fold_{uuid.uuid4().hex};create=true;territory=en_US;collation=TERRITORY_BASED:PRIMARY"
    return JdbcConfig(url, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")


WORDS = ["B", "a", "c", "A", "b", "C", "ä", "Zebra", "zebra", "it's", "", "_x", "a b", "aB", "Ab"]


def test_case_insensitive_collation(spark, folding):
    rows = [(w, i or None) for i in range(6) for w in WORDS]
    df = spark.createDataFrame(rows, "w STRING, n INT")
    JW.write_jdbc(df, folding, "WORDS", mode="overwrite", create_column_types=JW.column_types(df.schema, string_length=20))
    # The database does fold case: python's order of boundaries would read rows twice.
    python_order = [f"{folding.quote('w')} < 'B'", f"{folding.quote('w')} >= 'a' AND {folding.quote('w')} < 'c'"]
    assert sum(JR.predicate_counts(spark, folding, "WORDS", python_order)) > JR.predicate_counts(spark, folding, "WORDS", [f"{folding.quote('w')} < 'c'"])[0]
    for columns in (["w"], ["w", "n"], ["n", "w"]):
        for parts in (1, 2, 5, 9, 200):
            predicates = JR.row_predicates(spark, folding, "WORDS", columns, parts)
            assert JR.misplaced_rows(spark, folding, "WORDS", predicates) == 0
    back = JR.read_by_rows(spark, folding, "WORDS", ["w", "n"], 7)
    assert back.count() == df.count() and back.exceptAll(df).isEmpty()
    predicates = JR.balanced_predicates(spark, folding, "WORDS", "w", 4)
    assert JR.misplaced_rows(spark, folding, "WORDS", predicates) == 0
    assert JR.read_by_predicates(spark, folding, "WORDS", predicates).exceptAll(df).isEmpty()


def test_composite_key_of_a_database_table(spark, derby, tmp_path):
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")
    JW.write_jdbc(lines, derby, "LINES2", mode="overwrite")
    predicates = JR.row_predicates(spark, derby, "LINES2", ["l_linenumber", "l_orderkey"], 10)
    sizes = JR.predicate_counts(spark, derby, "LINES2", predicates)
    assert len(predicates) == 11 and sizes[-1] == 0 and max(sizes) - min(sizes[:-1]) <= 10
    path = str(tmp_path / "x")
    res = R.extract_table_resumable(spark, derby, "LINES2", path, ["l_orderkey", "l_linenumber"], 6, ranges_per_job=3)
    assert res.rows == lines.count() and R.read_extract(spark, path).exceptAll(lines).isEmpty()


def test_misplaced_rows_are_counted(spark, derby):
    df = spark.createDataFrame([(i,) for i in range(10)], "k INT")
    JW.write_jdbc(df, derby, "MIS", mode="overwrite")
    k = derby.quote("k")
    assert JR.misplaced_rows(spark, derby, "MIS", [f"{k} < 5", f"{k} >= 4 AND {k} <> 8"]) == 2
    assert JR.misplaced_rows(spark, derby, "MIS", [f"{k} < 5", f"{k} > 4"]) == 0


def test_backslashes_for_mysql():
    assert JR._literal("a\\b'c", "mysql") == "'a\\\\b''c'" and JR._literal("a\\b", "derby") == "'a\\b'"
