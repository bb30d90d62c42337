"""JDBC reads and writes against embedded in-memory Derby (inside the JVM,
no server, no port)."""

import pytest
from pyspark.sql import functions as F

from sluice.sinks import jdbc as JW
from sluice.sources import jdbc as JR
from tests.conftest import SF_SMALL


def _orders(spark):
    return spark.read.parquet(f"{SF_SMALL}/orders.parquet")


def _same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_connection_literal(spark, derby):
    JW.create_if_not_exists(spark, derby, "T0", "id INT")
    rows = JR.connection_check(spark, derby).collect()
    assert [tuple(r) for r in rows] == [(1,)] and rows[0].asDict() == {"connection_test": 1}


def test_round_trip_types_and_values(spark, derby):
    orders = _orders(spark)
    JW.write_jdbc(orders, derby, "ORDERS", mode="overwrite")
    back = JR.read_table(spark, derby, "ORDERS")
    assert back.schema.simpleString() == orders.schema.simpleString()
    _same(back, orders)


def test_partitioned_read_uses_measured_bounds(spark, derby):
    orders = _orders(spark)
    JW.write_jdbc(orders, derby, "ORDERS", mode="overwrite")
    b = JR.bounds(spark, derby, "ORDERS", "o_orderkey")
    assert (b.lower, b.upper, b.rows, b.nulls) == (0, 1499, 1500, 0)
    df = JR.read_partitioned(spark, derby, "ORDERS", "o_orderkey", 8)
    assert df.rdd.getNumPartitions() == 8
    sizes = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in sizes) <= 1500 / 8 + 2
    _same(df, orders)


def test_partition_count_capped_by_key_range(spark, derby):
    rows = spark.range(1, 5).select(F.col("id").cast("int").alias("id"))
    JW.write_jdbc(rows, derby, "SMALL", mode="overwrite")
    df = JR.read_partitioned(spark, derby, "SMALL", "id", 20)
    assert df.rdd.getNumPartitions() == 4
    assert sorted(r.id for r in df.collect()) == [1, 2, 3, 4]


def test_null_keys_are_read(spark, derby):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (50, "c"), (None, "d")], "k INT, v STRING")
    JW.write_jdbc(df, derby, "NK", mode="overwrite")
    back = JR.read_partitioned(spark, derby, "NK", "k", 4)
    assert sorted(r.v for r in back.collect()) == ["a", "b", "c", "d"]


def test_empty_source_reads_empty(spark, derby):
    JW.create_if_not_exists(spark, derby, "EMPTY", "k INT, v STRING")
    assert JR.read_partitioned(spark, derby, "EMPTY", "k", 8).count() == 0


def test_string_key_predicates_disjoint_and_covering(spark, derby):
    orders = _orders(spark)
    # Derby's text type cannot be compared: short strings get a length.
    JW.write_jdbc(orders, derby, "ORDERS", mode="overwrite", create_column_types=JW.column_types(_orders(spark).schema, string_length=20))
    preds = JR.balanced_predicates(spark, derby, "ORDERS", "o_orderpriority", 3)
    assert preds[-1].endswith("IS NULL") and len(preds) == 4
    back = JR.read_by_predicates(spark, derby, "ORDERS", preds)
    assert back.rdd.getNumPartitions() == len(preds)
    _same(back, orders)


def test_range_predicates_null_arm(spark, derby):
    # (Spark binds NULL strings with Derby's CLOB type, which a VARCHAR column
    # refuses, so the NULL arm is exercised on an integer key.)
    df = spark.createDataFrame([(1, "a"), (None, "b"), (50, "c"), (None, "d"), (99, "e")], "k INT, v STRING")
    JW.write_jdbc(df, derby, "NK", mode="overwrite")
    preds = JR.range_predicates(derby, "k", [10, 60])
    assert preds == ['"k" < 10', '"k" >= 10 AND "k" < 60', '"k" >= 60', '"k" IS NULL']
    back = JR.read_by_predicates(spark, derby, "NK", preds)
    _same(back, df)
    with pytest.raises(ValueError):
        JR.range_predicates(derby, "k", [60, 10])


def test_keys_with_many_values_are_cut_by_the_source(spark, derby, monkeypatch):
    """Derby has no NTILE, so the statement is checked and its rows are made up."""
    sent = []

    class Reply(list):
        def first(self):
            return self[0]

        def collect(self):
            return self

    def answer(spark, cfg, sql, alias):
        sent.append(sql)
        return Reply([{"n": 50_000}] if "DISTINCT" in sql else [{"v": v} for v in (1, 10, 20, 20)])

    monkeypatch.setattr(JR, "read_subquery", answer)
    got = JR.balanced_predicates(spark, derby, "ORDERS", "o_orderkey", 4)
    assert "NTILE(4) OVER (ORDER BY" in sent[1]
    assert got == JR.range_predicates(derby, "o_orderkey", [10, 20])


def test_balanced_read_on_skewed_key(spark, derby):
    # a third of the rows on one key value, the rest spread out
    hot = spark.range(0, 3000).select(F.lit(7).cast("int").alias("k"), F.col("id"))
    rest = spark.range(0, 6000).select((F.col("id") % 5000).cast("int").alias("k"), (F.col("id") + 10_000).alias("id"))
    df = hot.unionByName(rest)
    JW.write_jdbc(df, derby, "SKEW", mode="overwrite")
    back = JR.read_balanced(spark, derby, "SKEW", "k", 6)
    _same(back, df)
    sizes = sorted(r["count"] for r in back.groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] <= 3000 + 6000 / 6 + 50  # only the hot value's partition is large


def test_query_and_subquery(spark, derby):
    JW.write_jdbc(_orders(spark), derby, "ORDERS", mode="overwrite", create_column_types=JW.column_types(_orders(spark).schema, string_length=20))
    q = derby.quote
    df = JR.read_query(spark, derby, f"SELECT {q('o_orderkey')} FROM ORDERS WHERE {q('o_orderstatus')} = 'F'")
    expected = _orders(spark).filter("o_orderstatus = 'F'").count()
    assert df.count() == expected
    sub = JR.read_subquery(spark, derby, f"SELECT COUNT(*) AS {q('n')} FROM ORDERS", "c")
    assert sub.first()["n"] == 1500
    with pytest.raises(ValueError):
        JR.read_query(spark, derby, "TRUNCATE TABLE ORDERS")


def test_save_modes(spark, derby):
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    JW.write_jdbc(nation, derby, "N", mode="append")
    JW.write_jdbc(nation, derby, "N", mode="append")
    assert JW.row_count(spark, derby, "N") == 50
    JW.write_jdbc(nation, derby, "N", mode="ignore")
    assert JW.row_count(spark, derby, "N") == 50
    with pytest.raises(Exception):
        JW.write_jdbc(nation, derby, "N", mode="errorifexists")
    JW.write_jdbc(nation.limit(5), derby, "N", mode="overwrite")
    assert JW.row_count(spark, derby, "N") == 5
    with pytest.raises(ValueError):
        JW.write_jdbc(nation, derby, "N", mode="upsert")


def test_overwrite_truncate_keeps_target_types(spark, derby):
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    JW.write_jdbc(nation, derby, "N", mode="overwrite", create_column_types="n_nationkey INT, n_name VARCHAR(25), n_regionkey INT")
    JW.write_jdbc(nation.limit(3), derby, "N", mode="overwrite")  # truncate by default
    meta = JR.read_query(
        spark, derby,
        "SELECT c.COLUMNNAME, CAST(c.COLUMNDATATYPE AS VARCHAR(64)) AS T FROM SYS.SYSCOLUMNS c "
        "JOIN SYS.SYSTABLES t ON c.REFERENCEID = t.TABLEID WHERE t.TABLENAME = 'N'",
    ).collect()
    types = {r.COLUMNNAME: r.T for r in meta}
    assert types["n_name"].startswith("VARCHAR(25)")
    assert JW.row_count(spark, derby, "N") == 3


def test_truncate_table_empties_and_keeps_schema(spark, derby):
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    JW.write_jdbc(nation, derby, "N", mode="overwrite")
    assert JW.truncate_table(spark, derby, "N") is True
    back = JR.read_table(spark, derby, "N")
    assert back.count() == 0 and back.columns == nation.columns


def test_truncate_missing_table_is_error(spark, derby):
    JW.create_if_not_exists(spark, derby, "T0", "id INT")
    with pytest.raises(Exception):
        JW.truncate_table(spark, derby, "NOT_THERE")


def test_truncate_all_child_first(spark, derby):
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    region = spark.read.parquet(f"{SF_SMALL}/region.parquet")
    JW.write_jdbc(region, derby, "R", mode="overwrite")
    JW.write_jdbc(nation, derby, "N", mode="overwrite")
    assert JW.truncate_all(spark, derby, ["N", "R"]) == ["N", "R"]
    assert JW.row_count(spark, derby, "N") == 0 and JW.row_count(spark, derby, "R") == 0


def test_column_types_mapping():
    from pyspark.sql import types as T

    schema = T.StructType([
        T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()),
        T.StructField("c", T.DecimalType(15, 2)), T.StructField("d", T.DateType()),
        T.StructField("e", T.TimestampType()), T.StructField("f", T.LongType()),
    ])
    assert JW.column_types(schema, string_length=50) == (
        "`a` INT, `b` VARCHAR(50), `c` DECIMAL(15,2), `d` DATE, `e` TIMESTAMP, `f` BIGINT"
    )
    with pytest.raises(TypeError):
        JW.column_types(T.StructType([T.StructField("x", T.ArrayType(T.IntegerType()))]))


def test_stage_and_publish(spark, derby):
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    n = JW.stage_and_publish(nation, derby, "N", "N_STAGE", expected_rows=25)
    assert n == 25 and JW.row_count(spark, derby, "N") == 25


def test_source_inventory(spark, derby):
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    region = spark.read.parquet(f"{SF_SMALL}/region.parquet")
    JW.write_jdbc(nation, derby, "NATION", mode="overwrite")
    JW.write_jdbc(region, derby, "REGION", mode="overwrite")
    inv = {(r.table_name, r.row_count) for r in JR.source_inventory(spark, derby, "APP").collect()}
    assert inv == {("NATION", 25), ("REGION", 5)}


def test_retry_only_transient():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("java.sql.SQLTransientConnectionException: Communications link failure")
        return "ok"

    assert JR.with_retry(flaky, attempts=3, delay_s=0, sleep=lambda s: None) == "ok"
    assert len(calls) == 3

    def bad_args():
        calls.append(1)
        raise TypeError("unsupported operand type(s) for +: 'NoneType' and 'int'")

    calls.clear()
    with pytest.raises(TypeError):
        JR.with_retry(bad_args, attempts=3, delay_s=0, sleep=lambda s: None)
    assert len(calls) == 1


def test_retry_gives_up_after_attempts():
    calls = []

    def down():
        calls.append(1)
        raise RuntimeError("Connection refused")

    with pytest.raises(RuntimeError):
        JR.with_retry(down, attempts=3, delay_s=0, sleep=lambda s: None)
    assert len(calls) == 3


def test_config_redacts_password():
    from sluice.config import JdbcConfig, redact_url

    cfg = JdbcConfig("jdbc:mysql://h:3306/db", password="s3cret", options={"pwd": "x", "useSSL": "true"})
    assert "s3cret" not in repr(cfg) and "'x'" not in repr(cfg)
    assert redact_url("jdbc:x://h/db;password=abc;user=u") == "jdbc:x://h/db;password=******;user=u"
    assert redact_url("jdbc:x://h/db;password={a;b};user=u") == "jdbc:x://h/db;password=******;user=u"
    assert redact_url("jdbc:x://user:p@ss@h:1/db?pwd=q&a=b") == "jdbc:x://user:******@h:1/db?pwd=******&a=b"
    assert redact_url("jdbc:x://h:1/db?a=b") == "jdbc:x://h:1/db?a=b"
    assert cfg.quote("id") == "`id`"
    with pytest.raises(ValueError):
        JdbcConfig("mysql://h/db")


def test_extract_to_parquet_reads_source_once(spark, derby, tmp_path):
    from sluice.sinks.parquet import extract_to_parquet

    orders = _orders(spark)
    JW.write_jdbc(orders, derby, "ORDERS", mode="overwrite")
    res = extract_to_parquet(spark, derby, "ORDERS", str(tmp_path / "o"), partition_column="o_orderkey", num_partitions=4)
    assert res.rows_expected == res.rows_written == 1500
    back = spark.read.parquet(res.path)
    assert len(back.inputFiles()) == 4
    _same(back, orders)
    res2 = extract_to_parquet(spark, derby, "ORDERS", str(tmp_path / "o2"))
    assert res2.rows_written == 1500


def test_v2_catalog_pushes_aggregates_and_filters(spark, derby):
    from sluice.plans.inspect import plan_text

    JW.write_jdbc(_orders(spark), derby, "ORDERS", mode="overwrite")
    cat = JR.register_catalog(spark, "dby_t1", derby)
    b = JR.catalog_bounds(spark, f"{cat}.APP.ORDERS", "o_orderkey")
    assert "PushedAggregates: [MIN(o_orderkey), MAX(o_orderkey)]" in plan_text(b)
    assert tuple(b.first()) == (0, 1499)
    inv = {(r.table_name, r.row_count) for r in JR.catalog_inventory(spark, cat, "APP").collect()}
    assert inv == {("ORDERS", 1500)}


def test_v2_catalog_limit_is_exact_on_derby(spark, derby):
    # Spark's Derby dialect renders no LIMIT clause; with limit pushdown on, a
    # pushed TOP-N came back with every matching row. Registration turns it off.
    JW.write_jdbc(_orders(spark), derby, "ORDERS", mode="overwrite", create_column_types=JW.column_types(_orders(spark).schema, string_length=20))
    cat = JR.register_catalog(spark, "dby_t2", derby)
    top = spark.table(f"{cat}.APP.ORDERS").filter(F.col("o_orderstatus") == "F").orderBy("o_orderkey").limit(3)
    rows = top.collect()
    assert len(rows) == 3
    expected = _orders(spark).filter("o_orderstatus = 'F'").orderBy("o_orderkey").limit(3).collect()
    assert [r.o_orderkey for r in rows] == [r.o_orderkey for r in expected]


def test_balanced_read_negative_keys(spark, derby):
    df = spark.range(-500, 500).select(F.col("id").cast("int").alias("k"))
    JW.write_jdbc(df, derby, "NEG", mode="overwrite")
    back = JR.read_balanced(spark, derby, "NEG", "k", 4)
    _same(back, df)
    sizes = [r["count"] for r in back.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 300


def test_timestamp_key_partitioned_read(spark, derby):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    JW.write_jdbc(ev, derby, "EVENTS", mode="overwrite")
    back = JR.read_partitioned(spark, derby, "EVENTS", "ts", 6)
    assert back.rdd.getNumPartitions() == 7  # six equal-width ranges + the IS NULL arm
    assert back.schema["ts"].dataType.simpleString() == "timestamp_ntz"
    _same(back, ev)


def test_partitions_sized_by_row_count(spark, derby):
    JW.write_jdbc(_orders(spark), derby, "ORDERS", mode="overwrite")
    df = JR.read_partitioned(spark, derby, "ORDERS", "o_orderkey", 64, rows_per_partition=400)
    assert df.rdd.getNumPartitions() == 4  # ceil(1500 / 400)
    capped = JR.read_partitioned(spark, derby, "ORDERS", "o_orderkey", 3, rows_per_partition=100)
    assert capped.rdd.getNumPartitions() == 3  # never more connections than allowed
    assert df.count() == capped.count() == 1500


def test_write_without_portable_type_defers_to_dialect(spark, derby):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "id INT, v ARRAY<FLOAT>")
    with pytest.raises(Exception) as err:  # Derby has no array type: Spark's own error, not ours
        JW.write_jdbc(df, derby, "ARR", mode="overwrite")
    assert "no JDBC column type" not in str(err.value)


def test_missing_database_fails_without_retry(spark):
    import time

    from sluice.config import JdbcConfig

    cfg = JdbcConfig("jdbc:derby:memory:surely_missing_db", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    t0 = time.time()
    with pytest.raises(Exception) as err:
        JR.read_table(spark, cfg, "T")
    assert not JR.is_transient(err.value)
    assert time.time() - t0 < 8  # no 10 s retry pause


def test_long_texts_use_dialect_text_type(spark, derby):
    from sluice.sinks.jdbc import column_types

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    assert column_types(docs.schema, string_length=None) == "`doc_id` BIGINT"
    JW.write_jdbc(docs, derby, "DOCS", mode="overwrite", create_column_types=column_types(docs.schema, string_length=None))
    back = JR.read_table(spark, derby, "DOCS")
    _same(back, docs)  # whole texts, none cut to 255 characters


def test_append_counted_reports_rows(spark, derby):
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    assert JW.append_counted(nation, derby, "N", expected_rows=25) == 25
    assert JW.append_counted(nation.limit(7), derby, "N", batchsize=3) == 7
    with pytest.raises(RuntimeError):
        JW.append_counted(nation, derby, "N", expected_rows=1)


def test_reserved_word_column_names(spark, derby):
    df = spark.createDataFrame([(1, "x")], "`order` INT, `select` STRING")
    JW.write_jdbc(df, derby, "RW", mode="overwrite")
    assert [tuple(r) for r in JR.read_table(spark, derby, "RW").collect()] == [(1, "x")]


def test_inventory_refuses_unbounded_table_lists(spark, derby):
    for t in ("A1", "A2", "A3"):
        JW.create_if_not_exists(spark, derby, t, "id INT")
    with pytest.raises(ValueError, match="max_tables"):
        JR.source_inventory(spark, derby, "APP", max_tables=2)
    cat = JR.register_catalog(spark, "dby_inv", derby)
    with pytest.raises(ValueError, match="max_tables"):
        JR.catalog_inventory(spark, cat, "APP", max_tables=2)
    assert JR.source_inventory(spark, derby, "APP", max_tables=3).count() == 3


def test_inventory_key_bounds(spark, derby):
    JW.write_jdbc(_orders(spark), derby, "ORDERS", mode="overwrite")
    JW.write_jdbc(spark.read.parquet(f"{SF_SMALL}/region.parquet"), derby, "REGION", mode="overwrite")
    rows = {r.table_name: r for r in JR.source_inventory(spark, derby, "APP", key_columns={"orders": "o_orderkey"}).collect()}
    assert (rows["ORDERS"].row_count, rows["ORDERS"].min_key, rows["ORDERS"].max_key) == (1500, "0", "1499")
    assert (rows["REGION"].row_count, rows["REGION"].min_key) == (5, None)


def test_catalog_inventory_key_bounds_pushed(spark, derby):
    from sluice.plans.inspect import plan_text

    JW.write_jdbc(_orders(spark), derby, "ORDERS", mode="overwrite")
    cat = JR.register_catalog(spark, "dby_kb", derby)
    inv = JR.catalog_inventory(spark, cat, "APP", key_columns={"orders": "o_orderkey"})
    assert [(r.table_name, r.row_count, r.min_key, r.max_key) for r in inv.collect()] == [("ORDERS", 1500, "0", "1499")]
    assert "PushedAggregates: [COUNT(*), MIN(o_orderkey), MAX(o_orderkey)]" in plan_text(inv)


def test_hot_values_and_null_keys_are_spread(spark, derby):
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 7 ELSE CAST(id AS INT) END AS k", "CAST(id AS INT) AS s",
    ).withColumn("s", F.expr("CASE WHEN s % 10 = 0 THEN NULL ELSE s END"))
    JW.write_jdbc(df, derby, "HOTK", mode="overwrite")
    for read in (JR.read_balanced, JR.read_partitioned):
        back = read(spark, derby, "HOTK", "k", 6, spread_column="s")
        _same(back, df)
        sizes = [r["n"] for r in back.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) <= 3000 / 6 * 1.5, sizes


def test_more_rows_than_connections_is_logged(spark, derby, caplog):
    JW.write_jdbc(spark.range(100).selectExpr("CAST(id AS INT) AS id"), derby, "MANY", mode="overwrite")
    with caplog.at_level("WARNING"):
        assert JR.read_partitioned(spark, derby, "MANY", "id", 2, rows_per_partition=10).count() == 100
    assert "10 wanted" in caplog.text
