"""The JDBC functions over the driver's tables, through an in-process Derby
database that only this JVM sees; compared with DuckDB on the same files."""

import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from sluice.config import JdbcConfig, derby_memory
from sluice.operators import analytics as A
from sluice.plans.queries import table
from sluice.session import shared_path
from sluice.sinks import jdbc as JW
from sluice.sinks.parquet import extract_to_parquet
from sluice.sources import jdbc as JR
from tests.conftest import SF_SMALL


def _derby(spark, sf_dir, *names) -> JdbcConfig:
    cfg = derby_memory(f"sluice_{uuid.uuid4().hex[:12]}")
    for n in names:
        df = table(spark, sf_dir, n)  # Derby's text type cannot be compared: strings get a length
        JW.write_jdbc(df, cfg, n.upper(), mode="overwrite", create_column_types=JW.column_types(df.schema, string_length=255))
    return cfg


def partition_bounds(spark, d):
    cfg = _derby(spark, d, "orders")
    return JR.bounds_frame(spark, cfg, "ORDERS", "o_orderkey")


def _catalog(spark, cfg):
    return JR.register_catalog(spark, f"src_{uuid.uuid4().hex[:8]}", cfg)


def partition_bounds_catalog(spark, d):
    cat = _catalog(spark, _derby(spark, d, "orders"))
    return JR.catalog_bounds(spark, f"{cat}.APP.ORDERS", "o_orderkey")


def catalog_top_orders(spark, d):
    cat = _catalog(spark, _derby(spark, d, "orders"))
    orders = spark.table(f"{cat}.APP.ORDERS")
    return A.filter_not_in_top(
        orders,
        equals={"o_orderstatus": "F"},
        not_in={"o_orderpriority": ["5-LOW"]},
        order_by=[F.col("o_totalprice").desc(), F.col("o_orderkey")],
        limit=10,
    )


def source_inventory_catalog(spark, d):
    cat = _catalog(spark, _derby(spark, d, "customer", "orders", "supplier"))
    return JR.catalog_inventory(spark, cat, "APP")


def jdbc_read_table(spark, d):
    cfg = _derby(spark, d, "orders")
    return JR.read_table(spark, cfg, "ORDERS")


def jdbc_read_partitioned(spark, d):
    cfg = _derby(spark, d, "orders")
    return JR.read_partitioned(spark, cfg, "ORDERS", "o_orderkey", 8)


def jdbc_read_predicates(spark, d):
    cfg = _derby(spark, d, "orders")
    preds = JR.balanced_predicates(spark, cfg, "ORDERS", "o_orderpriority", 8)
    return JR.read_by_predicates(spark, cfg, "ORDERS", preds)


def jdbc_read_balanced(spark, d):
    cfg = _derby(spark, d, "orders")
    return JR.read_balanced(spark, cfg, "ORDERS", "o_custkey", 8)


def jdbc_read_query(spark, d):
    cfg = _derby(spark, d, "orders")
    q = cfg.quote
    sql = (
        f"SELECT {q('o_orderkey')}, {q('o_custkey')}, {q('o_totalprice')} FROM ORDERS "
        f"WHERE {q('o_orderstatus')} = 'F'"
    )
    return JR.read_query(spark, cfg, sql)


def jdbc_read_subquery(spark, d):
    cfg = _derby(spark, d, "orders")
    q = cfg.quote
    sql = (
        f"SELECT {q('o_orderstatus')}, COUNT(*) AS {q('n_orders')}, "
        f"MAX({q('o_totalprice')}) AS {q('max_totalprice')} FROM ORDERS GROUP BY {q('o_orderstatus')}"
    )
    return JR.read_subquery(spark, cfg, sql, "by_status").withColumn(
        "n_orders", F.col("n_orders").cast("bigint")
    )


def jdbc_append(spark, d):
    cfg = derby_memory(f"sluice_{uuid.uuid4().hex[:12]}")
    customer = table(spark, d, "customer")
    first = JW.append_counted(customer, cfg, "CUSTOMER")
    JW.append_counted(customer, cfg, "CUSTOMER", expected_rows=first, batchsize=500)
    return JR.read_table(spark, cfg, "CUSTOMER")


def jdbc_overwrite_truncate(spark, d):
    cfg = _derby(spark, d, "customer")
    subset = table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    JW.write_jdbc(subset, cfg, "CUSTOMER", mode="overwrite", truncate=True)
    return JR.read_table(spark, cfg, "CUSTOMER")


def jdbc_truncate(spark, d):
    cfg = _derby(spark, d, "customer")
    JW.truncate_table(spark, cfg, "CUSTOMER")
    return JR.read_table(spark, cfg, "CUSTOMER")


def source_inventory(spark, d):
    cfg = _derby(spark, d, "customer", "orders", "supplier")
    keys = {"customer": "c_custkey", "orders": "o_orderkey", "supplier": "s_suppkey"}
    return JR.source_inventory(spark, cfg, "APP", key_columns=keys)


def jdbc_extract_parquet(spark, d):
    cfg = _derby(spark, d, "orders")
    res = extract_to_parquet(
        spark, cfg, "ORDERS", shared_path(spark, "extract", "orders"), partition_column="o_orderkey", num_partitions=8
    )
    return spark.read.parquet(res.path)


QUERIES = {
    "partition_bounds": partition_bounds,
    "partition_bounds_catalog": partition_bounds_catalog,
    "catalog_top_orders": catalog_top_orders,
    "source_inventory_catalog": source_inventory_catalog,
    "jdbc_read_table": jdbc_read_table,
    "jdbc_read_partitioned": jdbc_read_partitioned,
    "jdbc_read_predicates": jdbc_read_predicates,
    "jdbc_read_balanced": jdbc_read_balanced,
    "jdbc_read_query": jdbc_read_query,
    "jdbc_read_subquery": jdbc_read_subquery,
    "jdbc_append": jdbc_append,
    "jdbc_overwrite_truncate": jdbc_overwrite_truncate,
    "jdbc_truncate": jdbc_truncate,
    "source_inventory": source_inventory,
    "jdbc_extract_parquet": jdbc_extract_parquet,
}

ORACLE_SQL = {
    "partition_bounds": "SELECT MIN(o_orderkey) AS min_val, MAX(o_orderkey) AS max_val FROM orders",
    "partition_bounds_catalog": "SELECT MIN(o_orderkey) AS min_val, MAX(o_orderkey) AS max_val FROM orders",
    "catalog_top_orders": """
        SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority NOT IN ('5-LOW')
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
    "source_inventory_catalog": """
        SELECT 'APP' AS namespace, 'CUSTOMER' AS table_name, (SELECT COUNT(*) FROM customer) AS row_count
        UNION ALL SELECT 'APP', 'ORDERS', (SELECT COUNT(*) FROM orders)
        UNION ALL SELECT 'APP', 'SUPPLIER', (SELECT COUNT(*) FROM supplier)""",
    "jdbc_read_table": "SELECT * FROM orders",
    "jdbc_read_partitioned": "SELECT * FROM orders",
    "jdbc_read_predicates": "SELECT * FROM orders",
    "jdbc_read_balanced": "SELECT * FROM orders",
    "jdbc_read_query": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
    "jdbc_read_subquery": """
        SELECT o_orderstatus, COUNT(*) AS n_orders, MAX(o_totalprice) AS max_totalprice
        FROM orders GROUP BY o_orderstatus""",
    "jdbc_append": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "jdbc_overwrite_truncate": "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'",
    "jdbc_truncate": "SELECT * FROM customer WHERE false",
    "source_inventory": """
        SELECT 'APP' AS namespace, 'CUSTOMER' AS table_name, COUNT(*) AS row_count,
               CAST(MIN(c_custkey) AS VARCHAR) AS min_key, CAST(MAX(c_custkey) AS VARCHAR) AS max_key
        FROM customer
        UNION ALL SELECT 'APP', 'ORDERS', COUNT(*), CAST(MIN(o_orderkey) AS VARCHAR),
               CAST(MAX(o_orderkey) AS VARCHAR) FROM orders
        UNION ALL SELECT 'APP', 'SUPPLIER', COUNT(*), CAST(MIN(s_suppkey) AS VARCHAR),
               CAST(MAX(s_suppkey) AS VARCHAR) FROM supplier""",
    "jdbc_extract_parquet": "SELECT * FROM orders",
}


@pytest.mark.parametrize("name", QUERIES)
def test_jdbc_query(spark, name):
    con = duckdb.connect()
    for t in ("customer", "orders", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'").fetchall()
    df = QUERIES[name](spark, SF_SMALL)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE_SQL[name]})").fetchall()

    def plain(rows):
        return sorted(repr(tuple(float(v) if type(v).__name__ in ("float", "Decimal") else v for v in r)) for r in rows)

    assert plain(df.collect()) == plain(want)
