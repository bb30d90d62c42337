"""Catalog tables: versioned replace, by-name insert, partition pruning, specs."""

import pytest
from pyspark.sql import functions as F

from sluice.plans.inspect import partition_filters, plan_text
from sluice.plans.specs import TPCDS_SPECS, spec
from sluice.sinks import tables as TB
from sluice.sources.rows import from_rows
from tests.conftest import SF_SMALL


def _customer(spark):
    return spark.read.parquet(f"{SF_SMALL}/customer.parquet")


def _same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_partitioned_load_and_prune(spark, tmp_path):
    c = _customer(spark)
    s = TB.spec_from_frame("cust_p", c, ["c_mktsegment"])
    res = TB.create_or_replace(spark, s, c, namespace="t_ns", base=str(tmp_path))
    assert res.rows == c.count() and res.previous_location is None
    back = TB.read_table(spark, s, "t_ns")
    assert back.columns == c.columns  # spec order restored
    _same(back, c)
    one = back.filter(F.col("c_mktsegment") == "BUILDING")
    pf = partition_filters(one)
    assert pf and "BUILDING" in pf[0]
    _same(one, c.filter("c_mktsegment = 'BUILDING'"))


def test_two_key_partitions(spark, tmp_path):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    s = TB.spec_from_frame("ord2", o, ["o_orderstatus", "o_orderpriority"])
    TB.create_or_replace(spark, s, o, namespace="t_ns", base=str(tmp_path))
    parts = spark.sql("SHOW PARTITIONS t_ns.ord2").count()
    assert parts == o.select("o_orderstatus", "o_orderpriority").distinct().count()
    _same(TB.read_table(spark, s, "t_ns"), o)


def test_replace_reads_its_own_previous_version(spark, tmp_path):
    c = _customer(spark)
    s = TB.spec_from_frame("cust_r", c, ["c_mktsegment"])
    first = TB.create_or_replace(spark, s, c, namespace="t_ns", base=str(tmp_path))
    current = TB.read_table(spark, s, "t_ns")
    second = TB.create_or_replace(spark, s, current.filter("c_acctbal >= 0"), namespace="t_ns", base=str(tmp_path))
    assert second.previous_location and second.previous_location.endswith(first.location.split("/")[-1])
    _same(TB.read_table(spark, s, "t_ns"), c.filter("c_acctbal >= 0"))
    # the previous version stays readable for rollback
    assert spark.read.parquet(first.location).count() == c.count()


def test_replace_by_name_not_position(spark, tmp_path):
    c = _customer(spark)
    s = TB.spec_from_frame("cust_n", c, ["c_mktsegment"])
    shuffled = c.select(list(reversed(c.columns)))
    TB.create_or_replace(spark, s, shuffled, namespace="t_ns", base=str(tmp_path))
    _same(TB.read_table(spark, s, "t_ns"), c)


def test_empty_string_partition_value_rejected(spark, tmp_path):
    df = spark.createDataFrame([(1, ""), (2, "x")], "id INT, p STRING")
    s = TB.spec_from_frame("blank", df, ["p"])
    with pytest.raises(ValueError, match="empty-string"):
        TB.create_or_replace(spark, s, df, namespace="t_ns", base=str(tmp_path))
    assert not spark.catalog.tableExists("t_ns.blank")


def test_null_partition_value_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "id INT, p STRING")
    s = TB.spec_from_frame("nullp", df, ["p"])
    TB.create_or_replace(spark, s, df, namespace="t_ns", base=str(tmp_path))
    _same(TB.read_table(spark, s, "t_ns"), df)


def test_insert_by_name(spark, tmp_path):
    c = _customer(spark)
    s = TB.spec_from_frame("cust_i", c, ["c_mktsegment"])
    TB.create_table(spark, s, "t_ns")
    TB.insert_by_name(spark, "t_ns.cust_i", c.select(list(reversed(c.columns))))
    _same(TB.read_table(spark, s, "t_ns"), c)
    with pytest.raises(ValueError):
        TB.insert_by_name(spark, "t_ns.cust_i", c.withColumn("extra", F.lit(1)))


def test_table_from_rows(spark, tmp_path):
    rows = [(i, f"größe {i}", 30 + i % 2) for i in range(5)]
    made = TB.TableSpec("made", (("id", "int"), ("label", "string"), ("grade", "int")), ("grade",))
    res = TB.table_from_rows(spark, made, from_rows(spark, rows, "id INT, label STRING, grade INT"), namespace="t_ns", base=str(tmp_path))
    assert res.rows == 5
    assert {tuple(r) for r in TB.read_table(spark, made, "t_ns").collect()} == set(rows)


def test_failed_create_keeps_the_old_table(spark, tmp_path):
    df = spark.range(6).selectExpr("id", "id % 2 as p")
    s = TB.spec_from_frame("keep_p", df, ["p"])
    TB.create_or_replace(spark, s, df, namespace="t_ns", base=str(tmp_path))
    broken = TB.TableSpec("keep_p", (*s.columns, ("extra", "int")), ("p",), defaults={"extra": "no_such_function()"})
    wide = df.withColumn("extra", F.lit(1))
    with pytest.raises(Exception, match="no_such_function"):
        TB.create_or_replace(spark, broken, wide, namespace="t_ns", base=str(tmp_path))
    _same(TB.read_table(spark, s, "t_ns"), df)


def test_unpartitioned_replace_moves_the_location(spark, tmp_path):
    s = TB.spec_from_frame("moved", spark.range(3))
    first = TB.create_or_replace(spark, s, spark.range(3), namespace="t_ns", base=str(tmp_path))
    second = TB.create_or_replace(spark, s, spark.table("t_ns.moved").where("id > 0"), namespace="t_ns", base=str(tmp_path))
    assert second.previous_location.endswith(first.location.split("/")[-1]) and second.rows == 2
    assert sorted(r.id for r in spark.table("t_ns.moved").collect()) == [1, 2]


def test_v2_replace_calls(spark, monkeypatch):
    """The calls of the V2 branch; no such table format is installed here."""
    from unittest.mock import MagicMock

    monkeypatch.setattr(TB, "_clustered", lambda df, spec: df)
    df, s = MagicMock(), TB.TableSpec("t", (("a", "int"), ("p", "string")), ("p",), "some_format", {"format-version": "2"})
    TB.v2_replace(spark, "cat.ns.t", s, df)
    df.writeTo.assert_called_once_with("`cat`.`ns`.`t`")
    writer = df.writeTo.return_value.using.return_value
    assert writer.partitionedBy.call_count == 1
    writer = writer.partitionedBy.return_value
    writer.tableProperty.assert_called_once_with("format-version", "2")
    writer.tableProperty.return_value.createOrReplace.assert_called_once_with()
    assert not TB.is_v2(spark, "t_ns")
    spark.conf.set("spark.sql.catalog.lake", "some.Catalog")
    assert TB.is_v2(spark, "lake.ns")
    spark.conf.unset("spark.sql.catalog.lake")


def test_tpcds_specs_shape():
    assert len(TPCDS_SPECS) == 11
    assert spec("web_returns").column_names[0] == "wr_returned_date_sk" and len(spec("web_returns").columns) == 24
    assert spec("customer_address").partition_by == ("ca_country", "ca_city")
    assert spec("income_band").partition_by == ()
    assert dict(spec("date_dim").columns)["d_date"] == "date"
    assert len(spec("web_sales").columns) == 34


def _generated_rows(sp, n=6):
    """A few rows per spec; string partition columns get a NULL in row 0."""
    import datetime as dt

    rows = []
    for i in range(n):
        row = []
        for name, typ in sp.columns:
            if typ == "string":
                row.append(None if (name in sp.partition_by and i == 0) else f"{name}_{i % 3}")
            elif typ == "date":
                row.append(dt.date(2020, 1, 1) + dt.timedelta(days=i % 2))
            elif typ in ("double", "float"):
                row.append(i * 1.25)
            else:
                row.append(i % 4)
        rows.append(tuple(row))
    return rows


def test_load_tables_all_tpcds_specs(spark, tmp_path):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS src_ns")
    for sp in TPCDS_SPECS:
        df = spark.createDataFrame(_generated_rows(sp), sp.ddl().replace("`", ""))
        df.write.mode("overwrite").saveAsTable(f"src_ns.{sp.name}")
    results = TB.load_tables(
        spark, TPCDS_SPECS, source_namespace="src_ns", target_namespace="tgt_ns", suffix="_tbl",
        base=str(tmp_path), parallelism=4,
    )
    assert [r.table for r in results] == [f"tgt_ns.{sp.name}_tbl" for sp in TPCDS_SPECS]
    assert [r.rows for r in results] == [6] * 11
    for sp in TPCDS_SPECS:
        target = TB.TableSpec(sp.name + "_tbl", sp.columns, sp.partition_by)
        _same(TB.read_table(spark, target, "tgt_ns"), spark.table(f"src_ns.{sp.name}"))
    # a partition value that is an empty string is refused, the table is kept
    sp = spec("household_demographics")
    bad = spark.createDataFrame([(1, 1, "", 1, 1)], sp.ddl().replace("`", ""))
    with pytest.raises(ValueError, match="empty-string"):
        TB.create_or_replace(spark, TB.TableSpec(sp.name + "_tbl", sp.columns, sp.partition_by), bad, namespace="tgt_ns", base=str(tmp_path))
    assert spark.table("tgt_ns.household_demographics_tbl").count() == 6


def test_column_pruning_reaches_scan(spark, tmp_path):
    c = _customer(spark)
    s = TB.spec_from_frame("cust_prune", c, ["c_mktsegment"])
    TB.create_or_replace(spark, s, c, namespace="t_ns", base=str(tmp_path))
    q = TB.read_table(spark, s, "t_ns").select("c_custkey").filter("c_custkey > 10")
    text = plan_text(q)
    assert "ReadSchema: struct<c_custkey:bigint>" in text
    assert "GreaterThan(c_custkey,10)" in text


def test_column_default_current_timestamp(spark, tmp_path):
    s = TB.TableSpec(
        "trunc_test",
        (("id", "int"), ("name", "string"), ("created_at", "timestamp")),
        defaults={"created_at": "current_timestamp()"},
    )
    TB.create_table(spark, s, "t_ns")
    TB.insert_by_name(spark, "t_ns.trunc_test", spark.createDataFrame([(1, "a"), (2, "b")], "id INT, name STRING"))
    rows = TB.read_table(spark, s, "t_ns").collect()
    assert len(rows) == 2 and all(r.created_at is not None for r in rows)
    # the same spec through a versioned replace fills the default too
    s2 = TB.TableSpec(s.name + "_v", s.columns, defaults=s.defaults)
    TB.create_or_replace(spark, s2, spark.createDataFrame([(3, "c")], "id INT, name STRING"), namespace="t_ns", base=str(tmp_path))
    assert TB.read_table(spark, s2, "t_ns").first().created_at is not None


def test_partitioned_write_is_rebalanced(spark, tmp_path):
    from sluice.plans.inspect import plan_text

    c = _customer(spark)
    s = TB.spec_from_frame("cust_rb", c, ["c_mktsegment"])
    text = plan_text(TB._clustered(s.conform(c), s))
    assert "REBALANCE_PARTITIONS_BY_COL" in text


def test_string_partition_values_keep_their_text(spark, tmp_path):
    # Hive-style path reads would infer '001' as the integer 1; the catalog
    # table carries the spec's string type.
    df = spark.createDataFrame([(1, "001"), (2, "010"), (3, "abc")], "id INT, code STRING")
    s = TB.spec_from_frame("codes", df, ["code"])
    TB.create_or_replace(spark, s, df, namespace="t_ns", base=str(tmp_path))
    got = sorted((r.id, r.code) for r in TB.read_table(spark, s, "t_ns").collect())
    assert got == [(1, "001"), (2, "010"), (3, "abc")]


def test_insert_overwrite_by_name(spark, tmp_path):
    c = _customer(spark)
    s = TB.spec_from_frame("cust_ow", c, ["c_mktsegment"])
    TB.create_table(spark, s, "t_ns")
    TB.insert_by_name(spark, "t_ns.cust_ow", c)
    sub = c.filter("c_acctbal >= 0")
    TB.insert_by_name(spark, "t_ns.cust_ow", sub.select(list(reversed(c.columns))), overwrite=True)
    _same(TB.read_table(spark, s, "t_ns"), sub)


def test_truncate_catalog_table(spark, tmp_path):
    c = _customer(spark)
    s = TB.spec_from_frame("cust_trunc", c, ["c_mktsegment"])
    first = TB.create_or_replace(spark, s, c, namespace="t_ns", base=str(tmp_path))
    res = TB.truncate(spark, s, namespace="t_ns", base=str(tmp_path))
    back = TB.read_table(spark, s, "t_ns")
    assert res.rows == 0 and back.count() == 0 and back.columns == c.columns
    assert res.previous_location.endswith(first.location.split("/")[-1])


def test_spec_column_parser_keeps_parameterised_types():
    from sluice.plans.specs import _cols, specs_from_json

    assert _cols("id int, budget decimal(15,2), tags map<string, int>, name string") == (
        ("id", "int"), ("budget", "decimal(15,2)"), ("tags", "map<string,int>"), ("name", "string"))
    (sp,) = specs_from_json('[{"name": "p", "columns": "id int, budget decimal(15,2)"}]')
    assert sp.columns == (("id", "int"), ("budget", "decimal(15,2)")) and sp.partition_by == ()
