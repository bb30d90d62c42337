"""Command-line jobs against in-memory Derby."""

import json

import pytest

from sluice import cli
from sluice.sinks import jdbc as JW
from sluice.sources import jdbc as JR
from tests.conftest import SF_SMALL


def _args(cfg):
    return ["--url", cfg.url, "--driver", cfg.driver]


def test_connection_test(spark, derby, capsys):
    JW.create_if_not_exists(spark, derby, "T1", "id INT")
    assert cli.main(["connection-test", *_args(derby), "--namespace", "APP"]) == 0
    out = capsys.readouterr().out
    assert "connection_test" in out and "T1" in out


def test_connection_test_failure_exit_code(spark):
    assert cli.main(["connection-test", "--url", "jdbc:derby:memory:nope_does_not_exist"]) == 1


def test_extract(spark, derby, tmp_path, capsys):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    JW.write_jdbc(orders, derby, "ORDERS", mode="overwrite")
    out_dir = str(tmp_path / "orders")
    assert cli.main(["extract", *_args(derby), "--table", "ORDERS", "--output", out_dir,
                     "--partition-column", "o_orderkey", "--num-partitions", "4"]) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["rows_written"] == res["rows_expected"] == 1500
    back = spark.read.parquet(out_dir)
    assert back.exceptAll(orders).isEmpty() and orders.exceptAll(back).isEmpty()


def test_password_from_env_only(spark, derby, monkeypatch):
    with pytest.raises(SystemExit):
        cli.main(["connection-test", *_args(derby), "--password-env", "SLUICE_TEST_UNSET_PW"])
    monkeypatch.setenv("SLUICE_TEST_PW", "secret")
    args = cli.build_parser().parse_args(["connection-test", *_args(derby), "--password-env", "SLUICE_TEST_PW",
                                          "--option", "connectTimeout=60000"])
    cfg = cli._config(args)
    assert cfg.password == "secret" and cfg.options == {"connectTimeout": "60000"} and "secret" not in repr(cfg)


def test_hr_report_with_write_back(spark, derby, hr):
    for name, df in hr.items():
        JW.write_jdbc(df, derby, name.upper(), mode="overwrite")
    stats, part = cli.hr_report(spark, derby, write_back="DEPARTMENT_STATISTICS")
    back = {(r.department, r.employee_count, r.avg_salary) for r in JR.read_table(spark, derby, "DEPARTMENT_STATISTICS").collect()}
    assert back == {("Engineering", 5, 89800.0), ("Finance", 3, 92000.0), ("Marketing", 3, 75000.0),
                    ("Human Resources", 2, 66500.0), ("Sales", 2, 107500.0)}
    assert [r.employee_count for r in part.collect()] == [4, 3, 3, 2, 3, 2]


def test_load_tables_command(spark, tmp_path, capsys):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS tpc_src")
    spark.createDataFrame([(1, 10, 20), (2, 21, 30)], "ib_income_band_sk INT, ib_lower_bound INT, ib_upper_bound INT") \
        .write.mode("overwrite").saveAsTable("tpc_src.income_band")
    assert cli.main(["load-tables", "--source-namespace", "tpc_src", "--target-namespace", "lake",
                     "--suffix", "_tbl", "--tables", "income_band", "--base", str(tmp_path)]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["rows"] == 2
    assert spark.table("lake.income_band_tbl").count() == 2


def test_extract_preflight_gate(spark, tmp_path):
    out = str(tmp_path / "never")
    assert cli.main(["extract", "--url", "jdbc:derby:memory:no_such_db_x", "--table", "T",
                     "--output", out, "--preflight"]) == 1
    import os

    assert not os.path.exists(out)


def test_extract_partitioned_output(spark, derby, tmp_path, capsys):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    JW.write_jdbc(orders, derby, "ORDERS", mode="overwrite")
    out_dir = tmp_path / "by_status"
    assert cli.main(["extract", *_args(derby), "--table", "ORDERS", "--output", str(out_dir),
                     "--partition-column", "o_orderkey", "--num-partitions", "3",
                     "--partition-by", "o_orderstatus"]) == 0
    assert sorted(p.name for p in out_dir.iterdir() if p.is_dir()) == [
        "o_orderstatus=F", "o_orderstatus=O", "o_orderstatus=P"]
    back = spark.read.parquet(str(out_dir)).select(orders.columns)
    assert back.exceptAll(orders).isEmpty() and orders.exceptAll(back).isEmpty()


def test_load_tables_from_spec_file(spark, tmp_path, capsys):
    import json as _json

    spark.sql("CREATE NAMESPACE IF NOT EXISTS spec_src")
    spark.read.parquet(f"{SF_SMALL}/customer.parquet").write.mode("overwrite").saveAsTable("spec_src.customer")
    spec_file = tmp_path / "specs.json"
    spec_file.write_text(_json.dumps([{
        "name": "customer",
        "columns": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        "partition_by": ["c_mktsegment"],
    }]))
    assert cli.main(["load-tables", "--source-namespace", "spec_src", "--target-namespace", "spec_tgt",
                     "--spec-file", str(spec_file), "--base", str(tmp_path / "t"), "--parallel", "2"]) == 0
    assert spark.table("spec_tgt.customer").count() == 150


def test_check_command(spark, capsys):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS chk")
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").write.mode("overwrite").saveAsTable("chk.lineitem")
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").write.mode("overwrite").saveAsTable("chk.orders")
    code = cli.main(["check", "--table", "chk.lineitem", "--not-null",
                     "--foreign-key", "l_orderkey=chk.orders.o_orderkey"])
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 0 and report["null_counts"] == {}
    assert report["orphans"]["l_orderkey=chk.orders.o_orderkey"] == {"keys": 0, "rows": 0}
    code = cli.main(["check", "--table", "chk.lineitem", "--unique", "l_orderkey,l_linenumber"])
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 1 and report["duplicate_keys"]["keys"] > 0


def test_increment_command(spark, derby, tmp_path, capsys):
    rows = spark.createDataFrame([(1, 1), (2, 2), (3, None)], "id INT, m INT")
    JW.write_jdbc(rows, derby, "T_INC", mode="overwrite")
    args = ["increment", *_args(derby), "--table", "T_INC", "--mark-column", "m", "--output", str(tmp_path / "t"),
            "--state", str(tmp_path / "s"), "--partition-column", "id", "--num-partitions", "2"]

    def run():
        assert cli.main(args) == 0
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    assert run()["rows"] == 3
    JW.write_jdbc(spark.createDataFrame([(4, 2), (5, 7)], "id INT, m INT"), derby, "T_INC")
    assert run() == {"low_mark": "2", "high_mark": "7", "rows": 2}
    assert run()["rows"] == 0


def test_hr_report_writes_whole_results(spark, derby, hr, tmp_path, capsys):
    for name, df in hr.items():
        JW.write_jdbc(df, derby, name.upper(), mode="overwrite")
    assert cli.main(["hr-report", *_args(derby), "--output", str(tmp_path / "r")]) == 0
    assert spark.read.parquet(str(tmp_path / "r" / "participation")).count() == 6
    capsys.readouterr()
    assert cli.main(["hr-report", *_args(derby)]) == 0
    assert len(capsys.readouterr().out.strip().splitlines()) == 11


def test_resumable_extract(spark, derby, tmp_path, capsys):
    from sluice.sinks import resumable as R

    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")
    JW.write_jdbc(lines, derby, "LINES", mode="overwrite")
    out_dir = str(tmp_path / "lines")
    command = ["extract", *_args(derby), "--table", "LINES", "--output", out_dir, "--partition-column", "l_orderkey,l_linenumber",
               "--ranges", "6", "--num-partitions", "3"]
    for ranges_read in (7, 0):  # six and the one of NULL keys; then nothing is left
        assert cli.main(command) == 0
        res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
        assert (res["ranges"], res["ranges_read"], res["rows_written"]) == (7, ranges_read, lines.count())
    assert R.read_extract(spark, out_dir).exceptAll(lines).isEmpty()
    with pytest.raises(SystemExit):
        cli.main([*command, "--rebalance"])


def test_compare(spark, tmp_path, capsys):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS cmp_db LOCATION '{tmp_path}/cmp'")
    orders.write.mode("overwrite").saveAsTable("cmp_db.a")
    orders.where("o_orderkey <> 3").withColumn("o_totalprice", orders.o_totalprice + (orders.o_orderkey == 5).cast("int")).write.mode("overwrite").saveAsTable("cmp_db.b")
    assert cli.main(["compare", "--left", "cmp_db.a", "--right", "cmp_db.a", "--keys", "o_orderkey"]) == 0
    out = str(tmp_path / "diff")
    assert cli.main(["compare", "--left", "cmp_db.a", "--right", "cmp_db.b", "--keys", "o_orderkey", "--output", out]) == 1
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["differences"] == {"missing_right": 1, "changed": 1}
    assert {(r.o_orderkey, r.status, r.changed) for r in spark.read.parquet(out).collect()} == {(3, "missing_right", ""), (5, "changed", "o_totalprice")}


def test_an_increment_reads_what_is_pending(spark, derby, tmp_path, capsys, monkeypatch):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    JW.write_jdbc(orders.where("o_orderkey < 900"), derby, "GROWS", mode="overwrite")
    command = ["increment", *_args(derby), "--table", "GROWS", "--mark-column", "o_orderkey", "--output", str(tmp_path / "t"),
               "--state", str(tmp_path / "s"), "--partition-column", "o_orderkey", "--num-partitions", "4"]
    assert cli.main(command) == 0
    JW.write_jdbc(orders.where("o_orderkey >= 900"), derby, "GROWS", mode="append")
    asked, real = [], JR.bounds
    monkeypatch.setattr(JR, "bounds", lambda spark, cfg, table, column: asked.append(real(spark, cfg, table, column)) or asked[-1])
    assert cli.main(command) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["rows"] == 600
    assert all((b.lower, b.rows) == (899, 601) for b in asked)  # the strides lie in the pending range
    from sluice.streaming.incremental import read_loaded

    loaded = read_loaded(spark, str(tmp_path / "t"))
    assert loaded.count() == orders.count() and loaded.exceptAll(orders).isEmpty()


def test_versioned_extract(spark, derby, tmp_path, capsys):
    from sluice.sinks.exports import read_export

    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    out_dir = str(tmp_path / "orders")
    for rows in (orders.where("o_orderkey < 100"), orders):
        JW.write_jdbc(rows, derby, "VERS", mode="overwrite")
        assert cli.main(["extract", *_args(derby), "--table", "VERS", "--output", out_dir, "--partition-column", "o_orderkey", "--versioned"]) == 0
    assert read_export(spark, out_dir).exceptAll(orders).isEmpty() and read_export(spark, out_dir).count() == 1500
    assert read_export(spark, out_dir, version=1).count() == 100
