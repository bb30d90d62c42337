"""Command-line jobs (``python -m sluice <command>`` or spark-submit).

  connection-test  SELECT 1 through the source, then list its tables
  extract          JDBC table -> Parquet, parallel by a measured key range,
                   verified against the source's COUNT(*); ``--preflight``
                   runs the connection test first and stops if it fails;
                   ``--ranges N`` makes it resumable: a run that failed is
                   taken up by running the command again
  load-tables      replace spec'd tables (TPC-DS set) from a source namespace
  hr-report        read the HR tables over JDBC, compute department statistics
                   and project participation, optionally write the statistics
                   back (truncating overwrite) and check the count
  increment        load what a JDBC table has gained since the last run
  compare          the differences of two catalog tables by key, found by a
                   tree of hash sums; exit code 1 if there are any
  check            NOT NULL / unique / foreign-key checks on a catalog table;
                   exit code 1 when any check finds violations

Secrets never go on the command line: ``--password-env NAME`` names an
environment variable that holds the password.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Sequence

from sluice.config import JdbcConfig, redact_url


def _jdbc_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--url", required=True, help="JDBC URL")
    p.add_argument("--driver", help="JDBC driver class")
    p.add_argument("--user")
    p.add_argument("--password-env", help="environment variable holding the password")
    p.add_argument(
        "--option", action="append", default=[], metavar="KEY=VALUE",
        help="driver / reader option, repeatable (connectTimeout=60000, useSSL=true, ...)",
    )


def _config(args: argparse.Namespace) -> JdbcConfig:
    password = None
    if args.password_env:
        if args.password_env not in os.environ:
            raise SystemExit(f"environment variable {args.password_env} is not set")
        password = os.environ[args.password_env]
    options = {}
    for item in args.option:
        key, sep, value = item.partition("=")
        if not sep:
            raise SystemExit(f"--option needs KEY=VALUE, got {item!r}")
        options[key] = value
    return JdbcConfig(url=args.url, driver=args.driver, user=args.user, password=password, options=options)


def _session():
    from sluice.session import build_session

    return build_session(app_name="sluice")


def cmd_connection_test(args: argparse.Namespace) -> int:
    from sluice.sources import jdbc as JR

    spark = _session()
    cfg = _config(args)
    print(f"testing {redact_url(cfg.url)}")
    try:
        JR.connection_check(spark, cfg).show()
        tables = JR.list_tables(spark, cfg, args.namespace).orderBy("namespace", "table_name")
        for r in tables.toLocalIterator():  # every table, one partition at a time
            print(f"{r['namespace']}.{r['table_name']}")
    except Exception as error:  # noqa: BLE001 - report and exit non-zero
        print(f"connection failed: {error}", file=sys.stderr)
        return 1
    return 0


def cmd_extract(args: argparse.Namespace) -> int:
    from sluice.sinks.parquet import extract_to_parquet

    from sluice.sources.jdbc import connection_check

    spark = _session()
    cfg = _config(args)
    if args.preflight:
        try:
            connection_check(spark, cfg).collect()
        except Exception as error:  # noqa: BLE001 - the gate reports and stops
            print(f"preflight failed, nothing read: {error}", file=sys.stderr)
            return 1
    if args.ranges:
        from sluice.sinks.resumable import extract_table_resumable

        if not args.partition_column:
            raise SystemExit("--ranges needs --partition-column (several columns: comma-separated)")
        unused = [n for n in ("rows_per_partition", "max_records_per_file", "partition_by", "rebalance", "versioned") if getattr(args, n)]
        if unused:
            raise SystemExit(f"--ranges goes without {', '.join('--' + n.replace('_', '-') for n in unused)}")
        key = args.partition_column.split(",")
        done = extract_table_resumable(
            spark, cfg, args.table, args.output, key[0] if len(key) == 1 else key, args.ranges,
            ranges_per_job=args.num_partitions, compression=args.compression,
        )
        print(json.dumps({"path": done.path, "ranges": done.ranges, "ranges_read": done.ranges_read, "rows_written": done.rows}))
        return 0
    res = extract_to_parquet(
        spark, cfg, args.table, args.output,
        partition_column=args.partition_column, num_partitions=args.num_partitions,
        rows_per_partition=args.rows_per_partition, compression=args.compression,
        max_records_per_file=args.max_records_per_file,
        partition_by=[c for c in (args.partition_by or "").split(",") if c],
        rebalance=args.rebalance, versioned=args.versioned,
    )
    print(json.dumps({"path": res.path, "rows_expected": res.rows_expected, "rows_written": res.rows_written}))
    return 0


def cmd_load_tables(args: argparse.Namespace) -> int:
    from pathlib import Path

    from sluice.plans.specs import TPCDS_SPECS, specs_from_json
    from sluice.sinks.tables import load_tables

    spark = _session()
    catalog = specs_from_json(Path(args.spec_file).read_text()) if args.spec_file else list(TPCDS_SPECS)
    wanted = set(args.tables.split(",")) if args.tables else None
    specs = [s for s in catalog if wanted is None or s.name in wanted]
    if wanted and len(specs) != len(wanted):
        raise SystemExit(f"unknown tables: {sorted(wanted - {s.name for s in specs})}")
    results = load_tables(
        spark, specs, source_namespace=args.source_namespace, target_namespace=args.target_namespace,
        suffix=args.suffix, base=args.base, parallelism=args.parallel,
    )
    for r in results:
        print(json.dumps({"table": r.table, "rows": r.rows, "location": r.location}))
    return 0


def hr_report(
    spark,
    cfg: JdbcConfig,
    *,
    write_back: str | None = None,
    tables: dict[str, str] | None = None,
    read_partitions: int = 10,
):
    """The HR analytics over JDBC tables; returns (department stats, participation)."""
    from sluice.operators import analytics as A
    from sluice.sinks import jdbc as JW
    from sluice.sources import jdbc as JR

    names = {"employees": "employees", "departments": "departments", "projects": "projects",
             "employee_projects": "employee_projects", **(tables or {})}
    employees = JR.read_table(spark, cfg, names["employees"])
    # One row per department, used three times (write, check, show): cache it
    # rather than reading the source again; a lost block is recomputed.
    stats = A.group_count_avg(employees, "department", "salary").cache()
    participation = A.project_participation(
        JR.read_table(spark, cfg, names["projects"]),
        JR.read_table(spark, cfg, names["departments"]),
        # The table that grows: read in parallel by its project key.
        JR.read_partitioned(spark, cfg, names["employee_projects"], "project_id", read_partitions),
        project_id="id", project_name="name", project_budget="budget", project_department="department_id",
        department_id="id", department_name="name", assignment_project="project_id",
        assignment_member="employee_id",
    )
    if write_back:
        JW.write_jdbc(stats, cfg, write_back, mode="overwrite")
        written, expected = JW.row_count(spark, cfg, write_back), stats.count()
        if written != expected:
            raise RuntimeError(f"{write_back}: {written} rows written, {expected} computed")
    return stats, participation


def cmd_hr_report(args: argparse.Namespace) -> int:
    spark = _session()
    stats, participation = hr_report(
        spark, _config(args), write_back=args.write_back, read_partitions=args.read_partitions
    )
    if args.output:
        from sluice.sinks.parquet import export_parquet

        for name, df in (("department_stats", stats), ("participation", participation)):
            res = export_parquet(df, f"{args.output.rstrip('/')}/{name}")
            print(json.dumps({"path": res.path, "rows_written": res.rows_written}))
        return 0
    for r in stats.toJSON().toLocalIterator():  # whole results, one partition at a time
        print(r)
    for r in participation.toJSON().toLocalIterator():
        print(r)
    return 0


def cmd_increment(args: argparse.Namespace) -> int:
    from sluice.sources import jdbc as JR
    from sluice.streaming.incremental import load_increment, read_mark, typed_mark

    spark = _session()
    cfg = _config(args)
    # What is pending is cut out by the source: its MAX, and the strides of a
    # parallel read, come from the pending rows alone.
    table, mark = args.table, cfg.quote(args.mark_column)
    dtype = JR.with_retry(lambda: JR.read_table(spark, cfg, table)).schema[args.mark_column].dataType
    last = typed_mark(read_mark(spark, args.state, redact_url(cfg.url), table), dtype)
    if last is not None:
        literal = JR._literal(last, cfg.flavor)
        table = f"(SELECT * FROM {table} WHERE {mark} >= {literal} OR {mark} IS NULL) pending"
    bounds = JR.with_retry(lambda: JR.bounds(spark, cfg, table, args.mark_column))
    if args.partition_column:
        source = JR.read_partitioned(spark, cfg, table, args.partition_column, args.num_partitions)
    else:
        source = JR.read_table(spark, cfg, table)
    res = load_increment(
        source, args.output, args.mark_column, args.state, source=redact_url(cfg.url), table=args.table,
        high_mark=bounds.upper,
    )
    print(json.dumps({"low_mark": str(res.low_mark), "high_mark": str(res.high_mark), "rows": res.rows}))
    return 0


def cmd_compare(args: argparse.Namespace) -> int:
    from pyspark.sql import functions as F

    from sluice.operators.fingerprint import compare_tables
    from sluice.sources.catalog import read_catalog_table

    spark = _session()
    columns = [c for c in (args.columns or "").split(",") if c] or None
    found = compare_tables(
        read_catalog_table(spark, args.left), read_catalog_table(spark, args.right), args.keys.split(","), columns
    )
    if args.output:
        from sluice.sinks.parquet import export_parquet

        export_parquet(found, args.output)
        found = spark.read.schema(found.schema).parquet(args.output)
    counts = {r["status"]: r["n"] for r in found.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}  # four at most
    print(json.dumps({"left": args.left, "right": args.right, "differences": counts}))
    return 1 if counts else 0


def cmd_check(args: argparse.Namespace) -> int:
    from pyspark.sql import functions as F

    from sluice.operators import quality as Q
    from sluice.sources.catalog import read_catalog_table

    spark = _session()
    df = read_catalog_table(spark, args.table)
    report: dict[str, object] = {"table": args.table}
    failed = False
    if args.not_null is not None:
        cols = [c for c in args.not_null.split(",") if c] or None
        nulls = {r.column_name: r.null_count for r in Q.check_not_null(df, cols).collect()}  # one row per column
        report["null_counts"] = {k: v for k, v in nulls.items() if v}
        failed |= bool(report["null_counts"])
    if args.unique:
        dup = Q.check_unique(df, args.unique.split(","))
        n = dup.agg(F.count(F.lit(1)).alias("keys"), F.sum("n_rows").alias("rows")).first()
        report["duplicate_keys"] = {"keys": n["keys"], "rows": n["rows"] or 0}
        failed |= bool(n["keys"])
    for fk in args.foreign_key:
        child_cols, _, target = fk.partition("=")
        parent_table, _, parent_cols = target.rpartition(".")
        orphans = Q.check_foreign_key(
            df, read_catalog_table(spark, parent_table), child_cols.split(","), parent_cols.split(",")
        )
        n = orphans.agg(F.count(F.lit(1)).alias("keys"), F.sum("n_rows").alias("rows")).first()
        report.setdefault("orphans", {})[fk] = {"keys": n["keys"], "rows": n["rows"] or 0}
        failed |= bool(n["keys"])
    print(json.dumps(report))
    return 1 if failed else 0


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(
        prog="sluice", description="Spark jobs: JDBC extract, table loads, analytics write-back."
    )
    sub = parser.add_subparsers(dest="command", required=True)

    p = sub.add_parser("connection-test", help="SELECT 1 through the source, then list its tables")
    _jdbc_args(p)
    p.add_argument("--namespace")
    p.set_defaults(func=cmd_connection_test)

    p = sub.add_parser("extract", help="JDBC table -> Parquet, parallel, checked against COUNT(*)")
    _jdbc_args(p)
    p.add_argument("--table", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--partition-column")
    p.add_argument("--num-partitions", type=int, default=10, help="upper limit of parallel connections")
    p.add_argument(
        "--ranges", type=int,
        help="resumable: cut the key (--partition-column, one or several) into so many ranges, --num-partitions of them in a job",
    )
    p.add_argument("--rows-per-partition", type=int, help="size the read by the source's COUNT(*)")
    p.add_argument("--compression", default="snappy")
    p.add_argument("--max-records-per-file", type=int)
    p.add_argument("--partition-by", help="comma-separated output partition columns")
    p.add_argument("--rebalance", action="store_true", help="cluster rows by the partition columns first")
    p.add_argument("--versioned", action="store_true", help="write a version behind a pointer; readers never find the output missing")
    p.add_argument("--preflight", action="store_true", help="run the connection test first; stop if it fails")
    p.set_defaults(func=cmd_extract)

    p = sub.add_parser("load-tables", help="replace the spec'd tables from a source namespace")
    p.add_argument("--source-namespace", required=True)
    p.add_argument("--target-namespace", required=True)
    p.add_argument("--suffix", default="")
    p.add_argument("--spec-file", help="JSON list of table specs (default: the TPC-DS set)")
    p.add_argument("--tables", help="comma-separated subset of the spec list")
    p.add_argument("--base", help="root folder for table versions (default: warehouse dir)")
    p.add_argument("--parallel", type=int, default=1, help="tables loaded as concurrent jobs")
    p.set_defaults(func=cmd_load_tables)

    p = sub.add_parser("hr-report", help="department statistics and project participation over JDBC")
    _jdbc_args(p)
    p.add_argument("--write-back", help="table to receive the department statistics")
    p.add_argument("--output", help="folder for both results as Parquet (default: JSON lines on standard output)")
    p.add_argument("--read-partitions", type=int, default=10, help="parallel reads of the assignments table")
    p.set_defaults(func=cmd_hr_report)

    p = sub.add_parser("increment", help="load what a JDBC table has gained since the last run")
    _jdbc_args(p)
    p.add_argument("--table", required=True)
    p.add_argument("--mark-column", required=True, help="monotonic column whose highest value is remembered")
    p.add_argument("--output", required=True)
    p.add_argument("--state", required=True, help="folder of the remembered marks")
    p.add_argument("--partition-column", help="key for parallel reads")
    p.add_argument("--num-partitions", type=int, default=10, help="upper limit of parallel connections")
    p.set_defaults(func=cmd_increment)

    p = sub.add_parser("compare", help="differences of two catalog tables by key")
    p.add_argument("--left", required=True, help="ns.table")
    p.add_argument("--right", required=True, help="ns.table")
    p.add_argument("--keys", required=True, help="key columns, comma-separated")
    p.add_argument("--columns", help="columns to compare, comma-separated (default: all others)")
    p.add_argument("--output", help="folder for the differences as Parquet")
    p.set_defaults(func=cmd_compare)

    p = sub.add_parser("check", help="NOT NULL / unique / foreign-key checks on a catalog table")
    p.add_argument("--table", required=True, help="ns.table")
    p.add_argument("--not-null", nargs="?", const="", help="columns (comma-separated; empty = all)")
    p.add_argument("--unique", help="key columns, comma-separated")
    p.add_argument(
        "--foreign-key", action="append", default=[], metavar="COLS=NS.PARENT.COLS",
        help="e.g. l_orderkey=sales.orders.o_orderkey (repeatable)",
    )
    p.set_defaults(func=cmd_check)
    return parser


def main(argv: Sequence[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    return int(args.func(args) or 0)


if __name__ == "__main__":
    raise SystemExit(main())
