"""Appends to a database table that happen once, however often they are tried.

Spark commits a JDBC write partition by partition, so a job that dies midway, or a
task that is lost after its commit, leaves rows twice or in part. Here the rows go
to a staging table, each with its number; then one transaction on one connection
enters the batch in a ledger table (its name is the primary key), moves the rows
inside the database with INSERT ... SELECT, each number once, compares their
number with what Spark wrote, and commits. A batch that is in the ledger is not
moved again, and readers of the target see all of a batch or nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.config import JdbcConfig
from sluice.sinks.counting import observed
from sluice.sinks.jdbc import table_exists, write_jdbc
from sluice.sources.jdbc import read_subquery

ROW = "sluice_row"
LEDGER = "sluice_batches"


class BatchRefused(RuntimeError):
    """The staged rows aren't those of the source; the target is unchanged."""


@dataclass(frozen=True)
class BatchResult:
    #: False if the batch was in the target already.
    moved: bool
    rows: int


@contextmanager
def transaction(spark: SparkSession, cfg: JdbcConfig):
    """One connection of the driver with one transaction: ``run(sql)`` gives the
    rows a statement touched. Commits at the end, rolls back on an error."""
    options = cfg.spark_options()
    url, jvm = options.pop("url"), spark._jvm
    if driver := options.pop("driver", None):
        jvm.java.lang.Class.forName(driver, True, jvm.Thread.currentThread().getContextClassLoader())
    properties = jvm.java.util.Properties()
    for k, v in options.items():
        properties.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()

        def run(sql: str) -> int:
            return statement.executeUpdate(sql)

        yield run
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def ensure_ledger(spark: SparkSession, cfg: JdbcConfig, ledger: str = LEDGER) -> None:
    """Make the ledger table if it isn't there. Batch names have at most 200 letters."""
    if table_exists(spark, cfg, ledger):
        return
    with transaction(spark, cfg) as run:
        run(
            f"CREATE TABLE {ledger} ({cfg.quote('batch')} VARCHAR(200) NOT NULL PRIMARY KEY, "
            f"{cfg.quote('target')} VARCHAR(200) NOT NULL, {cfg.quote('n_rows')} BIGINT NOT NULL)"
        )


def moved_rows(spark: SparkSession, cfg: JdbcConfig, batch: str, ledger: str = LEDGER) -> int | None:
    """Rows of a batch that the ledger holds, None if it doesn't hold it."""
    sql = f"SELECT {cfg.quote('n_rows')} FROM {ledger} WHERE {cfg.quote('batch')} = {_text(batch)}"
    row = read_subquery(spark, cfg, sql, "l").first()
    return None if row is None else int(row["n_rows"])


def append_batch(
    df: DataFrame,
    cfg: JdbcConfig,
    table: str,
    batch: str,
    *,
    staging_table: str | None = None,
    replace: bool = False,
    ledger: str = LEDGER,
    after_staging: Callable[[], None] | None = None,
    **write_options,
) -> BatchResult:
    """Add the rows of ``df`` to ``table`` as ``batch``, once. The table must
    exist; columns go by name. With ``replace`` the same transaction empties it
    first. ``after_staging`` runs between staging and moving (tests).

    Several copies of a staged row (a task that ran twice) have the same number
    and values and are moved as one, by grouping, which needs comparable columns
    (texts with a length, no CLOB)."""
    spark = df.sparkSession
    ensure_ledger(spark, cfg, ledger)
    already = moved_rows(spark, cfg, batch, ledger)
    if already is not None:
        return BatchResult(False, already)
    if not table_exists(spark, cfg, table):
        raise ValueError(f"{table} does not exist")
    staging = staging_table or f"{table}_stage"
    seen = Observation()
    numbered = df.withColumn(ROW, F.monotonically_increasing_id()).observe(seen, F.count(F.lit(1)).alias("n"))
    write_jdbc(numbered, cfg, staging, mode="overwrite", truncate=False, **write_options)
    rows = observed(seen, "n")["n"]
    if after_staging:
        after_staging()
    listed = ", ".join(cfg.quote(c) for c in df.columns)
    row = cfg.quote(ROW)
    n, k = cfg.quote("n"), cfg.quote("k")
    counts = read_subquery(spark, cfg, f"SELECT COUNT(*) AS {n}, COUNT(DISTINCT {row}) AS {k} FROM {staging}", "s").first()
    if counts["k"] != rows:
        raise BatchRefused(f"{staging} holds {counts['k']} rows, Spark wrote {rows}; {table} is unchanged")
    once = f"SELECT {listed} FROM {staging}"
    if counts["n"] != counts["k"]:
        least = ", ".join(f"MIN({cfg.quote(c)})" for c in df.columns)
        once = f"SELECT {least} FROM {staging} GROUP BY {row}"
    try:
        with transaction(spark, cfg) as run:
            # A second job with this batch waits here and then fails on the key.
            run(f"INSERT INTO {ledger} VALUES ({_text(batch)}, {_text(table)}, {rows})")
            if replace:
                run(f"DELETE FROM {table}")
            moved = run(f"INSERT INTO {table} ({listed}) {once}")
            if moved != rows:
                raise BatchRefused(f"{table}: {moved} rows would be added, Spark wrote {rows}; it is unchanged")
    except Exception:
        if (other := moved_rows(spark, cfg, batch, ledger)) is not None:
            return BatchResult(False, other)
        raise
    with transaction(spark, cfg) as run:
        run(f"DROP TABLE {staging}")
    return BatchResult(True, rows)
