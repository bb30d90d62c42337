"""JDBC write-back: append / overwrite / ignore / error, truncate, DDL types.

Spark writes each partition in its own transaction, so a failed task can
leave a partial append; ``stage_and_publish`` loads a staging table, checks
it, then replaces the target in one overwrite.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluice.config import JdbcConfig
from sluice.sources.jdbc import read_partitioned, read_subquery, read_table

SAVE_MODES = ("append", "overwrite", "ignore", "errorifexists", "error", "default")


def column_types(
    schema: T.StructType,
    *,
    string_length: int | None = None,
    overrides: Mapping[str, str] | None = None,
) -> str:
    """Target column types for ``createTableColumnTypes`` derived from a schema.

    String columns are left out of the list, so they get the dialect's text
    type, which holds any length (Spark accepts a partial list); with
    ``string_length`` they become VARCHAR(n), which can be indexed. Decimals
    keep precision and scale. A type without a mapping is an error, not a
    silent VARCHAR.
    """
    overrides = dict(overrides or {})
    parts = []
    for f in schema.fields:
        if f.name in overrides:
            parts.append(f"{_bq(f.name)} {overrides[f.name]}")
            continue
        t = f.dataType
        if isinstance(t, T.StringType):
            if string_length is None:
                continue
            sql = f"VARCHAR({string_length})"
        elif isinstance(t, T.IntegerType):
            sql = "INT"
        elif isinstance(t, T.LongType):
            sql = "BIGINT"
        elif isinstance(t, T.ShortType):
            sql = "SMALLINT"
        elif isinstance(t, T.DoubleType):
            sql = "DOUBLE"
        elif isinstance(t, T.FloatType):
            sql = "REAL"
        elif isinstance(t, T.DecimalType):
            sql = f"DECIMAL({t.precision},{t.scale})"
        elif isinstance(t, T.DateType):
            sql = "DATE"
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            sql = "TIMESTAMP"
        elif isinstance(t, T.BooleanType):
            sql = "BOOLEAN"
        else:
            raise TypeError(f"no JDBC column type for {f.name}: {t.simpleString()}")
        parts.append(f"{_bq(f.name)} {sql}")
    return ", ".join(parts)


def _bq(name: str) -> str:
    """Back-quote a column name for Spark's parser (reserved words, spaces)."""
    return "`" + name.replace("`", "``") + "`"


def write_jdbc(
    df: DataFrame,
    cfg: JdbcConfig,
    table: str,
    mode: str = "append",
    *,
    truncate: bool | None = None,
    batchsize: int = 1000,
    num_partitions: int | None = None,
    isolation_level: str | None = None,
    create_column_types: str | None = None,
    create_table_options: str | None = None,
) -> None:
    """Write ``df`` to ``table`` with any save mode.

    Overwrite truncates by default (keeps the target's keys and column
    types); set ``truncate=False`` for DROP + CREATE. New tables get
    ``column_types(df.schema)`` unless ``create_column_types`` is given.
    ``num_partitions`` caps concurrent connections (Spark coalesces, no
    shuffle).
    """
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of {SAVE_MODES}, got {mode!r}")
    opts = cfg.spark_options()
    opts["dbtable"] = table
    opts["batchsize"] = str(batchsize)
    try:
        types = create_column_types or column_types(df.schema)
    except TypeError:
        # A type without a portable mapping (arrays, maps...): leave creation
        # to Spark's dialect, which knows what the target supports, and is
        # not consulted at all when the table already exists.
        types = ""
    if types:
        opts["createTableColumnTypes"] = types
    if mode == "overwrite":
        opts["truncate"] = "false" if truncate is False else "true"
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    if isolation_level:
        opts["isolationLevel"] = isolation_level
    if create_table_options:
        opts["createTableOptions"] = create_table_options
    df.write.format("jdbc").options(**opts).mode(mode).save()


def create_if_not_exists(
    spark: SparkSession, cfg: JdbcConfig, table: str, schema: T.StructType | str, **kw
) -> None:
    """``CREATE TABLE IF NOT EXISTS`` through Spark: an empty frame, mode ignore."""
    empty = spark.createDataFrame([], schema)
    write_jdbc(empty, cfg, table, mode="ignore", **kw)


def row_count(spark: SparkSession, cfg: JdbcConfig, table: str) -> int:
    """Exact ``COUNT(*)`` computed by the source."""
    return int(
        read_subquery(spark, cfg, f"SELECT COUNT(*) AS {cfg.quote('n')} FROM {table}", "c").first()["n"]
    )


def table_exists(spark: SparkSession, cfg: JdbcConfig, table: str) -> bool:
    """Whether the source has ``table``. Only its own "no such table" counts as
    no; a failed connection or a refused login stays an error."""
    try:
        read_subquery(spark, cfg, f"SELECT 1 AS {cfg.quote('x')} FROM {table} WHERE 1 = 0", "c").schema
    except Exception as error:  # noqa: BLE001 - told apart by the SQL state below
        if _NO_TABLE.search(str(error)):
            return False
        raise
    return True


# How databases report an unknown table (SQL states 42S02, 42P01,
# 42X05, Oracle's ORA-00942, SQL Server's and SQLite's wording).
_NO_TABLE = re.compile(
    r"42S02|42P01|42X05|ORA-00942|doesn't exist|does not exist|no such table|Invalid object name|Table .* not found",
    re.IGNORECASE,
)


def truncate_table(spark: SparkSession, cfg: JdbcConfig, table: str, *, verify: bool = True) -> bool:
    """Empty ``table``, keeping its definition.

    Overwrites the table with an empty frame of the *table's own* schema and
    ``truncate=true``: Spark issues the dialect's TRUNCATE, then inserts
    nothing. A missing table is an error (it is not created). Returns True
    once the count is 0.
    """
    target_schema = read_table(spark, cfg, table).schema  # fails if missing
    empty = spark.createDataFrame([], target_schema)
    opts = cfg.spark_options()
    opts.update({"dbtable": table, "truncate": "true"})
    empty.write.format("jdbc").options(**opts).mode("overwrite").save()
    if verify:
        remaining = row_count(spark, cfg, table)
        if remaining:
            raise RuntimeError(f"{table} still has {remaining} rows after truncate")
    return True


def truncate_all(spark: SparkSession, cfg: JdbcConfig, tables_child_first: Sequence[str]) -> list[str]:
    """Truncate tables in dependency order, children before parents.

    With enforced foreign keys (MySQL) pass ``sessionVariables=FOREIGN_KEY_CHECKS=0``
    in the URL, as a bulk reload does.
    """
    done = []
    for t in tables_child_first:
        truncate_table(spark, cfg, t)
        done.append(t)
    return done


def append_counted(
    df: DataFrame, cfg: JdbcConfig, table: str, *, expected_rows: int | None = None, **kw
) -> int:
    """Append ``df`` and return the rows it added (pushed ``COUNT(*)`` before
    and after; a missing table counts as 0). With ``expected_rows`` a
    difference is an error. Assumes no concurrent writer on ``table``."""
    spark = df.sparkSession
    before = row_count(spark, cfg, table) if table_exists(spark, cfg, table) else 0
    write_jdbc(df, cfg, table, mode="append", **kw)
    added = row_count(spark, cfg, table) - before
    if expected_rows is not None and added != expected_rows:
        raise RuntimeError(f"{table}: {added} rows added, {expected_rows} expected")
    return added


def stage_and_publish(
    df: DataFrame,
    cfg: JdbcConfig,
    table: str,
    staging_table: str,
    *,
    expected_rows: int | None = None,
    partition_column: str | None = None,
    read_partitions: int = 10,
    **kw,
) -> int:
    """Load ``staging_table``, verify its count, then overwrite ``table`` from
    it with one truncating overwrite. A load that fails its check never touches
    ``table``; the overwrite itself commits partition by partition, so readers
    may see it under way. Publish inside the database (a rename) where they must
    not. ``partition_column`` reads the staging table in parallel."""
    spark = df.sparkSession
    write_jdbc(df, cfg, staging_table, mode="overwrite", **kw)
    staged = row_count(spark, cfg, staging_table)
    if expected_rows is not None and staged != expected_rows:
        raise RuntimeError(f"staging {staging_table}: {staged} rows, expected {expected_rows}")
    if partition_column:
        staged_df = read_partitioned(spark, cfg, staging_table, partition_column, read_partitions)
    else:
        staged_df = read_table(spark, cfg, staging_table)
    write_jdbc(staged_df, cfg, table, mode="overwrite", **kw)
    return staged
