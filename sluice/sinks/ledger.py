"""Small append-only tables that record what a job has committed.

One append is one Parquet file, which appears when Spark commits the write, so
a reader sees a record or doesn't; a killed append leaves nothing that is read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from sluice.sinks.parquet import _fs


def append_rows(spark: SparkSession, path: str, rows: Sequence[tuple], schema: str) -> None:
    """Add ``rows`` to the table in one file."""
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(path)


def read_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table, empty where nothing was appended yet."""
    fs, folder = _fs(spark, path)
    return spark.read.schema(schema).parquet(path) if fs.exists(folder) else spark.createDataFrame([], schema)


def now() -> dt.datetime:
    """UTC without a zone, as the tables hold it."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
