"""Incremental loads: read only what earlier runs have not processed.

Two mechanisms:

* ``load_increment`` -- a high-water mark on a monotonic column (JDBC or any
  DataFrame source). The upper mark is fixed *first*; rows from the last mark
  on are read (the filter reaches the source) and written as partitions named
  by the last mark alone, with dynamic partition overwrite, so re-running a
  batch replaces it instead of duplicating it. Rows that hold the highest mark
  have a partition of their own, which the next run reads again and replaces:
  a row that arrives late with exactly the stored mark isn't lost. So do rows
  without a mark. Only then is the new mark appended to the state table, one
  row per (source, table) run.
* ``bookmark_files`` -- Structured Streaming's file source with an
  ``availableNow`` trigger: the checkpoint records which files were
  processed, the file sink commits exactly once. Each run picks up only new
  files, then stops.
"""

from __future__ import annotations

import datetime as dt
import decimal
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.sinks.counting import observed
from sluice.sinks.parquet import IncompleteWrite

STATE_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("mark_column", T.StringType(), False),
        T.StructField("low_mark", T.StringType(), True),
        T.StructField("high_mark", T.StringType(), False),
        T.StructField("rows", T.LongType(), False),
        T.StructField("loaded_at", T.TimestampType(), False),
    ]
)


@dataclass(frozen=True)
class IncrementResult:
    low_mark: Any
    high_mark: Any
    rows: int


def _last_run(spark: SparkSession, state_path: str, source: str, table: str):
    """(low mark, high mark) of the last committed run, or None."""
    try:
        state = spark.read.schema(STATE_SCHEMA).parquet(state_path)
        return (
            state.filter((F.col("source") == source) & (F.col("table_name") == table))
            .orderBy(F.col("loaded_at").desc())
            .select("low_mark", "high_mark")
            .first()
        )
    except Exception as error:  # noqa: BLE001 - only "no state yet" is expected
        if "PATH_NOT_FOUND" in str(error) or "does not exist" in str(error):
            return None
        raise


def read_mark(spark: SparkSession, state_path: str, source: str, table: str) -> str | None:
    """Last committed high mark for (source, table), or None on a first run."""
    row = _last_run(spark, state_path, source, table)
    return None if row is None else row["high_mark"]


def typed_mark(mark: str | None, dtype: T.DataType) -> Any:
    """A stored mark as a value of the column's type."""
    if mark is None:
        return None
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType)):
        return int(mark)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return dt.datetime.fromisoformat(mark)
    if isinstance(dtype, T.DateType):
        return dt.date.fromisoformat(mark)
    if isinstance(dtype, T.DecimalType):
        return decimal.Decimal(mark)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return float(mark)
    return mark


def load_increment(
    source_df: DataFrame,
    target_path: str,
    column: str,
    state_path: str,
    *,
    source: str,
    table: str,
    batch_column: str = "_batch",
    high_mark: Any = None,
) -> IncrementResult:
    """Bring ``target_path`` up to ``source_df``: rows with ``column`` above the
    stored mark, rows that share it, and rows without a mark.

    ``high_mark`` -- the upper mark, when the caller already has it from the
    source (e.g. ``sources.jdbc.bounds``, a pushed MAX); otherwise it is
    computed from the pending rows before they are read for the write. The
    result counts the rows the target has gained: the rows written, as the write
    counts them, less those of the partitions it replaces. Only the partitions
    of this run are counted, so the cost does not grow with the history.
    """
    spark = source_df.sparkSession
    dtype = source_df.schema[column].dataType
    last = _last_run(spark, state_path, source, table)
    low = None if last is None else typed_mark(last["high_mark"], dtype)
    mark = F.col(f"`{column}`")
    pending = source_df if low is None else source_df.filter((mark >= F.lit(low)) | mark.isNull())
    high = high_mark if high_mark is not None else pending.agg(F.max(mark).alias("m")).first()["m"]
    if high is None or (low is not None and high < low):
        high = low
    batch = pending if high is None else pending.filter((mark <= F.lit(high)) | mark.isNull())
    # Partitions are named by *low* marks only: a run that wrote data but died
    # before recording the new mark is redone from the same low mark and
    # overwrites the same partitions, even if the source grew meanwhile.
    name = F.when(mark.isNull(), F.lit("no_mark"))
    if low is not None:
        tied = "first" if last["low_mark"] is None else f"from_{last['low_mark']}"
        name = name.when(mark == F.lit(low), F.lit(f"top_{tied}"))
    run = "first" if low is None else f"from_{low}"
    if high is not None and high != low:
        name = name.when(mark == F.lit(high), F.lit(f"top_{run}"))
    names = ["no_mark", f"below_{run}"]
    names += [f"top_{tied}"] if low is not None else []
    names += [f"top_{run}"] if high is not None and high != low else []
    before = _partition_rows(spark, target_path, batch_column, names)
    seen = Observation()
    named = batch.withColumn(batch_column, name.otherwise(F.lit(f"below_{run}")))
    counts = [F.count(F.when(F.col(f"`{batch_column}`") == n, 1)).alias(f"n{i}") for i, n in enumerate(names)]
    (
        named.observe(seen, *counts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(batch_column)
        .parquet(target_path)
    )
    counted = observed(seen, *[f"n{i}" for i in range(len(names))])
    replaced = {n: counted[f"n{i}"] for i, n in enumerate(names) if counted[f"n{i}"]}  # without new rows none is replaced
    written = _partition_rows(spark, target_path, batch_column, list(replaced)) if replaced else {}
    if written != replaced:
        raise IncompleteWrite(f"{target_path}: partitions hold {written}, written were {replaced}; the mark is unchanged")
    rows = sum(written.values()) - sum(before.get(n, 0) for n in replaced)
    if high != low:
        loaded_at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        state_row = (source, table, column, None if low is None else str(low), str(high), rows, loaded_at)
        spark.createDataFrame([state_row], STATE_SCHEMA).write.mode("append").parquet(state_path)
    return IncrementResult(low, high, rows)


def _partition_rows(spark: SparkSession, path: str, column: str, names: list[str]) -> dict[str, int]:
    """Rows of some partitions by their footers; those that aren't there are left out."""
    try:
        rows = spark.read.parquet(path)
    except Exception as error:  # noqa: BLE001 - only "nothing there" is expected
        if any(x in str(error) for x in ("PATH_NOT_FOUND", "does not exist", "UNABLE_TO_INFER_SCHEMA")):
            return {}
        raise
    name = F.col(f"`{column}`").cast("string")
    found = rows.where(name.isin(names)).groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return {r["name"]: r["n"] for r in found.collect()}  # four at most


def _rows_under(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet folder by its footers; 0 where there is none yet."""
    try:
        return spark.read.parquet(path).count()
    except Exception as error:  # noqa: BLE001 - only "nothing there" is expected
        if any(x in str(error) for x in ("PATH_NOT_FOUND", "does not exist", "UNABLE_TO_INFER_SCHEMA")):
            return 0
        raise


def read_loaded(spark: SparkSession, target_path: str, batch_column: str = "_batch") -> DataFrame:
    """Everything loaded so far, without the batch column."""
    return spark.read.parquet(target_path).drop(batch_column)


def bookmark_files(
    spark: SparkSession,
    landing_path: str,
    schema: T.StructType,
    target_path: str,
    checkpoint_path: str,
    *,
    file_format: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> int:
    """Process the files in ``landing_path`` not seen by earlier runs, then stop.

    Returns the rows this run added to the target, counted there before and
    after (the progress reports a query keeps are a bounded window).
    """
    before = _rows_under(spark, target_path)
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    query = (
        reader.load(landing_path)
        .writeStream.format("parquet")
        .option("path", target_path)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return _rows_under(spark, target_path) - before
