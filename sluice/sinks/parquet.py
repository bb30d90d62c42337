"""Parquet export with a completeness check."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sluice.sinks.counting import observed


class IncompleteWrite(RuntimeError):
    """The written output does not hold the rows the source gave."""


@dataclass(frozen=True)
class ExportResult:
    path: str
    rows_expected: int
    rows_written: int


def export_parquet(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    compression: str = "snappy",
    partition_by: Sequence[str] = (),
    max_records_per_file: int | None = None,
    expected_rows: int | None = None,
    verify: bool = True,
    rebalance: bool = False,
) -> ExportResult:
    """Write ``df`` in one pass and compare the *output* with the source.

    The source's rows are counted by the write itself (an ``Observation``), so
    it is scanned once; the output count is answered from Parquet footers. A
    caller who knows the count (a pushed ``COUNT(*)``) passes ``expected_rows``.

    An overwrite goes to a fresh folder beside ``path``, is checked there, and
    only then takes its place, so a failed or incomplete run leaves the old
    files, and ``df`` may read ``path`` itself. No partition of the old output
    survives, whatever ``partitionOverwriteMode`` the session has.

    No shuffle is added by default: one file per input partition (and per
    partition value), capped by ``max_records_per_file``. With
    ``partition_by`` and many values, ``rebalance`` clusters rows by the
    partition columns first (``REBALANCE``: one shuffle, AQE sizes the
    writers and splits a hot value) so files per value stay few.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    spark = df.sparkSession
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    seen = Observation()
    target = f"{path.rstrip('/')}.new-{uuid.uuid4().hex[:12]}" if mode == "overwrite" else path
    writer = (
        df.observe(seen, F.count(F.lit(1)).alias("n"))
        .write.mode("append" if mode == "append" else "errorifexists")
        .option("compression", compression)
        .option("partitionOverwriteMode", "static")
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    before = _existing_rows(spark, path) if mode == "append" else 0
    try:
        writer.parquet(target)
        # Rows this write added; an output without data files (an empty partitioned frame) has none.
        written = _existing_rows(spark, target) - before
        source_rows = observed(seen, "n")["n"]
        expected = source_rows if expected_rows is None else expected_rows
        if verify and not written == expected == source_rows:
            raise IncompleteWrite(f"{path}: wrote {written} rows, source had {expected}, {source_rows} were read")
    except Exception:
        if mode == "overwrite":
            _delete(spark, target)
        raise
    if mode == "overwrite":
        _publish(spark, target, path)
    return ExportResult(path, expected, written)


def _fs(spark, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _delete(spark, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _publish(spark, checked: str, path: str) -> None:
    """Put a checked folder in the place of ``path``: the old one is moved
    aside, and deleted only once the new one is there."""
    fs, new = _fs(spark, checked)
    _, place = _fs(spark, path)
    _, aside = _fs(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:12]}")
    had = fs.exists(place)
    if had and not fs.rename(place, aside):
        raise OSError(f"cannot move {path} aside; the new output is in {checked}")
    if not fs.rename(new, place):
        if had:
            fs.rename(aside, place)
        raise OSError(f"cannot move {checked} to {path}")
    if had:
        fs.delete(aside, True)
    spark.catalog.refreshByPath(path)


def _existing_rows(spark, path: str) -> int:
    """Rows already under ``path`` (0 when nothing is there yet). Appends to
    the same path are assumed not to run concurrently."""
    try:
        return spark.read.parquet(path).count()
    except Exception as error:  # noqa: BLE001 - only "nothing there" is expected
        if "PATH_NOT_FOUND" in str(error) or "does not exist" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return 0
        raise


def extract_to_parquet(
    spark,
    cfg,
    table: str,
    path: str,
    *,
    partition_column: str | None = None,
    num_partitions: int = 10,
    rows_per_partition: int | None = None,
    compression: str = "snappy",
    max_records_per_file: int | None = None,
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
    versioned: bool = False,
) -> ExportResult:
    """JDBC table -> Parquet, read in parallel, verified against the source.

    One pushed query measures MIN / MAX / COUNT(*) of the partition key; the
    strides come from the bounds and the completeness check compares the
    written output with that COUNT(*), so the table is read exactly once
    (no preview, no separate count). A source that changes during the read
    fails the check instead of passing silently. No shuffle: one output file
    per read partition. ``versioned`` writes a version behind a pointer
    (``exports.export_version``) instead of taking the place of ``path``.
    """
    from sluice.sinks.exports import export_version
    from sluice.sources import jdbc as JR

    if partition_column:
        b = JR.with_retry(lambda: JR.bounds(spark, cfg, table, partition_column))
        df = JR.read_partitioned(
            spark, cfg, table, partition_column, num_partitions, key_bounds=b, rows_per_partition=rows_per_partition
        )
        expected = b.rows
    else:
        df = JR.read_table(spark, cfg, table)
        expected = int(
            JR.read_subquery(spark, cfg, f"SELECT COUNT(*) AS {cfg.quote('n')} FROM {table}", "c").first()["n"]
        )
    export = export_version if versioned else export_parquet
    return export(
        df, path, compression=compression, max_records_per_file=max_records_per_file,
        expected_rows=expected, partition_by=partition_by, rebalance=rebalance,
    )
