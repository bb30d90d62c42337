"""Extracts that go on where a failed run stopped.

The key space is cut into ranges once, by the first run, which writes the plan
(predicate and row count of every range, the schema) before it reads a row. A
run reads the ranges that the ledger doesn't hold yet, ``ranges_per_job`` of
them in one Spark job, into a folder of its own; it compares the rows written
with the plan and then appends the ranges with their folders to the ledger. A
folder that the ledger doesn't name is what a killed run left behind and is
never read.

    path/_plan      range_id, predicate, rows, source, schema     written once
    path/_ledger    range_id, folder, rows, run, committed_at     one append a job
    path/data/<job>/_range=<id>/                                  the rows

``extract_table_resumable`` reads a JDBC table, ``extract_frame_resumable`` any
DataFrame (Parquet files, a catalog table). One run at a time may work on a path.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.config import JdbcConfig
from sluice.operators.ranges import key_ranges, row_ranges
from sluice.sinks.ledger import append_rows, now, read_rows
from sluice.sinks.parquet import IncompleteWrite, _delete, _fs

RANGE = "_range"
_PLAN = "range_id int, predicate string, rows long, source string, schema string"
_LEDGER = "range_id int, folder string, rows long, run string, committed_at timestamp_ntz"


class SourceChanged(IncompleteWrite):
    """A range no longer holds the rows that the plan counted."""


class IncompleteExtract(RuntimeError):
    """Ranges of the plan haven't been read yet."""


@dataclass(frozen=True)
class Range:
    range_id: int
    predicate: str
    rows: int


@dataclass(frozen=True)
class ResumeResult:
    path: str
    ranges: int
    #: Ranges and rows that this run read.
    ranges_read: int
    rows_read: int
    #: Rows of all ranges.
    rows: int


#: Rows of the given ranges, with the id of each row's range in column RANGE.
Reader = Callable[[Sequence[Range]], DataFrame]


def stored_plan(spark: SparkSession, path: str) -> tuple[str, list[Range], T.StructType] | None:
    """(source, ranges, schema) of an extract that was begun at ``path``."""
    rows = read_rows(spark, f"{path}/_plan", _PLAN).orderBy("range_id").collect()  # one per range
    if not rows:
        return None
    return (
        rows[0]["source"],
        [Range(r["range_id"], r["predicate"], r["rows"]) for r in rows],
        T.StructType.fromJson(json.loads(rows[0]["schema"])),
    )


def committed(spark: SparkSession, path: str) -> dict[int, tuple[str, int]]:
    """range id -> (folder, rows) of the ranges that are done. A range that was
    committed twice counts as its first commit."""
    rows = read_rows(spark, f"{path}/_ledger", _LEDGER).orderBy("committed_at", "folder").collect()
    done: dict[int, tuple[str, int]] = {}
    for r in rows:
        done.setdefault(r["range_id"], (r["folder"], r["rows"]))
    return done


def extract_ranges(
    spark: SparkSession,
    path: str,
    source: str,
    plan: Callable[[], Sequence[tuple[str, int]]],
    read: Reader,
    *,
    ranges_per_job: int = 1,
    compression: str = "snappy",
    on_commit: Callable[[int], None] | None = None,
) -> ResumeResult:
    """Read what is missing at ``path``. ``plan`` gives (predicate, rows) per
    range and is asked only if nothing was begun there; its predicates must hold
    every row of the source exactly once. ``on_commit`` is called with the number
    of ranges that are done after each commit.

    A range whose rows don't match the plan raises ``SourceChanged`` and isn't
    committed. Ranges without rows are committed without a folder.
    """
    if ranges_per_job < 1:
        raise ValueError("ranges_per_job must be positive")
    path = path.rstrip("/")
    begun = stored_plan(spark, path)
    if begun is None:
        ranges = [Range(i, p, n) for i, (p, n) in enumerate(plan())]
        schema = read(ranges[:1]).drop(RANGE).schema
        append_rows(
            spark, f"{path}/_plan", [(r.range_id, r.predicate, r.rows, source, schema.json()) for r in ranges], _PLAN
        )
    else:
        was, ranges, schema = begun
        if was != source:
            raise ValueError(f"{path} holds an extract of {was}, not of {source}")
    done = committed(spark, path)
    todo = [r for r in ranges if r.range_id not in done]
    run, rows_read = uuid.uuid4().hex[:12], 0
    for at in range(0, len(todo), ranges_per_job):
        job = todo[at : at + ranges_per_job]
        folder = f"data/{run}-{at:06d}"
        read(job).write.option("compression", compression).partitionBy(RANGE).parquet(f"{path}/{folder}")
        written = _rows_by_range(spark, f"{path}/{folder}", schema)
        for r in job:
            if written.get(r.range_id, 0) != r.rows:
                raise SourceChanged(
                    f"{source}: {r.predicate} gave {written.get(r.range_id, 0)} rows, the plan counted {r.rows}"
                )
        at_time = now()
        append_rows(
            spark,
            f"{path}/_ledger",
            [(r.range_id, f"{folder}/{RANGE}={r.range_id}" if r.rows else None, r.rows, run, at_time) for r in job],
            _LEDGER,
        )
        rows_read += sum(r.rows for r in job)
        if on_commit:
            on_commit(len(done) + at + len(job))
    return ResumeResult(path, len(ranges), len(todo), rows_read, sum(r.rows for r in ranges))


def _rows_by_range(spark: SparkSession, folder: str, schema: T.StructType) -> dict[int, int]:
    whole = T.StructType([*schema.fields, T.StructField(RANGE, T.IntegerType())])
    counts = spark.read.schema(whole).parquet(folder).groupBy(RANGE).agg(F.count(F.lit(1)).alias("n"))
    return {r[RANGE]: r["n"] for r in counts.collect()}  # one per range of the job


def read_extract(spark: SparkSession, path: str, *, partial: bool = False) -> DataFrame:
    """The rows of a finished extract: the union of its committed folders. An
    unfinished one raises ``IncompleteExtract`` unless ``partial``."""
    path = path.rstrip("/")
    begun = stored_plan(spark, path)
    if begun is None:
        raise IncompleteExtract(f"no extract was begun at {path}")
    _, ranges, schema = begun
    done = committed(spark, path)
    missing = [r.range_id for r in ranges if r.range_id not in done]
    if missing and not partial:
        raise IncompleteExtract(f"{path}: {len(missing)} of {len(ranges)} ranges are missing")
    folders = [f"{path}/{folder}" for folder, _ in done.values() if folder]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def discard_leftovers(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders that killed or refused jobs left; their names. No run
    may be at work on ``path``."""
    path = path.rstrip("/")
    fs, data = _fs(spark, f"{path}/data")
    if not fs.exists(data):
        return []
    kept = {folder.split("/")[1] for folder, _ in committed(spark, path).values() if folder}
    left = [s.getPath().getName() for s in fs.listStatus(data)]
    gone = sorted(name for name in left if name not in kept)
    for name in gone:
        _delete(spark, f"{path}/data/{name}")
    return gone


# --- sources ----------------------------------------------------------------


def extract_frame_resumable(
    df: DataFrame,
    path: str,
    key: str | Sequence[str],
    num_ranges: int,
    *,
    source: str,
    spread: str | None = None,
    **options,
) -> ResumeResult:
    """``df`` by ranges of ``key`` of about equal depth (``key_ranges``: hot
    values and NULL keys have ranges of their own), or of several key columns
    (``row_ranges``). ``source`` names what is read and must be the same when the
    extract is taken up again."""

    def plan() -> list[tuple[str, int]]:
        several = not isinstance(key, str)
        predicates = row_ranges(df, key, num_ranges) if several else key_ranges(df, key, num_ranges, spread=spread)
        sums = [F.count(F.when(F.expr(p), 1)) for p in predicates]
        counts = df.agg(F.count(F.lit(1)), *sums).first()
        if sum(counts[1:]) != counts[0]:
            raise IncompleteWrite(f"{source}: the ranges hold {sum(counts[1:])} of {counts[0]} rows")
        return list(zip(predicates, counts[1:]))

    def read(ranges: Sequence[Range]) -> DataFrame:
        which = F.expr("CASE " + " ".join(f"WHEN {r.predicate} THEN {r.range_id}" for r in ranges) + " END")
        return df.where(" OR ".join(f"({r.predicate})" for r in ranges)).withColumn(RANGE, which.cast("int"))

    return extract_ranges(df.sparkSession, path, source, plan, read, **options)


def extract_table_resumable(
    spark: SparkSession,
    cfg: JdbcConfig,
    table: str,
    path: str,
    key: str | Sequence[str],
    num_ranges: int,
    *,
    predicates: Sequence[str] | None = None,
    fetchsize: int | None = 10_000,
    **options,
) -> ResumeResult:
    """A JDBC table by ranges of ``key``: an integer key by the source's own
    histogram, any other, or several columns, in the source's own order
    (``row_predicates``); or by given ``predicates``. The source counts the rows
    of every range, and those in none or in several: such ranges are refused
    before a row is read. The ranges of a job are read over as many connections."""
    from sluice.sources import jdbc as JR

    columns = [key] if isinstance(key, str) else list(key)

    def plan() -> list[tuple[str, int]]:
        b = JR.with_retry(lambda: JR.bounds(spark, cfg, table, columns[0]))
        found = list(predicates) if predicates else None
        if found is None and len(columns) == 1 and isinstance(b.lower, int) and not isinstance(b.lower, bool):
            cuts = JR.histogram_boundaries(spark, cfg, table, columns[0], num_ranges, key_bounds=b)
            found = JR.range_predicates(cfg, columns[0], cuts)
        if found is None:
            found = JR.row_predicates(spark, cfg, table, columns, num_ranges)
        counts, wrong = JR.predicate_counts(spark, cfg, table, found), JR.misplaced_rows(spark, cfg, table, found)
        if wrong or sum(counts) != b.rows:
            raise IncompleteWrite(f"{table}: {wrong} rows lie in no range or in several; the ranges hold {sum(counts)} of {b.rows}")
        return list(zip(found, counts))

    def read(ranges: Sequence[Range]) -> DataFrame:
        # Partition i of a predicate read is its predicate i.
        rows = JR.read_by_predicates(spark, cfg, table, [r.predicate for r in ranges], fetchsize=fetchsize)
        ids = F.array(*[F.lit(r.range_id) for r in ranges])
        return rows.withColumn(RANGE, F.element_at(ids, F.spark_partition_id() + 1))

    return extract_ranges(spark, path, f"{table} by {', '.join(columns)}", plan, read, **options)
