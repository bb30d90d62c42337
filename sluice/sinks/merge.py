"""Keyed merges: a table kept up to date by batches of changed and deleted rows.

A high-water mark sees new rows only. Here a batch holds versions of rows, each
with a key, an ordering value and a mark for deletes, in any order, with repeats
and late arrivals; the table holds the latest version of every key.

Rows lie in buckets by a hash of their key. A merge reduces the batch to one
version per key, reads the buckets that hold touched keys, and writes only these
anew, into a folder of the merge; all other buckets keep their files. The
manifest lists, per merge, the new folder of each bucket rewritten, and is
appended in one file after the row counts agree, so a reader sees the table
before a merge or after it, and a killed merge leaves nothing that is read.
Deletes stay as marked rows without values (``compact`` drops old ones): a late
older version of a deleted key does not bring it back.

    path/_table       key, order and bucket settings, schema     written once
    path/_manifest    version, bucket, folder, rows              one append a merge
    path/data/v<version>-<id>/_bucket=<b>/                       the rows

One merge at a time may work on a path.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.sinks.counting import observed
from sluice.sinks.ledger import append_rows, read_rows
from sluice.sinks.parquet import IncompleteWrite

BUCKET, DELETED = "_bucket", "_deleted"
_TABLE = "keys string, order_column string, buckets int, schema string"
_MANIFEST = "version int, bucket int, folder string, rows long"


@dataclass(frozen=True)
class MergeResult:
    version: int
    #: Keys of the batch, and those whose version was newer than the table's.
    keys: int
    applied: int
    buckets_written: int


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class MergeTable:
    """A table at ``path``: its key columns, the column that orders the versions
    of a key, the number of buckets, and the columns of its rows."""

    path: str
    keys: tuple[str, ...]
    order_column: str
    buckets: int
    schema: T.StructType

    @property
    def stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(DELETED, T.BooleanType())])

    def bucket(self) -> Column:
        """The bucket of a row: a function of its key alone."""
        keys = [_col(k) for k in self.keys]
        nulls = F.concat(*[F.when(k.isNull(), F.lit("1")).otherwise(F.lit("0")) for k in keys])
        return F.pmod(F.xxhash64(nulls, *keys), F.lit(self.buckets)).cast("int")


def create(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order_column: str, *, buckets: int = 64
) -> MergeTable:
    """A new empty table. Key columns are compared by value, NULL like NULL."""
    names = [f.name for f in schema]
    unknown = [c for c in (*keys, order_column) if c not in names]
    if unknown or not keys or buckets < 1:
        raise ValueError(f"unknown columns {unknown}" if unknown else "a key and at least one bucket are required")
    if BUCKET in names or DELETED in names:
        raise ValueError(f"{BUCKET} and {DELETED} are names of the table itself")
    path = path.rstrip("/")
    if not read_rows(spark, f"{path}/_table", _TABLE).isEmpty():
        raise ValueError(f"{path} holds a table already")
    append_rows(spark, f"{path}/_table", [(json.dumps(list(keys)), order_column, buckets, schema.json())], _TABLE)
    return MergeTable(path, tuple(keys), order_column, buckets, schema)


def open_table(spark: SparkSession, path: str) -> MergeTable:
    path = path.rstrip("/")
    row = read_rows(spark, f"{path}/_table", _TABLE).first()
    if row is None:
        raise ValueError(f"{path} holds no table")
    return MergeTable(
        path, tuple(json.loads(row["keys"])), row["order_column"], row["buckets"], T.StructType.fromJson(json.loads(row["schema"]))
    )


def manifest(spark: SparkSession, table: MergeTable, version: int | None = None) -> tuple[int, dict[int, tuple[str, int]]]:
    """(version, bucket -> (folder, rows)) as of the latest version or a given one."""
    rows = read_rows(spark, f"{table.path}/_manifest", _MANIFEST)
    if version is not None:
        rows = rows.where(F.col("version") <= version)
    latest = rows.groupBy("bucket").agg(F.max_by(F.struct("folder", "rows"), "version").alias("at"), F.max("version").alias("version"))
    found = latest.collect()  # one per bucket
    return max([r["version"] for r in found], default=0), {r["bucket"]: (r["at"]["folder"], r["at"]["rows"]) for r in found}


def _folders(spark: SparkSession, table: MergeTable, entries: dict[int, tuple[str, int]]) -> DataFrame:
    paths = [f"{table.path}/{folder}" for folder, rows in entries.values() if rows]
    if not paths:
        return spark.createDataFrame([], table.stored)
    return spark.read.schema(table.stored).parquet(*paths)


def read_merged(spark: SparkSession, table: MergeTable, version: int | None = None) -> DataFrame:
    """The live rows, as of the latest merge or an earlier one."""
    _, entries = manifest(spark, table, version)
    return _folders(spark, table, entries).where(~F.col(DELETED)).drop(DELETED)


def latest_versions(table: MergeTable, changes: DataFrame, deleted: Column) -> DataFrame:
    """One row per key of ``changes``, with column DELETED: the version with the
    greatest ordering value (NULL is less than any). Of versions that tie, a delete
    wins, else the one whose values come last, so the choice doesn't depend on the
    order of rows. Rows of a delete keep only key and ordering value."""
    columns = [f.name for f in table.schema]
    order = _col(table.order_column)
    # What tells tied versions apart must be comparable: maps count by their sorted entries.
    content = [
        F.to_json(F.struct(F.array_sort(F.map_entries(_col(f.name))))) if isinstance(f.dataType, T.MapType) else _col(f.name)
        for f in table.schema
    ]
    gone = F.coalesce(deleted, F.lit(False))
    rows = changes.select(*[_col(c).cast(f.dataType).alias(c) for c, f in zip(columns, table.schema)], gone.alias(DELETED))
    rank = F.struct(order.isNotNull().alias("known"), order.alias("order"), F.col(DELETED).alias("gone"), *[c.alias(f"v{i}") for i, c in enumerate(content)])
    best = rows.groupBy(*[_col(k).alias(f"_k{i}") for i, k in enumerate(table.keys)]).agg(
        F.max_by(F.struct(*[_col(c).alias(c) for c in columns], F.col(DELETED)), rank).alias("row")
    )
    kept = {*table.keys, table.order_column}
    values = [
        (F.col("row").getField(c) if c in kept else F.when(~F.col("row").getField(DELETED), F.col("row").getField(c))).alias(c)
        for c in columns
    ]
    return best.select(*values, F.col("row").getField(DELETED).alias(DELETED))


def merge(spark: SparkSession, table: MergeTable, changes: DataFrame, deleted: Column | None = None) -> MergeResult:
    """Bring the table up to ``changes``; ``deleted`` says which rows are deletes.

    A key takes its latest version if that is not older than the table's; at
    equal ordering values the batch's is taken unless the table's is a delete, so
    merging the same batch again changes nothing. A batch without rows writes
    nothing and leaves the version as it is.
    """
    at, entries = manifest(spark, table)
    version = at + 1
    folder = f"data/v{version:06d}-{uuid.uuid4().hex[:8]}"
    batch = latest_versions(table, changes, F.lit(False) if deleted is None else deleted).withColumn(BUCKET, table.bucket())
    # The batch is read twice (touched buckets, rows): keep one evaluation of it.
    staged = f"{table.path}/staged/v{version:06d}-{uuid.uuid4().hex[:8]}"
    batch.write.parquet(staged)
    batch = spark.read.schema(batch.schema).parquet(staged)
    sizes = {r[BUCKET]: r["n"] for r in batch.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}  # one per bucket
    if not sizes:
        return MergeResult(at, 0, 0, 0)
    current = _folders(spark, table, {b: e for b, e in entries.items() if b in sizes})
    columns, order = [f.name for f in table.schema], table.order_column
    old = current.select(F.struct(*[_col(c).alias(c) for c in [*columns, DELETED]]).alias("old"), *[_col(k).alias(f"_o{i}") for i, k in enumerate(table.keys)])
    new = batch.select(F.struct(*[_col(c).alias(c) for c in [*columns, DELETED]]).alias("new"), *[_col(k).alias(f"_n{i}") for i, k in enumerate(table.keys)])
    on = F.lit(True)
    for i in range(len(table.keys)):
        on = on & F.col(f"_o{i}").eqNullSafe(F.col(f"_n{i}"))
    o, n = F.col("old").getField(order), F.col("new").getField(order)
    # NULL orders come first; at equal orders a delete that is in the table stays.
    later = F.coalesce(n > o, F.lit(False)) | (o.isNull() & n.isNotNull())
    tied = n.eqNullSafe(o) & (~F.col("old").getField(DELETED) | F.col("new").getField(DELETED))
    # Floating-point NaN orders after every number and equals itself, as in sorting.
    wins = F.col("old").isNull() | (F.col("new").isNotNull() & (later | tied))
    joined = old.join(new, on, "full_outer")
    applied = F.col("new").isNotNull() & wins
    row = F.when(wins, F.col("new")).otherwise(F.col("old"))
    seen = Observation()
    result = joined.select(row.alias("row"), applied.alias("applied")).observe(
        seen, F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("applied"), 1)).alias("applied")
    )
    result = result.select(*[F.col("row").getField(c).alias(c) for c in [*columns, DELETED]]).withColumn(BUCKET, table.bucket())
    result.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{table.path}/{folder}")
    counted = observed(seen, "n", "applied")
    whole = T.StructType([*table.stored.fields, T.StructField(BUCKET, T.IntegerType())])
    written = spark.read.schema(whole).parquet(f"{table.path}/{folder}").groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"))
    rows = {r[BUCKET]: r["n"] for r in written.collect()}  # one per bucket
    if sum(rows.values()) != counted["n"] or set(rows) != set(sizes):
        raise IncompleteWrite(f"{table.path}: wrote {sum(rows.values())} rows of {counted['n']}; the table is unchanged")
    append_rows(spark, f"{table.path}/_manifest", [(version, b, f"{folder}/{BUCKET}={b}", k) for b, k in rows.items()], _MANIFEST)
    return MergeResult(version, sum(sizes.values()), counted["applied"], len(rows))


def compact(spark: SparkSession, table: MergeTable, before: Any) -> MergeResult:
    """Drop deletes whose ordering value is less than ``before`` (or NULL), once
    no older version of their keys can arrive. Only buckets that hold such rows
    are written anew."""
    at, entries = manifest(spark, table)
    order = _col(table.order_column)
    old = F.col(DELETED) & (order.isNull() | (order < F.lit(before)))
    current = _folders(spark, table, entries).withColumn(BUCKET, table.bucket())
    hit = {r[BUCKET]: r["n"] for r in current.where(old).groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not hit:
        return MergeResult(at, 0, 0, 0)
    version = at + 1
    folder = f"data/v{version:06d}-{uuid.uuid4().hex[:8]}"
    kept = _folders(spark, table, {b: e for b, e in entries.items() if b in hit}).where(~old).withColumn(BUCKET, table.bucket())
    kept.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{table.path}/{folder}")
    whole = T.StructType([*table.stored.fields, T.StructField(BUCKET, T.IntegerType())])
    written = spark.read.schema(whole).parquet(f"{table.path}/{folder}").groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"))
    rows = {b: 0 for b in hit} | {r[BUCKET]: r["n"] for r in written.collect()}
    if any(rows[b] + hit[b] != entries[b][1] for b in hit):
        raise IncompleteWrite(f"{table.path}: compaction lost rows; the table is unchanged")
    append_rows(
        spark, f"{table.path}/_manifest", [(version, b, f"{folder}/{BUCKET}={b}", n) for b, n in rows.items()], _MANIFEST
    )
    return MergeResult(version, sum(hit.values()), sum(hit.values()), len(hit))
