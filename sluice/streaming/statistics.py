"""Statistics per group, kept up to date batch by batch.

The state holds per group what can be merged: row count, count and exact sum of
the values, least and largest value, and the bits of the distinct keys (see
``operators.bitmaps``). A batch is aggregated on its own and merged with the
state, so an update reads the new rows and the state, never the rows before. A
new state is written to a folder of its own and named in the ledger by one
append, together with the batch it holds: a batch given again changes nothing,
and a killed update leaves the old state.

    path/_ledger                     version, batch, folder, rows
    path/state/v<version>-<id>/groups, bits
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.sinks.ledger import append_rows, read_rows

_LEDGER = "version int, batch string, folder string, rows long"


@dataclass(frozen=True)
class Statistics:
    """What is kept at ``path``: ``groups`` and the statistics of ``value`` with
    ``scale`` exact decimals; distinct values of the integer column ``distinct``."""

    path: str
    groups: tuple[str, ...]
    value: str
    scale: int = 2
    distinct: str | None = None


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _versions(spark: SparkSession, stats: Statistics) -> list:
    return read_rows(spark, f"{stats.path.rstrip('/')}/_ledger", _LEDGER).orderBy("version").collect()  # one per batch


def _group_state(stats: Statistics, rows: DataFrame) -> DataFrame:
    value = _col(stats.value)
    exact = value.cast(T.DecimalType(38 - 10, stats.scale))
    return rows.groupBy(*[_col(g).alias(f"g{i}") for i, g in enumerate(stats.groups)]).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(value).alias("n_values"),
        F.sum(exact).cast(T.DecimalType(38, stats.scale)).alias("total"), F.min(value).alias("least"), F.max(value).alias("largest"),
    )


def _bit_state(stats: Statistics, rows: DataFrame) -> DataFrame:
    code = _col(stats.distinct).cast("long")
    there = rows.where(code.isNotNull())
    keys = [_col(g).alias(f"g{i}") for i, g in enumerate(stats.groups)]
    return there.groupBy(*keys, F.bitmap_bucket_number(code).alias("run")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(code)).alias("bits")
    )


def _merge_groups(state: DataFrame, names: Sequence[str]) -> DataFrame:
    return state.groupBy(*names).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"),
        F.sum("total").cast(state.schema["total"].dataType).alias("total"), F.min("least").alias("least"), F.max("largest").alias("largest"),
    )


def update(stats: Statistics, batch: DataFrame, batch_id: str) -> bool:
    """Merge the rows of ``batch`` into the state; False if ``batch_id`` is in it
    already. One update at a time may work on a path."""
    spark, path = batch.sparkSession, stats.path.rstrip("/")
    done = _versions(spark, stats)
    if any(r["batch"] == batch_id for r in done):
        return False
    version = done[-1]["version"] + 1 if done else 1
    folder = f"state/v{version:06d}-{uuid.uuid4().hex[:8]}"
    names = [f"g{i}" for i in range(len(stats.groups))]
    groups = _group_state(stats, batch)
    if done:
        old = spark.read.schema(groups.schema).parquet(f"{path}/{done[-1]['folder']}/groups")
        groups = _merge_groups(old.unionByName(groups), names)
    groups.write.parquet(f"{path}/{folder}/groups")
    if stats.distinct:
        bits = _bit_state(stats, batch)
        if done:
            old = spark.read.schema(bits.schema).parquet(f"{path}/{done[-1]['folder']}/bits")
            bits = old.unionByName(bits).groupBy(*names, "run").agg(F.bitmap_or_agg("bits").alias("bits"))
        bits.write.parquet(f"{path}/{folder}/bits")
    rows = spark.read.parquet(f"{path}/{folder}/groups").agg(F.sum("n_rows")).first()[0] or 0
    append_rows(spark, f"{path}/_ledger", [(version, batch_id, folder, rows)], _LEDGER)
    return True


def read_statistics(spark: SparkSession, stats: Statistics) -> DataFrame:
    """(groups, n_rows, n_values, total, mean, least, largest[, n_distinct]) as of
    the last update. ``total`` is exact; ``mean`` is total / n_values as a double."""
    done, path = _versions(spark, stats), stats.path.rstrip("/")
    if not done:
        raise ValueError(f"no batch has been merged at {path}")
    names = [f"g{i}" for i in range(len(stats.groups))]
    state = spark.read.parquet(f"{path}/{done[-1]['folder']}/groups")
    out = ["n_rows", "n_values", "total", (F.col("total").cast("double") / F.when(F.col("n_values") > 0, F.col("n_values"))).alias("mean"), "least", "largest"]
    if stats.distinct:
        bits = spark.read.parquet(f"{path}/{done[-1]['folder']}/bits")
        counts = bits.groupBy(*[F.col(n).alias(f"b{n}") for n in names]).agg(F.sum(F.bitmap_count("bits")).alias("n_distinct"))
        on = F.lit(True)
        for n in names:
            on = on & F.col(n).eqNullSafe(F.col(f"b{n}"))
        state = state.join(counts, on, "left")
        out.append(F.coalesce("n_distinct", F.lit(0)).cast("long").alias("n_distinct"))
    return state.select(*[F.col(n).alias(g) for n, g in zip(names, stats.groups)], *out)
