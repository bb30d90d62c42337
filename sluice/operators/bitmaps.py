"""Exact key checks by bitmaps: uniqueness, foreign keys, distinct counts.

An integer key is one bit: ``bitmap_bucket_number`` names a run of 32,768 keys
and ``bitmap_bit_position`` the bit in it. Every task sets the bits of its rows
and the bitmaps of a run are merged, so a check shuffles 4 KB for each run that
a task meets, not its rows. A run's bitmap tells without a join whether its keys
are unique (as many bits as rows) and whether all its child keys have a parent
(the parent's bits grow no more when the child's are added). Only the rows of
runs that fail are read again and grouped by key to name the offenders.

Bitmaps pay where keys are dense and a task meets few runs. ``runs_met``
measures that in one pass over the key alone; where the bitmaps would be larger
than the keys themselves, each task's distinct keys are shuffled to the owner of
their run first (8 bytes a key), which sets the bits there. The results are the
same.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import shared_path

BITMAP_BYTES = 4096
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_LONG_MAX = (1 << 63) - 1


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _present(keys: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [_col(k).isNotNull() for k in keys])


def key_bounds(frames: Sequence[tuple[DataFrame, Sequence[str]]]) -> list[tuple[int, int]]:
    """(least, largest) value of each key column over all frames."""
    out: list[tuple[int, int]] = []
    for df, keys in frames:
        for k in keys:
            if not isinstance(df.schema[k].dataType, _INTEGERS):
                raise TypeError(f"{k}: {df.schema[k].dataType.simpleString()} is no integer key")
        aggs = [f(_col(k)).cast("long").alias(f"{f.__name__}{i}") for i, k in enumerate(keys) for f in (F.min, F.max)]
        row = df.where(_present(keys)).agg(*aggs).first()
        found = [(row[f"min{i}"], row[f"max{i}"]) for i in range(len(keys))]
        if found[0][0] is None:
            continue
        out = found if not out else [(min(a, c), max(b, d)) for (a, b), (c, d) in zip(out, found)]
    return out


def packed(keys: Sequence[str], bounds: Sequence[tuple[int, int]]) -> Column:
    """One long for the key columns: a number in mixed radix over their bounds.
    A single key is itself. Raises if the combinations don't fit a long."""
    if len(keys) == 1:
        return _col(keys[0]).cast("long")
    if not bounds:
        return F.lit(0).cast("long")
    size, code = 1, F.lit(0).cast("long")
    for k, (lo, hi) in zip(keys, bounds):
        size *= hi - lo + 1
        if size > _LONG_MAX or hi - lo + 1 > _LONG_MAX:
            raise OverflowError(f"keys {list(keys)} span more combinations than a long holds")
        code = code * F.lit(hi - lo + 1) + (_col(k).cast("long") - F.lit(lo))
    return code


def runs_met(rows: DataFrame) -> tuple[int, int]:
    """(rows, runs that the tasks meet, each task on its own), of a frame with a
    column ``run``; the second number by a sketch."""
    each = rows.groupBy(F.spark_partition_id().alias("task")).agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("run").alias("runs")
    )
    found = each.agg(F.sum("n").alias("n"), F.sum("runs").alias("runs")).first()
    return found["n"] or 0, found["runs"] or 0


def key_bitmaps(df: DataFrame, code: Column, *, dense: bool | None = None) -> DataFrame:
    """(run, n, bits): rows and key bits of each run of keys. ``dense`` says
    whether tasks send bitmaps or distinct keys; None measures it."""
    rows = df.select(F.bitmap_bucket_number(code).alias("run"), F.bitmap_bit_position(code).alias("bit"))
    if dense is None:
        n, runs = runs_met(rows)
        dense = runs * BITMAP_BYTES <= 16 * n
    if not dense:
        rows = rows.groupBy("run", "bit").agg(F.count(F.lit(1)).alias("n"))
        return rows.groupBy("run").agg(F.sum("n").alias("n"), F.bitmap_construct_agg("bit").alias("bits"))
    return rows.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.bitmap_construct_agg("bit").alias("bits"))


def _saved(frame: DataFrame, name: str) -> DataFrame:
    spark = frame.sparkSession
    path = shared_path(spark, "bitmaps", f"{name}_{uuid.uuid4().hex[:8]}")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def unique_violations(df: DataFrame, keys: Sequence[str], count_name: str = "n_rows", *, dense: bool | None = None) -> DataFrame:
    """Integer key values that occur more than once, with their multiplicity, as
    ``quality.check_unique`` gives them. Rows with a NULL key aren't compared."""
    rows = df.where(_present(keys))
    code = packed(keys, key_bounds([(df, keys)]) if len(keys) > 1 else [])
    bitmaps = key_bitmaps(rows, code, dense=dense)
    suspect = _saved(bitmaps.where(F.col("n") > F.bitmap_count("bits")).select("run"), "unique")
    grouped = [_col(k) for k in keys]
    if suspect.isEmpty():
        return rows.where(F.lit(False)).groupBy(*grouped).agg(F.count(F.lit(1)).alias(count_name))
    again = rows.withColumn("_run", F.bitmap_bucket_number(code)).join(suspect.withColumnRenamed("run", "_run"), "_run", "left_semi")
    return again.groupBy(*grouped).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) > 1)


def foreign_key_violations(
    child: DataFrame,
    parent: DataFrame,
    child_keys: Sequence[str],
    parent_keys: Sequence[str] | None = None,
    count_name: str = "n_rows",
    *,
    dense: bool | None = None,
) -> DataFrame:
    """Integer child keys without a parent, with their number of child rows, as
    ``quality.check_foreign_key`` gives them. NULL child keys aren't violations."""
    parent_keys = list(parent_keys or child_keys)
    if len(parent_keys) != len(child_keys):
        raise ValueError("child and parent key lists differ in length")
    bounds = key_bounds([(child, child_keys), (parent, parent_keys)]) if len(child_keys) > 1 else []
    c_rows, p_rows = child.where(_present(child_keys)), parent.where(_present(parent_keys))
    c_code, p_code = packed(child_keys, bounds), packed(parent_keys, bounds)
    c_bits = key_bitmaps(c_rows, c_code, dense=dense).select("run", F.lit(False).alias("up"), "bits")
    p_bits = key_bitmaps(p_rows, p_code, dense=dense).select("run", F.lit(True).alias("up"), "bits")
    merged = c_bits.unionByName(p_bits).groupBy("run").agg(
        F.max(F.when(F.col("up"), F.bitmap_count("bits"))).alias("parents"), F.bitmap_count(F.bitmap_or_agg("bits")).alias("all")
    )
    suspect = _saved(merged.where(F.col("all") > F.coalesce("parents", F.lit(0))).select("run"), "foreign")
    grouped = [_col(k) for k in child_keys]
    if suspect.isEmpty():
        return c_rows.where(F.lit(False)).groupBy(*grouped).agg(F.count(F.lit(1)).alias(count_name))
    suspect = suspect.withColumnRenamed("run", "_run")
    again = c_rows.withColumn("_code", c_code).withColumn("_run", F.bitmap_bucket_number(c_code)).join(suspect, "_run", "left_semi")
    counted = again.groupBy("_code", *grouped).agg(F.count(F.lit(1)).alias(count_name))
    known = p_rows.select(p_code.alias("_code"), F.bitmap_bucket_number(p_code).alias("_run")).join(suspect, "_run", "left_semi").select("_code")
    return counted.join(known, "_code", "left_anti").drop("_code")


def distinct_counts(
    df: DataFrame, group_keys: Sequence[str], value: str, name: str = "n_distinct", *, dense: bool | None = None
) -> DataFrame:
    """``COUNT(DISTINCT value)`` of an integer column per group, NULLs left out:
    the bits of each (group, run), merged and counted. A group that holds a third
    of the rows is spread over its runs. No group keys: one row."""
    if not isinstance(df.schema[value].dataType, _INTEGERS):
        raise TypeError(f"{value}: {df.schema[value].dataType.simpleString()} is no integer")
    code, groups = _col(value).cast("long"), [_col(g) for g in group_keys]
    names = [f"g{i}" for i in range(len(groups))]
    rows = df.select(*[g.alias(n) for g, n in zip(groups, names)], F.bitmap_bucket_number(code).alias("run"), F.bitmap_bit_position(code).alias("bit"), code.isNotNull().alias("there"))
    if dense is None:
        n, runs = runs_met(rows.select(F.struct(*names, "run").alias("run")))
        dense = runs * BITMAP_BYTES <= 16 * n
    if not dense:
        rows = rows.distinct()
    bits = rows.groupBy(*names, "run").agg(F.max("there").alias("there"), F.bitmap_construct_agg("bit").alias("bits"))
    counted = F.sum(F.when(F.col("there"), F.bitmap_count("bits")).otherwise(0))
    out = bits.groupBy(*names).agg(F.coalesce(counted, F.lit(0)).cast("long").alias(name))
    return out.select(*[F.col(n).alias(g) for n, g in zip(names, group_keys)], name)
