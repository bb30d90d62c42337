"""Comparing two copies of a table by a tree of hash sums.

Every row has a place (a hash of its key) and a fingerprint (a hash of all its
values). A level of the tree cuts the places into ``2 ** bits`` buckets; a
bucket's entry is its row count and the sum of its fingerprints, which does not
depend on order and is added with map-side aggregation. Buckets whose entries
agree on both sides hold the same rows; only the others are cut again, and only
the rows of the last differing buckets are joined. Where the copies agree, what
crosses the network is one entry per task and bucket, never a row.

Two different sets of rows pass as equal if the sums of their 64-bit
fingerprints collide: a chance of about 2 ** -64 a bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import shared_path

_SUMS = ("n", "high", "low")


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def canonical(df: DataFrame, name: str) -> Column:
    """A column as a value that hashes and compares by content: arrays, structs
    and maps as JSON, maps in the order of their keys."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.MapType):
        return F.when(_col(name).isNotNull(), _json(F.array_sort(F.map_entries(_col(name)))))
    if isinstance(kind, (T.ArrayType, T.StructType)):
        if "map<" in kind.simpleString():
            raise TypeError(f"{name}: maps inside {kind.simpleString()} have no canonical order")
        return F.when(_col(name).isNotNull(), _json(_col(name)))
    return _col(name)


def _json(value: Column) -> Column:
    return F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})


def fingerprint(columns: Sequence[Column]) -> Column:
    """64-bit hash of the columns. ``xxhash64`` passes over NULLs, so which
    columns are NULL is hashed too."""
    nulls = F.concat(*[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    return F.xxhash64(nulls, *columns)


def hash_sums(rows: DataFrame, by: Sequence[str], value: str = "_h") -> DataFrame:
    """Entries of the buckets ``by``: row count and the sum of the fingerprints,
    as two sums of 32 bits each, which stay within a long for 2^31 rows a bucket."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.shiftrightunsigned(value, 32)).alias("high"),
        F.sum(F.col(value).bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
    )


def _hashed(df: DataFrame, keys: Sequence[str], columns: Sequence[str], bits: int, levels: int) -> DataFrame:
    """Keys k0.., values c0.., fingerprint _h and the bucket of each level d0.."""
    k = [canonical(df, c) for c in keys]
    c = [canonical(df, x) for x in columns]
    rows = df.select(
        *[x.alias(f"k{i}") for i, x in enumerate(k)], *[x.alias(f"c{i}") for i, x in enumerate(c)],
        fingerprint(k).alias("_place"), fingerprint([*k, *c]).alias("_h"),
    )
    for level in range(levels):
        digit = F.shiftrightunsigned("_place", bits * level).bitwiseAND(F.lit((1 << bits) - 1))
        rows = rows.withColumn(f"d{level}", digit)
    return rows


def compare_tables(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    *,
    bits: int = 12,
    levels: int = 3,
    join_rows: int = 1_000_000,
) -> DataFrame:
    """The differences of two copies, one row per key that differs:
    (keys, status, changed, n_left, n_right).

    ``columns`` (default: all columns of ``left`` that are no keys) are compared
    by value, NULL like NULL. ``status`` is ``missing_left`` or ``missing_right``
    where one side lacks the key; ``changed`` where both have one row, with the
    names of the columns that differ in ``changed``, joined by commas;
    ``duplicate`` where a side has several rows and the two sets of rows differ.
    A key whose rows are the same on both sides gives no row, however many.

    The tree is descended at most ``levels`` deep, until the buckets that still
    differ hold ``join_rows`` rows or fewer on both sides together. Columns of
    one side must have the types of the other's.
    """
    spark = left.sparkSession
    columns = [c for c in left.columns if c not in keys] if columns is None else list(columns)
    if not keys:
        raise ValueError("at least one key column is required")
    for c in [*keys, *columns]:
        if left.schema[c].dataType != right.schema[c].dataType:
            raise TypeError(f"{c}: {left.schema[c].dataType.simpleString()} against {right.schema[c].dataType.simpleString()}")
    root = shared_path(spark, "fingerprint", uuid.uuid4().hex[:12])
    sides = [_hashed(df, keys, columns, bits, levels) for df in (left, right)]
    differing: DataFrame | None = None
    for level in range(levels):
        path = [f"d{i}" for i in range(level + 1)]
        entries = []
        for rows in sides:
            if differing is not None:
                rows = rows.join(differing, path[:-1], "left_semi")
            entries.append(hash_sums(rows, path))
        differing = _differing(*entries, path)
        differing.write.parquet(f"{root}/level_{level}")
        found = spark.read.schema(differing.schema).parquet(f"{root}/level_{level}")
        size = found.agg(F.sum("rows").alias("n")).first()["n"] or 0
        differing = found.select(*path)
        if size == 0:
            break
        if size <= join_rows:
            break
    if size == 0:
        none = left.select(*[_col(k) for k in keys]).where(F.lit(False))
        return none.select(
            "*", F.lit("").alias("status"), F.lit("").alias("changed"),
            F.lit(0).cast("long").alias("n_left"), F.lit(0).cast("long").alias("n_right"),
        )
    last = [rows.join(differing, path, "left_semi") for rows in sides]
    return _compared(*last, left, keys, columns)


def _differing(left: DataFrame, right: DataFrame, path: Sequence[str]) -> DataFrame:
    """Buckets whose entries differ, with the rows they hold on both sides."""
    r = right.select(*path, *[F.col(s).alias(f"r_{s}") for s in _SUMS])
    both = left.join(r, list(path), "full_outer")
    same = reduce(lambda x, y: x & y, [F.col(s).eqNullSafe(F.col(f"r_{s}")) for s in _SUMS])
    rows = F.coalesce("n", F.lit(0)) + F.coalesce("r_n", F.lit(0))
    return both.where(~same).select(*path, rows.cast("long").alias("rows"))


def _compared(left: DataFrame, right: DataFrame, named: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of the differing buckets, collapsed to one per key and joined. The
    key's own values come back from JSON where a key is no plain value."""
    ks = [f"k{i}" for i in range(len(keys))]

    def collapsed(rows: DataFrame, side: str) -> DataFrame:
        values = [F.min(f"c{i}").alias(f"{side}_c{i}") for i in range(len(columns))]
        sums = [
            F.count(F.lit(1)).alias(f"{side}_n"),
            F.sum(F.shiftrightunsigned("_h", 32)).alias(f"{side}_high"),
            F.sum(F.col("_h").bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"{side}_low"),
        ]
        return rows.groupBy(*[F.col(k).alias(f"{side}_{k}") for k in ks]).agg(*sums, *values)

    x, y = collapsed(left, "l"), collapsed(right, "r")
    on = reduce(lambda a, b: a & b, [x[f"l_{k}"].eqNullSafe(y[f"r_{k}"]) for k in ks])
    both = x.join(y, on, "full_outer")
    differ = [~F.col(f"l_c{i}").eqNullSafe(F.col(f"r_c{i}")) for i in range(len(columns))]
    names = [F.when(d, F.lit(c)) for d, c in zip(differ, columns)]
    one = (F.col("l_n") == 1) & (F.col("r_n") == 1)
    changed = F.when(one, F.concat_ws(",", *names)).otherwise(F.lit("")) if names else F.lit("")
    same_rows = reduce(lambda a, b: a & b, [F.col(f"l_{s}") == F.col(f"r_{s}") for s in _SUMS])
    status = (
        F.when(F.col("l_n").isNull(), "missing_left")
        .when(F.col("r_n").isNull(), "missing_right")
        .when(one & (F.col("changed") != ""), "changed")
        .when(~one & ~same_rows, "duplicate")
    )
    keyed = []
    for k, name in zip(ks, keys):
        value, kind = F.coalesce(F.col(f"l_{k}"), F.col(f"r_{k}")), named.schema[name].dataType
        if isinstance(kind, (T.ArrayType, T.StructType)):
            value = F.from_json(value, T.StructType([T.StructField("v", kind)])).getField("v")
        keyed.append(value.alias(name))
    return (
        both.withColumn("changed", changed)
        .withColumn("status", status)
        .where("status is not null")
        .select(
            *keyed, "status", F.when(F.col("status") == "changed", F.col("changed")).otherwise("").alias("changed"),
            F.coalesce("l_n", F.lit(0)).cast("long").alias("n_left"), F.coalesce("r_n", F.lit(0)).cast("long").alias("n_right"),
        )
    )
