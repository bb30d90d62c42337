"""Skew helpers for joins: finding hot keys and salting them.

How a side is joined is left to Catalyst and AQE, which choose from measured
shuffle sizes at run time; nothing here forces a broadcast or a sort-merge.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def hot_keys(df: DataFrame, key: str, *, min_share: float = 0.01) -> list[Any]:
    """Values of ``key`` that hold at least ``min_share`` of the rows, heaviest
    first: one scan of the key column with a frequent-items sketch per task
    (``approx_top_k``), merged by Spark. At most ``1 / min_share`` values can
    hold that share, so the list is bounded; a sketch tracks a hundred times as
    many items, which keeps its error far below the share."""
    if not 0 < min_share <= 1:
        raise ValueError("min_share must be in (0, 1]")
    k = math.ceil(1 / min_share)
    name = "`" + key.replace("`", "``") + "`"
    total, top = df.agg(
        F.count(F.lit(1)), F.expr(f"approx_top_k({name}, {k}, {min(max(10_000, 100 * k), 1_000_000)})")
    ).first()
    return [r["item"] for r in top if r["item"] is not None and r["count"] >= max(2, min_share * total)]


def partitions_for(df: DataFrame, rows_per_task: int) -> int | None:
    """Partitions that leave a task of a join or an aggregate at most about
    ``rows_per_task`` rows of ``df``, by a count of them; None where the rows
    don't fill that much on every core, which AQE spreads as it is.

    AQE alone sizes tasks by shuffled bytes, and narrow rows that compress well
    take more than twenty times as much memory when they are sorted and grouped.
    """
    if rows_per_task < 1:
        raise ValueError("rows_per_task must be at least 1")
    rows, session = df.count(), df.sparkSession
    if rows <= rows_per_task * session.sparkContext.defaultParallelism:
        return None
    return max(int(session.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / rows_per_task))


def dealt_distinct(df: DataFrame, key: str, others: Sequence[str], rows_per_task: int) -> DataFrame:
    """``df`` itself, or, where ``partitions_for`` gives a number, its distinct
    rows of ``key`` and ``others`` dealt by the key over so many partitions: for
    queries that count distinct rows per key, which then need no other shuffle."""
    partitions = partitions_for(df, rows_per_task)
    if partitions is None:
        return df
    return df.select(key, *others).distinct().repartition(partitions, key)


def salt_spread(key: Column, hot: Sequence[Any], spread: Column, splits: int) -> Column:
    """Salt for the large side: rows of a hot key get ``hash(spread) % splits``,
    all other rows 0. The salt is a pure function of the row."""
    return F.when(key.isin(list(hot)), F.pmod(F.xxhash64(spread), F.lit(splits))).otherwise(F.lit(0))


def salt_replicate(key: Column, hot: Sequence[Any], splits: int) -> Column:
    """Salt for the other side: rows of a hot key are repeated once per salt
    value (``explode``), all other rows keep salt 0. Only hot-key rows grow,
    by ``splits`` each."""
    return F.explode(
        F.when(key.isin(list(hot)), F.sequence(F.lit(0), F.lit(splits - 1))).otherwise(F.array(F.lit(0)))
    )
