"""Transfer checks: constraints Spark tables do not enforce, as Spark jobs.

NOT NULL, PRIMARY KEY / UNIQUE and FOREIGN KEY are declared on the source
database; a Parquet table accepts violations silently. Each check returns
the violations as a DataFrame (empty = passed) and pre-aggregates before any
shuffle, so a key holding a large share of the rows costs one partial row
per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def check_not_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, null_count) for every column, in one pass over ``df``."""
    cols = list(columns or df.columns)
    if not cols:
        raise ValueError("no columns to check")
    counts = df.agg(
        *[(F.count(F.lit(1)) - F.count(F.col(f"`{c}`"))).alias(f"n{i}") for i, c in enumerate(cols)]
    )
    pairs = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', n{i}" for i, c in enumerate(cols))
    return counts.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, null_count)")


def check_unique(
    df: DataFrame, keys: Sequence[str], count_name: str = "n_rows", *, nulls_distinct: bool = True
) -> DataFrame:
    """Key values that occur more than once, with their multiplicity.

    As a SQL UNIQUE constraint does, rows with a NULL in any key column are
    not compared (``nulls_distinct``); NULL primary keys are the NOT NULL
    check's business. ``nulls_distinct=False`` groups NULLs like values.
    """
    if nulls_distinct:
        present = F.lit(True)
        for k in keys:
            present = present & F.col(k).isNotNull()
        df = df.filter(present)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).filter(F.col(count_name) > 1)


def check_foreign_key(
    child: DataFrame,
    parent: DataFrame,
    child_keys: Sequence[str],
    parent_keys: Sequence[str] | None = None,
    count_name: str = "n_rows",
) -> DataFrame:
    """Child key values with no parent row, and how many child rows carry them.

    NULL child keys are not violations (SQL foreign-key semantics). Orphans are
    counted per key after the anti join. AQE chooses the join: with a small
    parent it is a broadcast and only orphans are shuffled for the count; else
    both sides are shuffled once on the key, a skewed child partition can be
    split, and the count reuses that partitioning where none was.
    """
    parent_keys = list(parent_keys or child_keys)
    if len(parent_keys) != len(child_keys):
        raise ValueError("child and parent key lists differ in length")
    not_null = F.lit(True)
    for k in child_keys:
        not_null = not_null & F.col(k).isNotNull()
    keyed = child.filter(not_null).groupBy(*child_keys).agg(F.count(F.lit(1)).alias(count_name))
    par = parent.select([F.col(p).alias(f"_p{i}") for i, p in enumerate(parent_keys)])
    cond = None
    for i, k in enumerate(child_keys):
        term = keyed[k] == par[f"_p{i}"]
        cond = term if cond is None else cond & term
    return keyed.join(par, cond, "left_anti")


def compare_counts(expected: int, df: DataFrame) -> tuple[bool, int]:
    """Completeness after a write: (rows written == rows given, rows written)."""
    n = df.count()
    return n == expected, n


def is_empty(df: DataFrame) -> bool:
    """Emptiness after a truncate, without counting every row."""
    return df.isEmpty()


def reconcile(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    fields: Sequence[tuple[str, str, str]],
    key_name: str = "key",
) -> DataFrame:
    """Field-by-field comparison of two keyed record sets.

    ``fields`` is a list of (output_name, left_column, right_column). Per key
    and field the status is ``match`` / ``mismatch`` (null-safe equality),
    ``missing_left`` / ``missing_right`` when one side has no row, or
    ``duplicate`` when the key is not unique on a side.

    Each side is first collapsed to one row per key (row count and one value
    per field) -- a map-side combined aggregate -- so the full outer join
    never pairs up duplicate rows, however hot a key is. With one row the
    value is that row's; with more the status is ``duplicate`` anyway.
    """

    def collapse(df: DataFrame, key: str, side: str, idx: int) -> DataFrame:
        aggs = [F.count(F.lit(1)).alias(f"{side}_n")]
        for name, lcol, rcol in fields:
            aggs.append(F.min(lcol if idx == 0 else rcol).alias(f"{side}_min_{name}"))
        return df.groupBy(F.col(key).alias(f"{side}_key")).agg(*aggs)

    lft = collapse(left, left_key, "l", 0)
    rgt = collapse(right, right_key, "r", 1)
    joined = lft.join(rgt, lft["l_key"] == rgt["r_key"], "full_outer")
    out = [F.coalesce(F.col("l_key"), F.col("r_key")).alias(key_name)]
    for name, _, _ in fields:
        status = (
            F.when(F.col("l_key").isNull() & F.col("l_n").isNull(), F.lit("missing_left"))
            .when(F.col("r_key").isNull() & F.col("r_n").isNull(), F.lit("missing_right"))
            .when((F.col("l_n") > 1) | (F.col("r_n") > 1), F.lit("duplicate"))
            .when(F.col(f"l_min_{name}").eqNullSafe(F.col(f"r_min_{name}")), F.lit("match"))
            .otherwise(F.lit("mismatch"))
        )
        out.append(status.alias(f"{name}_status"))
    return joined.select(*out)
