"""Splitting a table by key into ranges of about equal depth."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.joins import hot_keys


def _literal(value) -> str:
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def key_ranges(df: DataFrame, key: str, parts: int, *, spread: str | None = None) -> list[str]:
    """SQL predicates that together hold every row of ``df`` exactly once, each
    about a ``parts``-th of the rows.

    Boundaries are approximate quantiles of the key. A value that holds more
    than its share, and the rows without a key, get predicates of their own;
    with a ``spread`` column these are cut into parts by a hash of it. What
    comes to the driver is ``parts`` boundaries and at most about ``parts``
    hot values. Rows whose ``spread`` is null hash like any other value.
    """
    if parts < 1:
        raise ValueError("parts must be positive")
    k = "`" + key.replace("`", "``") + "`"
    total, missing = df.agg(F.count(F.lit(1)), F.count(F.when(F.col(k).isNull(), 1))).first()
    target = max(1, -(-total // parts))

    def cut(predicate: str, rows: int) -> list[str]:
        n = -(-rows // target)
        if spread is None or n <= 1:
            return [predicate]
        s = "`" + spread.replace("`", "``") + "`"
        return [f"({predicate} AND pmod(xxhash64({s}), {n}) = {i})" for i in range(n)]

    out = cut(f"{k} IS NULL", missing) if missing else []
    hot = hot_keys(df, key, min_share=1 / parts) if total else []
    rest = df.where(F.col(k).isNotNull())
    if hot:
        sizes = {r[0]: r[1] for r in df.where(F.col(k).isin(hot)).groupBy(F.col(k)).count().collect()}
        for value in hot:
            out += cut(f"{k} = {_literal(value)}", sizes[value])
        rest = rest.where(~F.col(k).isin(hot))
    others = f"{k} IS NOT NULL" + (f" AND {k} NOT IN ({', '.join(map(_literal, hot))})" if hot else "")
    left = total - missing - (sum(sizes.values()) if hot else 0)
    n = -(-left // target)
    if n <= 1:
        return [*out, f"({others})"]
    # Boundaries are values of the key, so no row lies between two ranges.
    cuts = rest.agg(F.percentile_approx(F.col(k), [i / n for i in range(1, n)], 10_000)).first()[0]
    cuts = sorted(set(cuts))
    out.append(f"({others} AND {k} <= {_literal(cuts[0])})")
    out += [f"({others} AND {k} > {_literal(a)} AND {k} <= {_literal(b)})" for a, b in zip(cuts, cuts[1:])]
    return [*out, f"({others} AND {k} > {_literal(cuts[-1])})"]


# --- several columns --------------------------------------------------------


def at_or_after(columns: Sequence[str], bound: Sequence[str]) -> str:
    """SQL text: the row's columns come at or after ``bound`` in lexicographic
    order. Columns and values are SQL texts; a bound may name the first columns
    only. Plain comparisons, so whoever evaluates it applies its own order."""
    *rest, last = list(zip(columns, bound))
    text = f"{last[0]} >= {last[1]}"
    for c, v in reversed(rest):
        text = f"{c} > {v} OR ({c} = {v} AND ({text}))"
    return f"({text})"


def before(columns: Sequence[str], bound: Sequence[str]) -> str:
    """SQL text: the row's columns come before ``bound``."""
    *rest, last = list(zip(columns, bound))
    text = f"{last[0]} < {last[1]}"
    for c, v in reversed(rest):
        text = f"{c} < {v} OR ({c} = {v} AND ({text}))"
    return f"({text})"


def lexicographic_ranges(
    columns: Sequence[str], bounds: Sequence[Sequence[Any]], literal: Callable[[Any], str]
) -> list[str]:
    """Predicates that hold every row exactly once, for ``bounds`` in the order
    of whoever evaluates them: before the first, between each two, from the last
    on, and rows with a NULL among ``columns``. ``columns`` are quoted names. A
    bound that equals its predecessor in that order only makes an empty range."""
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    absent = " OR ".join(f"{c} IS NULL" for c in columns)
    texts = [[literal(v) for v in b] for b in bounds]
    if not texts:
        return [present, absent]
    out = [f"{present} AND {before(columns, texts[0])}"]
    out += [f"{present} AND {at_or_after(columns, a)} AND {before(columns, b)}" for a, b in zip(texts, texts[1:])]
    return [*out, f"{present} AND {at_or_after(columns, texts[-1])}", absent]


def row_ranges(df: DataFrame, keys: Sequence[str], parts: int, *, sampled: int = 1000) -> list[str]:
    """SQL predicates over one or several key columns of any orderable types that
    hold every row of ``df`` exactly once, each about a ``parts``-th of them.

    Bounds come from a random sample of about ``sampled`` rows a part, which
    Spark deals out by ranges of the key; eight ranges a part are merged to equal
    depth by their row counts. So a sample of the keys is shuffled, and eight
    rows a part come to the driver. Whatever the bounds, the predicates hold all
    rows; a combination of keys with more than its share stays whole.
    """
    if parts < 1 or not keys:
        raise ValueError("parts must be positive and at least one key is required")
    quoted = ["`" + k.replace("`", "``") + "`" for k in keys]
    names = [f"k{i}" for i in range(len(keys))]
    present = df.select(*[F.col(q).alias(n) for q, n in zip(quoted, names)]).dropna()
    total = present.count()
    if parts == 1 or total <= 1:
        return lexicographic_ranges(quoted, [], _literal)
    share = min(1.0, sampled * parts / total)
    rows = present.sample(share, seed=7) if share < 1 else present
    dealt = rows.repartitionByRange(8 * parts, *names).groupBy(F.spark_partition_id().alias("part"))
    found = sorted(dealt.agg(F.min(F.struct(*names)).alias("first"), F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["part"])
    bounds: list[tuple] = []
    seen, target = 0, sum(r["n"] for r in found) / parts
    for r in found:
        if seen >= target * (len(bounds) + 1) - r["n"] / 2 and seen and len(bounds) < parts - 1:
            bounds.append(tuple(r["first"]))
        seen += r["n"]
    return lexicographic_ranges(quoted, bounds, _literal)
