"""Loading tables that refer to each other: all of them, or none.

The declared keys order the tables, parents before children. Every table is
staged as a version that no reader sees, the keys are checked across the staged
versions, and only if all hold are they released together (``versions.release``).
A violation, or a failure while staging, leaves every table as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators import bitmaps
from sluice.operators import quality as Q
from sluice.sinks import versions as V
from sluice.sinks.tables import TableSpec


@dataclass(frozen=True)
class Key:
    """A primary key (NOT NULL and UNIQUE)."""

    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Reference:
    """A foreign key: ``child.columns`` refer to ``parent.parent_columns``."""

    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Violation:
    rule: str
    keys: int
    rows: int


class GraphRejected(RuntimeError):
    """Keys don't hold across the staged tables; nothing was published."""

    def __init__(self, violations: Sequence[Violation]):
        super().__init__("; ".join(f"{v.rule}: {v.keys} keys, {v.rows} rows" for v in violations))
        self.violations = list(violations)


@dataclass(frozen=True)
class GraphResult:
    release: int
    #: In load order.
    versions: tuple[V.Version, ...]


def load_levels(names: Sequence[str], references: Sequence[Reference]) -> list[list[str]]:
    """The tables in levels: each refers to tables of earlier levels only (or to
    itself). Names keep their order within a level; a cycle is an error."""
    unknown = [r for r in references if r.child not in names or r.parent not in names]
    if unknown:
        raise ValueError(f"references to tables that aren't loaded: {unknown}")
    above = {n: {r.parent for r in references if r.child == n and r.parent != n} for n in names}
    levels: list[list[str]] = []
    placed: set[str] = set()
    while len(placed) < len(names):
        level = [n for n in names if n not in placed and above[n] <= placed]
        if not level:
            raise ValueError(f"references form a cycle among {sorted(set(names) - placed)}")
        levels.append(level)
        placed.update(level)
    return levels


def check_keys(
    frames: Mapping[str, DataFrame], keys: Sequence[Key] = (), references: Sequence[Reference] = ()
) -> list[Violation]:
    """The rules that don't hold across the frames. Integer keys are checked by
    bitmaps, others by grouping and joining keys."""
    found = []
    for k in keys:
        frame = frames[k.table]
        nulls = sum(r["null_count"] for r in Q.check_not_null(frame, k.columns).collect())  # one per column
        if nulls:
            found.append(Violation(f"{k.table}({', '.join(k.columns)}) NOT NULL", 0, nulls))
        if _integers(frame, k.columns):
            repeated = bitmaps.unique_violations(frame, k.columns)
        else:
            repeated = Q.check_unique(frame, list(k.columns))
        found += _counted(f"{k.table}({', '.join(k.columns)}) UNIQUE", repeated)
    for r in references:
        child, parent = frames[r.child], frames[r.parent]
        if _integers(child, r.columns) and _integers(parent, r.parent_columns):
            orphans = bitmaps.foreign_key_violations(child, parent, r.columns, r.parent_columns)
        else:
            orphans = Q.check_foreign_key(child, parent, list(r.columns), list(r.parent_columns))
        found += _counted(f"{r.child}({', '.join(r.columns)}) REFERENCES {r.parent}({', '.join(r.parent_columns)})", orphans)
    return found


def _integers(df: DataFrame, columns: Sequence[str]) -> bool:
    return all(isinstance(df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) for c in columns)


def _counted(rule: str, violations: DataFrame) -> list[Violation]:
    row = violations.agg(F.count(F.lit(1)).alias("keys"), F.sum("n_rows").alias("rows")).first()
    return [Violation(rule, row["keys"], row["rows"])] if row["keys"] else []


def load_graph(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    sources: Mapping[str, DataFrame],
    *,
    namespace: str,
    keys: Sequence[Key] = (),
    references: Sequence[Reference] = (),
    base: str | None = None,
    parallelism: int = 4,
    **options,
) -> GraphResult:
    """Replace the tables of ``specs`` with the rows of ``sources`` (by spec
    name), together. References may also name tables that aren't loaded here but
    were released before: these are checked as they are published."""
    by_name = {s.name: s for s in specs}
    published = V.release_versions(spark, namespace, base)
    outside = {n for r in references for n in (r.child, r.parent)} - set(by_name)
    missing = sorted(n for n in outside if not published.get(n))
    if missing:
        raise ValueError(f"references to tables that are neither loaded nor released: {missing}")
    levels = load_levels([*by_name, *sorted(outside)], references)
    order = [n for level in levels for n in level if n in by_name]
    staged: dict[str, V.Version] = {}

    def one(name: str) -> None:
        staged[name] = V.stage(spark, by_name[name], sources[name], namespace=namespace, base=base, **options)

    try:
        _together([lambda n=n: one(n) for n in order], parallelism)
        frames = {n: V.read_version(spark, namespace, v.table) for n, v in staged.items()}
        frames |= {n: V.read_version(spark, namespace, published[n]) for n in outside}
        violations = check_keys(frames, keys, references)
        if violations:
            raise GraphRejected(violations)
        number = V.release(spark, namespace, {n: staged[n].table for n in order}, base=base)
    except Exception:
        for version in staged.values():
            V.discard(spark, namespace, version.table)
        raise
    return GraphResult(number, tuple(staged[n] for n in order))


def truncate_graph(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    *,
    namespace: str,
    references: Sequence[Reference] = (),
    base: str | None = None,
) -> GraphResult:
    """Empty a set of tables together, keeping their definitions. A released
    table that refers to one of them and still has such rows refuses it."""
    empty = {s.name: spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in s.columns)) for s in specs}
    return load_graph(spark, specs, empty, namespace=namespace, references=references, base=base)


def _together(actions: Sequence[Callable[[], None]], parallelism: int) -> None:
    """Run actions, up to ``parallelism`` at once; the first error is raised
    after all have ended, so nothing is written behind a clean-up."""
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        futures = [pool.submit(a) for a in actions]
        wait(futures)
    for f in futures:
        f.result()
