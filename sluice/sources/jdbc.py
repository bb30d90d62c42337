"""JDBC sources: whole-table, query, measured-bounds partitioned and
predicate-partitioned reads, plus a source inventory.

Spark's JDBC scan is parallel only when it is told how to split the key space.
Every split here is derived from numbers the database computes itself (MIN /
MAX / COUNT, a bucket histogram, a value histogram) through pushed-down
subqueries; only those few numbers reach the driver, never rows.
"""

from __future__ import annotations

import datetime as dt
import logging
import math
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any, TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.config import JdbcConfig
from sluice.operators.ranges import lexicographic_ranges

log = logging.getLogger(__name__)
R = TypeVar("R")

# Markers of connection failures worth retrying: transient / recoverable
# connection exceptions, refused or reset sockets, timeouts, and the SQLSTATEs
# for "unable to connect" / "link failure". Anything else -- a missing
# database, bad credentials, bad SQL, bad arguments -- fails at once.
TRANSIENT_MARKERS = (
    "SQLTransientConnectionException",
    "SQLRecoverableException",
    "CommunicationsException",
    "Communications link failure",
    "Connection refused",
    "connect timed out",
    "Connection reset",
    "SocketTimeoutException",
    "SQLState: 08001",
    "SQLState: 08S01",
    "SQLState: 08006",
)


def is_transient(error: BaseException) -> bool:
    text = f"{type(error).__name__}: {error}"
    return any(marker in text for marker in TRANSIENT_MARKERS)


def with_retry(
    action: Callable[[], R],
    attempts: int = 3,
    delay_s: float = 10.0,
    transient: Callable[[BaseException], bool] = is_transient,
    sleep: Callable[[float], None] = time.sleep,
) -> R:
    """Run ``action``; retry only transient connection errors, ``attempts`` times.

    This covers driver-side work such as schema resolution in ``load()`` and
    bound queries. Scan tasks are retried by Spark itself
    (``spark.task.maxFailures``), so executor loss needs nothing here.
    """
    if attempts < 1:
        raise ValueError("attempts must be >= 1")
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except Exception as error:  # noqa: BLE001 - classified below
            if attempt == attempts or not transient(error):
                raise
            log.warning("transient JDBC failure (attempt %d/%d): %s", attempt, attempts, error)
            sleep(delay_s)
    raise AssertionError("unreachable")


def _reader(spark: SparkSession, cfg: JdbcConfig, **options: Any):
    opts = cfg.spark_options()
    opts.setdefault("preferTimestampNTZ", "true")
    opts.update({k: str(v) for k, v in options.items() if v is not None})
    return spark.read.format("jdbc").options(**opts)


def read_table(
    spark: SparkSession,
    cfg: JdbcConfig,
    table: str,
    *,
    fetchsize: int | None = 10_000,
    query_timeout_s: int | None = None,
    retries: int = 3,
) -> DataFrame:
    """Whole-table read in one partition (small tables, dimension lookups)."""
    return with_retry(
        lambda: _reader(
            spark, cfg, dbtable=table, fetchsize=fetchsize, queryTimeout=query_timeout_s
        ).load(),
        attempts=retries,
    )


def read_query(spark: SparkSession, cfg: JdbcConfig, sql: str, *, retries: int = 3) -> DataFrame:
    """Read the result of a SELECT (the ``query`` option). Only SELECTs work:
    Spark wraps the text as a derived table to learn its schema."""
    head = sql.lstrip().split(None, 1)[0].upper() if sql.strip() else ""
    if head not in ("SELECT", "WITH", "VALUES", "("):
        raise ValueError(f"query must be a SELECT, got {head or 'empty'}")
    return with_retry(lambda: _reader(spark, cfg, query=sql).load(), attempts=retries)


def read_subquery(
    spark: SparkSession, cfg: JdbcConfig, sql: str, alias: str = "q", *, retries: int = 3
) -> DataFrame:
    """Read ``(sql) AS alias`` through ``dbtable`` -- the database evaluates the
    subquery, so projections, filters and aggregates inside it are pushed by
    construction."""
    return with_retry(
        lambda: _reader(spark, cfg, dbtable=f"({sql}) {cfg.quote(alias)}").load(), attempts=retries
    )


def connection_check(spark: SparkSession, cfg: JdbcConfig, probe_sql: str | None = None) -> DataFrame:
    """``SELECT 1 AS connection_test`` through the source (A3 / C3)."""
    sql = probe_sql or _literal_probe(cfg)
    return read_query(spark, cfg, sql)


def _literal_probe(cfg: JdbcConfig) -> str:
    alias = cfg.quote("connection_test")
    if cfg.flavor == "derby":
        return f"SELECT 1 AS {alias} FROM SYSIBM.SYSDUMMY1"
    if cfg.flavor == "oracle":
        return f"SELECT 1 AS {alias} FROM DUAL"
    return f"SELECT 1 AS {alias}"


@dataclass(frozen=True)
class KeyBounds:
    """What the source says about a partition key."""

    lower: Any
    upper: Any
    rows: int
    nulls: int

    @property
    def empty(self) -> bool:
        return self.lower is None


def bounds(spark: SparkSession, cfg: JdbcConfig, table: str, column: str) -> KeyBounds:
    """MIN, MAX, COUNT(*) and NULL count of ``column``, computed by the source."""
    c = cfg.quote(column)
    sql = (
        f"SELECT MIN({c}) AS {cfg.quote('min_val')}, MAX({c}) AS {cfg.quote('max_val')}, "
        f"COUNT(*) AS {cfg.quote('n_rows')}, COUNT({c}) AS {cfg.quote('n_keys')} FROM {table}"
    )
    row = read_subquery(spark, cfg, sql, "min_max").first()
    return KeyBounds(row["min_val"], row["max_val"], int(row["n_rows"]), int(row["n_rows"]) - int(row["n_keys"]))


def bounds_frame(spark: SparkSession, cfg: JdbcConfig, table: str, column: str) -> DataFrame:
    """The bounds as a one-row DataFrame (``min_val``, ``max_val``)."""
    c = cfg.quote(column)
    sql = f"SELECT MIN({c}) AS {cfg.quote('min_val')}, MAX({c}) AS {cfg.quote('max_val')} FROM {table}"
    return read_subquery(spark, cfg, sql, "min_max")


def _format_bound(value: Any) -> str:
    if isinstance(value, bool):
        raise TypeError("boolean partition keys are not supported")
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        if not value.is_integer():
            raise TypeError("fractional bounds: partition on an integer, date or timestamp key")
        return str(int(value))
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, dt.date):
        return value.isoformat()
    if hasattr(value, "to_integral_value"):  # Decimal
        return str(int(value))
    raise TypeError(
        f"cannot stride-partition on {type(value).__name__}; use read_by_predicates for string keys"
    )


def _span(b: KeyBounds) -> int | None:
    """Number of distinct integral points in [lower, upper], if countable."""
    lo, hi = b.lower, b.upper
    if isinstance(lo, dt.datetime) or isinstance(hi, dt.datetime):
        return None
    if isinstance(lo, dt.date):
        return (hi - lo).days + 1
    try:
        return int(hi) - int(lo) + 1
    except (TypeError, ValueError):
        return None


def read_partitioned(
    spark: SparkSession,
    cfg: JdbcConfig,
    table: str,
    column: str,
    num_partitions: int = 10,
    *,
    key_bounds: KeyBounds | None = None,
    rows_per_partition: int | None = None,
    fetchsize: int | None = 10_000,
    retries: int = 3,
    spread_column: str | None = None,
) -> DataFrame:
    """Parallel range read on an integer, date or timestamp key.

    Bounds are measured unless given. Spark uses them only to place strides,
    never as a filter: rows outside the bounds and NULL keys still arrive (NULLs
    in the first partition). The partition count is capped by the number of key
    values so no stride is empty by construction; an empty source reads in one
    partition.

    With ``rows_per_partition`` the count follows the source size instead:
    ``ceil(COUNT(*) / rows_per_partition)`` partitions (from the same pushed
    bounds query), at most ``num_partitions`` -- the number of connections the
    database may serve at once -- so each read task stays a bounded size as
    the table grows. A source that needs more than that is logged.

    NULL keys land in partition 0. Where they are more than a partition's share
    and ``spread_column`` names another integer column, the read is balanced
    instead (``read_balanced``), which cuts them by that column.
    """
    if num_partitions < 1:
        raise ValueError("num_partitions must be >= 1")
    b = key_bounds or with_retry(lambda: bounds(spark, cfg, table, column), attempts=retries)
    if b.empty:
        return read_table(spark, cfg, table, fetchsize=fetchsize, retries=retries)
    if rows_per_partition:
        wanted = math.ceil(b.rows / rows_per_partition)
        if wanted > num_partitions:
            log.warning(
                "%s: %d rows in %d partitions, %d wanted; raise num_partitions if the source can serve more",
                table, b.rows, num_partitions, wanted,
            )
        num_partitions = max(1, min(num_partitions, wanted))
    if b.nulls and b.rows and b.nulls * num_partitions > b.rows:
        if spread_column and isinstance(b.lower, int):
            return read_balanced(spark, cfg, table, column, num_partitions, spread_column=spread_column)
        log.warning("%s.%s: %d of %d keys are NULL; they all land in partition 0", table, column, b.nulls, b.rows)
    span = _span(b)
    n = min(num_partitions, span) if span else num_partitions
    if n <= 1 or b.lower == b.upper:
        return read_table(spark, cfg, table, fetchsize=fetchsize, retries=retries)
    if isinstance(b.lower, dt.datetime):
        # Spark strides only TIMESTAMP (local-time) keys; reads here keep
        # timestamp_ntz, so equal-width strides become range predicates.
        step = (b.upper - b.lower) / n
        cuts = sorted({b.lower + step * i for i in range(1, n)})
        return read_by_predicates(
            spark, cfg, table, range_predicates(cfg, column, cuts), fetchsize=fetchsize, retries=retries
        )
    upper = b.upper
    if span is not None and not isinstance(upper, dt.date):
        upper = int(upper) + 1  # strides over [lower, upper + 1) cover every value evenly
    return with_retry(
        lambda: _reader(
            spark,
            cfg,
            dbtable=table,
            partitionColumn=column,
            lowerBound=_format_bound(b.lower),
            upperBound=_format_bound(upper),
            numPartitions=n,
            fetchsize=fetchsize,
        ).load(),
        attempts=retries,
    )


def read_by_predicates(
    spark: SparkSession,
    cfg: JdbcConfig,
    table: str,
    predicates: Sequence[str],
    *,
    fetchsize: int | None = 10_000,
    retries: int = 3,
) -> DataFrame:
    """One partition per WHERE clause. The clauses must be disjoint and cover
    every row (including NULL keys), or rows are lost or duplicated."""
    if not predicates:
        raise ValueError("at least one predicate is required")
    props = cfg.spark_options()
    url = props.pop("url")
    props.setdefault("preferTimestampNTZ", "true")
    if fetchsize:
        props["fetchsize"] = str(fetchsize)
    return with_retry(
        lambda: spark.read.jdbc(url, table, predicates=list(predicates), properties=props),
        attempts=retries,
    )


def _literal(value: Any, flavor: str = "") -> str:
    """A SQL literal; Derby spells typed literals as functions."""
    if isinstance(value, str):
        if flavor in ("mysql", "mariadb"):  # there a backslash escapes
            value = value.replace("\\", "\\\\")
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, dt.datetime):
        text = value.isoformat(sep=" ")
        return f"TIMESTAMP('{text}')" if flavor == "derby" else f"TIMESTAMP '{text}'"
    if isinstance(value, dt.date):
        return f"DATE('{value.isoformat()}')" if flavor == "derby" else f"DATE '{value.isoformat()}'"
    return str(value)


def equal_depth_cuts(histogram: Sequence[tuple[Any, int]], num_ranges: int) -> list[Any]:
    """Cut points over an ascending (value, row count) histogram so that at
    most ``num_ranges`` contiguous ranges each hold about total / num_ranges
    rows; no range holds more than total / num_ranges plus the heaviest
    single value (a hot value can only share its range with lighter ones
    before it, and the range closes right after it)."""
    k = max(1, min(num_ranges, len(histogram)))
    target = sum(n for _, n in histogram) / k
    if target <= 0:
        return []
    cuts: list[Any] = []
    acc = 0  # rows before ``value``
    for value, n in histogram:
        # Range j closes at the first value boundary past j * target, so
        # every range stays within target + (its last value's count).
        if len(cuts) < k - 1 and acc > 0 and acc >= target * (len(cuts) + 1):
            cuts.append(value)
        acc += n
    return cuts


def range_predicates(cfg: JdbcConfig, column: str, boundaries: Sequence[Any]) -> list[str]:
    """Disjoint, covering clauses for ascending ``boundaries`` b1 < b2 < ...:
    ``c < b1``, ``b1 <= c < b2``, ..., ``c >= bk``, and ``c IS NULL``."""
    c = cfg.quote(column)
    bs = list(boundaries)
    if any(b is None for b in bs) or bs != sorted(bs) or len(set(bs)) != len(bs):
        raise ValueError("boundaries must be distinct, non-null and ascending")
    if not bs:
        return [f"{c} IS NOT NULL", f"{c} IS NULL"]
    lit = lambda v: _literal(v, cfg.flavor)
    out = [f"{c} < {lit(bs[0])}"]
    out += [f"{c} >= {lit(a)} AND {c} < {lit(b)}" for a, b in zip(bs, bs[1:])]
    out.append(f"{c} >= {lit(bs[-1])}")
    out.append(f"{c} IS NULL")
    return out


def predicate_counts(
    spark: SparkSession, cfg: JdbcConfig, table: str, predicates: Sequence[str], *, per_query: int = 100
) -> list[int]:
    """Rows that the source counts for each predicate, ``per_query`` of them in
    one pushed query."""
    out: list[int] = []
    for at in range(0, len(predicates), per_query):
        part = predicates[at : at + per_query]
        sums = ", ".join(f"SUM(CASE WHEN {p} THEN 1 ELSE 0 END) AS {cfg.quote(f'p{i}')}" for i, p in enumerate(part))
        row = with_retry(lambda s=sums: read_subquery(spark, cfg, f"SELECT {s} FROM {table}", "sizes").first())
        out += [int(row[f"p{i}"] or 0) for i in range(len(part))]
    return out


def split_heavy(
    spark: SparkSession,
    cfg: JdbcConfig,
    table: str,
    predicates: Sequence[str],
    spread_column: str,
    rows_per_partition: int,
) -> list[str]:
    """The predicates, those that hold more than ``rows_per_partition`` rows
    (a hot value, the rows without a key) cut into parts by an integer column,
    hashed modulo a prime so that a step in it does no harm; a NULL there
    belongs to part 0. One pushed
    query counts all of them. Disjoint and covering predicates stay so."""
    if rows_per_partition < 1:
        raise ValueError("rows_per_partition must be positive")
    counts = predicate_counts(spark, cfg, table, predicates)
    s = cfg.quote(spread_column)
    out = []
    for i, p in enumerate(predicates):
        n = math.ceil(counts[i] / rows_per_partition)
        if n <= 1:
            out.append(p)
            continue
        part = f"MOD(MOD(MOD(ABS({s}), 100003) * 7919, 100003), {n})"
        out.append(f"({p}) AND ({part} = 0 OR {s} IS NULL)")
        out += [f"({p}) AND {part} = {k}" for k in range(1, n)]
    return out


def balanced_predicates(
    spark: SparkSession,
    cfg: JdbcConfig,
    table: str,
    column: str,
    num_partitions: int,
    *,
    max_values: int = 10_000,
) -> list[str]:
    """Balanced, disjoint predicates for any orderable key (strings included).

    The source computes a value histogram (``GROUP BY column``); its size is
    checked by a pushed ``COUNT(DISTINCT)`` first, so at most ``max_values``
    (value, count) pairs reach the driver. With more values the source cuts
    the rows itself (``NTILE``) and sends one boundary per partition. Values
    are cut into contiguous ranges of roughly equal row counts; one very hot
    value keeps a partition of its own. Range clauses (not IN lists) keep each
    predicate short.
    """
    c = cfg.quote(column)
    n_values = read_subquery(
        spark, cfg, f"SELECT COUNT(DISTINCT {c}) AS {cfg.quote('n')} FROM {table}", "nd"
    ).first()["n"]
    if n_values > max_values:
        v, t = cfg.quote("v"), cfg.quote("t")
        tiles = read_subquery(
            spark,
            cfg,
            f"SELECT MIN({v}) AS {v} FROM (SELECT {c} AS {v}, NTILE({num_partitions}) OVER (ORDER BY {c}) AS {t} "
            f"FROM {table} WHERE {c} IS NOT NULL) {cfg.quote('k')} GROUP BY {t}",
            "tiles",
        ).collect()  # one row per partition
        if any(isinstance(r["v"], str) for r in tiles):
            return row_predicates(spark, cfg, table, [column], num_partitions)
        return range_predicates(cfg, column, sorted({r["v"] for r in tiles})[1:])
    hist = read_subquery(
        spark,
        cfg,
        f"SELECT {c} AS {cfg.quote('v')}, COUNT(*) AS {cfg.quote('n')} FROM {table} "
        f"WHERE {c} IS NOT NULL GROUP BY {c}",
        "hist",
    ).collect()  # bounded by max_values, checked above
    if any(isinstance(r["v"], str) for r in hist):
        return row_predicates(spark, cfg, table, [column], num_partitions)
    pairs = sorted((r["v"], int(r["n"])) for r in hist)
    return range_predicates(cfg, column, equal_depth_cuts(pairs, num_partitions))


def row_bounds(
    spark: SparkSession, cfg: JdbcConfig, table: str, columns: Sequence[str], num_partitions: int
) -> list[tuple]:
    """Equal-depth boundaries over one or several key columns, in the *source's*
    lexicographic order: it numbers its rows by that order and sends every
    (rows / num_partitions)-th key with its number. Rows with a NULL among the
    columns have no place in it."""
    quoted = [cfg.quote(c) for c in columns]
    listed, there = ", ".join(quoted), " AND ".join(f"{c} IS NOT NULL" for c in quoted)
    n = int(read_subquery(spark, cfg, f"SELECT COUNT(*) AS {cfg.quote('n')} FROM {table} WHERE {there}", "c").first()["n"])
    step = -(-n // num_partitions)
    if step < 1 or num_partitions < 2:
        return []
    place = cfg.quote("sluice_place")
    if cfg.flavor == "derby":  # no ORDER BY inside OVER: number the rows of an ordered derived table
        numbered = f"SELECT ROW_NUMBER() OVER () AS {place}, o.* FROM (SELECT {listed} FROM {table} WHERE {there} ORDER BY {listed}) o"
    else:
        numbered = f"SELECT ROW_NUMBER() OVER (ORDER BY {listed}) AS {place}, {listed} FROM {table} WHERE {there}"
    found = read_subquery(
        spark, cfg, f"SELECT {place}, {listed} FROM ({numbered}) k WHERE {place} > 1 AND MOD({place} - 1, {step}) = 0", "bounds"
    ).collect()  # one row per partition
    out: list[tuple] = []
    for r in sorted(found, key=lambda r: r["sluice_place"]):
        key = tuple(r[c] for c in columns)
        if not out or out[-1] != key:
            out.append(key)
    return out


def row_predicates(
    spark: SparkSession, cfg: JdbcConfig, table: str, columns: Sequence[str], num_partitions: int
) -> list[str]:
    """Balanced, disjoint and covering predicates over one or several key columns
    of any orderable types. Boundaries, their order and the comparisons are all
    the source's, so they agree under every collation. The last predicate holds
    the rows with a NULL key."""
    bounds = row_bounds(spark, cfg, table, columns, num_partitions)
    return lexicographic_ranges([cfg.quote(c) for c in columns], bounds, lambda v: _literal(v, cfg.flavor))


def misplaced_rows(
    spark: SparkSession, cfg: JdbcConfig, table: str, predicates: Sequence[str], *, per_query: int = 100
) -> int:
    """Rows that don't lie in exactly one of ``predicates``, counted by the source
    over neighbouring groups of them: 0 means that a read by them is whole. Up to
    ``per_query`` predicates are counted exactly; more are counted group by group
    and by their sum, which finds rows in none and rows in several."""
    total = int(read_subquery(spark, cfg, f"SELECT COUNT(*) AS {cfg.quote('n')} FROM {table}", "c").first()["n"])
    if len(predicates) <= per_query:
        hits = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in predicates)
        sql = f"SELECT COUNT(*) AS {cfg.quote('n')} FROM {table} WHERE {hits} <> 1"
        return int(with_retry(lambda: read_subquery(spark, cfg, sql, "m").first())["n"])
    return abs(total - sum(predicate_counts(spark, cfg, table, predicates, per_query=per_query)))


def read_by_rows(
    spark: SparkSession, cfg: JdbcConfig, table: str, columns: Sequence[str], num_partitions: int = 10, **kw
) -> DataFrame:
    """Parallel read by ranges over one or several key columns, checked by the
    source before a row is read."""
    predicates = row_predicates(spark, cfg, table, columns, num_partitions)
    wrong = misplaced_rows(spark, cfg, table, predicates)
    if wrong:
        raise RuntimeError(f"{table}: {wrong} rows lie in no range or in several")
    return read_by_predicates(spark, cfg, table, predicates, **kw)


def histogram_boundaries(
    spark: SparkSession,
    cfg: JdbcConfig,
    table: str,
    column: str,
    num_partitions: int,
    *,
    buckets: int = 1024,
    key_bounds: KeyBounds | None = None,
) -> list[int]:
    """Equal-depth boundaries for a skewed integer key from a pushed
    fixed-width bucket histogram (at most ``buckets`` rows reach the driver)."""
    b = key_bounds or bounds(spark, cfg, table, column)
    if b.empty:
        return []
    lo, hi = int(b.lower), int(b.upper)
    width = max(1, math.ceil((hi - lo + 1) / buckets))
    c = cfg.quote(column)
    b_, n_ = cfg.quote("b"), cfg.quote("n")
    # The bucket is computed in a derived table and grouped by its alias:
    # some databases (Derby) reject GROUP BY on a function expression.
    rows = read_subquery(
        spark,
        cfg,
        f"SELECT {b_}, COUNT(*) AS {n_} FROM (SELECT FLOOR(({c} - ({lo})) / {width}) AS {b_} "
        f"FROM {table} WHERE {c} IS NOT NULL) {cfg.quote('k')} GROUP BY {b_}",
        "bh",
    ).collect()  # <= buckets rows
    counts = sorted((lo + int(r["b"]) * width, int(r["n"])) for r in rows)
    return equal_depth_cuts(counts, num_partitions)


def read_balanced(
    spark: SparkSession,
    cfg: JdbcConfig,
    table: str,
    column: str,
    num_partitions: int = 10,
    *,
    buckets: int = 1024,
    spread_column: str | None = None,
) -> DataFrame:
    """Range read whose partitions hold similar row counts even on a skewed
    integer key (strides from a histogram instead of from MIN/MAX alone). With
    a ``spread_column`` a hot value, a dense bucket and the rows without a key
    are cut further, so no partition holds much more than its share."""
    cuts = histogram_boundaries(spark, cfg, table, column, num_partitions, buckets=buckets)
    predicates = range_predicates(cfg, column, cuts)
    if spread_column:
        rows = int(read_subquery(spark, cfg, f"SELECT COUNT(*) AS {cfg.quote('n')} FROM {table}", "c").first()["n"])
        predicates = split_heavy(spark, cfg, table, predicates, spread_column, max(1, math.ceil(rows / num_partitions)))
    return read_by_predicates(spark, cfg, table, predicates)


# Metadata SQL per database family: (namespace, table) of base tables, system
# schemas excluded.
_INVENTORY_SQL = {
    "derby": (
        "SELECT s.SCHEMANAME AS {ns}, t.TABLENAME AS {tn} FROM SYS.SYSTABLES t "
        "JOIN SYS.SYSSCHEMAS s ON t.SCHEMAID = s.SCHEMAID WHERE t.TABLETYPE = 'T'"
    ),
    "default": (
        "SELECT table_schema AS {ns}, table_name AS {tn} FROM information_schema.tables "
        "WHERE table_type = 'BASE TABLE' AND table_schema NOT IN "
        "('information_schema', 'mysql', 'performance_schema', 'sys', 'pg_catalog')"
    ),
}


def list_tables(spark: SparkSession, cfg: JdbcConfig, namespace: str | None = None) -> DataFrame:
    """(namespace, table_name) of the source's base tables, via a SELECT on the
    catalog views -- ``SHOW TABLES`` is not a derived table and cannot be read."""
    template = _INVENTORY_SQL.get(cfg.flavor, _INVENTORY_SQL["default"])
    sql = template.format(ns=cfg.quote("namespace"), tn=cfg.quote("table_name"))
    df = read_subquery(spark, cfg, sql, "inv")
    if namespace is not None:
        df = df.filter(F.col("namespace") == namespace)
    return df


#: Tables that one pushed query of an inventory counts.
_TABLES_A_QUERY = 100


def source_inventory(
    spark: SparkSession,
    cfg: JdbcConfig,
    namespace: str | None = None,
    *,
    key_columns: dict[str, str] | None = None,
    max_tables: int | None = None,
) -> DataFrame:
    """(namespace, table_name, row_count[, min_key, max_key]) computed by the
    source. Tables are counted ``_TABLES_A_QUERY`` at a time in one pushed
    ``UNION ALL``, so the plan stays small however many there are; a table that
    ``key_columns`` names is read on its own, with ``MIN`` / ``MAX`` of the key.
    Key bounds come back as text so tables with different key types share one
    frame. Only the list of names comes to the driver; ``max_tables`` refuses a
    longer one."""
    tables = list_tables(spark, cfg, namespace)
    n = tables.count()
    if max_tables is not None and n > max_tables:
        raise ValueError(f"{n} tables > max_tables={max_tables}; narrow the namespace")
    keys = {k.upper(): v for k, v in (key_columns or {}).items()}
    fields = [
        T.StructField("namespace", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("row_count", T.LongType()),
    ]
    if key_columns is not None:
        fields += [T.StructField("min_key", T.StringType()), T.StructField("max_key", T.StringType())]
    parts, counted_only = [], []
    for row in tables.orderBy("namespace", "table_name").collect():
        qualified = f"{cfg.quote(row['namespace'])}.{cfg.quote(row['table_name'])}"
        key = keys.get(row["table_name"].upper())
        if not key:
            counted_only.append((row["namespace"], row["table_name"], qualified))
            continue
        k = cfg.quote(key)
        select = f"COUNT(*) AS {cfg.quote('row_count')}, MIN({k}) AS {cfg.quote('min_key')}, MAX({k}) AS {cfg.quote('max_key')}"
        counted = read_subquery(spark, cfg, f"SELECT {select} FROM {qualified}", "cnt")
        parts.append(
            counted.select(
                F.lit(row["namespace"]).alias("namespace"), F.lit(row["table_name"]).alias("table_name"),
                F.col("row_count").cast("bigint").alias("row_count"), F.col("min_key").cast("string"), F.col("max_key").cast("string"),
            )
        )
    place, n_rows = cfg.quote("place"), cfg.quote("row_count")
    for at in range(0, len(counted_only), _TABLES_A_QUERY):
        some = counted_only[at : at + _TABLES_A_QUERY]
        union = " UNION ALL ".join(f"SELECT {i} AS {place}, COUNT(*) AS {n_rows} FROM {q}" for i, (_, _, q) in enumerate(some))
        names = F.array(*[F.struct(F.lit(ns).alias("namespace"), F.lit(t).alias("table_name")) for ns, t, _ in some])
        counted = read_subquery(spark, cfg, union, "cnt").select(
            F.element_at(names, F.col("place").cast("int") + 1).alias("name"), F.col("row_count").cast("bigint").alias("row_count")
        ).select("name.namespace", "name.table_name", "row_count")
        if key_columns is not None:
            none = F.lit(None).cast("string")
            counted = counted.select("*", none.alias("min_key"), none.alias("max_key"))
        parts.append(counted)
    if not parts:
        return spark.createDataFrame([], T.StructType(fields))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Dialects whose Spark JDBC dialect renders no row-limit clause: a pushed
# LIMIT / TOP-N would be dropped by Spark *and* not applied by the database,
# returning too many rows (seen on Derby), so limit pushdown is turned off.
_NO_LIMIT_PUSHDOWN = ("derby",)


def register_catalog(
    spark: SparkSession,
    name: str,
    cfg: JdbcConfig,
    *,
    push_down_aggregate: bool = True,
    fetchsize: int | None = 10_000,
) -> str:
    """Register the source as a V2 JDBC catalog ``name``.

    Tables are then plain DataFrames (``spark.table(f"{name}.ns.t")``) whose
    filters, column pruning, aggregates (MIN / MAX / COUNT / SUM / GROUP BY)
    and -- where the dialect supports it -- LIMIT / TOP-N are pushed into the
    database by Catalyst, and ``SHOW TABLES IN name.ns`` lists the source.
    """
    prefix = f"spark.sql.catalog.{name}"
    spark.conf.set(prefix, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    for key, value in cfg.spark_options().items():
        spark.conf.set(f"{prefix}.{key}", value)
    spark.conf.set(f"{prefix}.pushDownAggregate", str(push_down_aggregate).lower())
    limit_ok = cfg.flavor not in _NO_LIMIT_PUSHDOWN
    spark.conf.set(f"{prefix}.pushDownLimit", str(limit_ok).lower())
    spark.conf.set(f"{prefix}.pushDownOffset", str(limit_ok).lower())
    spark.conf.set(f"{prefix}.preferTimestampNTZ", "true")
    if fetchsize:
        spark.conf.set(f"{prefix}.fetchsize", str(fetchsize))
    return name


def catalog_bounds(spark: SparkSession, catalog_table: str, column: str) -> DataFrame:
    """MIN / MAX of a key through a V2 JDBC catalog: a DataFrame aggregate
    that Catalyst pushes into the database (``PushedAggregates``)."""
    return spark.table(catalog_table).agg(F.min(column).alias("min_val"), F.max(column).alias("max_val"))


def catalog_inventory(
    spark: SparkSession,
    catalog: str,
    namespace: str,
    *,
    key_columns: dict[str, str] | None = None,
    max_tables: int | None = None,
) -> DataFrame:
    """(namespace, table_name, row_count[, min_key, max_key]) through a V2
    JDBC catalog: the list from ``SHOW TABLES``, each count (and key MIN /
    MAX) a DataFrame aggregate that Catalyst pushes into the database."""
    tables = spark.sql(f"SHOW TABLES IN {catalog}.{namespace}")
    n = tables.count()
    if max_tables is not None and n > max_tables:
        raise ValueError(f"{n} tables > max_tables={max_tables}; narrow the namespace")
    keys = {k.upper(): v for k, v in (key_columns or {}).items()}
    schema = "namespace STRING, table_name STRING, row_count BIGINT"
    if key_columns is not None:
        schema += ", min_key STRING, max_key STRING"
    parts = []
    for r in tables.orderBy("tableName").collect():
        key = keys.get(r["tableName"].upper())
        aggs = [F.count(F.lit(1)).cast("bigint").alias("row_count")]
        if key_columns is not None:
            aggs += [
                (F.min(key) if key else F.lit(None)).cast("string").alias("min_key"),
                (F.max(key) if key else F.lit(None)).cast("string").alias("max_key"),
            ]
        counted = spark.table(f"{catalog}.{namespace}.{r['tableName']}").agg(*aggs)
        parts.append(
            counted.select(
                F.lit(r["namespace"]).alias("namespace"), F.lit(r["tableName"]).alias("table_name"),
                *[c for c in counted.columns],
            )
        )
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
