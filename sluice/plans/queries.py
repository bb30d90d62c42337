"""The registered queries: every operator of the toolkit run over the driver's
tables (or data Spark derives from them), each with an equivalent DuckDB SQL
oracle where one exists.

Stand-ins for the reference's HR tables: orders are projects (key = name,
o_totalprice = budget, o_custkey = department), customer rows are departments
(c_name) and employees (c_mktsegment = department, c_acctbal = salary),
lineitem rows are assignments (l_orderkey = project, l_suppkey = employee).

JDBC reads and writes need a database, which only one process here could see,
so they are no queries; tests run them (``tests/test_jdbc_queries.py``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.connection import first_present, jdbc_database, jdbc_host, redact_map, round2
from sluice.operators import analytics as A
from sluice.operators import bitmaps as B
from sluice.operators import quality as Q
from sluice.operators.fingerprint import compare_tables
from sluice.operators.joins import dealt_distinct
from sluice.operators.keys import assign_keys
from sluice.operators.lattice import field_types, merged_types, resolve
from sluice.operators.profile import least_types, profile_columns
from sluice.operators.ranges import key_ranges, row_ranges
from sluice.session import shared_path
from sluice.sinks import graph as G
from sluice.sinks import merge as M
from sluice.sinks import resumable as R
from sluice.sinks import tables as TB
from sluice.sinks import versions as V
from sluice.sinks.parquet import export_parquet
from sluice.sources.catalog import read_parquet_table
from sluice.streaming import statistics as S
from sluice.streaming.incremental import bookmark_files, load_increment, read_loaded

QueryFn = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables (``<sf_dir>/<name>.parquet``)."""
    return read_parquet_table(spark, sf_dir, name)


def _ns(spark: SparkSession) -> str:
    ns = "sluice_q"
    TB.create_namespace(spark, ns, shared_path(spark, "namespaces", ns, unique=False))
    return ns


def _uniq(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:8]}"


# ---------------------------------------------------------------- analytics

#: Assignments in a task of the three-way join, whatever the size of the input.
JOIN3_ROWS = 500_000


def join3_count_distinct(spark: SparkSession, d: str) -> DataFrame:
    return A.project_participation(
        table(spark, d, "orders"),
        table(spark, d, "customer"),
        table(spark, d, "lineitem"),
        project_id="o_orderkey",
        project_name="o_orderkey",
        project_budget="o_totalprice",
        project_department="o_custkey",
        department_id="c_custkey",
        department_name="c_name",
        assignment_project="l_orderkey",
        assignment_member="l_suppkey",
        rows_per_task=JOIN3_ROWS,
    )


def _view(df: DataFrame, name: str) -> str:
    view = _uniq(name)
    df.createOrReplaceTempView(view)
    return view


def join3_count_distinct_sql(spark: SparkSession, d: str) -> DataFrame:
    tables = [table(spark, d, n) for n in ("orders", "customer", "lineitem")]
    tables[2] = dealt_distinct(tables[2], "l_orderkey", ["l_suppkey"], JOIN3_ROWS)
    views = [_view(df, n) for df, n in zip(tables, ("orders", "customer", "lineitem"))]
    return A.participation_sql(
        spark,
        views,
        project=("o_orderkey", "o_orderkey", "o_totalprice", "o_custkey"),
        department=("c_custkey", "c_name"),
        assignment=("l_orderkey", "l_suppkey"),
    )


def group_count_avg_sql(spark: SparkSession, d: str) -> DataFrame:
    view = _view(table(spark, d, "customer"), "employees")
    # The sum of doubles depends on the order of addition: compared to 6 places.
    return A.grouped_stats_sql(spark, view, "c_mktsegment", "c_acctbal").select(
        F.col("c_mktsegment").alias("department"), "employee_count", F.round("avg_salary", 6).alias("avg_salary")
    )


def group_count_avg(spark: SparkSession, d: str) -> DataFrame:
    employees = table(spark, d, "customer").select(
        F.col("c_mktsegment").alias("department"), F.col("c_acctbal").alias("salary")
    )
    return A.group_count_avg(employees, "department", "salary", scale=2)  # money: exact mean


def group_mean_min_max(spark: SparkSession, d: str) -> DataFrame:
    return A.group_mean_min_max(
        table(spark, d, "customer"), "c_mktsegment", "c_acctbal", key_name="department", scale=2
    )


def row_count(spark: SparkSession, d: str) -> DataFrame:
    return A.row_count(table(spark, d, "lineitem"))


def filter_not_in_limit(spark: SparkSession, d: str) -> DataFrame:
    return A.filter_not_in_top(
        table(spark, d, "customer"),
        equals={"c_mktsegment": "BUILDING"},
        not_in={"c_nationkey": [0, 1, 2, 3, 4]},
        order_by=[F.col("c_acctbal").desc(), F.col("c_custkey")],
        limit=10,
    )


def preview_rows(spark: SparkSession, d: str) -> DataFrame:
    return A.preview(table(spark, d, "orders"), 5, ["o_orderkey"])


# -------------------------------------------------------- read planning, tables


def key_bounds(spark: SparkSession, d: str) -> DataFrame:
    return A.min_max(table(spark, d, "orders"), "o_orderkey")


def key_range_plan(spark: SparkSession, d: str) -> DataFrame:
    """How often the rows of orders fall into the ranges planned over a key
    with NULLs and a hot value: each must fall into exactly one."""
    keyed = table(spark, d, "orders").withColumn(
        "k", F.expr("CASE WHEN o_custkey % 7 = 0 THEN NULL WHEN o_custkey % 3 = 0 THEN 3 ELSE o_custkey END")
    )
    ranges = key_ranges(keyed, "k", 8, spread="o_orderkey")
    hits = sum((F.expr(f"coalesce({r}, false)").cast("int") for r in ranges[1:]), F.expr(f"coalesce({ranges[0]}, false)").cast("int"))
    return (
        keyed.select(hits.alias("n_ranges"), F.col("k").isNull().alias("no_key"))
        .groupBy("n_ranges", "no_key").agg(F.count(F.lit(1)).alias("n_rows"))
    )


def row_range_plan(spark: SparkSession, d: str) -> DataFrame:
    """How often the rows of lineitem fall into twelve ranges over two columns,
    the first of few values, some NULL; and whether the ranges are of a size."""
    lines = table(spark, d, "lineitem").withColumn("line", F.expr("CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_linenumber END"))
    ranges = row_ranges(lines, ["line", "l_orderkey"], 12)
    which = F.array_compact(F.array(*[F.when(F.expr(r), F.lit(i)) for i, r in enumerate(ranges)]))
    sizes = lines.groupBy(which.alias("in_ranges")).agg(F.count(F.lit(1)).alias("n"))  # one row per range
    last = F.element_at("in_ranges", 1) == len(ranges) - 1
    even = F.max(F.when(~last, F.col("n"))) <= 1.5 * F.sum(F.when(~last, F.col("n"))) / 12
    return sizes.groupBy(F.size("in_ranges").alias("n_ranges")).agg(F.sum("n").alias("n_rows"), even.alias("even"))


def derived_table(spark: SparkSession, d: str) -> DataFrame:
    view = _view(table(spark, d, "orders"), "orders")
    return spark.sql(
        f"SELECT s.o_orderstatus, s.n_orders, s.max_totalprice FROM (SELECT o_orderstatus, count(*) AS n_orders, "
        f"max(o_totalprice) AS max_totalprice FROM {view} GROUP BY o_orderstatus) s WHERE s.n_orders > 0"
    )


def _created(spark: SparkSession, src: DataFrame, name: str, defaults: dict[str, str] | None = None, extra: tuple = ()) -> str:
    base = TB.spec_from_frame(_uniq(name), src)
    spec = TB.TableSpec(base.name, (*base.columns, *extra), defaults=defaults or {})
    ns = _ns(spark)
    TB.create_table(spark, spec, ns)
    return TB.create_table(spark, spec, ns)  # it is there: a no-op


def create_if_not_exists(spark: SparkSession, d: str) -> DataFrame:
    src = table(spark, d, "customer")
    t = _created(spark, src, "customer")
    TB.insert_by_name(spark, t, src.select(*reversed(src.columns)))
    return spark.table(t)


def append_twice(spark: SparkSession, d: str) -> DataFrame:
    src = table(spark, d, "customer")
    t = _created(spark, src, "customer")
    for _ in range(2):
        TB.insert_by_name(spark, t, src)
    return spark.table(t)


def default_column(spark: SparkSession, d: str) -> DataFrame:
    src = table(spark, d, "orders")
    t = _created(spark, src, "orders", {"created_at": "current_timestamp()"}, (("created_at", "timestamp"),))
    TB.insert_by_name(spark, t, src)
    return spark.table(t).withColumn("created_at", F.col("created_at").isNotNull()).withColumnRenamed("created_at", "has_created_at")


def truncate_count(spark: SparkSession, d: str) -> DataFrame:
    spec, ns = _load(spark, d, "customer", ("c_mktsegment",))
    before = A.row_count(TB.read_table(spark, spec, ns), "rows_before").checkpoint()  # the table is emptied below
    TB.truncate(spark, spec, namespace=ns, base=shared_path(spark, "tables", unique=False))
    after = TB.read_table(spark, spec, ns)
    return before.crossJoin(A.row_count(after, "rows_after")).withColumn("is_empty", F.lit(Q.is_empty(after)))


# ------------------------------------------------------------ files, tables


def export_parquet_q(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "export", "lineitem")
    res = export_parquet(table(spark, d, "lineitem"), path)
    return spark.read.parquet(res.path)


def _load(spark: SparkSession, d: str, name: str, parts: tuple[str, ...]) -> tuple[TB.TableSpec, str]:
    ns = _ns(spark)
    src = table(spark, d, name)
    spec = TB.spec_from_frame(_uniq(name), src, parts)
    TB.create_or_replace(spark, spec, src, namespace=ns, base=shared_path(spark, "tables", unique=False))
    return spec, ns


def table_load_partitioned(spark: SparkSession, d: str) -> DataFrame:
    spec, ns = _load(spark, d, "customer", ("c_mktsegment",))
    return TB.read_table(spark, spec, ns)


def table_load_two_keys(spark: SparkSession, d: str) -> DataFrame:
    spec, ns = _load(spark, d, "orders", ("o_orderstatus", "o_orderpriority"))
    return TB.read_table(spark, spec, ns)


def table_load_plain(spark: SparkSession, d: str) -> DataFrame:
    spec, ns = _load(spark, d, "part", ())
    return TB.read_table(spark, spec, ns)


def table_partition_prune(spark: SparkSession, d: str) -> DataFrame:
    spec, ns = _load(spark, d, "customer", ("c_mktsegment",))
    return TB.read_table(spark, spec, ns).filter(F.col("c_mktsegment") == "BUILDING")


def table_replace(spark: SparkSession, d: str) -> DataFrame:
    spec, ns = _load(spark, d, "customer", ("c_mktsegment",))
    current = TB.read_table(spark, spec, ns)  # the replace reads its own table
    TB.create_or_replace(
        spark, spec, current.filter(F.col("c_acctbal") >= 0), namespace=ns,
        base=shared_path(spark, "tables", unique=False),
    )
    return TB.read_table(spark, spec, ns)


def load_tables_multi(spark: SparkSession, d: str) -> DataFrame:
    ns_src = _ns(spark)
    names = ("customer", "orders", "supplier", "nation")
    parts = {"customer": ("c_mktsegment",), "orders": ("o_orderstatus",), "supplier": (), "nation": ("n_regionkey",)}
    specs = []
    for n in names:
        src = table(spark, d, n)
        view = _uniq(f"src_{n}")
        src.createOrReplaceTempView(view)
        base_spec = TB.spec_from_frame(_uniq(n), src, parts[n])
        specs.append(TB.TableSpec(base_spec.name, base_spec.columns, base_spec.partition_by, source=view))
    results = TB.load_tables(
        spark, specs, source_namespace=None, target_namespace=ns_src,
        base=shared_path(spark, "tables", unique=False), parallelism=4,
    )
    out = None
    for n, r in zip(names, results):
        counted = spark.table(r.table).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(n).alias("table_name"), "row_count"
        )
        out = counted if out is None else out.unionByName(counted)
    return out


def load_increment_q(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    split = orders.agg(((F.min("o_orderkey") + F.max("o_orderkey")) / 2).cast("bigint").alias("s")).first()["s"]
    target = shared_path(spark, "increment", "orders")
    state = shared_path(spark, "increment", "state")
    first = orders.filter(F.col("o_orderkey") <= split)  # the source as of run 1
    load_increment(first, target, "o_orderkey", state, source="driver", table="orders")
    load_increment(orders, target, "o_orderkey", state, source="driver", table="orders")
    load_increment(orders, target, "o_orderkey", state, source="driver", table="orders")  # no-op
    return read_loaded(spark, target)


def stream_increment(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    landing = shared_path(spark, "landing", "orders")
    target = shared_path(spark, "bookmark", "orders")
    ckpt = shared_path(spark, "bookmark", "ckpt")
    split = orders.agg(((F.min("o_orderkey") + F.max("o_orderkey")) / 2).cast("bigint").alias("s")).first()["s"]
    orders.filter(F.col("o_orderkey") <= split).write.mode("append").parquet(landing)
    bookmark_files(spark, landing, orders.schema, target, ckpt)
    orders.filter(~(F.col("o_orderkey") <= split) | F.col("o_orderkey").isNull()).write.mode(
        "append"
    ).parquet(landing)
    bookmark_files(spark, landing, orders.schema, target, ckpt)
    bookmark_files(spark, landing, orders.schema, target, ckpt)  # nothing new: no-op
    return spark.read.parquet(target)


def _mixed(spark: SparkSession, d: str) -> DataFrame:
    """events whose field k is a number, a text, null, missing, nested or no JSON."""
    made = """CASE event_id % 10 WHEN 0 THEN concat('{"k": "', event_id, '"}') WHEN 1 THEN concat('{"k": ', event_id, '.5}')
        WHEN 2 THEN '{"k": null}' WHEN 3 THEN '{}' WHEN 4 THEN concat('{"k": {"v": ', event_id, ', "u": "x"}}')
        WHEN 5 THEN concat('{"k": [', event_id, ', "x", true]}') WHEN 6 THEN '{"k": "many"}' WHEN 7 THEN '{broken' ELSE props END"""
    return table(spark, d, "events").select("event_id", F.expr(made).alias("mixed"))


def mixed_types(spark: SparkSession, d: str) -> DataFrame:
    """The types at every path of mixed records, and what they merge to."""
    types = field_types(_mixed(spark, d), "mixed")
    return types.join(merged_types(types).select("path", "merged", "conflict", "n_other"), "path")


def mixed_types_resolved(spark: SparkSession, d: str) -> DataFrame:
    """Mixed records with k cast, split by type and kept."""
    cast = resolve(_mixed(spark, d), "mixed", {"$.k": "cast:bigint"})
    split = resolve(cast.withColumnsRenamed({"k": "k_cast"}), "mixed", {"$.k": "split:BIGINT,DECIMAL,STRING", "$.k.u": "keep"})
    return split.drop("mixed")


def maintained_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Statistics of orders per priority after three batches, one given twice."""
    orders = table(spark, d, "orders")
    kept = S.Statistics(shared_path(spark, "statistics", "orders"), ("o_orderpriority",), "o_totalprice", 2, "o_custkey")
    for part in (0, 1, 1, 2):
        S.update(kept, orders.where(f"o_orderkey % 3 = {part}"), f"batch {part}")
    return S.read_statistics(spark, kept).withColumn("total", F.col("total").cast("double"))


def profile_types(spark: SparkSession, d: str) -> DataFrame:
    """The least column types that hold customer and part."""
    whole = None
    for name in ("customer", "part"):
        types = least_types(profile_columns(table(spark, d, name))).withColumn("table_name", F.lit(name))
        whole = types if whole is None else whole.unionByName(types)
    return whole.select("table_name", "column_name", "sql_type", "nullable")


class _Killed(Exception):
    pass


def resumable_extract(spark: SparkSession, d: str) -> DataFrame:
    """orders by eight ranges: a first run is killed after three, a second one
    reads the other five. Every row once, with what each run read."""
    orders, path = table(spark, d, "orders"), shared_path(spark, "extract", "orders")
    read = []

    def kill(done: int) -> None:
        read.append(done)
        if done == 3:
            raise _Killed

    try:
        R.extract_frame_resumable(orders, path, "o_orderkey", 8, source="orders", on_commit=kill)
    except _Killed:
        pass
    second = R.extract_frame_resumable(orders, path, "o_orderkey", 8, source="orders")
    return R.read_extract(spark, path).withColumns(
        {"n_ranges": F.lit(second.ranges), "read_first": F.lit(read[-1]), "read_second": F.lit(second.ranges_read)}
    )


def keyed_merge(spark: SparkSession, d: str) -> DataFrame:
    """orders as a keyed table after batches of updates, deletes, ties, late
    versions and a replay."""
    orders = table(spark, d, "orders")

    def rows(where: str, seq: int, gone: bool = False, **values: str) -> DataFrame:
        changed = {c: F.expr(values.get(c, c)).cast(orders.schema[c].dataType) for c in orders.columns}
        found = orders.where(where).select(*[x.alias(c) for c, x in changed.items()])
        return found.withColumns({"seq": F.lit(seq), "gone": F.lit(gone)})

    def together(first: DataFrame, *more: DataFrame) -> DataFrame:
        for other in more:
            first = first.unionByName(other)
        return first

    start = rows("true", 1)
    schema = start.drop("gone").schema
    merged = M.create(spark, shared_path(spark, "merged", "orders"), schema, ["o_orderkey"], "seq", buckets=16)
    first = together(
        rows("o_orderkey % 5 = 0", 2, o_totalprice="o_totalprice + 1"),
        rows("o_orderkey % 7 = 0", 2, gone=True),  # a tie where both apply: the delete wins
        rows("o_orderkey % 11 = 0", 2, o_orderkey="-1 - o_orderkey", o_totalprice="0"),
    )
    second = together(
        rows("o_orderkey % 7 = 0", 1),  # late: older than the delete
        rows("o_orderkey % 35 = 0", 3, o_totalprice="5"),
        rows("o_orderkey % 13 = 0 AND o_orderkey % 35 <> 0", 3, o_totalprice="10"),
        rows("o_orderkey % 13 = 0 AND o_orderkey % 35 <> 0", 3, o_totalprice="20"),  # a tie: the greater row
    )
    for batch in (start, first, second, first):  # the last one is a replay
        M.merge(spark, merged, batch, F.col("gone"))
    return M.read_merged(spark, merged)


def publish_versions(spark: SparkSession, d: str) -> DataFrame:
    """customer published behind a view, partitioned; replaced by a filter of
    itself, replaced again and rolled back."""
    ns, base = _ns(spark), shared_path(spark, "versions", unique=False)
    src = table(spark, d, "customer")
    spec = TB.spec_from_frame(_uniq("customer"), src, ("c_mktsegment",))
    V.publish(spark, spec, src, namespace=ns, base=base)
    view = f"{ns}.{spec.name}"
    V.publish(spark, spec, spark.table(view).where("c_acctbal >= 0"), namespace=ns, base=base)
    V.publish(spark, spec, src.limit(0), namespace=ns, base=base)
    V.rollback(spark, ns, spec.name)
    return spark.table(view)


def load_graph(spark: SparkSession, d: str) -> DataFrame:
    """Four tables loaded together, then again with orders that lineitem needs
    left out: rejected, all four stay. Rows of each before and after, and the
    rows that broke a rule of it."""
    ns, base = _ns(spark), shared_path(spark, "graph", unique=False)
    sources = {n: table(spark, d, n) for n in ("nation", "customer", "orders", "lineitem")}
    parts = {"customer": ("c_mktsegment",), "orders": ("o_orderstatus",)}
    named = {n: _uniq(n) for n in sources}
    specs = [TB.spec_from_frame(named[n], df, parts.get(n, ())) for n, df in sources.items()]
    keys = [G.Key(named["orders"], ("o_orderkey",)), G.Key(named["customer"], ("c_custkey",))]
    references = [
        G.Reference(named["lineitem"], ("l_orderkey",), named["orders"], ("o_orderkey",)),
        G.Reference(named["orders"], ("o_custkey",), named["customer"], ("c_custkey",)),
        G.Reference(named["customer"], ("c_nationkey",), named["nation"], ("n_nationkey",)),
    ]

    def load(frames: dict[str, DataFrame]) -> None:
        G.load_graph(
            spark, specs, {named[n]: df for n, df in frames.items()}, namespace=ns, base=base, keys=keys, references=references
        )

    def counts(column: str) -> DataFrame:
        shown = [A.row_count(spark.table(f"{ns}.{t}"), column).withColumn("table_name", F.lit(n)) for n, t in named.items()]
        whole = shown[0]
        for other in shown[1:]:
            whole = whole.unionByName(other)
        return whole

    load(sources)
    before = counts("rows_before").checkpoint()
    broken: dict[str, int] = {}
    try:
        load(sources | {"orders": sources["orders"].where("o_orderkey % 11 <> 0"), "customer": sources["customer"].where("c_custkey >= 0")})
    except G.GraphRejected as error:
        broken = {v.rule.split("(")[0]: v.rows for v in error.violations}
    rejected = F.create_map(*[F.lit(x) for n, t in named.items() for x in (n, broken.get(t, 0))])
    return before.join(counts("rows_after"), "table_name").withColumn("rows_rejected", rejected[F.col("table_name")].cast("long"))


# ----------------------------------------------------------------- checks


def fingerprint_diff(spark: SparkSession, d: str) -> DataFrame:
    """orders against a copy with rows left out, changed, repeated and added:
    only the keys that differ."""
    left = table(spark, d, "orders")
    right = left.where("o_orderkey % 101 <> 3").withColumns(
        {
            "o_totalprice": F.expr("CASE WHEN o_orderkey % 97 = 5 THEN o_totalprice + 1 ELSE o_totalprice END"),
            "o_custkey": F.expr("CASE WHEN o_orderkey % 89 = 7 THEN NULL ELSE o_custkey END"),
        }
    )
    right = right.unionByName(right.where("o_orderkey % 83 = 11")).unionByName(
        left.where("o_orderkey % 79 = 13").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    )
    return compare_tables(left, right, ["o_orderkey"], join_rows=10_000)


def bitmap_unique(spark: SparkSession, d: str) -> DataFrame:
    """lineitem's key, with some lines repeated: the keys that occur again."""
    lines = table(spark, d, "lineitem")
    twice = lines.unionByName(lines.where("l_orderkey % 53 = 1 AND l_linenumber = 1"))
    return B.unique_violations(twice, ["l_orderkey", "l_linenumber"])


def bitmap_foreign_key(spark: SparkSession, d: str) -> DataFrame:
    """lineitem against orders of which some are gone, keys shifted below zero."""
    child = table(spark, d, "lineitem").select((F.col("l_orderkey") - 500).alias("l_orderkey"))
    parent = table(spark, d, "orders").where("o_orderkey % 29 <> 4").select((F.col("o_orderkey") - 500).alias("o_orderkey"))
    return B.foreign_key_violations(child, parent, ["l_orderkey"], ["o_orderkey"])


def bitmap_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Distinct customers per order priority and status."""
    return B.distinct_counts(table(spark, d, "orders"), ["o_orderpriority", "o_orderstatus"], "o_custkey", "n_customers")


def check_not_null(spark: SparkSession, d: str) -> DataFrame:
    return Q.check_not_null(table(spark, d, "orders"))


def check_unique(spark: SparkSession, d: str) -> DataFrame:
    return Q.check_unique(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def check_foreign_key(spark: SparkSession, d: str) -> DataFrame:
    return Q.check_foreign_key(table(spark, d, "documents"), table(spark, d, "labels"), ["doc_id"])


def check_foreign_key_lineitem(spark: SparkSession, d: str) -> DataFrame:
    return Q.check_foreign_key(
        table(spark, d, "lineitem"), table(spark, d, "orders"), ["l_orderkey"], ["o_orderkey"]
    )


def reconcile(spark: SparkSession, d: str) -> DataFrame:
    return Q.reconcile(
        table(spark, d, "customer"),
        table(spark, d, "supplier"),
        "c_custkey",
        "s_suppkey",
        [("nationkey", "c_nationkey", "s_nationkey"), ("name", "c_name", "s_name"), ("acctbal", "c_acctbal", "s_acctbal")],
    )


def assign_keys_q(spark: SparkSession, d: str) -> DataFrame:
    return assign_keys(table(spark, d, "customer"), ["c_name", "c_custkey"], key_name="id")


# ---------------------------------------------------------------- functions


def url_host(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select(
        "page_id", jdbc_host("url").alias("host"), jdbc_database("url").alias("database")
    )


def redact(spark: SparkSession, d: str) -> DataFrame:
    # Parse the JSON once; the map column is then read by three expressions
    # (Catalyst keeps a non-cheap projection that is referenced twice).
    ev = table(spark, d, "events").select(
        "event_id", "value", F.from_json("props", "map<string,string>").alias("props_map")
    )
    return ev.select(
        "event_id",
        F.to_json(redact_map("props_map")).alias("props_redacted"),
        first_present("props_map", "key", "k").alias("k_value"),
        round2("value").alias("value_2dp"),
    )


QUERIES: dict[str, QueryFn] = {
    "join3_count_distinct": join3_count_distinct,
    "join3_count_distinct_sql": join3_count_distinct_sql,
    "group_count_avg": group_count_avg,
    "group_count_avg_sql": group_count_avg_sql,
    "group_mean_min_max": group_mean_min_max,
    "row_count": row_count,
    "filter_not_in_limit": filter_not_in_limit,
    "preview_rows": preview_rows,
    "key_bounds": key_bounds,
    "key_range_plan": key_range_plan,
    "row_range_plan": row_range_plan,
    "derived_table": derived_table,
    "create_if_not_exists": create_if_not_exists,
    "append_twice": append_twice,
    "default_column": default_column,
    "truncate_count": truncate_count,
    "export_parquet": export_parquet_q,
    "table_load_partitioned": table_load_partitioned,
    "table_load_two_keys": table_load_two_keys,
    "table_load_plain": table_load_plain,
    "table_partition_prune": table_partition_prune,
    "table_replace": table_replace,
    "load_tables_multi": load_tables_multi,
    "load_increment": load_increment_q,
    "stream_increment": stream_increment,
    "mixed_types": mixed_types,
    "mixed_types_resolved": mixed_types_resolved,
    "maintained_statistics": maintained_statistics,
    "profile_types": profile_types,
    "resumable_extract": resumable_extract,
    "keyed_merge": keyed_merge,
    "publish_versions": publish_versions,
    "load_graph": load_graph,
    "fingerprint_diff": fingerprint_diff,
    "bitmap_unique": bitmap_unique,
    "bitmap_foreign_key": bitmap_foreign_key,
    "bitmap_distinct": bitmap_distinct,
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_foreign_key": check_foreign_key,
    "check_foreign_key_lineitem": check_foreign_key_lineitem,
    "reconcile": reconcile,
    "assign_keys": assign_keys_q,
    "url_host": url_host,
    "redact": redact,
}


_ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _not_null_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count FROM orders" for c in _ORDERS_COLS
    )


_JOIN3_SQL = """
        SELECT o.o_orderkey AS project_name, o.o_totalprice AS project_budget,
               c.c_name AS department_name, COUNT(DISTINCT l.l_suppkey) AS employee_count
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                      JOIN lineitem l ON o.o_orderkey = l.l_orderkey
        GROUP BY o.o_orderkey, o.o_totalprice, c.c_name
        ORDER BY project_budget DESC, project_name, department_name"""

def _profile_sql() -> str:
    """Types by the rule, column by column."""
    whole = "CASE WHEN min({c}) >= -32768 AND max({c}) < 32768 THEN 'SMALLINT' WHEN min({c}) >= -2147483648 AND max({c}) < 2147483648 THEN 'INT' ELSE 'BIGINT' END"
    text = "CASE " + " ".join(f"WHEN max(length({{c}})) <= {n} THEN 'VARCHAR({n})'" for n in (16, 32, 64, 128, 255, 1000, 4000)) + " END"
    scale = "max(CASE " + " ".join(f"WHEN {{c}} = round({{c}}, {n}) THEN {n}" for n in range(7)) + " ELSE 7 END)"
    digits = "length(CAST(CAST(floor(max(abs({c}))) AS BIGINT) AS VARCHAR))"
    money = f"CASE WHEN {scale} <= 6 AND {digits} + {scale} <= 15 THEN 'DECIMAL(' || ({digits} + {scale}) || ',' || {scale} || ')' ELSE 'DOUBLE' END"
    columns = {
        "customer": {"c_custkey": whole, "c_name": text, "c_nationkey": whole, "c_acctbal": money, "c_mktsegment": text},
        "part": {"p_partkey": whole, "p_name": text, "p_brand": text, "p_type": text, "p_size": whole, "p_retailprice": money},
    }
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, {rule.format(c=c)} AS sql_type, count(*) > count({c}) AS nullable FROM {t}"
        for t, cs in columns.items() for c, rule in cs.items()
    )


_MIXED_K = """
        WITH k AS (SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'STRING' WHEN 1 THEN 'DECIMAL' WHEN 2 THEN 'VOID' WHEN 3 THEN NULL
            WHEN 4 THEN 'OBJECT' WHEN 5 THEN 'ARRAY' WHEN 6 THEN 'STRING' WHEN 7 THEN NULL ELSE 'BIGINT' END AS t FROM events)"""

_GROUP_SQL = """
        SELECT c_mktsegment AS department, COUNT(*) AS employee_count,
               CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / COUNT(c_acctbal) AS avg_salary
        FROM customer GROUP BY c_mktsegment ORDER BY employee_count DESC, department"""

ORACLE_SQL: dict[str, str] = {
    "join3_count_distinct": _JOIN3_SQL,
    "join3_count_distinct_sql": _JOIN3_SQL,
    "group_count_avg": _GROUP_SQL,
    "group_count_avg_sql": """
        SELECT c_mktsegment AS department, COUNT(*) AS employee_count, round(AVG(c_acctbal), 6) AS avg_salary
        FROM customer GROUP BY c_mktsegment""",
    "group_mean_min_max": """
        SELECT c_mktsegment AS department,
               CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / COUNT(c_acctbal) AS mean_value,
               MIN(c_acctbal) AS min_value, MAX(c_acctbal) AS max_value
        FROM customer GROUP BY c_mktsegment ORDER BY department""",
    "row_count": "SELECT COUNT(*) AS row_count FROM lineitem",
    "filter_not_in_limit": """
        SELECT * FROM customer
        WHERE c_mktsegment = 'BUILDING' AND c_nationkey NOT IN (0, 1, 2, 3, 4)
        ORDER BY c_acctbal DESC, c_custkey LIMIT 10""",
    "preview_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "key_bounds": "SELECT MIN(o_orderkey) AS min_val, MAX(o_orderkey) AS max_val FROM orders",
    "key_range_plan": """
        SELECT 1 AS n_ranges, o_custkey % 7 = 0 AS no_key, COUNT(*) AS n_rows FROM orders GROUP BY no_key""",
    "derived_table": """
        SELECT o_orderstatus, COUNT(*) AS n_orders, MAX(o_totalprice) AS max_totalprice FROM orders GROUP BY o_orderstatus""",
    "create_if_not_exists": "SELECT * FROM customer",
    "append_twice": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "default_column": "SELECT *, true AS has_created_at FROM orders",
    "truncate_count": "SELECT COUNT(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after, true AS is_empty FROM customer",
    "export_parquet": "SELECT * FROM lineitem",
    "table_load_partitioned": "SELECT * FROM customer",
    "table_load_two_keys": "SELECT * FROM orders",
    "table_load_plain": "SELECT * FROM part",
    "table_partition_prune": "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'",
    "table_replace": "SELECT * FROM customer WHERE c_acctbal >= 0",
    "load_tables_multi": """
        SELECT 'customer' AS table_name, COUNT(*) AS row_count FROM customer
        UNION ALL SELECT 'orders', COUNT(*) FROM orders
        UNION ALL SELECT 'supplier', COUNT(*) FROM supplier
        UNION ALL SELECT 'nation', COUNT(*) FROM nation""",
    "load_increment": "SELECT * FROM orders",
    "stream_increment": "SELECT * FROM orders",
    "row_range_plan": "SELECT 1 AS n_ranges, COUNT(*) AS n_rows, true AS even FROM lineitem",
    "mixed_types": _MIXED_K + """, found AS (
          SELECT '$' AS path, CASE WHEN event_id % 10 = 7 THEN 'INVALID' ELSE 'OBJECT' END AS type FROM k
          UNION ALL SELECT '$.k', t FROM k WHERE t IS NOT NULL
          UNION ALL SELECT unnest(['$.k.v', '$.k.u']), unnest(['BIGINT', 'STRING']) FROM k WHERE t = 'OBJECT'
          UNION ALL SELECT '$.k[]', unnest(['BIGINT', 'STRING', 'BOOLEAN']) FROM k WHERE t = 'ARRAY'
        ), types AS (SELECT path, type, COUNT(*) AS n_rows FROM found GROUP BY ALL
        ), merged AS (
          SELECT path, count(*) FILTER (type <> 'VOID') AS n,
            coalesce(sum(n_rows) FILTER (type <> 'VOID'), 0) - coalesce(max(n_rows) FILTER (type <> 'VOID'), 0) AS n_other,
            min(type) FILTER (type <> 'VOID') AS one FROM types GROUP BY path
        )
        SELECT path, type, n_rows, CASE WHEN n = 0 THEN 'VOID' WHEN n = 1 THEN one ELSE 'STRING' END AS merged, n > 1 AS conflict,
          CAST(n_other AS BIGINT) AS n_other
        FROM types JOIN merged USING (path)""",
    "mixed_types_resolved": """
        SELECT event_id,
          CASE WHEN event_id % 10 IN (0, 1) THEN event_id WHEN event_id % 10 IN (8, 9) THEN CAST(props->>'k' AS BIGINT) END AS k_cast,
          event_id % 10 IN (4, 5, 6) AS k_failed,
          CASE WHEN event_id % 10 IN (8, 9) THEN CAST(props->>'k' AS BIGINT) END AS k_bigint,
          CASE WHEN event_id % 10 = 1 THEN event_id + 0.5::DOUBLE END AS k_decimal,
          CASE event_id % 10 WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 6 THEN 'many' END AS k_string,
          CASE WHEN event_id % 10 = 4 THEN '"x"' END AS u
        FROM events""",
    "maintained_statistics": """
        SELECT o_orderpriority, COUNT(*) AS n_rows, COUNT(o_totalprice) AS n_values,
          CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
          CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice) AS mean,
          MIN(o_totalprice) AS least, MAX(o_totalprice) AS largest, COUNT(DISTINCT o_custkey) AS n_distinct
        FROM orders GROUP BY o_orderpriority""",
    "profile_types": _profile_sql(),
    "resumable_extract": "SELECT *, 8 AS n_ranges, 3 AS read_first, 5 AS read_second FROM orders",
    "keyed_merge": """
        SELECT * REPLACE (CASE WHEN o_orderkey % 35 = 0 THEN 5.0 WHEN o_orderkey % 13 = 0 THEN 20.0
                               WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice),
               CASE WHEN o_orderkey % 35 = 0 OR o_orderkey % 13 = 0 THEN 3 WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END AS seq
        FROM orders WHERE o_orderkey % 7 <> 0 OR o_orderkey % 35 = 0 OR o_orderkey % 13 = 0
        UNION ALL
        SELECT * REPLACE (-1 - o_orderkey AS o_orderkey, 0.0 AS o_totalprice), 2 FROM orders WHERE o_orderkey % 11 = 0""",
    "publish_versions": "SELECT * FROM customer WHERE c_acctbal >= 0",
    "load_graph": """
        WITH t AS (SELECT 'nation' AS table_name, COUNT(*) AS n FROM nation UNION ALL SELECT 'customer', COUNT(*) FROM customer
          UNION ALL SELECT 'orders', COUNT(*) FROM orders UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem)
        SELECT table_name, n AS rows_before, n AS rows_after,
          CASE WHEN table_name = 'lineitem' THEN (SELECT COUNT(*) FROM lineitem WHERE l_orderkey % 11 = 0) ELSE 0 END AS rows_rejected
        FROM t""",
    "fingerprint_diff": """
        WITH kept AS (
          SELECT * REPLACE (CASE WHEN o_orderkey % 97 = 5 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
                            CASE WHEN o_orderkey % 89 = 7 THEN NULL ELSE o_custkey END AS o_custkey)
          FROM orders WHERE o_orderkey % 101 <> 3
        ), r AS (
          SELECT *, CASE WHEN o_orderkey % 83 = 11 THEN 2 ELSE 1 END AS n FROM kept
          UNION ALL SELECT * REPLACE (-1 - o_orderkey AS o_orderkey), 1 FROM orders WHERE o_orderkey % 79 = 13
        ), j AS (
          SELECT COALESCE(l.o_orderkey, r.o_orderkey) AS o_orderkey, l.o_orderkey IS NULL AS no_left, r.o_orderkey IS NULL AS no_right,
            COALESCE(r.n, 0) AS n, concat_ws(',',
              CASE WHEN l.o_custkey IS DISTINCT FROM r.o_custkey THEN 'o_custkey' END,
              CASE WHEN l.o_totalprice IS DISTINCT FROM r.o_totalprice THEN 'o_totalprice' END) AS diff
          FROM orders l FULL OUTER JOIN r ON l.o_orderkey = r.o_orderkey
        ), s AS (
          SELECT *, CASE WHEN no_left THEN 'missing_left' WHEN no_right THEN 'missing_right' WHEN n > 1 THEN 'duplicate'
                         WHEN diff <> '' THEN 'changed' END AS status FROM j
        )
        SELECT o_orderkey, status, CASE WHEN status = 'changed' THEN diff ELSE '' END AS changed,
          CASE WHEN no_left THEN 0 ELSE 1 END AS n_left, n AS n_right FROM s WHERE status IS NOT NULL""",
    "bitmap_unique": """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows
        FROM (SELECT l_orderkey, l_linenumber FROM lineitem
              UNION ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 53 = 1 AND l_linenumber = 1)
        WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
        GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "bitmap_foreign_key": """
        SELECT l_orderkey - 500 AS l_orderkey, COUNT(*) AS n_rows FROM lineitem
        WHERE l_orderkey IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderkey % 29 <> 4)
        GROUP BY l_orderkey""",
    "bitmap_distinct": """
        SELECT o_orderpriority, o_orderstatus, COUNT(DISTINCT o_custkey) AS n_customers FROM orders
        GROUP BY o_orderpriority, o_orderstatus""",
    "check_not_null": _not_null_sql(),
    "check_unique": """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem
        WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
        GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "check_foreign_key": """
        SELECT d.doc_id, COUNT(*) AS n_rows FROM documents d
        WHERE d.doc_id IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
        GROUP BY d.doc_id""",
    "check_foreign_key_lineitem": """
        SELECT li.l_orderkey, COUNT(*) AS n_rows FROM lineitem li
        WHERE li.l_orderkey IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = li.l_orderkey)
        GROUP BY li.l_orderkey""",
    "reconcile": """
        WITH l AS (SELECT c_custkey AS k, COUNT(*) AS n, MIN(c_nationkey) AS nk, MIN(c_name) AS nm,
                          MIN(c_acctbal) AS ab FROM customer GROUP BY c_custkey),
             r AS (SELECT s_suppkey AS k, COUNT(*) AS n, MIN(s_nationkey) AS nk, MIN(s_name) AS nm,
                          MIN(s_acctbal) AS ab FROM supplier GROUP BY s_suppkey)
        SELECT COALESCE(l.k, r.k) AS key,
          CASE WHEN l.n IS NULL THEN 'missing_left' WHEN r.n IS NULL THEN 'missing_right'
               WHEN l.n > 1 OR r.n > 1 THEN 'duplicate'
               WHEN l.nk IS NOT DISTINCT FROM r.nk THEN 'match' ELSE 'mismatch' END AS nationkey_status,
          CASE WHEN l.n IS NULL THEN 'missing_left' WHEN r.n IS NULL THEN 'missing_right'
               WHEN l.n > 1 OR r.n > 1 THEN 'duplicate'
               WHEN l.nm IS NOT DISTINCT FROM r.nm THEN 'match' ELSE 'mismatch' END AS name_status,
          CASE WHEN l.n IS NULL THEN 'missing_left' WHEN r.n IS NULL THEN 'missing_right'
               WHEN l.n > 1 OR r.n > 1 THEN 'duplicate'
               WHEN l.ab IS NOT DISTINCT FROM r.ab THEN 'match' ELSE 'mismatch' END AS acctbal_status
        FROM l FULL OUTER JOIN r ON l.k = r.k""",
    "assign_keys": "SELECT ROW_NUMBER() OVER (ORDER BY c_name, c_custkey) AS id, * FROM customer",
    "url_host": """
        SELECT page_id,
          NULLIF(regexp_extract(url, '^(?:jdbc:)?[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:;]+)', 1), '') AS host,
          NULLIF(regexp_extract(url, '^(?:jdbc:)?[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/(?:[^?#;]*/)?([^/?#;]*)', 1), '') AS database
        FROM pages""",
    "redact": """
        SELECT event_id,
          to_json(map_from_entries(list_transform(json_keys(props), lambda k: {'key': k, 'value':
            CASE WHEN lower(k) IN ('password', 'pwd') THEN '******' ELSE props->>k END}))) AS props_redacted,
          COALESCE(props->>'key', props->>'k') AS k_value,
          printf('%.2f', value) AS value_2dp
        FROM events""",
}
