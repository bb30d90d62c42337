"""Partitioned catalog tables from declarative specs.

``CREATE OR REPLACE TABLE`` needs a V2 catalog; on plain
Parquet tables in the session catalog it is rejected, overwriting a path the
same query reads destroys it, and renaming a partitioned table loses its
partitions. So a replace here writes a *new versioned location*, checks it,
and only then points the table at it:

    write base/<ns>/<table>/v<stamp>  ->  verify count  ->  SET LOCATION v<stamp>

A partitioned table, whose partitions have locations of their own, and one
whose definition changes are dropped (external, files stay) and created at the
new location instead; a failed CREATE brings the old definition back. A reader
sees either the old or the new version, except for the short gap between DROP
and CREATE. The previous version stays on disk for rollback. In a V2 catalog
the table format's own atomic replace is used.
Columns are always matched by name, never by position.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor, wait
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.session import shared_path
from sluice.sinks.counting import observed
from sluice.sources.catalog import quote_name


@dataclass(frozen=True)
class TableSpec:
    """One target table: ordered (name, type) columns, partition columns,
    provider and table options."""

    name: str
    columns: tuple[tuple[str, str], ...]
    partition_by: tuple[str, ...] = ()
    provider: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    source: str | None = None  # source table name when it differs from ``name``
    defaults: dict[str, str] = field(default_factory=dict)  # column -> SQL default expression

    def __post_init__(self) -> None:
        names = [c for c, _ in self.columns]
        if len(set(names)) != len(names):
            raise ValueError(f"{self.name}: duplicate column names")
        missing = [p for p in self.partition_by if p not in names]
        if missing:
            raise ValueError(f"{self.name}: partition columns not in spec: {missing}")
        unknown = [c for c in self.defaults if c not in names]
        if unknown:
            raise ValueError(f"{self.name}: defaults for unknown columns {unknown}")

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    def ddl(self) -> str:
        return ", ".join(
            f"`{c}` {t}" + (f" DEFAULT {self.defaults[c]}" if c in self.defaults else "")
            for c, t in self.columns
        )

    def conform(self, df: DataFrame) -> DataFrame:
        """Select the spec's columns from ``df`` by name, cast to the spec types;
        a column the source lacks takes its DEFAULT expression (evaluated once
        per query, like an insert-time default), else it is an error."""
        have = {c.lower() for c in df.columns}
        missing = [c for c in self.column_names if c.lower() not in have and c not in self.defaults]
        if missing:
            raise ValueError(f"{self.name}: source lacks columns {missing}")
        return df.select(
            [
                (F.col(f"`{c}`") if c.lower() in have else F.expr(self.defaults[c])).cast(t).alias(c)
                for c, t in self.columns
            ]
        )


def spec_from_frame(
    name: str, df: DataFrame, partition_by: Sequence[str] = (), provider: str = "parquet"
) -> TableSpec:
    cols = tuple((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    return TableSpec(name, cols, tuple(partition_by), provider)


@dataclass(frozen=True)
class LoadResult:
    table: str
    location: str
    rows: int
    previous_location: str | None


def table_location(spark: SparkSession, table: str) -> str | None:
    """Current location of a catalog table, or None when it does not exist."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(table)}").collect()
    for r in rows:
        if r["col_name"] == "Location":
            return r["data_type"]
    return None


def _default_base(spark: SparkSession) -> str:
    """The warehouse folder where it is shared; on a cluster an unset one would
    be a folder of the driver alone, so the shared folder is taken."""
    warehouse = spark.sparkContext.getConf().get("spark.sql.warehouse.dir", None)
    return (warehouse or shared_path(spark, "tables", unique=False)).rstrip("/")


def _clustered(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cluster rows by partition value before a partitioned write.

    Without this each task opens a file per partition value it holds
    (tasks x values files). Plain hashing on the partition columns would
    send a hot value (say a third of all rows) to one task. ``REBALANCE``
    hashes on the partition columns and lets AQE split any partition larger
    than ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` (and merge small
    ones), so a hot value is written by as many tasks as its size needs.
    Splits are ranges of map outputs, so a retried task writes the same rows.
    """
    if not spec.partition_by:
        return df
    return df.hint("rebalance", *spec.partition_by)


def create_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """``CREATE NAMESPACE IF NOT EXISTS``; ``location`` keeps its folder out of
    the default warehouse dir (which is relative to the working directory
    when unset)."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quote_name(namespace)}{where}")


def create_or_replace(
    spark: SparkSession,
    spec: TableSpec,
    source: DataFrame,
    *,
    namespace: str = "default",
    base: str | None = None,
    max_records_per_file: int | None = None,
    reject_empty_partition_values: bool = True,
    verify: bool = True,
) -> LoadResult:
    """Replace ``namespace.spec.name`` with the rows of ``source`` (by name).

    In a catalog that can replace tables itself (Iceberg, Delta: see
    ``is_v2``) this is its atomic CREATE OR REPLACE with the spec's provider,
    partitioning and options as table properties. Otherwise a new version is
    written and checked, then the table is pointed at it. Either way the source
    is read once: rows and blank partition values are counted by the write.
    """
    table = f"{namespace}.{spec.name}"
    create_namespace(spark, namespace)
    data, seen = _observed_source(spec, source, reject_empty_partition_values)
    if is_v2(spark, namespace):
        previous = table_location(spark, table)
        v2_replace(spark, table, spec, data)
        written = spark.table(quote_name(table)).count()
        n = observed(seen, "n")["n"]
        if verify and written != n:
            raise RuntimeError(f"{table}: holds {written} rows, source had {n}")
        return LoadResult(table, table_location(spark, table) or "", written, previous)
    location, written = _write_version(spark, spec, data, seen, table, namespace, base, max_records_per_file, verify)
    previous = table_location(spark, table)
    if previous and _same_definition(spark, table, spec):
        spark.sql(f"ALTER TABLE {quote_name(table)} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table)
        return LoadResult(table, location, written, previous)
    # Partitions keep locations of their own, so a partitioned table (or a
    # changed definition) is created anew; the old definition comes back if
    # that fails.
    old = spark.sql(f"SHOW CREATE TABLE {quote_name(table)}").first()[0] if previous else None
    was_partitioned = bool(previous) and any(c.isPartition for c in spark.catalog.listColumns(table))
    opts = ""
    if spec.options:
        opts = " OPTIONS (" + ", ".join(f"'{k}'='{v}'" for k, v in spec.options.items()) + ")"
    spark.sql(f"DROP TABLE IF EXISTS {quote_name(table)}")
    try:
        spark.sql(
            f"CREATE TABLE {quote_name(table)} ({spec.ddl()}) USING {spec.provider}{_partitioned(spec)}{opts} "
            f"LOCATION '{location}'"
        )
        if spec.partition_by:
            spark.sql(f"ALTER TABLE {quote_name(table)} RECOVER PARTITIONS")
    except Exception:
        if old:
            spark.sql(f"DROP TABLE IF EXISTS {quote_name(table)}")
            spark.sql(old)
            if was_partitioned:
                spark.sql(f"ALTER TABLE {quote_name(table)} RECOVER PARTITIONS")
        raise
    return LoadResult(table, location, written, previous)


def _write_version(
    spark: SparkSession, spec: TableSpec, data: DataFrame, seen: Observation, table: str, namespace: str,
    base: str | None, max_records_per_file: int | None, verify: bool,
) -> tuple[str, int]:
    """Write ``data`` (observed by ``seen``) to a fresh folder, clustered by
    partition value, and check it: (location, rows). No table is touched."""
    base = (base or _default_base(spark)).rstrip("/")
    stamp = f"v{int(time.time() * 1000)}_{uuid.uuid4().hex[:8]}"
    location = f"{base}/{namespace}/{spec.name}/{stamp}"
    writer = _clustered(data, spec).write.mode("errorifexists").format(spec.provider).options(**spec.options)
    if spec.partition_by:
        writer = writer.partitionBy(*spec.partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.save(location)
    counted = observed(seen, "n", "blank")
    if counted["blank"]:
        raise ValueError(f"{table}: empty-string partition value; map it to NULL explicitly; table left unchanged")
    # Read back with the spec's schema: no inference from paths ('001' stays
    # a string) and an empty version (no data files) counts as 0 rows.
    written = spark.read.format(spec.provider).schema(_schema(spec)).load(location).count()
    if verify and written != counted["n"]:
        raise RuntimeError(f"{table}: wrote {written} rows, source had {counted['n']}; table left unchanged")
    return location, written


def _observed_source(spec: TableSpec, source: DataFrame, reject_empty: bool) -> tuple[DataFrame, Observation]:
    """The source in the spec's columns; its rows and blank partition values are
    counted by the write. Hive-style paths would turn '' into NULL: refused
    instead of changing data."""
    blank = F.lit(False)
    for p in spec.partition_by:
        if reject_empty and dict(spec.columns)[p].lower() == "string":
            blank = blank | (F.col(f"`{p}`") == "")
    seen = Observation()
    data = spec.conform(source).observe(seen, F.count(F.lit(1)).alias("n"), F.count(F.when(blank, 1)).alias("blank"))
    return data, seen


def write_version(
    spark: SparkSession, spec: TableSpec, source: DataFrame, *, namespace: str = "default", base: str | None = None,
    max_records_per_file: int | None = None, verify: bool = True,
) -> tuple[str, int]:
    """The rows of ``source`` as a checked version folder of the spec that no
    table points at yet: (location, rows)."""
    data, seen = _observed_source(spec, source, True)
    return _write_version(spark, spec, data, seen, f"{namespace}.{spec.name}", namespace, base, max_records_per_file, verify)


def _partitioned(spec: TableSpec) -> str:
    return f" PARTITIONED BY ({', '.join(f'`{p}`' for p in spec.partition_by)})" if spec.partition_by else ""


def _same_definition(spark: SparkSession, table: str, spec: TableSpec) -> bool:
    """Unpartitioned, without options or defaults, and with the spec's columns
    and provider: only the location has to change."""
    if spec.partition_by or spec.options or spec.defaults:
        return False
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(table)}").collect()
    provider = next((r["data_type"] for r in rows if r["col_name"] == "Provider"), "")
    if provider.lower() != spec.provider.lower() or any(c.isPartition for c in spark.catalog.listColumns(table)):
        return False
    wanted = spark.createDataFrame([], _schema(spec)).schema
    have = spark.table(quote_name(table)).schema
    return [(f.name, f.dataType) for f in have] == [(f.name, f.dataType) for f in wanted]


def is_v2(spark: SparkSession, namespace: str) -> bool:
    """Whether the namespace lies in a catalog of its own: one named in front of
    it, or an extension of the session catalog."""
    first, dot, _ = namespace.partition(".")
    name = first if dot else spark.catalog.currentCatalog()
    return spark.conf.get(f"spark.sql.catalog.{name}", None) is not None


def v2_replace(spark: SparkSession, table: str, spec: TableSpec, data: DataFrame) -> None:
    """CREATE OR REPLACE TABLE ... AS SELECT in a V2 catalog: one atomic
    statement, rows clustered by partition value first. Tested on the calls it
    makes; this box has no such table format."""
    writer = _clustered(data, spec).writeTo(quote_name(table)).using(spec.provider)
    if spec.partition_by:
        writer = writer.partitionedBy(*[F.col(f"`{p}`") for p in spec.partition_by])
    for key, value in spec.options.items():
        writer = writer.tableProperty(key, value)
    writer.createOrReplace()


def read_table(spark: SparkSession, spec: TableSpec, namespace: str = "default") -> DataFrame:
    """The table in spec column order (the catalog puts partition columns last)."""
    return spark.table(quote_name(f"{namespace}.{spec.name}")).select(
        [F.col(f"`{c}`") for c in spec.column_names]
    )


def create_table(
    spark: SparkSession, spec: TableSpec, namespace: str = "default", *, if_not_exists: bool = True
) -> str:
    """``CREATE TABLE [IF NOT EXISTS]`` from a spec (managed location)."""
    table = f"{namespace}.{spec.name}"
    create_namespace(spark, namespace)
    parts = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in spec.partition_by)})" if spec.partition_by else ""
    guard = " IF NOT EXISTS" if if_not_exists else ""
    spark.sql(f"CREATE TABLE{guard} {quote_name(table)} ({spec.ddl()}) USING {spec.provider}{parts}")
    return table


def insert_by_name(spark: SparkSession, table: str, df: DataFrame, *, overwrite: bool = False) -> None:
    """``INSERT INTO t BY NAME``: columns matched by name, so partition
    columns moved to the end of a Parquet table cannot shift values; columns
    left out take their DEFAULT (NULL when none is declared)."""
    target_cols = spark.table(quote_name(table)).columns
    extra = [c for c in df.columns if c not in target_cols]
    if extra:
        raise ValueError(f"{table}: unknown columns {extra}")
    view = f"_sluice_ins_{uuid.uuid4().hex[:10]}"
    df.createOrReplaceTempView(view)
    try:
        verb = "INSERT OVERWRITE" if overwrite else "INSERT INTO"
        spark.sql(f"{verb} {quote_name(table)} BY NAME SELECT * FROM `{view}`")
    finally:
        spark.catalog.dropTempView(view)


def load_tables(
    spark: SparkSession,
    specs: Iterable[TableSpec],
    *,
    source_namespace: str | None,
    target_namespace: str,
    suffix: str = "",
    base: str | None = None,
    parallelism: int = 1,
    **kw,
) -> list[LoadResult]:
    """Replace every spec'd table from the same-named source table.

    Each table is published on its own, so a failure leaves the other tables
    at their new or their old version -- never empty. With ``parallelism`` > 1
    up to that many tables load as concurrent Spark jobs (small dimension
    tables then run beside a large fact table instead of after it); results
    come back in spec order and the first failure is raised after the others
    finish.
    """
    specs = list(specs)
    create_namespace(spark, target_namespace)

    def one(spec: TableSpec) -> LoadResult:
        src = spec.source or spec.name
        qualified = f"{source_namespace}.{src}" if source_namespace else src  # None: session views
        source_df = spark.table(quote_name(qualified))
        target = TableSpec(
            spec.name + suffix, spec.columns, spec.partition_by, spec.provider, spec.options, None, spec.defaults
        )
        return create_or_replace(spark, target, source_df, namespace=target_namespace, base=base, **kw)

    if parallelism <= 1:
        return [one(spec) for spec in specs]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        futures = [pool.submit(one, spec) for spec in specs]
        wait(futures)
    return [f.result() for f in futures]


def truncate(
    spark: SparkSession, spec: TableSpec, *, namespace: str = "default", base: str | None = None
) -> LoadResult:
    """Empty a table, keeping its definition: a replace with an empty version.

    Spark refuses ``TRUNCATE TABLE`` on external tables, and the tables here
    are external (versioned locations); an empty version is published like
    any other, so the previous rows stay available for rollback.
    """
    empty = spark.createDataFrame([], _schema(spec))
    return create_or_replace(spark, spec, empty, namespace=namespace, base=base)


def _schema(spec: TableSpec) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in spec.columns)


def table_from_rows(
    spark: SparkSession, spec: TableSpec, df: DataFrame, *, namespace: str = "default", base: str | None = None
) -> LoadResult:
    """Rows -> view -> create -> insert, as one by-name replace."""
    view = f"{spec.name}_temp"
    df.createOrReplaceTempView(view)
    return create_or_replace(spark, spec, spark.table(view), namespace=namespace, base=base)
