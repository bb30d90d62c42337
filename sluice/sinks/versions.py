"""Tables published without a gap: a view over immutable versions.

Every load writes a version of its own: a checked folder, and a catalog table
over it named ``<name>__v<milliseconds>_<id>`` that never changes. ``<name>``
itself is a view of one version. Publishing is one catalog call, ``ALTER VIEW
... AS``, which replaces the view's text in place; ``CREATE OR REPLACE VIEW``
drops and creates, and a reader between the two would fail. A query reads the
version its view named when it was analysed, from the first file to the last, so
it never fails and never mixes versions while others are published.

Several tables are published together by a release: one append to the ledger
``<base>/<namespace>/_releases`` names the version of each. The append is the
moment of publication; the views follow, and ``recover`` sets them again from
the ledger if a process died in between.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sinks.ledger import append_rows, read_rows
from sluice.sinks.parquet import _delete
from sluice.sinks.tables import TableSpec, _default_base, _partitioned, create_namespace, table_location, write_version
from sluice.sources.catalog import quote_name

_RELEASES = "release long, name string, version string"
#: Table property: the columns in the spec's order (the catalog puts partition columns last).
_ORDER = "sluice.columns"


@dataclass(frozen=True)
class Version:
    """A staged or published version: its table in the namespace, folder, rows."""

    name: str
    table: str
    location: str
    rows: int


def stage(
    spark: SparkSession, spec: TableSpec, source: DataFrame, *, namespace: str, base: str | None = None, **options
) -> Version:
    """Write and check a version that no reader sees yet. ``source`` may read the
    published view itself."""
    create_namespace(spark, namespace)
    location, rows = write_version(spark, spec, source, namespace=namespace, base=base, **options)
    table = f"{spec.name}__v{int(time.time() * 1000)}_{uuid.uuid4().hex[:8]}"
    qualified = quote_name(f"{namespace}.{table}")
    opts = " OPTIONS (" + ", ".join(f"'{k}'='{v}'" for k, v in spec.options.items()) + ")" if spec.options else ""
    order = json.dumps(spec.column_names).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {qualified} ({spec.ddl()}) USING {spec.provider}{_partitioned(spec)}{opts} "
        f"LOCATION '{location}' TBLPROPERTIES ('{_ORDER}' = '{order}')"
    )
    if spec.partition_by:
        spark.sql(f"ALTER TABLE {qualified} RECOVER PARTITIONS")
    return Version(spec.name, table, location, rows)


def _columns(spark: SparkSession, namespace: str, version: str) -> list[str]:
    properties = spark.sql(f"SHOW TBLPROPERTIES {quote_name(f'{namespace}.{version}')}").collect()
    return json.loads(next(r["value"] for r in properties if r["key"] == _ORDER))


def read_version(spark: SparkSession, namespace: str, version: str) -> DataFrame:
    """The rows of one version, in the spec's column order."""
    columns = ["`" + c.replace("`", "``") + "`" for c in _columns(spark, namespace, version)]
    return spark.table(quote_name(f"{namespace}.{version}")).select(*columns)


def discard(spark: SparkSession, namespace: str, version: str) -> None:
    """Drop a version and delete its folder."""
    location = table_location(spark, f"{namespace}.{version}")
    spark.sql(f"DROP TABLE IF EXISTS {quote_name(f'{namespace}.{version}')}")
    if location:
        _delete(spark, location)


def current(spark: SparkSession, namespace: str, name: str) -> str | None:
    """The version that the view shows, None where there is no view."""
    if not spark.catalog.tableExists(f"{namespace}.{name}"):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(f'{namespace}.{name}')}").collect()
    text = next((r["data_type"] for r in rows if r["col_name"] == "View Text"), None)
    if text is None:
        raise ValueError(f"{namespace}.{name} is a table, not a view of versions")
    return re.search(rf"{re.escape(name)}__v\d+_[0-9a-f]+", text).group()


def versions(spark: SparkSession, namespace: str, name: str) -> list[str]:
    """All versions of ``name``, oldest first."""
    pattern = re.compile(rf"{re.escape(name)}__v(\d+)_[0-9a-f]{{8}}", re.IGNORECASE)
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {quote_name(namespace)} LIKE '{name}__v*'").collect()]
    return sorted((n for n in names if pattern.fullmatch(n)), key=lambda n: (int(pattern.fullmatch(n).group(1)), n))


def switch(spark: SparkSession, namespace: str, name: str, version: str) -> None:
    """Point the view ``name`` at ``version`` (made if it isn't there)."""
    exists = current(spark, namespace, name) is not None
    source = quote_name(f"{namespace}.{version}")
    chosen = ", ".join("`" + c.replace("`", "``") + "`" for c in _columns(spark, namespace, version))
    verb = "ALTER VIEW" if exists else "CREATE VIEW"
    spark.sql(f"{verb} {quote_name(f'{namespace}.{name}')} AS SELECT {chosen} FROM {source}")


def publish(
    spark: SparkSession, spec: TableSpec, source: DataFrame, *, namespace: str, base: str | None = None,
    keep: int | None = None, **options,
) -> Version:
    """Replace ``namespace.name`` with the rows of ``source``: stage, then switch.
    With ``keep``, versions older than the ``keep`` newest are expired."""
    staged = stage(spark, spec, source, namespace=namespace, base=base, **options)
    switch(spark, namespace, spec.name, staged.table)
    if keep is not None:
        expire(spark, namespace, spec.name, keep=keep)
    return staged


def rollback(spark: SparkSession, namespace: str, name: str) -> str:
    """Show the version before the one that is shown; its name."""
    found, now = versions(spark, namespace, name), current(spark, namespace, name)
    if now is None or found.index(now) == 0:
        raise ValueError(f"{namespace}.{name} has no earlier version")
    earlier = found[found.index(now) - 1]
    switch(spark, namespace, name, earlier)
    return earlier


def expire(spark: SparkSession, namespace: str, name: str, *, keep: int = 2, min_age_s: float = 0) -> list[str]:
    """Drop the versions older than the ``keep`` newest and than ``min_age_s``
    (longer than the longest query), files included; never the one that is shown.
    A query that reads a version while it is dropped fails."""
    if keep < 1:
        raise ValueError("keep must be positive")
    shown, limit = current(spark, namespace, name), (time.time() - min_age_s) * 1000
    old = [v for v in versions(spark, namespace, name)[:-keep] if v != shown and int(re.search(r"__v(\d+)_", v).group(1)) <= limit]
    for version in old:
        discard(spark, namespace, version)
    return old


# --- releases ---------------------------------------------------------------


def _ledger(spark: SparkSession, namespace: str, base: str | None) -> str:
    return f"{(base or _default_base(spark)).rstrip('/')}/{namespace}/_releases"


def release_versions(spark: SparkSession, namespace: str, base: str | None = None, release: int | None = None) -> dict[str, str]:
    """name -> version as of the latest release or a given one."""
    rows = read_rows(spark, _ledger(spark, namespace, base), _RELEASES)
    if release is not None:
        rows = rows.where(F.col("release") <= release)
    latest = rows.groupBy("name").agg(F.max_by("version", "release").alias("version")).collect()  # one per table
    return {r["name"]: r["version"] for r in latest}


def release(spark: SparkSession, namespace: str, staged: Mapping[str, str], *, base: str | None = None) -> int:
    """Publish several staged versions (name -> version) together. One append
    decides; then the views are set. If a view can't be set, those already set go
    back, and so does the release, and the error is raised."""
    path = _ledger(spark, namespace, base)
    before = release_versions(spark, namespace, base)
    number = (read_rows(spark, path, _RELEASES).agg(F.max("release").alias("n")).first()["n"] or 0) + 1
    append_rows(spark, path, [(number, n, v) for n, v in staged.items()], _RELEASES)
    done: list[str] = []
    try:
        for name, version in staged.items():
            switch(spark, namespace, name, version)
            done.append(name)
    except Exception:
        append_rows(spark, path, [(number + 1, n, before.get(n)) for n in staged], _RELEASES)
        for name in done:
            if before.get(name):
                switch(spark, namespace, name, before[name])
            else:
                spark.sql(f"DROP VIEW IF EXISTS {quote_name(f'{namespace}.{name}')}")
        raise
    return number


def recover(spark: SparkSession, namespace: str, *, base: str | None = None) -> list[str]:
    """Set the views that don't show the latest release; their names."""
    behind = []
    for name, version in release_versions(spark, namespace, base).items():
        if version and current(spark, namespace, name) != version:
            switch(spark, namespace, name, version)
            behind.append(name)
    return sorted(behind)


def read_release(
    spark: SparkSession, namespace: str, names: Sequence[str], *, base: str | None = None, release: int | None = None
) -> dict[str, DataFrame]:
    """Several tables as of one release, so that their rows belong together."""
    found = release_versions(spark, namespace, base, release)
    missing = [n for n in names if not found.get(n)]
    if missing:
        raise ValueError(f"not released in {namespace}: {missing}")
    return {n: read_version(spark, namespace, found[n]) for n in names}
