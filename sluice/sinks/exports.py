"""Exports that readers never find missing: versions behind a pointer.

``export_parquet`` puts a checked folder in the place of the old one by renaming,
which object stores do by copying, with a moment in between. Here every export is
a folder of its own under ``path``; a ledger names the current one, by one append
after the check. Readers ask the ledger (``read_export``), and a query that has
begun goes on reading its version while others are exported.

    path/v<milliseconds>-<id>/    path/_current  version, folder, rows, exported_at
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sinks.ledger import append_rows, now, read_rows
from sluice.sinks.parquet import ExportResult, _delete, export_parquet

_CURRENT = "version long, folder string, rows long, schema string, exported_at timestamp_ntz"


def _entries(spark: SparkSession, path: str) -> list:
    return read_rows(spark, f"{path.rstrip('/')}/_current", _CURRENT).orderBy("version", "exported_at").collect()  # one per export


def export_version(df: DataFrame, path: str, **options) -> ExportResult:
    """``export_parquet`` into a folder of its own, which becomes the current
    version once it is checked; ``options`` are its options. ``df`` may read an
    earlier version. A failed run leaves the current version as it is."""
    spark, path = df.sparkSession, path.rstrip("/")
    done = _entries(spark, path)
    folder = f"v{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"
    result = export_parquet(df, f"{path}/{folder}", **options)
    number = (done[-1]["version"] if done else 0) + 1
    append_rows(spark, f"{path}/_current", [(number, folder, result.rows_written, df.schema.json(), now())], _CURRENT)
    return ExportResult(f"{path}/{folder}", result.rows_expected, result.rows_written)


def read_export(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The current version of an export, or an earlier one."""
    import json

    from pyspark.sql import types as T

    found = [e for e in _entries(spark, path) if version is None or e["version"] == version]
    if not found:
        raise ValueError(f"{path} holds no such export")
    schema = T.StructType.fromJson(json.loads(found[-1]["schema"]))
    rows = spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{found[-1]['folder']}")
    return rows.select(*[F.col("`" + f.name.replace("`", "``") + "`") for f in schema])


def expire_exports(spark: SparkSession, path: str, *, keep: int = 2) -> list[str]:
    """Delete the folders of all but the ``keep`` latest versions; their names.
    A query that still reads one of them fails."""
    if keep < 1:
        raise ValueError("keep must be positive")
    entries = _entries(spark, path)
    kept = {e["folder"] for e in entries[-keep:]}
    gone = [e["folder"] for e in entries if e["folder"] not in kept]
    for folder in gone:
        _delete(spark, f"{path.rstrip('/')}/{folder}")
    return gone
