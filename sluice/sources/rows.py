"""Local literal rows -> DataFrame, with the coercions the declared schema needs.

``createDataFrame`` refuses a Python float for a DecimalType field and a str
for a DateType field; rows written by hand usually carry both. Values are
converted from the schema, field by field, before Spark sees them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _coerce(value: Any, dtype: T.DataType) -> Any:
    if value is None:
        return None
    if isinstance(dtype, T.DecimalType) and not isinstance(value, Decimal):
        return Decimal(str(value))
    if isinstance(dtype, T.DateType) and isinstance(value, str):
        return dt.date.fromisoformat(value)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) and isinstance(value, str):
        return dt.datetime.fromisoformat(value)
    if isinstance(dtype, (T.DoubleType, T.FloatType)) and isinstance(value, (int, Decimal)):
        return float(value)
    return value


def from_rows(
    spark: SparkSession,
    rows: Iterable[Sequence[Any]],
    schema: T.StructType | Sequence[str] | str,
) -> DataFrame:
    """Rows with an explicit ``StructType`` / DDL string (coerced), or with
    column names only (types inferred: int -> bigint, float -> double)."""
    rows = [tuple(r) for r in rows]
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema  # DDL "a INT, b STRING"
    if isinstance(schema, T.StructType):
        fields = schema.fields
        for r in rows:
            if len(r) != len(fields):
                raise ValueError(f"row has {len(r)} values, schema has {len(fields)} fields: {r!r}")
        coerced = [tuple(_coerce(v, f.dataType) for v, f in zip(r, fields)) for r in rows]
        return spark.createDataFrame(coerced, schema)
    return spark.createDataFrame(rows, list(schema))
