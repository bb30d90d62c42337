"""Plan inspection through ``DataFrame.explain`` -- what tests assert on:
pushed filters, pruned partitions, read schemas, join strategies."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df))


def partition_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", plan_text(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_text(df))


def count_exchanges(df: DataFrame) -> int:
    """Shuffle exchanges in the physical plan (before AQE re-planning)."""
    return len(re.findall(r"^\(\d+\) Exchange", plan_text(df), flags=re.M))
