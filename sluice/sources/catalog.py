"""Catalog tables and session views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def quote_name(name: str) -> str:
    """Back-quote every part of ``db.table`` (names like ``tpc-source`` need it)."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in name.split("."))


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """``SELECT * FROM `db`.t`` as a DataFrame; pruning and partition filters
    still reach the scan because nothing is materialised here."""
    return spark.table(quote_name(name))


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def read_parquet_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
