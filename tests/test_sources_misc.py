"""Local rows and catalog helpers."""

import pytest

from sluice.sources.catalog import quote_name, read_catalog_table, read_parquet_table, register_view
from sluice.sources.rows import from_rows
from tests.conftest import SF_SMALL


def test_rows_with_names_only_infer_types(spark):
    df = from_rows(spark, [(7, "harbour", "quay 4", 12.5)], ["id", "name", "place", "weight"])
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "string", "string", "double"]


def test_rows_arity_checked(spark):
    with pytest.raises(ValueError):
        from_rows(spark, [(1, "a")], "id INT, name STRING, age INT")


def test_catalog_helpers(spark):
    nation = read_parquet_table(spark, SF_SMALL, "nation")
    spark.sql("CREATE NAMESPACE IF NOT EXISTS src_cat")
    nation.write.mode("overwrite").saveAsTable("src_cat.nation")
    assert quote_name("src_cat.nation") == "`src_cat`.`nation`"
    assert read_catalog_table(spark, "src_cat.nation").count() == 25
    register_view(nation, "nation_view")
    assert spark.sql("SELECT COUNT(*) AS n FROM nation_view").first().n == 25
