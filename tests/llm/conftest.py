import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
)


@pytest.fixture()
def docs(spark):
    """Builds a documents table from (doc_id, text[, lang]) rows."""

    def make(rows, extra=()):
        df = spark.createDataFrame([(*r, None)[:3] for r in rows], DOCS)
        for name in extra:  # columns whose names clash with results
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit("mine"))
        return df

    return make


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF
