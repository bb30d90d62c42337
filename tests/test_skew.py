"""A key holding a third of the rows: results stay exact and whole, and the
hot join partition is split (AQE skew join, thresholds lowered for the test)."""

import pytest
from pyspark.sql import functions as F

from sluice.operators import quality as Q
from sluice.operators.analytics import project_participation
from sluice.plans.inspect import plan_text
from tests.conftest import SF_SMALL

SKEW_CONF = {
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _skewed_lineitem(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    n = li.count()
    hot = li.withColumn("l_orderkey", F.lit(7).cast("bigint")).limit(n // 2)
    return li.unionByName(hot)  # order 7 now holds about a third of all rows


def test_join3_hot_key_exact_and_split(spark, skew_conf):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    li = _skewed_lineitem(spark)
    df = project_participation(
        o, c, li, project_id="o_orderkey", project_name="o_orderkey", project_budget="o_totalprice",
        project_department="o_custkey", department_id="c_custkey", department_name="c_name",
        assignment_project="l_orderkey", assignment_member="l_suppkey",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the sides are small here
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    got = sorted(tuple(r) for r in df.collect())
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name, d in (("o", o), ("c", c), ("li", li)):
        d.createOrReplaceTempView(f"skew_{name}")
    ref = spark.sql(
        "SELECT o.o_orderkey, o.o_totalprice, c.c_name, COUNT(DISTINCT li.l_suppkey) "
        "FROM skew_o o JOIN skew_c c ON o.o_custkey = c.c_custkey JOIN skew_li li ON o.o_orderkey = li.l_orderkey "
        "GROUP BY 1, 2, 3"
    )
    assert got == sorted(tuple(r) for r in ref.collect())
    assert "SortMergeJoin(skew=true)" in plan_text(df)


def test_checks_hot_key_whole(spark):
    li = _skewed_lineitem(spark)
    dup = Q.check_unique(li, ["l_orderkey", "l_linenumber"])
    hot = dup.filter("l_orderkey = 7").agg(F.sum("n_rows")).first()[0]
    assert hot == li.filter("l_orderkey = 7").count()
    orphans = Q.check_foreign_key(li, spark.read.parquet(f"{SF_SMALL}/orders.parquet"), ["l_orderkey"], ["o_orderkey"])
    assert orphans.count() == 0


def test_hot_partition_value_written_by_several_tasks(spark, skew_conf, tmp_path):
    from sluice.sinks import tables as TB

    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    hot = o.withColumn("o_orderpriority", F.lit("1-URGENT")).withColumn("o_orderkey", F.col("o_orderkey") + 10_000)
    df = o.unionByName(hot)  # one partition value now holds ~60% of the rows
    s = TB.spec_from_frame("hot_prio", df, ["o_orderpriority"])
    res = TB.create_or_replace(spark, s, df, namespace="skew_ns", base=str(tmp_path))
    assert res.rows == df.count()
    files = spark.read.parquet(res.location).filter("o_orderpriority = '1-URGENT'").inputFiles()
    assert len(files) > 1  # split by size, not one task per value
    back = TB.read_table(spark, s, "skew_ns")
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_assign_keys_spreads_a_hot_tied_value(spark):
    from sluice.operators.keys import assign_keys

    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet").select("c_custkey", "c_mktsegment")
    hot = c.withColumn("c_mktsegment", F.lit("AAA"))  # ties on the whole order key
    df = c.unionByName(hot).unionByName(hot)
    keyed = assign_keys(df, ["c_mktsegment"], num_partitions=6)
    ids = sorted(r.id for r in keyed.collect())
    assert ids == list(range(1, df.count() + 1))  # dense, unique
    first_aaa = keyed.filter("c_mktsegment = 'AAA'").agg(F.min("id"), F.max("id")).first()
    assert (first_aaa[0], first_aaa[1]) == (1, 2 * c.count())  # the tied block comes first, whole


def test_join3_salted_hot_keys_exact_without_session_settings(spark):
    from sluice.operators.joins import hot_keys

    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    li = _skewed_lineitem(spark)
    assert hot_keys(li, "l_orderkey", min_share=0.05) == [7]
    kw = dict(project_id="o_orderkey", project_name="o_orderkey", project_budget="o_totalprice",
              project_department="o_custkey", department_id="c_custkey", department_name="c_name",
              assignment_project="l_orderkey", assignment_member="l_suppkey")
    plain = project_participation(o, c, li, **kw)
    salted = project_participation(o, c, li, hot_key_share=0.05, hot_key_splits=8, **kw)
    assert sorted(tuple(r) for r in salted.collect()) == sorted(tuple(r) for r in plain.collect())
    assert "xxhash64" in plan_text(salted)


def test_join3_tasks_are_sized_by_rows(spark):
    """Narrow rows that compress well: AQE would put all of them into a task or two."""
    from sluice.operators.joins import dealt_distinct

    o = spark.range(4_000).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "CAST(id % 11 AS DOUBLE) AS o_totalprice")
    c = spark.range(7).selectExpr("id AS c_custkey", "concat('c', id) AS c_name")
    li = spark.range(40_000).selectExpr("IF(id < 4000, 5, id % 4000) AS l_orderkey", "id % 13 AS l_suppkey")
    kw = dict(project_id="o_orderkey", project_name="o_orderkey", project_budget="o_totalprice",
              project_department="o_custkey", department_id="c_custkey", department_name="c_name",
              assignment_project="l_orderkey", assignment_member="l_suppkey")
    names = ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in zip(names, ("4", "-1", "-1")):
            spark.conf.set(k, v)
        plain = project_participation(o, c, li, **kw)
        rows = 40_000 // (20 * spark.sparkContext.defaultParallelism)
        sized = project_participation(o, c, li, rows_per_task=rows, **kw)
        want = sorted(tuple(r) for r in plain.collect())
        assert sorted(tuple(r) for r in sized.collect()) == want and len(want) == 4_000
        text, n = plan_text(sized), -(-40_000 // rows)
        shuffles = [x for x in text.splitlines() if "hashpartitioning" in x]
        assert any(f" {n}), REPARTITION_BY_NUM" in x for x in shuffles), shuffles
        assert any("l_orderkey" in x and f" {n}), ENSURE_REQUIREMENTS" in x for x in shuffles), shuffles
        assert "xxhash64" in text  # project 5 holds a tenth of the rows
        dealt = dealt_distinct(li, "l_orderkey", ["l_suppkey"], rows)
        assert dealt.rdd.getNumPartitions() == n
        assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, li.distinct().collect()))
        assert dealt_distinct(li, "l_orderkey", ["l_suppkey"], 40_000) is li
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
