"""Plan shape of the headline queries: shuffles, broadcasts, pushdown."""

from sluice.plans import queries as Q
from sluice.plans.inspect import count_exchanges, plan_text
from tests.conftest import SF_SMALL


def test_join3_shuffles_lineitem_once(spark):
    """With sides too large to broadcast; joins are not hinted."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = Q.join3_count_distinct(spark, SF_SMALL)
        text = plan_text(df)
        assert count_exchanges(df) == 5  # customer, orders by customer, orders and lineitem by order, ORDER BY
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in text
    assert "hint" not in text.lower()


def test_group_stats_partial_then_final(spark):
    df = Q.group_count_avg(spark, SF_SMALL)
    text = plan_text(df)
    assert count_exchanges(df) == 2  # group key + ORDER BY
    assert "partial_count" in text and "ReadSchema: struct<c_acctbal:double,c_mktsegment:string>" in text


def test_checks_single_shuffle(spark):
    assert count_exchanges(Q.check_unique(spark, SF_SMALL)) == 1
    assert count_exchanges(Q.check_foreign_key_lineitem(spark, SF_SMALL)) == 1
    assert count_exchanges(Q.reconcile(spark, SF_SMALL)) == 2


def test_top_k_has_no_shuffle(spark):
    df = Q.filter_not_in_limit(spark, SF_SMALL)
    text = plan_text(df)
    assert count_exchanges(df) == 0 and "TakeOrderedAndProject" in text
    assert "Not(In(c_nationkey, [0,1,2,3,4]))" in text
