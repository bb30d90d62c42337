"""High-water-mark loads and file bookmarks: no loss, no duplicates, reruns are no-ops."""

from pyspark.sql import functions as F

from sluice.streaming.incremental import bookmark_files, load_increment, read_loaded, read_mark
from tests.conftest import SF_SMALL


def test_high_water_mark(spark, tmp_path):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    target, state = str(tmp_path / "t"), str(tmp_path / "s")
    r1 = load_increment(o.filter("o_orderkey < 1000"), target, "o_orderkey", state, source="src", table="orders")
    assert (r1.low_mark, r1.high_mark, r1.rows) == (None, 999, 1000)
    assert read_mark(spark, state, "src", "orders") == "999"
    r2 = load_increment(o, target, "o_orderkey", state, source="src", table="orders")
    assert (r2.low_mark, r2.high_mark, r2.rows) == (999, 1499, 500)
    r3 = load_increment(o, target, "o_orderkey", state, source="src", table="orders")
    assert r3.rows == 0
    loaded = read_loaded(spark, target)
    assert loaded.count() == 1500 and loaded.exceptAll(o).isEmpty()


def test_high_water_mark_pushes_filter(spark, tmp_path):
    from sluice.plans.inspect import pushed_filters

    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    pending = o.filter(F.col("o_orderkey") > F.lit(999))
    assert any("GreaterThan(o_orderkey,999)" in p for p in pushed_filters(pending))


def test_file_bookmark(spark, tmp_path):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    landing, target, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    o.filter("o_orderkey < 700").write.parquet(landing)
    assert bookmark_files(spark, landing, o.schema, target, ckpt) == 700
    o.filter("o_orderkey >= 700").write.mode("append").parquet(landing)
    assert bookmark_files(spark, landing, o.schema, target, ckpt) == 800
    assert bookmark_files(spark, landing, o.schema, target, ckpt) == 0
    out = spark.read.parquet(target)
    assert out.count() == 1500 and out.exceptAll(o).isEmpty()


def test_high_water_mark_from_source_bounds(spark, tmp_path, derby):
    from sluice.sinks import jdbc as JW
    from sluice.sources import jdbc as JR

    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    JW.write_jdbc(o, derby, "ORDERS", mode="overwrite")
    src = JR.read_partitioned(spark, derby, "ORDERS", "o_orderkey", 4)
    hi = JR.bounds(spark, derby, "ORDERS", "o_orderkey").upper  # pushed MAX
    target, state = str(tmp_path / "t"), str(tmp_path / "s")
    r = load_increment(src, target, "o_orderkey", state, source="derby", table="ORDERS", high_mark=hi)
    assert (r.high_mark, r.rows) == (1499, 1500)
    assert load_increment(src, target, "o_orderkey", state, source="derby", table="ORDERS", high_mark=hi).rows == 0


def test_rerun_after_lost_mark_does_not_duplicate(spark, tmp_path):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    target, state = str(tmp_path / "t"), str(tmp_path / "s")
    load_increment(o.filter("o_orderkey < 500"), target, "o_orderkey", state, source="s", table="o")
    # run 2 writes its batch, then "dies" before recording the mark:
    lost_state = str(tmp_path / "lost")
    spark.read.parquet(state).write.parquet(lost_state)
    load_increment(o.filter("o_orderkey < 1000"), target, "o_orderkey", state, source="s", table="o")
    # the rerun starts from the old mark (state copy without run 2) on a grown source
    r = load_increment(o, target, "o_orderkey", lost_state, source="s", table="o")
    assert (r.low_mark, r.high_mark) == (499, 1499)
    loaded = read_loaded(spark, target)
    assert loaded.count() == 1500 and loaded.exceptAll(o).isEmpty()


def test_null_marks_and_late_ties_are_loaded(spark, tmp_path):
    target, state = str(tmp_path / "t"), str(tmp_path / "s")

    def run(rows):
        return load_increment(spark.createDataFrame(rows, "m int, v string"), target, "m", state, source="s", table="t")

    rows = [(1, "a"), (2, "b"), (None, "n")]
    assert run(rows).rows == 3
    rows.append((2, "late tie"))
    assert run(rows).rows == 1
    rows += [(None, "n2"), (3, "c")]
    assert run(rows).rows == 2
    assert run(rows).rows == 0
    rows += [(3, "tie of the new top"), (5, "e"), (4, "d")]
    assert run(rows).rows == 3
    assert sorted(read_loaded(spark, target).collect(), key=str) == sorted(spark.createDataFrame(rows, "m int, v string").collect(), key=str)


def test_only_null_marks(spark, tmp_path):
    target, state = str(tmp_path / "t"), str(tmp_path / "s")
    for rows, added in (([(None, "x")], 1), ([(None, "x"), (None, "y")], 1), ([(None, "x"), (None, "y"), (1, "z")], 1)):
        r = load_increment(spark.createDataFrame(rows, "m int, v string"), target, "m", state, source="s", table="t")
        assert r.rows == added
    assert read_loaded(spark, target).count() == 3


def test_bookmark_counts_more_batches_than_the_progress_window(spark, tmp_path):
    landing, target, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    df = spark.range(130).repartition(130)
    df.write.option("maxRecordsPerFile", 1).parquet(landing)
    n = bookmark_files(spark, landing, df.schema, target, ckpt, max_files_per_trigger=1)
    assert n == 130 == spark.read.parquet(target).count()
