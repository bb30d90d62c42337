"""Dense surrogate keys in a global order, without a global window.

``row_number() OVER (ORDER BY ...)`` with no PARTITION BY moves every row
into one task. Instead:

1. range-partition by the order columns and sort within partitions -- the
   global order is then (partition index, position in partition);
2. tag each row with its partition index and ``monotonically_increasing_id``
   (consecutive inside a partition), and checkpoint to the shared folder so
   both passes below see the same rows even if executors are lost;
3. count rows per partition (one row per partition) and turn the counts into
   start offsets -- a frame bounded by the partition count, so broadcasting it
   is safe;
4. key = start + offset[partition] + (id - first id of the partition).

The result equals ``ROW_NUMBER() OVER (ORDER BY order_cols) + start - 1``
when the order is total. A row id is appended as the last sort key: tied rows
(even a value or an exact duplicate row holding a third of the table) are
spread over several ranges instead of one task, and ties -- which have no
defined order anyway -- get consistent keys because the numbered frame is
checkpointed once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import ensure_checkpoint_dir


def assign_keys(
    df: DataFrame,
    order_by: Sequence[str],
    *,
    key_name: str = "id",
    start: int = 1,
    num_partitions: int | None = None,
) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order_by, "_tie"]
    ordered = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
    )
    tagged = ordered.withColumn("_part", F.spark_partition_id()).withColumn(
        "_mono", F.monotonically_increasing_id()
    )
    tagged = tagged.checkpoint(eager=True)
    per_part = tagged.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mono").alias("_first")
    )
    offsets = per_part.select(
        "_part",
        "_first",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_before"),
    ).fillna(0, subset=["_before"])
    keyed = tagged.join(F.broadcast(offsets), "_part").withColumn(
        key_name, F.lit(start) + F.col("_before") + (F.col("_mono") - F.col("_first"))
    )
    return keyed.select(key_name, *df.columns)


def next_key(df: DataFrame, key: str) -> int:
    """``max(key) + 1`` (1 for an empty table) -- where appended keys start."""
    m = df.agg(F.max(key).alias("m")).first()["m"]
    return 1 if m is None else int(m) + 1
