"""Exact integer k-means by dimension-sharded Lloyd rounds.

Vectors are kept as tiles of up to ``TILE`` rows, each cut into column blocks of
``block`` components; the table of shards (tile, block) is written once, one
folder per block, with the narrowest integers that hold a shard. Rounds:

1. a task takes shards of one column block and computes the exact partial
   distances of their rows to the block's slice of every centroid;
2. the partial distances are reduced by tile: adding its blocks gives the exact
   distances, whose least is the assignment;
3. each shard, joined with its tile's assignment, adds its own columns by
   cluster within the task; the sums per (cluster, component) are added with
   map-side aggregation and make the new centroid slices.

Only the k x dim centroids pass through the driver; their size depends on the
parameters alone, not on the rows.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import shared_path

#: Rows of a tile: what one record of partial distances covers.
TILE = 4096
#: Components must stay below this in magnitude: the squared distance of 64 such fits a long.
COMPONENT_LIMIT = 1 << 27
_KINDS = ("<i1", "<i2", "<i4")


def _narrow(values: np.ndarray) -> tuple[int, bytes]:
    """(index of the narrowest kind that holds ``values``, their bytes)."""
    most = int(np.abs(values).max(initial=0))
    kind = 0 if most < 1 << 7 else 1 if most < 1 << 15 else 2
    return kind, values.astype(_KINDS[kind]).tobytes()


def _wide(kind: int, data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, _KINDS[kind]).reshape(-1, width).astype(np.int64)


def _widths(dim: int, block: int) -> list[tuple[int, int]]:
    return [(lo, min(lo + block, dim)) for lo in range(0, dim, block)]


def _make_shards(dim: int, block: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                ids, vectors = (c.slice(at, TILE) for c in batch.columns)
                flat = vectors.flatten().to_numpy(zero_copy_only=False)
                values = np.floor(scale * flat.reshape(-1, dim)).astype(np.int64)
                blocks = [_narrow(values[:, lo:hi]) for lo, hi in _widths(dim, block)]
                n = len(blocks)
                every = pa.ListArray.from_arrays(pa.array([0, *[len(ids)] * n], pa.int32()), ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([tile] * n, pa.int64()),
                        pa.array(range(n), pa.int32()),
                        pa.array([kind for kind, _ in blocks], pa.int32()),
                        pa.array([data for _, data in blocks], pa.binary()),
                        every,  # the ids stand with the first block
                    ],
                    ["tile", "block", "kind", "data", "ids"],
                )
                tile += 1

    return run


def _partial_distances(centroids, dim: int, block: int):
    """Rows (tile, block, kind, data) -> (tile, partial): the block's part of the
    squared distance of each row to each centroid."""

    def run(batches):
        k = centroids.value
        for batch in batches:
            out, sizes = [], []
            for b, kind, data in zip(*(c.to_pylist() for c in batch.columns[1:])):
                lo, hi = _widths(dim, block)[b]
                x = _wide(kind, data, hi - lo)
                part = np.empty((len(x), len(k)), np.int64)
                for j in range(len(k)):
                    part[:, j] = np.square(x - k[j, lo:hi]).sum(axis=1)
                sizes.append(len(x))
                out.append(part.astype("<i4" if part.max(initial=0) < 1 << 31 else "<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), pa.array(out, pa.binary())], ["tile", "rows", "partial"]
            )

    return run


def _reduce(k: int):
    """The blocks of a tile -> (tile, labels, distances): their sum's least
    entry, ties to the smaller number."""

    def run(table: pa.Table) -> pa.Table:
        total = None
        for p, n in zip(table.column("partial").to_pylist(), table.column("rows").to_pylist()):
            part = np.frombuffer(p, "<i4" if len(p) == 4 * n * k else "<i8").reshape(n, k).astype(np.int64)
            total = part if total is None else total + part
        labels = total.argmin(axis=1)
        least = total[np.arange(len(total)), labels]
        return pa.table(
            {
                "tile": table.column("tile").slice(0, 1),
                "labels": pa.array([labels.astype("<i4").tobytes()], pa.binary()),
                "distances": pa.array([least.astype("<i8").tobytes()], pa.binary()),
            }
        )

    return run


def _block_sums(k: int, dim: int, block: int):
    """Shards with their tile's labels -> (cluster, component, total, n), one row
    per task and entry."""

    def run(batches):
        totals, counts = np.zeros((k, dim), np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            for b, kind, data, labels in zip(*(c.to_pylist() for c in batch.columns)):
                lo, hi = _widths(dim, block)[b]
                x, own = _wide(kind, data, hi - lo), np.frombuffer(labels, "<i4")
                for j in np.unique(own):
                    mine = own == j
                    totals[j, lo:hi] += x[mine].sum(axis=0)
                    counts[j, lo:hi] += int(mine.sum())
        cluster, component = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster), pa.array(component), pa.array(totals[cluster, component]), pa.array(counts[cluster, component])],
            ["cluster", "component", "total", "n"],
        )

    return run


def _rows(batches):
    """(ids, labels, distances) of tiles -> (id, cluster, distance) of rows."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, labels, distances = (c.slice(i, 1) for c in batch.columns)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.flatten(),
                    pa.array(np.frombuffer(labels[0].as_py(), "<i4")),
                    pa.array(np.frombuffer(distances[0].as_py(), "<i8")),
                ],
                ["id", "cluster", "distance"],
            )


def lloyd(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    *,
    dim: int = 64,
    k: int = 16,
    rounds: int = 3,
    scale: int = 64,
    seed: str = "1",
    block: int = 16,
) -> tuple[DataFrame, list[list[int]]]:
    """((id, cluster, distance) per kept vector, the final centroids).

    A vector is kept if it has exactly ``dim`` components, none null or
    non-finite, and becomes the integers floor(``scale`` * x). Centroids start as
    the ``k`` kept vectors with the least sha256 of ``<seed>:<id>``, in ascending
    order. ``rounds`` times every vector goes to its nearest centroid (squared
    Euclidean distance, ties to the smaller number) and every non-empty centroid
    becomes the floor of its vectors' mean; then vectors are assigned once more.

    Rows sharing an id are vectors of their own; as start centroids they stand in
    the order of their components. Vectors with a null id are assigned but don't
    start a centroid. With fewer than ``k`` vectors there are fewer centroids. No
    kept vector (an empty table too) gives an empty result. Integers of 2^27 and
    more have no squared distance in a long; such vectors aren't kept. Other
    columns of ``df`` play no part.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    root = shared_path(spark, "centroids", uuid.uuid4().hex[:12])
    limit = COMPONENT_LIMIT / scale

    def fits(x):
        return x.isNotNull() & (F.abs(x) < limit)  # NaN counts as larger than any number

    vector = F.col(f"`{vector_col}`").cast("array<double>")
    kept = df.select(F.col(f"`{id_col}`").alias("id"), vector.alias("vector"))
    kept = kept.where((F.size("vector") == dim) & F.forall("vector", fits))

    id_type = kept.schema["id"].dataType
    shard_type = T.StructType(
        [
            T.StructField("tile", T.LongType()), T.StructField("block", T.IntegerType()), T.StructField("kind", T.IntegerType()),
            T.StructField("data", T.BinaryType()), T.StructField("ids", T.ArrayType(id_type)),
        ]
    )
    kept.mapInArrow(_make_shards(dim, block, scale), shard_type).write.partitionBy("block").parquet(f"{root}/shards")
    shards = spark.read.schema(shard_type).parquet(f"{root}/shards")

    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.where("id is not null").select("vector", order.alias("order")).orderBy("order", "vector").limit(k).collect()
    centroids = np.array([[math.floor(scale * x) for x in r["vector"]] for r in first], np.int64).reshape(-1, dim)
    k = len(centroids)
    if k == 0:
        none = "id is null and id is not null"
        return kept.where(none).select(F.col("id").alias(id_col), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []

    def assign():
        sent = sc.broadcast(centroids)
        parts = shards.select("tile", "block", "kind", "data").mapInArrow(
            _partial_distances(sent, dim, block), "tile long, rows int, partial binary"
        )
        return parts.groupBy("tile").applyInArrow(_reduce(k), "tile long, labels binary, distances binary")

    for _ in range(rounds):
        labelled = shards.join(assign().select("tile", "labels"), "tile").select("block", "kind", "data", "labels")
        sums = labelled.mapInArrow(_block_sums(k, dim, block), "cluster long, component long, total long, n long")
        sums = sums.groupBy("cluster", "component").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        for r in sums.collect():  # k * dim rows
            centroids[r["cluster"], r["component"]] = r["total"] // r["n"]

    ids = shards.where("block = 0").select("tile", "ids")
    tiles = ids.join(assign(), "tile").select("ids", "labels", "distances")
    rows_type = T.StructType([T.StructField("id", id_type), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    tiles.mapInArrow(_rows, rows_type).write.parquet(f"{root}/assigned")
    assigned = spark.read.schema(rows_type).parquet(f"{root}/assigned")
    return assigned.withColumnRenamed("id", id_col), centroids.tolist()


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``assigned`` with the distance summed over each row's cluster
    (cluster_inertia) and over all rows (inertia), and the sha256 of its
    centroid's components joined by commas (centroid_sha256)."""
    spark = assigned.sparkSession
    digests = [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids)]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = assigned.agg(F.sum("distance").alias("inertia"))
    # One row per centroid: k is a parameter, not a property of the data.
    each = sums.join(named, "cluster").join(F.broadcast(total))
    return assigned.join(F.broadcast(each), "cluster")
