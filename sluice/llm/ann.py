"""Approximate nearest neighbours by inner product: adaptive dimension scans.

Index. Every vector gets one more dimension that fills its norm up to the
largest norm of the table, so the largest inner product becomes the least
distance; all are rotated by one random rotation and go to the list of their
nearest centroid, stored as column blocks. Centroids are fitted on a bounded
sample; every row is indexed.

Search. A query scans its nearest lists. Its k-th nearest distance within the
sample bounds what it looks for from the start. Per list, all queries that scan
it add up squared distances one column block after another; after each block a
hypothesis test compares the partial distance, scaled up, with the distance of
the query's k-th candidate so far and abandons those significantly farther. While
many are left a block is one matrix product; then only the pairs that are left
go on. Survivors are scored exactly, in double precision, on the original
vectors, and tighten the query's bound for the lists after.

The number of lists a query scans is calibrated on the sample, so that about
``COVERAGE`` of its rows' nearest neighbours there lie in the lists scanned.

Lists are packed into tiles of bounded size and a list that holds more is dealt
over several; a query goes once to every tile that holds lists it scans. Very
many queries of one tile are cut into parts too. So a list that holds a third of
all rows, or that all queries scan, is spread over many tasks.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import shared_path

#: Vectors the centroids are fitted on, the first by hash of their id.
SAMPLE = 16_384
#: Columns of a block, candidates and queries of a tile.
BLOCK_COLUMNS = 16
TILE_ROWS, TILE_QUERIES = 4_096, 32_768
#: Queries handled at once inside a tile, and pairs of a query and a row.
_QUERIES, _PAIRS = 256, 1 << 18
#: Share of pairs left from which on single pairs go on instead of whole blocks.
_SPARSE = 0.2
#: Significance of the test: partial distances may exceed their share by EPSILON / sqrt(columns).
EPSILON = 2.1
#: Share of nearest neighbours that the scanned lists should hold, and the sample queries that measure it.
COVERAGE, CALIBRATION = 0.97, 256
_ITERATIONS = 12


@dataclass(frozen=True)
class Index:
    centroids: np.ndarray  # lists x (dim + 1), rotated
    rotation: np.ndarray
    largest: float
    dim: int
    probes: int
    sample: np.ndarray  # rotated, float32, and the list of each row: what bounds a search
    own: np.ndarray


def _usable(vector: str = "v") -> str:
    """SQL: no null, NaN or infinite component, and not all zero."""
    return (
        f"{vector} is not null and size({vector}) > 0 "
        f"and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('inf')) "
        f"and exists({vector}, x -> x <> 0)"
    )


def _augment(x: np.ndarray, largest: float) -> np.ndarray:
    """Vectors (float64) with the dimension that fills up their norm, 0 for queries."""
    rest = np.maximum(largest**2 - (x**2).sum(axis=1), 0.0)
    return np.c_[x, np.sqrt(rest)]


def fit(vectors: DataFrame, k: int) -> Index | None:
    """Centroids from the SAMPLE first of ``vectors`` (id, v; all of one length)
    by hash of id; the norm bound and the number of lists from all of them."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    n, largest, dim = vectors.agg(F.count(F.lit(1)), F.max(norm), F.max(F.size("v"))).first()
    if not n:
        return None
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()
    sample = np.array(rows.column("v").to_pylist(), np.float64)
    rng = np.random.default_rng(11)
    rotation, _ = np.linalg.qr(rng.normal(size=(dim + 1, dim + 1)))
    x = _augment(sample, largest) @ rotation
    lists = max(1, min(int(math.sqrt(n)), len(x) // 16))
    centroids = x[rng.choice(len(x), lists, replace=False)]
    for _ in range(_ITERATIONS):
        near = _nearest(x, centroids, 1)[:, 0]
        count = np.bincount(near, minlength=lists)
        total = np.zeros_like(centroids)
        np.add.at(total, near, x)
        centroids = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centroids)
    asked = np.c_[sample[:CALIBRATION], np.zeros(min(len(sample), CALIBRATION))] @ rotation
    own = _nearest(x, centroids, 1)[:, 0]
    probes = _calibrate(sample, own, _nearest(asked, centroids, lists), k)
    return Index(centroids, rotation, float(largest), int(dim), probes, x.astype(np.float32), own)


def _calibrate(sample: np.ndarray, own: np.ndarray, order: np.ndarray, k: int) -> int:
    """Fewest lists that hold COVERAGE of the sample queries' nearest neighbours.
    Neighbours in a sample are farther than in the whole table, so this errs on
    the side of more lists."""
    ranks = []
    for q, lists in enumerate(order):
        score = sample @ sample[q]
        score[q] = -np.inf
        near = np.argsort(-score, kind="stable")[: min(k, len(sample) - 1)]
        place = np.empty(len(lists), np.int64)
        place[lists] = np.arange(len(lists))
        ranks.append(place[own[near]])
    found = np.sort(np.concatenate(ranks))
    return int(found[math.ceil(COVERAGE * len(found)) - 1]) + 1 if len(found) else 1


def _nearest(x: np.ndarray, centroids: np.ndarray, k: int) -> np.ndarray:
    """The k nearest centroids of each row, nearest first."""
    out = []
    norms = (centroids**2).sum(axis=1)
    for lo in range(0, len(x), 4096):
        d = norms - 2 * (x[lo : lo + 4096] @ centroids.T)
        out.append(np.argsort(d, axis=1, kind="stable")[:, :k])
    return np.concatenate(out) if out else np.zeros((0, k), np.int64)


def _list_of(shared):
    """Rows (list, id, rotated, v) of vectors."""

    def run(batches):
        index = shared.value
        for batch in batches:
            ids, x = batch.column(0), _matrix(batch.column(1), index.dim)
            rotated = _augment(x, index.largest) @ index.rotation
            yield pa.RecordBatch.from_arrays(
                [pa.array(_nearest(rotated, index.centroids, 1)[:, 0]), ids, _packed(rotated.astype(np.float32)), _packed(x)],
                ["list", "id", "rotated", "v"],
            )

    return run


def _sample_bounds(queries: np.ndarray, scanned: np.ndarray, index: Index, k: int) -> np.ndarray:
    """Squared distance within which each query has k rows of the sample besides
    itself in the lists it scans (so that many are found); infinite without."""
    out = np.full(len(queries), np.inf)
    if len(index.sample) <= k:
        return out
    norms = (index.sample.astype(np.float64) ** 2).sum(axis=1)
    for lo in range(0, len(queries), _QUERIES):
        q, lists = queries[lo : lo + _QUERIES], scanned[lo : lo + _QUERIES]
        held = np.zeros((len(q), len(index.centroids)), bool)
        np.put_along_axis(held, lists, True, axis=1)
        d = (q**2).sum(axis=1)[:, None] + norms - 2 * (q.astype(np.float32) @ index.sample.T)
        d[~held[:, index.own]] = np.inf
        out[lo : lo + _QUERIES] = np.partition(d, k, axis=1)[:, k]
    return out * (1 + 1e-4) + 1e-3


def _tiles_of(shared, first: np.ndarray, parts: np.ndarray, k: int):
    """Rows (tile, lists, bound, id, rotated, v) of queries: once for every tile
    that holds lists the query scans, with these lists, nearest first."""

    def run(batches):
        index = shared.value
        for batch in batches:
            ids, x = batch.column(0), _matrix(batch.column(1), index.dim)
            rotated = np.c_[x, np.zeros(len(x))] @ index.rotation
            near = _nearest(rotated, index.centroids, index.probes)
            bound = pa.array(_sample_bounds(rotated, near, index, k))
            row, tile, lists = [], [], []
            for i, scanned in enumerate(near):
                held: dict[int, list[int]] = {}
                for x_list in scanned.tolist():
                    for t in range(first[x_list], first[x_list] + parts[x_list]):
                        held.setdefault(t, []).append(x_list)
                row += [i] * len(held)
                tile += held.keys()
                lists += held.values()
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tile, pa.int64()), pa.array(lists, pa.list_(pa.int32())), bound.take(take), ids.take(take),
                    _packed(rotated.astype(np.float32)).take(take), _packed(x).take(take),
                ],
                ["tile", "lists", "bound", "id", "rotated", "v"],
            )

    return run


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(vectors.flatten(), np.float64).reshape(-1, dim)


def _packed(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _limits(bound: np.ndarray, rounding: np.ndarray, hi: int, dim: int) -> np.ndarray:
    """The largest partial distance over ``hi`` of ``dim`` columns with which a
    candidate isn't significantly farther than ``bound``."""
    slack = (1 + EPSILON / math.sqrt(hi)) ** 2 if hi < dim else 1 + 1e-4
    return bound * slack * (hi / dim) + rounding


def survivors(queries: np.ndarray, x: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) of positions that no test abandons, for the rotated
    ``queries`` (few) and rows ``x`` of one list and a bound per query."""
    dim = x.shape[1]
    partial = np.zeros((len(queries), len(x)), np.float32)
    # Distances from norms and products in float32 are this uncertain.
    rounding = 4e-6 * ((queries**2).sum(axis=1) + (x**2).sum(axis=1).max(initial=0)).astype(np.float64)
    lo = 0
    while True:  # whole blocks, as long as many pairs are left
        hi = min(lo + BLOCK_COLUMNS, dim)
        q, r = queries[:, lo:hi], x[:, lo:hi]
        partial += (q**2).sum(axis=1)[:, None] + (r**2).sum(axis=1) - 2 * (q @ r.T)
        keep = partial <= _limits(bound, rounding, hi, dim)[:, None]
        lo = hi
        if lo == dim or np.count_nonzero(keep) <= _SPARSE * keep.size:
            break
    which, row = np.nonzero(keep)
    left = [(which[at : at + _PAIRS], row[at : at + _PAIRS], partial[which[at : at + _PAIRS], row[at : at + _PAIRS]]) for at in range(0, len(row), _PAIRS)]
    found = []
    for i, j, d in left:
        for low in range(lo, dim, BLOCK_COLUMNS):
            high = min(low + BLOCK_COLUMNS, dim)
            diff = x[j, low:high] - queries[i, low:high]
            d = d + np.einsum("ij,ij->i", diff, diff)
            stay = d <= _limits(bound, rounding, high, dim)[i]
            i, j, d = i[stay], j[stay], d[stay]
        found.append((i, j))
    if not found:
        return which, row
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


def _prefix_bound(query: np.ndarray, x: np.ndarray, k: int) -> float:
    """A squared distance within which ``query`` has k of the rows ``x`` (more
    than k): of those that look nearest after each column block, the best."""
    partial, bound = np.zeros(len(x), np.float32), np.inf
    for lo in range(0, x.shape[1], BLOCK_COLUMNS):
        partial += np.square(x[:, lo : lo + BLOCK_COLUMNS] - query[lo : lo + BLOCK_COLUMNS]).sum(axis=1)
        first = np.argpartition(partial, k - 1)[:k]
        bound = min(bound, float(np.square(x[first] - query).sum(axis=1).max()))
    return bound


def scan(query: np.ndarray, x: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Those of ``rows`` of ``x`` that may be among the k nearest of one ``query``."""
    if len(rows) <= k:
        return rows
    bound = np.array([_prefix_bound(query, x[rows], k)])
    return rows[survivors(query[None, :], x[rows], bound)[1]]


def _best(found: list[tuple], k: int) -> tuple:
    """(query, id, score) of the k best of each query, ordered by query and rank."""
    q, ids, score = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((ids, -score, q))
    q, ids, score = q[order], ids[order], score[order]
    start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.r_[start, len(q)]))
    top = rank < k
    return q[top], ids[top], score[top]


def _search_tile(k: int, largest: float):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(rows):
            rows = rows.sort_values(["list", "id"], kind="stable")
            ids, lists = rows["id"].to_numpy(), rows["list"].to_numpy()
            x = np.frombuffer(b"".join(rows["rotated"]), np.float32).reshape(len(rows), -1)
            v = np.frombuffer(b"".join(rows["v"]), np.float64).reshape(len(rows), -1)
            names, starts = np.unique(lists, return_index=True)
            ends = [*starts[1:].tolist(), len(lists)]
            for lo in range(0, len(queries), _QUERIES):
                some = queries.iloc[lo : lo + _QUERIES]
                asked = some["id"].to_numpy()
                q = np.frombuffer(b"".join(some["rotated"]), np.float32).reshape(len(some), -1)
                original = np.frombuffer(b"".join(some["v"]), np.float64).reshape(len(some), -1)
                bound = some["bound"].to_numpy(np.float64).copy()
                norm = (original**2).sum(axis=1)
                scans: dict[int, list[int]] = {}
                for i, held in enumerate(some["lists"]):
                    for name in held.tolist():
                        scans.setdefault(name, []).append(i)
                best = (np.zeros(0, np.int64), np.zeros(0, ids.dtype), np.zeros(0))
                for name, s, e in zip(names.tolist(), starts.tolist(), ends):
                    own = np.array(scans.get(name, []), np.int64)
                    if not len(own):
                        continue
                    for u in own[np.isinf(bound[own])] if e - s > k + 1 else ():
                        bound[u] = _prefix_bound(q[u], x[s:e], k + 1) * (1 + 1e-4)  # one may be the query itself
                    i, j = survivors(q[own], x[s:e], bound[own])
                    i, j = own[i], j + s
                    other = ids[j] != asked[i]
                    i, j = i[other], j[other]
                    score = np.empty(len(i))
                    for at in range(0, len(i), _PAIRS):
                        score[at : at + _PAIRS] = (v[j[at : at + _PAIRS]] * original[i[at : at + _PAIRS]]).sum(axis=1)
                    best = _best([best, (i, ids[j], score)], k)
                    # The k-th best score as a distance in the filled-up space bounds what follows.
                    full = np.flatnonzero(np.bincount(best[0], minlength=len(some)) == k)
                    last = np.searchsorted(best[0], full, side="right") - 1
                    bound[full] = np.minimum(bound[full], largest**2 + norm[full] - 2 * best[2][last])
                found.append(pd.DataFrame({"query_id": asked[best[0]], "vec_id": best[1], "score": best[2]}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return run


def _pack(sizes: dict[int, int], lists: int) -> tuple[np.ndarray, np.ndarray]:
    """(first tile, number of tiles) of every list: small lists share a tile of
    about TILE_ROWS rows, larger ones get as many tiles as they need."""
    first, parts = np.zeros(lists, np.int64), np.zeros(lists, np.int64)
    tile, room = -1, 0
    for x in range(lists):
        n = sizes.get(x, 0)
        if n > TILE_ROWS:
            first[x], parts[x] = tile + 1, -(-n // TILE_ROWS)
            tile, room = tile + int(parts[x]), 0
        elif n:
            if n > room:
                tile, room = tile + 1, TILE_ROWS
            first[x], parts[x] = tile, 1
            room -= n
    return first, parts


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors`` found with the
    largest inner product for every row of ``queries`` but the query's own id.

    Ties go to the smaller id. Vectors that are null, zero, hold a null or a
    non-finite component or have a null id take no part. Vectors of different
    lengths have no inner product: each length is searched among its own, with an
    index of its own. Fewer candidates than k: all that were found. Rows sharing
    an id are separate candidates.
    """
    spark = vectors.sparkSession

    def clean(df):
        return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("v")).where(
            f"id is not null and {_usable()}"
        )

    rows, asked = clean(vectors), clean(queries)
    lengths = [r["dim"] for r in rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1))).orderBy("dim").collect()]
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for i, dim in enumerate(lengths):
        found = _nearest_of_length(rows.where(F.size("v") == dim), asked.where(F.size("v") == dim), k)
        out = out.unionByName(found) if i else found
    return out


def _nearest_of_length(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``nearest`` for clean vectors (id, v) of one length."""
    spark = rows.sparkSession
    index = fit(rows, k)
    shared = spark.sparkContext.broadcast(index)
    lists = len(index.centroids)
    path = shared_path(spark, "ann", uuid.uuid4().hex[:12])
    columns = "id long, rotated binary, v binary"
    rows.mapInArrow(_list_of(shared), f"list long, {columns}").write.parquet(path)
    listed = spark.read.schema(f"list long, {columns}").parquet(path)
    # One number per list, and there are at most SAMPLE / 16 lists.
    sizes = {r["list"]: r["n"] for r in listed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, parts = _pack(sizes, lists)
    tiles = spark.createDataFrame([(x, int(first[x]), int(parts[x])) for x in sizes], "list long, first long, parts long")
    dealt = F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))
    listed = listed.join(F.broadcast(tiles), "list").select(dealt.alias("tile"), "list", "id", "rotated", "v")

    parts_of_queries = max(1, -(-asked.count() // TILE_QUERIES))
    asked = asked.mapInArrow(_tiles_of(shared, first, parts, k), f"tile long, lists array<int>, bound double, {columns}")
    asked = asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts_of_queries)))
    listed = listed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts_of_queries - 1).cast("long"))))
    # A cell of a tile and a part is the unit of work: about two tasks for each, however small its bytes are.
    cells = 2 * int((first + parts).max()) * parts_of_queries
    found = (
        asked.repartition(cells, "tile", "part").groupBy("tile", "part")
        .cogroup(listed.repartition(cells, "tile", "part").groupBy("tile", "part"))
        .applyInPandas(_search_tile(k, index.largest), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
