"""SimHash near-duplicate classes by deletion-variant signatures.

1. A task hashes every shingle of a text, repeats included, with XXH64 and
   takes the majority of each bit (no shuffle). Only (id, fingerprint) goes on;
   equal fingerprints form one node.
2. The 64 bits are cut into two segments of 32. Two fingerprints with at most
   two differing bits have a segment that differs by one bit at most, so they
   agree on one of its one-wildcard variants: the segment without one bit. Every
   node is indexed under its 64 variants; variants held by one node are dropped.
3. Nodes join on equal variants, with the bit count of the full fingerprints in
   the join condition: only verified links leave the join.
4. A variant that more than ``BUCKET`` nodes hold isn't joined. Its nodes are
   indexed by every fingerprint one bit away instead: two fingerprints with at
   most two differing bits have such a neighbour in common, all that share one
   are linked, and at most 65 fingerprints can. So hot variants cost 65 rows a
   node, no pairs, and lose no link.
5. Components come from alternating large-star and small-star.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.batches import append_columns
from sluice.llm.stars import Save, components
from sluice.session import shared_path

SEED = 42
MAX_BITS = 2
#: Nodes of a variant compared with each other; larger ones go by common neighbours.
BUCKET = 128
#: Shingles whose bits are counted at once.
_BLOCK = 1 << 15

_TRANSLATE = bytes(
    0x20 if b == 0x20 or 0x09 <= b <= 0x0D else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)
)


def _shingle_spans(texts: list, width: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(words of all texts with one space after each, start and end of each
    shingle in them, number of shingles of each text)."""
    sizes = np.fromiter((len(t) + 1 if t else 1 for t in texts), np.int64, len(texts))
    raw = np.frombuffer(b" ".join([t or b"" for t in texts]).translate(_TRANSLATE) + b" ", np.uint8)
    space = raw == 0x20
    ends = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(sizes, out=bounds[1:])
    first = np.searchsorted(ends, bounds)
    keep = ~space
    keep[ends] = True
    packed = raw[keep]
    end = np.flatnonzero(packed == 0x20)
    start = np.concatenate([np.zeros(1, np.int64), end[:-1] + 1]) if len(end) else end
    words = np.diff(first)
    count = np.where(words >= width, words - width + 1, np.minimum(words, 1))
    # Shingle i of a text begins at its word i and ends `width` words on, or at its last word.
    begin = np.repeat(first[:-1], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    last = np.minimum(begin + width, np.repeat(first[1:], count)) - 1
    return packed.tobytes(), start[begin], end[last], count


def fingerprints(texts: list, width: int) -> np.ndarray:
    """Unsigned 64-bit fingerprint per text (UTF-8 bytes; None counts as empty)."""
    data, start, end, count = _shingle_spans(texts, width)
    ones = np.zeros((len(texts), 64), np.int64)
    owner = np.repeat(np.arange(len(texts)), count)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, len(start), _BLOCK):
        spans = zip(start[lo : lo + _BLOCK].tolist(), end[lo : lo + _BLOCK].tolist())
        hashes = np.array([digest(data[i:j], SEED) for i, j in spans], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[lo : lo + _BLOCK]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1])
        ones[own[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
    major = 2 * ones > count[:, None]
    return np.packbits(major, axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)


def _worker(width: int):
    def make():
        return lambda texts: (pa.array(fingerprints(texts, width).view(np.int64)),)

    return make


def _variants(nodes: DataFrame) -> DataFrame:
    """(key, fp): every node under the one-wildcard variants of its segments. The
    key holds the 32 bits of the segment without bit number ``b`` and ``b`` itself."""
    segment = "shiftrightunsigned(fp, 32 * (b >> 5)) & 4294967295L & ~shiftleft(1L, b & 31)"
    every = nodes.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("b"))
    return every.select(F.expr(f"shiftleft({segment}, 6) + b").alias("key"), "fp")


def _joined(buckets: DataFrame) -> DataFrame:
    """Links (u, v) between nodes that share a variant. Equal segments share all
    32 variants of theirs and are compared under the first one alone."""
    x, y = buckets.select("key", F.col("fp").alias("u")), buckets.select("key", F.col("fp").alias("v"))
    differs = "shiftrightunsigned(u ^ v, cast(32 * ((key >> 5) & 1) as int)) & 4294967295L"
    condition = F.expr(f"u < v and bit_count(u ^ v) <= {MAX_BITS} and (key & 31 = 0 or ({differs}) <> 0)")
    return x.join(y, "key").where(condition).select("u", "v").distinct()


def _by_neighbours(nodes: DataFrame) -> DataFrame:
    """Links (u, v) that join all nodes with a common fingerprint at one bit or
    none from each: at most 65 of them, every two linked."""
    near = nodes.select(F.explode(F.sequence(F.lit(0), F.lit(64))).alias("b"), "fp").select(
        F.expr("fp ^ case when b < 64 then shiftleft(1L, b) else 0L end").alias("near"), "fp"
    )
    met = near.groupBy("near").agg(F.collect_set("fp").alias("all")).where("size(all) > 1")
    star = met.select(F.explode("all").alias("u"), F.array_min("all").alias("v")).where("u <> v")
    return star.distinct()


def links(nodes: DataFrame, save: Save) -> DataFrame:
    """Pairs (u, v) of fingerprints (column ``fp``, each once) with at most two
    differing bits: of nodes with a common variant all, of nodes in hot variants
    as many as connect them alike."""
    variants = _variants(nodes)
    sizes = variants.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = save(variants.join(sizes, "key"), "buckets")
    hot = save(buckets.where(F.col("n") > BUCKET).select("fp").distinct(), "hot")
    return _joined(buckets.where(F.col("n") <= BUCKET)).unionByName(_by_neighbours(hot))


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 5
) -> DataFrame:
    """(id, fingerprint, component_id) for every row of ``df``.

    Words are runs of bytes other than space and \\t..\\r, with A-Z lower-cased;
    a text's shingles are all its runs of ``shingle`` words, repeats included
    (fewer words: the whole sequence). A bit of the fingerprint is 1 if it is set
    in over half their hashes. Fingerprints (16 hex digits) with at most
    ``MAX_BITS`` differing bits are linked; ``component_id`` is the least id
    reachable, the row's own included.

    Null and empty texts, and texts of white space: fingerprint zero, linked like
    any other. Rows with a null id are linked too but give no component id, which
    is null where no row of the component has an id. Rows sharing an id are one
    row each. An empty table gives an empty result. Other columns play no part.
    """
    spark = df.sparkSession
    root = shared_path(spark, "simhash", uuid.uuid4().hex[:12])

    def save(frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{root}/{name}")

    source = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    marked = append_columns(source, "text", [T.StructField("fp", T.LongType())], _worker(shingle), keep=["id"])
    marked = save(marked, "fingerprints")
    nodes = save(marked.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    labels = components(save(links(nodes.select("fp"), save), "links"), save)
    placed = nodes.join(labels.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left")
    placed = placed.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    node = placed.join(least, "root").select("fp", "component_id")
    return marked.join(node, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
