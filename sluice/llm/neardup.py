"""Near-duplicate classes of documents: MinHash, banding, verification, components.

1. A task hashes a text's word shingles, takes the minimum of each of several
   hundred universal hash functions over the set, and combines the minima into
   band keys (no shuffle). One byte per minimum stays as the signature.
2. Texts with equal shingle sets form a class by a digest of the set; only the
   class representative goes on.
3. Representatives that share a band key are candidates. A bucket never emits
   all its pairs: first its smallest id, the pivot, is compared with the
   others. Members of buckets that still hold several components meet again in
   buckets by the rarest tokens of their sets, which any two sets that reach
   the threshold share (prefix filter, with length and positional bounds).
   There pivots are compared with members of other components, in rounds with
   more pivots each, until no bucket holds an uncompared pair of different
   components. So no candidate link is lost, and a group of near copies costs
   about one comparison per member.
4. Candidates pass a signature check, then an exact count on the full sets.
5. Components come from alternating large-star and small-star.

Bands are chosen so that a pair exactly at the threshold shares none with a
probability of at most ``MISS``; more similar pairs, less.
"""

from __future__ import annotations

import hashlib
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.batches import append_columns, text_slices
from sluice.llm.stars import Save, components
from sluice.llm.wordhash import SPACES, Words, text_shingles
from sluice.session import shared_path

MISS = 1e-6
MAX_HASHES = 320
#: Signature agreement may fall this many standard deviations below the threshold.
SIGMAS = 5.0
#: Pivots of a token bucket in its first round, and how many times more in each next one.
FIRST_PIVOTS, PIVOT_GROWTH = 64, 64
#: Bits of the slots in which token rarity is counted.
SKETCH_BITS = 18


def bands_for(percent: int) -> tuple[int, int]:
    """(minima per band, bands) for a similarity of ``percent`` / 100: the
    widest bands whose number keeps the miss probability within MISS."""
    t = percent / 100
    for rows in range(12, 0, -1):
        bands = math.ceil(math.log(MISS) / math.log1p(-(t**rows))) if t < 1 else 1
        if rows * bands <= MAX_HASHES:
            return rows, bands
    return 1, MAX_HASHES


def _hash_functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(977)
    odd = rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd, rng.integers(0, 1 << 32, n, dtype=np.uint32)


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 4096) -> np.ndarray:
    """Minimum of a*x + b (mod 2^32) per function over the shingle hashes."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(x), block):
        values = np.multiply.outer(a, x[lo : lo + block])
        values += b[:, None]
        np.minimum(best, values.min(axis=1), out=best)
    return best


def _signature_worker(shingle: int, percent: int):
    rows, bands = bands_for(percent)

    def make():
        a, b = _hash_functions(rows * bands)

        def work(texts):
            counts, keys, sigs, band_keys = [], [], [], []
            for s in text_shingles(Words(texts, SPACES), shingle):
                counts.append(len(s))
                if len(s) == 0:
                    keys.append(None), sigs.append(None), band_keys.append(None)
                    continue
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                m = minima(s, a, b)
                sigs.append((m >> np.uint32(24)).astype(np.uint8).tobytes())
                band_keys.append(
                    [
                        int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8, key=b"%d" % i).digest(), "little", signed=True)
                        for i, x in enumerate(m.reshape(bands, rows))
                    ]
                )
            return (
                pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary()),
                pa.array(band_keys, pa.list_(pa.int64())),
            )

        return work

    return make


def signatures(df: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """(id, n_shingles, set_key, sig, bands) per row; the last three are null
    for a text without words."""
    fields = [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_key", T.BinaryType()),
        T.StructField("sig", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
    source = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return append_columns(source, "text", fields, _signature_worker(shingle, percent), keep=["id"])


def _open(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Bucket rows with their component ``c``, of buckets that hold more than
    one. ``labels``: (u, v) component of each node that isn't the least of its own."""
    rows = buckets.withColumn("c", F.col("id"))
    if labels is not None:
        rows = buckets.join(labels.select(F.col("u").alias("id"), F.col("v").alias("label")), "id", "left")
        rows = rows.select(*buckets.columns, F.coalesce("label", "id").alias("c"))
    stats = rows.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
    return rows.join(stats, "key", "left_semi")


def _next_pairs(rows: DataFrame, pivots: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(pairs to compare, the rows without this round's pivots).

    ``rows``: (key, id, n, pos, c) of open buckets: the size of the id's set
    and the position of the key among its ordered tokens. At most the tokens
    from there on are common, which bounds the overlap.
    """
    # The smallest ids of a bucket: groups are cut to `pivots` rows before the shuffle.
    rank = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    pivot = rows.withColumn("rank", rank).where(F.col("rank") <= pivots)
    pivot = pivot.select("key", F.col("id").alias("a"), F.col("c").alias("ca"), F.col("n").alias("na"), F.col("pos").alias("ia"))
    overlap = F.least(F.col("n") - F.col("pos"), F.col("na") - F.col("ia"))
    pairs = (
        rows.join(pivot, "key")
        .where(F.expr("a < id and c <> ca") & ((100 + percent) * overlap >= percent * (F.col("n") + F.col("na"))))
        .select("a", F.col("id").alias("b"))
        .distinct()
    )
    rest = rows.drop("c").join(pivot.select("key", F.col("a").alias("id")), ["key", "id"], "left_anti")
    return pairs, rest


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _count_slots(shingle: int):
    """Rows (slot, n): how many sets of a task hold a shingle of each slot."""

    def run(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for lo, hi in text_slices(batch.column(0)):
                texts = batch.column(0).slice(lo, hi - lo).cast(pa.binary()).to_pylist()
                for s in text_shingles(Words(texts, SPACES), shingle):
                    total += np.bincount(_slots(s), minlength=len(total)) if len(s) > 4096 else 0
                    if len(s) <= 4096:
                        np.add.at(total, _slots(s), 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["slot", "n"])

    return run


def _prefix_tokens(shingle: int, percent: int, sketch):
    """Rows (key, id, n, pos): the necessary prefix of each set, its rarest
    tokens. Any two sets that reach the threshold share one of them."""

    def run(batches):
        counts = sketch.value
        for batch in batches:
            for lo, hi in text_slices(batch.column(1)):
                texts = batch.column(1).slice(lo, hi - lo).cast(pa.binary()).to_pylist()
                keys, owner, size, pos = [], [], [], []
                for i, s in enumerate(text_shingles(Words(texts, SPACES), shingle)):
                    n = len(s)
                    take = n - -(-percent * n // 100) + 1 if n else 0
                    rarest = np.lexsort((s, counts[_slots(s)]))[:take]
                    keys.append(s[rarest])
                    owner += [i] * take
                    size += [n] * take
                    pos += range(take)
                flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
                ids = batch.column(0).slice(lo, hi - lo).take(pa.array(owner, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat.view(np.int64)), ids, pa.array(size, pa.int64()), pa.array(pos, pa.int64())],
                    ["key", "id", "n", "pos"],
                )

    return run


def _prefix_buckets(texts: DataFrame, id_type: T.DataType, shingle: int, percent: int) -> DataFrame:
    """Texts (id, text) by the rarest tokens of their sets. Rarity is counted
    over these texts in a sketch of 2^SKETCH_BITS slots; tokens of one slot are
    as rare as all of them together, which can only lengthen buckets."""
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    slots = texts.select("text").mapInArrow(_count_slots(shingle), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = slots.toArrow()
    counts[np.asarray(found.column("slot"))] = np.asarray(found.column("n"))
    sketch = texts.sparkSession.sparkContext.broadcast(counts)
    schema = T.StructType(
        [T.StructField("key", T.LongType()), T.StructField("id", id_type), T.StructField("n", T.LongType()), T.StructField("pos", T.LongType())]
    )
    return texts.select("id", "text").mapInArrow(_prefix_tokens(shingle, percent, sketch), schema)


def _signature_check(percent: int):
    """Keeps pairs whose minima agree about as often as the threshold asks."""
    rows, bands = bands_for(percent)
    n, t = rows * bands, percent / 100
    # One byte of a minimum agrees by chance once in 256 times.
    least = n * (t + (1 - t) / 256) - SIGMAS * math.sqrt(n * t * (1 - t) + 1)

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, y = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, n) for i in (2, 3)
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(
                pa.array((x == y).sum(axis=1) >= least)
            )

    return run


def _exact_check(shingle: int, percent: int):
    """Keeps pairs with 100 * intersection >= percent * union of the full sets."""

    def run(batches):
        last, last_set = None, None
        for batch in batches:
            a_ids, b_ids = batch.column(0), batch.column(1)
            ok = []
            for a, ta, tb in zip(a_ids.to_pylist(), batch.column(2).cast(pa.binary()), batch.column(3).cast(pa.binary())):
                tb = tb.as_py()
                if last_set is None or a != last[0] or ta.as_py() != last[1]:
                    last = (a, ta.as_py())
                    last_set = text_shingles(Words([last[1]], SPACES), shingle)[0]
                other = text_shingles(Words([tb], SPACES), shingle)[0]
                common = len(np.intersect1d(last_set, other, assume_unique=True))
                union = len(last_set) + len(other) - common
                ok.append(bool(union) and 100 * common >= percent * union)
            yield pa.RecordBatch.from_arrays([a_ids, b_ids], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    shingle: int = 5,
    percent: int = 80,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``df``.

    Words are runs of bytes other than space and \\t..\\r, with A-Z lower-cased;
    a text's set is its distinct runs of ``shingle`` words (fewer words: the
    whole sequence). Texts with 100 * intersection >= ``percent`` * union are
    linked; ``component_id`` is the least id reachable and ``kept`` marks it.

    Null and empty texts, and texts of white space: 0 shingles, linked with
    nothing, kept. Rows with a null id: component_id null, kept. Rows sharing
    an id are one node. An empty table gives an empty result. Other columns of
    ``df`` play no part.
    """
    spark = df.sparkSession
    root = shared_path(spark, "neardup", uuid.uuid4().hex[:12])

    def save(frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{root}/{name}")

    sigs = save(signatures(df, id_col, text_col, shingle, percent), "signatures")
    has_set = sigs.where("set_key is not null and id is not null")
    classes = has_set.groupBy("set_key").agg(F.min("id").alias("rep"))
    reps = classes.select(F.col("rep").alias("id"))

    banded = has_set.select("id", "n_shingles", "bands").join(reps, "id", "left_semi")
    banded = banded.select("id", "n_shingles", F.posexplode("bands").alias("band", "key"))
    banded = banded.select(
        F.xxhash64("band", "key").alias("key"), "id", F.col("n_shingles").alias("n"), F.lit(0).cast("long").alias("pos")
    )
    shared = banded.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key")
    buckets = save(banded.join(shared, "key", "left_semi"), "buckets")

    labels = _link(df, id_col, text_col, sigs, buckets, shingle, percent, save)
    labels = _same_id(has_set, classes, labels, save)

    node = classes.join(labels.select(F.col("u").alias("rep"), F.col("v").alias("label")), "rep", "left").select(
        "set_key", F.coalesce("label", "rep").alias("component_id")
    )
    return (
        sigs.select("id", "n_shingles", "set_key")
        .join(node, "set_key", "left")
        .select(
            F.col("id").alias(id_col),
            "n_shingles",
            F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(f"`{id_col}`") == F.col("component_id"), F.lit(True)))
    )


def _same_id(has_set: DataFrame, classes: DataFrame, labels: DataFrame, save: Save) -> DataFrame:
    """``labels`` with the classes of rows that share an id joined: one id is one
    node, whatever texts it has."""
    several = has_set.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    rows = has_set.select("id", "set_key").join(several, "id", "left_semi").distinct().join(classes, "set_key")
    least = rows.groupBy("id").agg(F.min("rep").alias("v"), F.max("rep").alias("most")).where("v < most")
    shared = save(rows.join(least.select("id", "v"), "id").where("rep <> v").select(F.col("rep").alias("u"), "v").distinct(), "same_id")
    if shared.isEmpty():
        return labels
    return components(labels.select("u", "v").unionByName(shared), save, "stars_same_id")


def _link(df, id_col, text_col, sigs, buckets, shingle, percent, save: Save) -> DataFrame:
    """Star forest (u, v) of the verified links among the bucketed ids."""
    none = buckets.select(F.col("id").alias("u"), F.col("id").alias("v")).where("false")
    if buckets.isEmpty():
        return none
    whole = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    texts = save(whole.where("text is not null").join(buckets.select("id").distinct(), "id", "left_semi"), "texts")
    sig = sigs.where("sig is not null").select("id", "sig")

    def verified(pairs: DataFrame, step: int) -> DataFrame:
        pairs = save(pairs, f"pairs_{step}")
        signed = (
            pairs.join(sig.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sig.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b")
            .select("a", "b", "sa", "sb")
        )
        likely = save(signed.mapInArrow(_signature_check(percent), pairs.schema), f"likely_{step}")
        with_texts = (
            likely.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
            .join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
            .select("a", "b", "ta", "tb")
        )
        return with_texts.mapInArrow(_exact_check(shingle, percent), pairs.schema).select(
            F.col("a").alias("u"), F.col("b").alias("v")
        )

    # One pivot per band bucket settles most groups of copies ...
    pairs, _ = _next_pairs(_open(buckets, None), 1, percent)
    labels = components(verified(pairs, 0), save, "stars_0")
    # ... the members of buckets still open meet again by their rarest tokens.
    unsettled = save(_open(buckets, labels).select("id").distinct(), "unsettled")
    if unsettled.isEmpty():
        return labels
    rest = _prefix_buckets(texts.join(unsettled, "id", "left_semi"), buckets.schema["id"].dataType, shingle, percent)
    pivots, step = FIRST_PIVOTS, 0
    while True:
        step += 1
        rows = save(_open(rest, labels), f"open_{step}")
        if rows.isEmpty():
            return labels
        pairs, rest = _next_pairs(rows, pivots, percent)
        labels = components(verified(pairs, step).unionByName(labels), save, f"stars_{step}")
        pivots *= PIVOT_GROWTH
