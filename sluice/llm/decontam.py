"""Benchmark decontamination: a prefix-filtered set join with exact windows.

A window is 13 consecutive words of a benchmark item (a shorter item is one
window). Its tokens are its 3-word shingles, ordered by rarity in the corpus.
A text that contains the window holds every token, so the rarest one is a
necessary prefix: only places where it occurs are candidates. Its offset in
the window fixes where the window would start and end (positional and length
bounds), and the words there are compared exactly.

Document frequencies cover the whole corpus. The benchmark is cut into blocks
of at most ``BLOCK_WINDOWS`` windows, each broadcast for one pass over the
documents, so memory is bounded for benchmarks of any size.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.batches import append_columns
from sluice.llm.wordhash import NON_ALNUM, Words
from sluice.session import shared_path

WINDOW_WORDS = 13
SHINGLE_WORDS = 3
#: Windows broadcast at once; a larger benchmark takes several passes.
BLOCK_WINDOWS = 100_000
_FILTER_BITS = 22


def item_windows(text: bytes | None, width: int = WINDOW_WORDS) -> set[tuple[bytes, ...]]:
    """The distinct windows of one benchmark item."""
    words = Words([text], NON_ALNUM)
    seq = [words.buf[s:e].tobytes() for s, e in zip(words.start.tolist(), words.end.tolist())]
    if not seq:
        return set()
    size = min(width, len(seq))
    return {tuple(seq[i : i + size]) for i in range(len(seq) - size + 1)}


@dataclass
class Index:
    """One block of windows, looked up by shingle hash."""

    shingle_sizes: tuple[int, ...] = ()
    windows: list = field(default_factory=list)  # word tuples
    hashes: list = field(default_factory=list)  # word hashes per window
    items: list = field(default_factory=list)  # item ids per window
    tokens: list = field(default_factory=list)  # (shingle size, shingle hashes) per window

    def add(self, window: tuple[bytes, ...], items: list[str]) -> None:
        words = Words([b" ".join(window)], NON_ALNUM)
        size = min(SHINGLE_WORDS, len(window))
        self.windows.append(window)
        self.hashes.append(words.hash)
        self.items.append(items)
        self.tokens.append((size, words.shingles(size)))
        self.shingle_sizes = tuple(sorted({*self.shingle_sizes, size}))


class _Lookup:
    """Membership of 64-bit hashes in a fixed set: a bit table, then binary search."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.table = np.zeros(1 << _FILTER_BITS, bool)
        self.table[self.keys >> np.uint64(64 - _FILTER_BITS)] = True

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions whose hash is in the set, index of each in ``keys``)."""
        at = np.flatnonzero(self.table[hashes >> np.uint64(64 - _FILTER_BITS)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        found = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        hit = self.keys[found] == hashes[at]
        return at[hit], found[hit]


def _sized(index: Index, size: int) -> np.ndarray:
    found = [h for s, h in index.tokens if s == size]
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _frequencies(df: DataFrame, text_col: str, index: Index) -> dict[tuple[int, int], int]:
    """Documents holding each shingle of the block, over all of ``df``: counted
    per task, then summed. The result is bounded by the block's shingles."""
    shared = df.sparkSession.sparkContext.broadcast({s: np.unique(_sized(index, s)) for s in index.shingle_sizes})

    def count(batches):
        lookups = {s: _Lookup(keys) for s, keys in shared.value.items()}
        totals = {s: np.zeros(len(lk.keys), np.int64) for s, lk in lookups.items()}
        from sluice.llm.batches import text_slices

        for batch in batches:
            column = batch.column(0)
            for lo, hi in text_slices(column):
                words = Words(column.slice(lo, hi - lo).cast(pa.binary()).to_pylist(), NON_ALNUM)
                for size, lookup in lookups.items():
                    at, key = lookup.places(words.shingles(size))
                    text = np.searchsorted(words.first, at, side="right") - 1
                    inside = at + size <= words.first[text + 1]
                    pairs = np.unique(np.stack([text[inside], key[inside]]), axis=1)
                    np.add.at(totals[size], pairs[1], 1)
        for size, lookup in lookups.items():
            some = np.flatnonzero(totals[size])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(some), size, np.int32)),
                    pa.array(lookup.keys[some].view(np.int64)),
                    pa.array(totals[size][some]),
                ],
                ["size", "shingle", "n"],
            )

    counted = df.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(
        count, "size int, shingle long, n long"
    )
    rows = counted.groupBy("size", "shingle").agg(F.sum("n").alias("n")).collect()
    return {(r["size"], r["shingle"] & 0xFFFFFFFFFFFFFFFF): r["n"] for r in rows}


def _prefixes(index: Index, frequency: dict) -> dict[int, dict[int, list[tuple[int, int]]]]:
    """Per shingle size: rarest shingle of a window -> (window, offset of the shingle)."""
    out: dict[int, dict[int, list]] = {s: defaultdict(list) for s in index.shingle_sizes}
    for w, (size, shingles) in enumerate(index.tokens):
        ordered = sorted((frequency.get((size, int(h)), 0), int(h), o) for o, h in enumerate(shingles))
        _, key, offset = ordered[0]
        out[size][key].append((w, offset))
    return {s: dict(p) for s, p in out.items()}


def _search(index: Index, prefixes: dict):
    """Worker: per text its number of words, merged hit spans and items."""

    def make_state():
        lookups = {}
        for size, table in prefixes.items():
            lookup = _Lookup(np.fromiter(table, np.uint64, len(table)))
            lookups[size] = (lookup, [table[int(k)] for k in lookup.keys])
        return lookups

    def make():
        lookups = make_state()

        def work(texts):
            words = Words(texts, NON_ALNUM)
            spans: dict[int, list] = defaultdict(list)
            items: dict[int, set] = defaultdict(set)
            for size, (lookup, entries) in lookups.items():
                at, key = lookup.places(words.shingles(size))
                owner = np.searchsorted(words.first, at, side="right") - 1
                for p, k, t in zip(at.tolist(), key.tolist(), owner.tolist()):
                    lo, hi = words.first[t], words.first[t + 1]
                    for w, offset in entries[k]:
                        start = p - offset
                        end = start + len(index.windows[w])
                        if start >= lo and end <= hi and _same(words, start, end, index.hashes[w], index.windows[w]):
                            spans[t].append((int(start - lo), int(end - lo)))
                            items[t].update(index.items[w])
            sizes = np.diff(words.first)
            return (
                pa.array(sizes, pa.int64()),
                pa.array(
                    [[{"s": s, "e": e} for s, e in _merged(spans[t])] if t in spans else [] for t in range(len(texts))],
                    pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])),
                ),
                pa.array([sorted(items[t]) if t in items else [] for t in range(len(texts))], pa.list_(pa.string())),
            )

        return work

    return make


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Union of half-open spans, sorted."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _same(words: Words, start: int, end: int, hashes: np.ndarray, window: tuple) -> bool:
    if not np.array_equal(words.hash[start:end], hashes):
        return False
    return all(
        words.buf[words.start[i] : words.end[i]].tobytes() == w for i, w in zip(range(start, end), window)
    )


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> list[DataFrame]:
    """Distinct windows with their items, dealt into blocks of bounded size."""

    def cut(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            out = [(i, b" ".join(w)) for i, t in zip(ids, texts) for w in item_windows(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in out], pa.string()), pa.array([w for _, w in out], pa.binary())], ["item", "window"]
            )

    source = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("i"), F.col(f"`{text_col}`").cast("string").alias("t"))
    windows = source.where("t is not null").mapInArrow(cut, "item string, window binary").distinct()
    n = windows.select("window").distinct().count()
    blocks = max(1, -(-n // BLOCK_WINDOWS))
    part = F.pmod(F.xxhash64("window"), F.lit(blocks))
    return [windows.where(part == b) for b in range(blocks)] if n else []


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """The ``keep`` columns of ``docs`` (default: the id) plus n_words, n_hit,
    n_items, items_sha256 and contaminated, one row per row of ``docs``.

    Words are runs of [a-z0-9] and non-ASCII characters, A-Z lower-cased. A
    word inside any occurrence of a window is hit; ``contaminated`` means
    n_hit > 0 and 20 * n_hit >= n_words. Null and empty texts have no words and
    are never hit. Items without words are left out; items sharing an id are one
    item. Windows of items with a null id hit like any other; such items have no
    id to list or count. With an empty benchmark nothing is hit.
    Columns of ``docs`` with the result's names are replaced; so are columns
    whose names begin with two underscores.
    """
    spark = docs.sparkSession
    kept = [id_col] if keep is None else keep
    if text_col not in kept:
        out = docs.select(*[F.col(f"`{c}`") for c in [*kept, text_col]])
    else:
        out = docs.select(*[F.col(f"`{c}`") for c in kept])
    blocks = _blocks(benchmark, item_col, item_text_col)
    root = shared_path(spark, "decontam", uuid.uuid4().hex[:12])
    n_words, spans, items = "__words", [], []
    span_type = T.ArrayType(T.StructType([T.StructField("s", T.LongType()), T.StructField("e", T.LongType())]))
    for b, block in enumerate(blocks or [None]):
        index = Index()
        rows = block.groupBy("window").agg(F.collect_set("item").alias("items")).collect() if block is not None else []
        for row in sorted(rows, key=lambda r: bytes(r["window"])):
            index.add(tuple(bytes(row["window"]).split(b" ")), sorted(row["items"]))
        prefixes = _prefixes(index, _frequencies(out, text_col, index) if rows else {})
        fields = [
            T.StructField(n_words, T.LongType()),
            T.StructField(f"__spans{b}", span_type),
            T.StructField(f"__items{b}", T.ArrayType(T.StringType())),
        ]
        spans.append(f"__spans{b}"), items.append(f"__items{b}")
        out = append_columns(out, text_col, fields, _shared_search(spark, index, prefixes))
        if len(blocks) > 1:
            out.write.mode("overwrite").parquet(f"{root}/block_{b}")
            out = spark.read.parquet(f"{root}/block_{b}")
    # Words under the union of the spans: spans sorted by start, each counted from the furthest end so far.
    all_spans = F.array_sort(F.flatten(F.array(*spans)))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    covered = F.aggregate(
        all_spans,
        zero,
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), x["e"] - F.greatest(acc["end"], x["s"]))).alias("n"),
            F.greatest(acc["end"], x["e"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    out = out.withColumn("__hit", covered).withColumn("__all", F.array_sort(F.array_distinct(F.flatten(F.array(*items)))))
    names = {"n_words", "n_hit", "n_items", "items_sha256", "contaminated"}
    return out.select(
        *[F.col(f"`{c}`") for c in kept if c not in names],
        F.col(n_words).alias("n_words"),
        F.col("__hit").alias("n_hit"),
        F.size("__all").cast("long").alias("n_items"),
        F.sha2(F.array_join("__all", ","), 256).alias("items_sha256"),
        ((F.col("__hit") > 0) & (20 * F.col("__hit") >= F.col(n_words))).alias("contaminated"),
    )


def _shared_search(spark, index: Index, prefixes: dict):
    shared = spark.sparkContext.broadcast((index, prefixes))
    return lambda: _search(*shared.value)()
