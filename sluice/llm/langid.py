"""Language identification by prediction by partial matching (PPM).

Each language has a variable-order context tree over bytes. A byte's code
length is that of its longest kept context; a byte new there is coded by an
escape (method C: distinct successors / (visits + distinct successors)) and the
next shorter context, whose probabilities are shared over the bytes that the
longer one has not seen. Below order 0 all 256 bytes are equally likely.
Statistics are frozen after training, so the code length of a text is a sum of
table entries, and the least sum names the language.

Training counts every training text in full; tasks count their own n-grams,
Spark adds them up. Every context seen is kept. The most visited ones
(``CONTEXTS``, within ``TABLE_BYTES``) are a dense table of contexts, bytes and
languages; the others are sorted arrays of the bytes seen after them and of one
escape cost per language and context, looked up by binary search. Which contexts
are dense changes the speed and no code length. The driver and every task hold
the whole model: 12 bytes for a distinct gram of a language outside the table.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.batches import append_columns, text_slices

ORDER = 3
#: Contexts of the dense table per order, the most visited over all languages.
CONTEXTS = {0: 1, 1: 256, 2: 4096, 3: 16384}
#: Most bytes of the dense table; the contexts beyond it are looked up.
TABLE_BYTES = 96 << 20
UNKNOWN = "und"
_PAD = b"\x00" * ORDER

_LETTER = re.compile(r"[^\W\d_]")


def _prepared(text: bytes) -> bytes:
    return text.decode("utf-8", "replace").lower().encode("utf-8", "replace")


def _padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, each after ORDER pad bytes; bounds of each with its pad)."""
    flat = np.frombuffer(b"".join(_PAD + t for t in texts), np.uint8)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + ORDER for t in texts], out=bounds[1:])
    return flat, bounds


def _grams(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The (ORDER + 1)-byte gram ending at every byte that isn't a pad."""
    x = flat.astype(np.uint32)
    gram = (x[:-3] << np.uint32(24)) | (x[1:-2] << np.uint32(16)) | (x[2:-1] << np.uint32(8)) | x[3:]
    keep = np.ones(len(gram), bool)
    for k in range(1, ORDER + 1):  # grams that end in the pad of the next text
        at = bounds[1:-1] - 1 - ORDER + k
        keep[at[(at >= 0) & (at < len(gram))]] = False
    return gram[keep]


def _count_grams(batches):
    """Rows (lang, gram, n) of a task's texts."""
    totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    waiting: dict[str, list] = {}

    def settle(lang):
        parts = waiting.pop(lang, [])
        if not parts:
            return
        keys, counts = np.unique(np.concatenate(parts), return_counts=True)
        if lang in totals:
            keys = np.concatenate([totals[lang][0], keys])
            counts = np.concatenate([totals[lang][1], counts])
            keys, back = np.unique(keys, return_inverse=True)
            counts = np.bincount(back, counts).astype(np.int64)
        totals[lang] = (keys, counts)

    for batch in batches:
        column = batch.column(0)
        langs = batch.column(1).to_pylist()
        for lo, hi in text_slices(column, 4 << 20):
            by_lang: dict[str, list] = {}
            for t, lang in zip(column.slice(lo, hi - lo).cast(pa.binary()).to_pylist(), langs[lo:hi]):
                by_lang.setdefault(lang, []).append(_prepared(t))
            for lang, texts in by_lang.items():
                flat, bounds = _padded(texts)
                if len(flat) > ORDER:
                    waiting.setdefault(lang, []).append(_grams(flat, bounds))
                    settle(lang) if sum(map(len, waiting[lang])) > 1 << 20 else None
    for lang in list(waiting):
        settle(lang)
    for lang, (keys, counts) in totals.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(counts.astype(np.int64))],
            ["lang", "gram", "n"],
        )


@dataclass(frozen=True)
class Ppm:
    langs: list
    symbol: np.ndarray  # byte -> symbol
    contexts: np.ndarray  # packed context symbols -> row of the longest dense suffix
    bits: np.ndarray  # (row * symbols + symbol, lang) code lengths in bits
    symbols: int
    orders: np.ndarray  # row -> order of its context
    grams: np.ndarray  # sorted _key of each byte seen after a context that isn't dense ...
    gram_bits: np.ndarray  # ... and its code length
    escapes: np.ndarray  # sorted _key of each context that isn't dense ...
    escape_bits: np.ndarray  # ... and what an escape from it costs


def train(df: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> Ppm | None:
    """Fit on all rows of ``df`` with a text and a language; None if there are none.

    Null texts, null and empty languages teach nothing. Every language and
    every byte seen counts, however rare.
    """
    rows = df.select(
        F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")
    ).where("text is not null and text <> '' and lang is not null and lang <> ''")
    counts = rows.mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = counts.toArrow().combine_chunks()
    if found.num_rows == 0:
        return None
    coded = pc.dictionary_encode(found.column("lang")).combine_chunks()
    coded = coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded
    names = coded.dictionary.to_pylist()
    langs = sorted(names)
    place = np.array([langs.index(x) for x in names], np.int64)
    return _build(
        langs, place[np.asarray(coded.indices)], np.asarray(found.column("gram")).astype(np.int64), np.asarray(found.column("n")).astype(np.int64)
    )


def _key(lang, order: int, bytes_):
    """One number for a gram or context (up to 4 bytes) of an order of a language."""
    return (lang << 34) | (order << 32) | bytes_


def _levels(lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(lang, tail, n) per order, sorted: how often each language has each gram
    of a coded byte (the last one) and ``order`` bytes before it."""
    levels = []
    for order in range(ORDER + 1):
        key, back = np.unique((lang << 32) | (gram & ((1 << (8 * (order + 1))) - 1)), return_inverse=True)
        levels.append((key >> 32, key & 0xFFFFFFFF, np.bincount(back, n, len(key)).astype(np.int64)))
    return levels


def _dense_contexts(levels: list, coded: int, langs: int) -> list[np.ndarray]:
    """The contexts of the dense table per order, sorted. All suffixes of a dense context are dense."""
    room = TABLE_BYTES // (4 * coded * langs) - 1
    kept = [np.zeros(1, np.int64)]
    for order in range(1, ORDER + 1):
        _, tail, n = levels[order]
        context, back = np.unique(tail >> 8, return_inverse=True)
        visits = np.bincount(back, n, len(context))
        suffix = np.isin(context & ((1 << (8 * (order - 1))) - 1), kept[-1])
        context, visits = context[suffix], visits[suffix]
        top = np.lexsort((context, -visits))[: max(0, min(CONTEXTS[order], room))]
        kept.append(np.sort(context[top]))
        room -= len(top)
    return kept


def _sparse(levels: list, dense: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(grams, gram_bits, escapes, escape_bits) of all contexts that aren't dense."""
    grams, gram_bits, escapes, escape_bits = [], [], [], []
    shorter_key = shorter_p = None
    for order, (lang, tail, n) in enumerate(levels):
        context = (lang << 32) | (tail >> 8)
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
        distinct = np.diff(np.r_[first, len(context)])
        total = np.add.reduceat(n, first) + distinct
        p = n / np.repeat(total, distinct)
        if order:
            # A byte seen after a context is seen after its suffix too.
            parent = shorter_p[np.searchsorted(shorter_key, (lang << 32) | (tail & ((1 << (8 * order)) - 1)))]
            mass = np.maximum(1 - np.add.reduceat(parent, first), 1e-12)
            rare = ~np.isin(tail >> 8, dense[order])
            grams.append(_key(lang, order, tail)[rare])
            gram_bits.append(-np.log2(p[rare]))
            rare = rare[first]
            escapes.append(_key(lang[first], order, tail[first] >> 8)[rare])
            escape_bits.append(np.log2(total * mass / distinct)[rare])
        shorter_key, shorter_p = (lang << 32) | tail, p

    def ordered(keys, bits):
        keys, bits = np.concatenate(keys), np.concatenate(bits).astype(np.float32)
        order = np.argsort(keys)
        return keys[order], bits[order]

    return *ordered(grams, gram_bits), *ordered(escapes, escape_bits)


def _build(langs: list, lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Ppm:
    levels = _levels(lang, gram, n)
    seen = np.unique(levels[0][1])
    symbol = np.full(256, len(seen), np.int64)  # bytes never seen share one more symbol ...
    symbol[seen] = np.arange(len(seen))
    pad = len(seen) + 1  # ... and the pad before a text is a symbol of contexts only
    size = len(seen) + 2
    coded = len(seen) + 1
    symbol[0] = pad if 0 not in seen else symbol[0]
    tables = []
    contexts = np.zeros(size**ORDER, np.int32)
    row_of: dict[int, dict[int, int]] = {}
    rows = 0
    dense = _dense_contexts(levels, coded, len(langs))
    for order, kept in enumerate(dense):
        lang, tail, n = levels[order]
        inside = np.isin(tail >> 8, kept)
        lang, tail, n = lang[inside], tail[inside], n[inside].astype(np.float64)
        table = np.zeros((len(langs), len(kept), coded))
        np.add.at(table, (lang, np.searchsorted(kept, tail >> 8), symbol[tail & 0xFF]), n)
        if order == 0:
            parent = np.zeros((len(langs), 1, coded))
            parent[:, :, : len(seen)] = 1 / 256
            parent[:, :, len(seen)] = (256 - len(seen)) / 256 if len(seen) < 256 else 1 / 256
        else:
            parent = np.concatenate(tables, axis=1)[:, [_suffix_row(row_of, c, order) for c in kept.tolist()], :] if len(kept) else np.zeros((len(langs), 0, coded))
        tables.append(_escape_c(table, parent))
        row_of[order] = {c: rows + i for i, c in enumerate(kept.tolist())}
        rows += len(kept)
        # Contexts in symbols: every packed context whose last `order` symbols are these.
        for c, row in row_of[order].items():
            s = [symbol[(c >> (8 * k)) & 0xFF] for k in range(order)]  # newest first
            code = sum(int(v) * size**k for k, v in enumerate(s))
            contexts[code :: size**order] = row
    p = np.concatenate(tables, axis=1)
    # One entry per byte: bytes never seen in training share the last symbol's probability equally.
    unseen = max(1, 256 - len(seen))
    p[:, :, len(seen)] /= unseen
    bits = -np.log2(p).astype(np.float64)
    bits = np.ascontiguousarray(bits.transpose(1, 2, 0).reshape(-1, len(langs)), dtype=np.float32)
    orders = np.repeat(np.arange(ORDER + 1), [len(kept) for kept in dense])
    return Ppm(langs, symbol, contexts, bits, size, orders, *_sparse(levels, dense))


def _suffix_row(row_of: dict, context: int, order: int) -> int:
    """Row of the longest kept proper suffix of a context of ``order`` bytes."""
    for k in range(order - 1, -1, -1):
        row = row_of[k].get(context & ((1 << (8 * k)) - 1))
        if row is not None:
            return row
    raise AssertionError("order 0 is always kept")


def _escape_c(counts: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Probabilities of every symbol in every context: seen ones by frequency,
    the escape mass over unseen ones in proportion to the parent's."""
    visits = counts.sum(axis=2, keepdims=True)
    seen = counts > 0
    distinct = seen.sum(axis=2, keepdims=True)
    left = np.where(seen, 0.0, parent)
    mass = left.sum(axis=2, keepdims=True)
    total = np.maximum(visits + distinct, 1)
    out = np.where(seen, counts / total, np.where(mass > 0, left / np.where(mass > 0, mass, 1) * distinct / total, 0.0))
    return np.where(visits > 0, np.maximum(out, 1e-12), parent)


def _find(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of ``asked`` are in the sorted ``keys``, the values of those)."""
    if not len(keys):
        return np.zeros(len(asked), bool), values[:0]
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    hit = keys[at] == asked
    return hit, values[at[hit]]


def _looked_up(model: Ppm, gram: np.ndarray, order: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """Code lengths of grams whose longest dense context has ``order`` bytes and
    gives ``dense``: from the longest context seen, which may be longer."""
    out = np.zeros(dense.shape, np.float32)
    for lang in range(len(model.langs)):
        cost, pending = np.zeros(len(gram), np.float32), np.ones(len(gram), bool)
        for k in range(ORDER, 0, -1):
            at = np.flatnonzero(pending & (order < k))
            tail = gram[at] & ((1 << (8 * (k + 1))) - 1)
            hit, bits = _find(model.grams, model.gram_bits, _key(lang, k, tail))
            cost[at[hit]] += bits
            pending[at[hit]] = False
            at, tail = at[~hit], tail[~hit]
            hit, bits = _find(model.escapes, model.escape_bits, _key(lang, k, tail >> 8))
            cost[at[hit]] += bits
        out[:, lang] = cost + np.where(pending, dense[:, lang], 0)
    return out


def code_lengths(model: Ppm, texts: list[bytes]) -> np.ndarray:
    """Bits of every text under every language (float64, one row per text)."""
    out = np.zeros((len(texts), len(model.langs)))
    flat, bounds = _padded(texts)
    coded = model.bits.shape[0] // max(1, int(model.contexts.max()) + 1)
    s = model.symbol[flat]
    step = 1 << 20
    starts = np.zeros(len(flat), bool)
    for k in range(ORDER):
        starts[bounds[:-1] + k] = True
    for lo in range(ORDER, len(flat), step):
        hi = min(lo + step, len(flat))
        code = (s[lo - 3 : hi - 3] * model.symbols + s[lo - 2 : hi - 2]) * model.symbols + s[lo - 1 : hi - 1]
        row = model.contexts[code]
        cost = model.bits[row.astype(np.int64) * coded + np.minimum(s[lo:hi], coded - 1)]
        loose = np.flatnonzero((model.orders[row] < ORDER) & ~starts[lo:hi]) if len(model.grams) else []
        if len(loose):
            at = loose + lo
            gram = (flat[at - 3].astype(np.int64) << 24) | (flat[at - 2].astype(np.int64) << 16) | (flat[at - 1].astype(np.int64) << 8) | flat[at]
            gram, first, back = np.unique(gram, return_index=True, return_inverse=True)
            first = loose[first]
            cost[loose] = _looked_up(model, gram, model.orders[row[first]], cost[first])[back]
        cost[starts[lo:hi]] = 0
        text = np.searchsorted(bounds, [lo, hi - 1], side="right") - 1
        cuts = np.maximum(bounds[text[0] : text[1] + 1] - lo, 0)
        out[text[0] : text[1] + 1] += np.add.reduceat(cost, cuts, axis=0, dtype=np.float64)
    return out


def predictor(model: Ppm | None):
    """texts -> (languages, scores): the posterior of the least code length."""

    def work(texts):
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        decoded = [t.decode("utf-8", "replace").lower() if t else "" for t in texts]
        known = [i for i, t in enumerate(decoded) if _LETTER.search(t)] if model else []
        if known:
            bits = code_lengths(model, [decoded[i].encode("utf-8", "replace") for i in known])
            best = bits.argmin(axis=1)
            gap = np.minimum((bits - bits[np.arange(len(known)), best][:, None]) * math.log(2), 700)
            share = 1 / np.exp(-gap).sum(axis=1)
            for i, b, p in zip(known, best.tolist(), share.tolist()):
                langs[i], scores[i] = model.langs[b], p
        return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

    return work


def identify(df: DataFrame, model: Ppm | None, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its ``keep`` columns) plus lang_pred and score.

    A null text, one without a letter, and any text under an empty model get
    ``und`` and score 0. Equal code lengths go to the first language in
    alphabetical order. Columns with the result's names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return append_columns(df, text_col, fields, lambda: predictor(shared.value), keep=keep)
