"""Toxicity of texts: noisy-channel restoration, then a classifier on restored text.

Restoration. A disguised word (digits or symbols for letters, letters set
apart, letters repeated) is a character lattice: each source character may
stand for itself, for a letter it resembles, for a word break, or for nothing.
Viterbi decoding finds the cheapest path under the channel's costs and a
character trigram model counted over the whole corpus. Words whose lattice has
one path only (no letter twice in a row, no lookalike, no gap but at an end)
are their own decoding and skip the search; so do those without any letter
(numbers, punctuation). Words are decoded together where they are single
characters ("i - d - i - o - t"), or where the model alone holds their joined
reading for cheaper than the break between them by more than a join costs
("stu pid"); gap characters that stand alone between two words are part of the break.

Scoring. Features are letter n-grams of 4 to 6 bytes (a leading space marks the
start of a word) and whole words of the restored text. Those much more frequent
in toxic texts enter a logistic regression. It is fitted on at most
``MAX_LABELLED`` labelled texts; the character model covers every text.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.batches import append_columns, text_slices
from sluice.llm.wordhash import SPACES, Words

#: Labelled texts the classifier is fitted on, the first by hash of their id.
MAX_LABELLED = 20_000
#: Most frequent n-grams of toxic texts that are tested for selection, and features selected.
MAX_CANDIDATES, MAX_FEATURES = 200_000, 2_000
#: Least log-likelihood ratio statistic of a selected feature (chance level about 1e-6).
MIN_G2 = 24.0
GRAMS = (4, 5, 6)
#: Bytes of text whose n-grams are all held at once while features are counted.
TRAINING_SLICE = 1 << 18

# Channel: symbols and the letters they resemble (fixed values).
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
# Costs in bits of reading a character otherwise than as itself.
COST = {"letter": 1.0, "nothing": 4.0, "repeat": 1.0, "gap": 0.5, "break": 2.0, "join": 12.0}
GAPS = " ._-*~'\u200b\u00ad"
#: Steps of the search after which the part shared by all paths is written out.
TRACE_STEPS = 1024
#: Decoded spans a task remembers and the most bytes of one; emptied when full, which changes no result.
REMEMBERED_SPANS, REMEMBERED_BYTES = 200_000, 64

_SYMBOLS = 28  # break, a-z, any other letter
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[65:91] = np.arange(1, 27)
_CLASS[128:] = 27
_LETTER = (_CLASS > 0)
_LEET = np.zeros(256, bool)
_LEET[[ord(c) for c in LOOKALIKES if ord(c) < 128]] = True
_GAP = np.zeros(256, bool)
_GAP[[ord(c) for c in GAPS if ord(c) < 128]] = True
_GAP[0x20] = False
# Symbols at the two ends of a break; marks that close a sentence are no letters there,
# and other letters than a-z, which the model knows as one symbol, are never joined.
_END = _CLASS.copy()
for _c, _letters in LOOKALIKES.items():
    if ord(_c) < 128 and (_c.isdigit() or _c in "@$"):
        _END[ord(_c)] = ord(_letters[0]) - 96

# Lower case, and a space for every ASCII byte that is no letter.
_TO_LETTERS = bytes((b + 32 if 65 <= b < 91 else b if 97 <= b < 123 or b >= 128 else 32) for b in range(256))


# ---------------------------------------------------------------- character model


def _count_trigrams(batches):
    total = np.zeros(_SYMBOLS**3, np.int64)
    for batch in batches:
        column = batch.column(0)
        for lo, hi in text_slices(column):
            data = b"  ".join(t for t in column.slice(lo, hi - lo).cast(pa.binary()).to_pylist() if t)
            c = _CLASS[np.frombuffer(b"  " + data + b"  ", np.uint8)]
            c = c[np.r_[True, (c[1:] > 0) | (c[:-1] > 0)]].astype(np.int64)
            c = np.r_[0, c]
            total += np.bincount((c[:-2] * _SYMBOLS + c[1:-1]) * _SYMBOLS + c[2:], minlength=len(total))
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["code", "n"])


def character_model(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """Bits of a symbol after two others, over all texts of ``df``; 28^3 entries."""
    rows = (
        df.select(F.col(f"`{text_col}`").cast("string").alias("text"))
        .mapInArrow(_count_trigrams, "code long, n long")
        .groupBy("code").agg(F.sum("n").alias("n")).collect()
    )
    n3 = np.zeros(_SYMBOLS**3)
    for r in rows:
        n3[r["code"]] = r["n"]
    n3 = n3.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)
    n2, n1 = n3.sum(axis=0), n3.sum(axis=(0, 1))
    p1 = (n1 + 1) / (n1.sum() + _SYMBOLS)
    p2 = (n2 + 8 * p1) / (n2.sum(axis=1, keepdims=True) + 8)
    p3 = (n3 + 8 * p2[None]) / (n3.sum(axis=2, keepdims=True) + 8)
    return -np.log2(p3)


# ---------------------------------------------------------------- restoration


_LATIN = {chr(96 + s): s for s in range(1, 27)}


def _symbol(c: str) -> int:
    return _LATIN.get(c, 27)


def _wide_spaces(span: str) -> dict[int, list[tuple[str, float]]]:
    """Readings of the spaces between two words that aren't both single
    characters: the first one breaks, or joins at a cost; the others are nothing."""
    found: dict[int, list[tuple[str, float]]] = {}
    words = [w.span() for w in re.finditer(r"\S+", span) if not all(c in GAPS for c in w.group())]
    for (s, e), (s2, e2) in zip(words, words[1:]):
        if e - s > 1 or e2 - s2 > 1:
            spaces = [i for i in range(e, s2) if span[i] == " "]
            found.update((i, [("", 0.0)]) for i in spaces[1:])
            found.update((i, [(" ", 0.0), ("", COST["join"])]) for i in spaces[:1])
    return found


def _readings(span: str):
    before = ""
    wide = _wide_spaces(span) if " " in span else {}
    for i, c in enumerate(span):
        if i in wide:
            before = ""
            yield wide[i]
            continue
        if c.isalpha():
            edges = [(c, 0.0)]
            if c == before:
                edges.append(("", COST["repeat"]))
        elif c in LOOKALIKES:
            edges = [(x, COST["letter"]) for x in LOOKALIKES[c]]
            edges += [("", COST["nothing"]), (" ", COST["break"])]
        elif c in GAPS:
            yield [("", COST["gap"]), (" ", COST["break"])]
            continue  # a gap doesn't end a run of one letter
        else:
            edges = [(" ", 0.0)]
        before = c
        yield edges


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """Readings (text, bits) of each character of a lower-case span: a letter,
    nothing (""), or a word break (" ")."""
    return list(_readings(span))


def restore(span: str, bits) -> str:
    """Cheapest reading of a span of any length: Viterbi over (last two symbols).

    Each step keeps, per state, the place of its predecessor and what was read.
    What all live paths share is written out and forgotten, which changes no
    result: time is linear in the span, and memory is what the paths differ in.
    Among equally cheap readings the one met first is taken.
    """
    costs: dict[tuple[int, int], float] = {(0, 0): 0.0}
    steps: list[tuple[array, list[str]]] = []
    done: list[str] = []
    full = TRACE_STEPS
    for edges in _readings(span):
        if len(costs) == 1 and len(edges) == 1 and not steps and edges[0][0].isalpha():
            # One path so far, one reading: nothing to choose.
            ((a, b), cost), (reading, extra) = next(iter(costs.items())), edges[0]
            s = _symbol(reading)
            costs = {(b, s): cost + extra + bits[a][b][s]}
            done.append(reading)
            continue
        after: dict[tuple[int, int], float] = {}
        back: dict[tuple[int, int], tuple[int, str]] = {}
        for place, ((a, b), cost) in enumerate(costs.items()):
            for reading, extra in edges:
                total, now = cost + extra, reading
                if reading == "":
                    state = (a, b)
                elif reading == " ":
                    if b == 0:
                        state, now = (a, b), ""
                    else:
                        state, total = (b, 0), total + bits[a][b][0]
                else:
                    s = _symbol(reading)
                    state, total = (b, s), total + bits[a][b][s]
                known = after.get(state)
                if known is None or total < known:
                    after[state], back[state] = total, (place, now)
        costs = after
        steps.append((array("H", [back[state][0] for state in after]), [back[state][1] for state in after]))
        if len(after) == 1:
            done.append(_read_back(steps, 0))
            steps.clear()
        elif len(steps) >= full:
            done.append(_shared_prefix(steps))
            full = 2 * len(steps) + TRACE_STEPS
    ends = [cost + (bits[a][b][0] if b else 0.0) for (a, b), cost in costs.items()]
    done.append(_read_back(steps, ends.index(min(ends))))
    return "".join(done).strip()


def _read_back(steps, place: int) -> str:
    """What the path that ends at ``place`` of the last step read."""
    out = []
    for places, read in reversed(steps):
        out.append(read[place])
        place = places[place]
    return "".join(reversed(out))


def _shared_prefix(steps) -> str:
    """Takes off ``steps`` those that all live paths share; what was read in them."""
    live = set(range(len(steps[-1][0]))) if steps else set()
    for at in range(len(steps) - 1, -1, -1):
        if len(live) == 1:
            place = live.pop()
            text = _read_back(steps[: at + 1], place)
            del steps[: at + 1]
            return text
        live = {steps[at][0][p] for p in live}
    return ""


#: ASCII that has one reading at an end of a word, a break or nothing.
_EDGE = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in LOOKALIKES)
#: A lower-case word without its _EDGE whose lattice has more than one path.
_AMBIGUOUS = re.compile(rf"[{re.escape(''.join(LOOKALIKES) + GAPS)}]|([^\W\d_])\1")


class Restorer:
    def __init__(self, bits: np.ndarray):
        self.bits = bits.tolist()
        # Bits that joining two words saves: by the last two symbols of one and
        # the first of the other, and by the last of one and the first two of the other.
        self._before = (bits[:, :, :1] + bits[None, :, 0, :] - bits).astype(np.float32).ravel()
        self._after = (bits[0][None] - bits).astype(np.float32).ravel()
        self.memory: dict[bytes, bytes] = {}

    def _decode(self, span: bytes) -> bytes:
        known = self.memory.get(span)
        if known is None:
            text = span.decode("utf-8", "replace").lower()
            core = text.strip(_EDGE)
            known = span
            if _AMBIGUOUS.search(core) and any(c.isalpha() for c in core):
                known = restore(core, self.bits).encode("utf-8")
                if known.split() == span.translate(_TO_LETTERS).split():
                    known = span  # read as it is written
            if len(span) <= REMEMBERED_BYTES:
                if len(self.memory) >= REMEMBERED_SPANS:
                    self.memory.clear()
                self.memory[span] = known
        return known

    def texts(self, texts: list) -> list[bytes]:
        """The texts with every disguised word restored (None as empty)."""
        words = Words(texts, SPACES)
        if not len(words.start):
            return [t or b"" for t in texts]
        spans = self._spans(words, joins=True)
        if not spans:
            return [t or b"" for t in texts]
        out: list = [None] * len(texts)
        by_text: dict[int, list] = defaultdict(list)
        owner = np.searchsorted(words.bounds, [s for s, _ in spans], side="right") - 1
        for t, span in zip(owner.tolist(), spans):
            by_text[t].append(span)
        for t, found in by_text.items():
            base, raw = int(words.bounds[t]), texts[t]
            parts, at = [], 0
            for s, e in sorted(found):
                parts += [raw[at : s - base], self._decode(raw[s - base : e - base])]
                at = e - base
            parts.append(raw[at:])
            out[t] = b"".join(parts)
        return [o if o is not None else (t or b"") for o, t in zip(out, texts)]

    def _spans(self, words: Words, joins: bool = False) -> list[tuple[int, int]]:
        """Byte ranges of tokens and of rows of words that may have a lattice of
        more than one path: all tokens that do, those with a character outside
        ASCII, rows of single characters and, with ``joins``, of words with a dear break."""
        buf = words.buf
        letter, leet = _LETTER[buf], _LEET[buf]
        marked = leet | (buf >= 128)
        marked[1:] |= letter[1:] & ((buf[1:] | 0x20) == (buf[:-1] | 0x20)) & letter[:-1]  # a letter twice in a row
        sizes = words.end - words.start
        places = np.flatnonzero(marked)
        gaps = np.flatnonzero(_GAP[buf])
        token = np.searchsorted(words.start, gaps, side="right") - 1
        inside = (token >= 0) & (gaps > words.start[token]) & (gaps < words.end[token] - 1)
        tokens = np.unique(np.r_[np.searchsorted(words.start, places, side="right") - 1, token[inside]])
        tokens = tokens[tokens >= 0]
        has_letter = np.add.reduceat(letter, words.start, dtype=np.int64)[tokens] > 0
        tokens = tokens[has_letter]
        spans = list(zip(words.start[tokens].tolist(), words.end[tokens].tolist()))
        rows = self._rows(words, np.bincount(token[token >= 0], minlength=len(sizes)) == sizes, joins)
        return _outside(spans, rows) + rows if rows else spans

    def _rows(self, words: Words, gap: np.ndarray, joins: bool) -> list[tuple[int, int]]:
        """Byte ranges of two or more words to be read together; ``gap`` marks
        words of gap characters only, which are passed over."""
        real = np.flatnonzero(~gap)
        if len(real) < 2:
            return []
        buf, start, end = words.buf, words.start[real], words.end[real]
        text = np.searchsorted(words.first, real, side="right")
        lead = buf[start]
        alone = (end - start == _char_size(lead)) & (_LETTER[lead] | _LEET[lead])
        linked = alone[1:] & alone[:-1]
        if joins:
            linked |= self._dear(buf, start, end)
        linked &= text[1:] == text[:-1]
        first = np.flatnonzero(linked & ~np.r_[False, linked[:-1]])
        last = np.flatnonzero(linked & ~np.r_[linked[1:], False]) + 1
        return list(zip(start[first].tolist(), end[last].tolist()))

    def _dear(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Breaks between neighbouring words that cost more than to join them."""
        # Symbols a, b before the break and c, d after it (0: no further letter).
        a = np.where(end - start > 1, _END[buf[np.maximum(end - 2, 0)]], 0)[:-1].astype(np.int64)
        b, c = _END[buf[end - 1]][:-1], _END[buf[start]][1:]
        d = np.where(end - start > 1, _END[buf[np.minimum(start + 1, len(buf) - 1)]], 0)[1:]
        code = (a * _SYMBOLS + b) * _SYMBOLS + c
        saved = self._before[code] + self._after[code % _SYMBOLS**2 * _SYMBOLS + d]
        return (b % 27 > 0) & (c % 27 > 0) & (saved > COST["join"])


def _outside(spans, rows):
    starts = np.array([a for a, _ in rows])
    ends = np.array([b for _, b in rows])
    at = np.searchsorted(starts, [s for s, _ in spans], side="right") - 1
    return [sp for sp, k in zip(spans, at.tolist()) if k < 0 or sp[0] >= ends[k]]


def _char_size(lead: np.ndarray) -> np.ndarray:
    """Bytes of the UTF-8 character that starts with a byte."""
    return np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))


# ---------------------------------------------------------------- features


class Features:
    """n-grams and words of letter texts as 64-bit keys, looked up in a fixed set."""

    def __init__(self, keys: np.ndarray | None = None):
        self.keys = None if keys is None else np.sort(keys)
        if keys is not None:
            self.table = np.zeros(1 << 20, bool)
            self.table[self._slot(self.keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)

    def pairs(self, restored: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, key) pairs, keys as values, or as places in ``keys``
        and only those in it when a set was given."""
        letters = [b" " + t.translate(_TO_LETTERS) for t in restored]
        words = Words(letters, b" ")
        buf = words.buf.astype(np.uint64)
        space = words.buf == 0x20
        texts, found = [], []

        def take(places, keys):
            if self.keys is not None:
                hit = self.table[self._slot(keys)]
                places, keys = places[hit], keys[hit]
                if not len(self.keys):
                    return
                at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
                hit = self.keys[at] == keys
                places, keys = places[hit], at[hit]
            texts.append(np.searchsorted(words.bounds, places, side="right") - 1)
            found.append(keys)

        gram, free = buf, np.ones(len(buf), bool)
        for n in range(2, max(GRAMS) + 1):
            if len(buf) < n:
                break
            gram = (gram[:-1] << np.uint64(8)) | buf[n - 1 :]
            free = free[:-1] & ~space[n - 1 :]
            if n in GRAMS:
                at = np.flatnonzero(free)
                take(at, gram[at])
        take(words.start, words.hash)
        if not texts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        text, key = np.concatenate(texts), np.concatenate(found)
        order = np.lexsort((key, text))
        text, key = text[order], key[order]
        new = np.r_[True, (text[1:] != text[:-1]) | (key[1:] != key[:-1])] if len(text) else np.zeros(0, bool)
        return text[new], key[new]


# ---------------------------------------------------------------- model


@dataclass(frozen=True)
class ToxicityModel:
    bits: np.ndarray
    keys: np.ndarray  # sorted feature keys
    weights: np.ndarray
    bias: float


def _key_counts(bits, keys):
    """Rows (key, n): texts of a task that hold each feature."""

    def run(batches):
        restorer, features = Restorer(bits.value), Features(None if keys is None else keys.value)
        parts, waiting = [], 0
        total = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def settle():
            nonlocal total, parts, waiting
            k, back = np.unique(np.concatenate([total[0], *parts]), return_inverse=True)
            n = np.bincount(back, np.concatenate([total[1], *[np.ones(len(p), np.int64) for p in parts]]), len(k))
            total, parts, waiting = (k, n.astype(np.int64)), [], 0

        for batch in batches:
            column = batch.column(0)
            for lo, hi in text_slices(column, TRAINING_SLICE):
                _, found = features.pairs(restorer.texts(column.slice(lo, hi - lo).cast(pa.binary()).to_pylist()))
                parts.append(found.astype(np.uint64))
                waiting += len(found)
                settle() if waiting > 1 << 20 else None
        settle()
        yield pa.RecordBatch.from_arrays([pa.array(total[0].view(np.int64)), pa.array(total[1])], ["key", "n"])

    return run


def _design(bits, keys):
    """Rows (toxic, places): the selected features of each labelled text."""

    def run(batches):
        restorer, features = Restorer(bits.value), Features(keys.value)
        for batch in batches:
            column, label = batch.column(0), batch.column(1)
            for lo, hi in text_slices(column):
                text, place = features.pairs(restorer.texts(column.slice(lo, hi - lo).cast(pa.binary()).to_pylist()))
                cuts = np.searchsorted(text, np.arange(hi - lo + 1))
                lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(place.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([label.slice(lo, hi - lo), lists], ["toxic", "places"])

    return run


def _g2(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Log-likelihood ratio of a feature in ``a`` of n1 and ``b`` of n0 texts."""

    def part(x, expected):
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-12) / np.maximum(expected, 1e-12)), 0.0)

    total, n = a + b, n1 + n0
    return 2 * (
        part(a, total * n1 / n) + part(b, total * n0 / n)
        + part(n1 - a, (n - total) * n1 / n) + part(n0 - b, (n - total) * n0 / n)
    )


def _logistic(labels: np.ndarray, row: np.ndarray, col: np.ndarray, width: int, l2: float = 0.05) -> tuple[np.ndarray, float]:
    """L2-regularised logistic regression on 0/1 features by accelerated gradient steps."""
    w, bias = np.zeros(width), math.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5))
    per_row = np.bincount(row, minlength=len(labels))
    step = 4.0 / (per_row.max(initial=0) * np.bincount(col, minlength=width).max(initial=0) + len(labels) + l2) if width else 0
    velocity, bias_velocity = np.zeros(width), 0.0
    for i in range(1500 if width else 0):
        z = np.bincount(row, (w + velocity)[col], len(labels)) + bias + bias_velocity
        error = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels
        gradient = np.bincount(col, error[row], width) + l2 * (w + velocity)
        new, new_bias = w + velocity - step * gradient, bias + bias_velocity - step * error.sum()
        momentum = i / (i + 3)
        velocity, bias_velocity = momentum * (new - w), momentum * (new_bias - bias)
        w, bias = new, new_bias
    return w, float(bias)


def fit(
    texts: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> ToxicityModel:
    """Count the character model over all of ``texts``, select features and fit
    the classifier on the labelled ones (at most MAX_LABELLED, by hash of id).

    Labels other than 0 and 1, null ids and null texts teach nothing; an id
    labelled twice counts twice. Without any label every score is 0.
    """
    spark = texts.sparkSession
    sc = spark.sparkContext
    bits = sc.broadcast(character_model(texts, text_col))
    chosen = (
        labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
        .where("id is not null and toxic in (0, 1)")
        .orderBy(F.xxhash64("id"), "id", "toxic").limit(MAX_LABELLED)
    )
    sample = (
        texts.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
        .where("text is not null")
        .join(F.broadcast(chosen), "id")  # at most MAX_LABELLED rows of two numbers
        .select("text", "toxic")
    ).persist()
    try:
        sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
        if not n1:
            return ToxicityModel(bits.value, np.zeros(0, np.uint64), np.zeros(0), -40.0)

        def counted(toxic, keys=None):
            rows = sample.where(F.col("toxic") == toxic).select("text").mapInArrow(_key_counts(bits, keys), "key long, n long")
            return rows.groupBy("key").agg(F.sum("n").alias("n"))

        common = counted(1).where("n >= 3").orderBy(F.desc("n"), "key").limit(MAX_CANDIDATES).toArrow()
        keys = np.asarray(common.column("key")).astype(np.int64).view(np.uint64)
        a = np.asarray(common.column("n")).astype(np.float64)
        order = np.argsort(keys)
        keys, a = keys[order], a[order]
        b = np.zeros(len(keys))
        tested = sc.broadcast(keys)
        for r in counted(0, tested).collect():
            b[r["key"]] = r["n"]
        g2 = np.where(a * n0 > b * n1, _g2(a, b, n1, n0), 0.0)
        best = np.argsort(-g2, kind="stable")[:MAX_FEATURES]
        keys = np.sort(keys[best[g2[best] >= MIN_G2]])
        design = sample.mapInArrow(_design(bits, sc.broadcast(keys)), "toxic int, places array<int>").toArrow()
        y = np.asarray(design.column("toxic")).astype(np.float64)
        lists = design.column("places").combine_chunks()
        lengths = np.asarray(lists.value_lengths()).astype(np.int64)
        col = np.asarray(lists.flatten()).astype(np.int64)
        weights, bias = _logistic(y, np.repeat(np.arange(len(y)), lengths), col, len(keys))
    finally:
        sample.unpersist()
    return ToxicityModel(bits.value, keys, weights, bias)


def scorer(model: ToxicityModel):
    restorer, features = Restorer(model.bits), Features(model.keys)

    def work(texts):
        text, place = features.pairs(restorer.texts(texts))
        z = np.bincount(text, model.weights[place], len(texts)) if len(text) else np.zeros(len(texts))
        p = 1 / (1 + np.exp(-np.clip(z + model.bias, -40, 40)))
        return [pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))]

    return work


def score(df: DataFrame, model: ToxicityModel, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its ``keep`` columns) plus score (0 to 1) and predicted (1 if
    score >= 0.5) of every whole text.

    Null and empty texts get the score of a text without features. Columns
    with the result's names are replaced. No shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return append_columns(df, text_col, fields, lambda: scorer(shared.value), keep=keep)
