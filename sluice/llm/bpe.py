"""Byte-level BPE with word ends: encoding by batched numpy merge rounds, decoding by table.

The distinct new words of a slice of texts are encoded together. Their symbols
lie in one flat array; each adjacent pair of a word is looked up by binary
search over the sorted pair keys of the merge table; every round merges, in
every unfinished word, the pair of lowest rank, leftmost first, until no word
holds a known pair. Per-document work is then a lookup per word.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import sys
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluice.llm.batches import append_columns

NO_RANK = np.int32(2**31 - 1)

#: Words a task remembers; the memory is emptied when full, which changes no result.
REMEMBERED_WORDS = 150_000

# Pre-token patterns (fixed values of the tokenizer file): contractions, runs
# of letters, single digits, runs of other non-space characters.
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_ASCII_PATTERN = re.compile(_CONTRACTIONS + r"|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
# Characters with the Unicode property White_Space.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _char_class(major: str, newer: frozenset[int], last: int) -> str:
    """Ranges, as in a regular expression, of the characters up to ``last`` of one
    major general category: by Python's Unicode tables, and the ``newer`` ones."""
    codes = np.array([unicodedata.category(chr(i))[0] == major or i in newer for i in range(last + 1)])
    edges = np.flatnonzero(np.diff(np.r_[False, codes, False].astype(np.int8)))
    return "".join(rf"\U{a:08x}-\U{b - 1:08x}" for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()))


#: Code points from here on are in planes without letters, or private.
_LAST_LETTER = 0x33480


def newer_characters(path: str) -> tuple[frozenset[int], frozenset[int], dict[int, str]]:
    """(letters, numbers, lower-case forms) that the tokenizers library knows and
    Python's Unicode tables don't: the library is asked, once, on the driver, about
    the code points that Python takes as unassigned."""
    import tokenizers  # on the driver alone

    tokenizer = tokenizers.Tokenizer.from_file(path)
    letters, numbers, lowered = set(), set(), {}
    for i in range(0x80, _LAST_LETTER):
        c = chr(i)
        if unicodedata.category(c) != "Cn":
            continue
        # Between two letters, twice: one run of letters, or four pieces with a digit each, or three.
        pieces = len(tokenizer.pre_tokenizer.pre_tokenize_str(f"a{c}{c}b"))
        if pieces == 1:
            letters.add(i)
        elif pieces == 4:
            numbers.add(i)
        if (form := tokenizer.normalizer.normalize_str(c)) != c:
            lowered[i] = form
    return frozenset(letters), frozenset(numbers), lowered


@functools.cache
def _pattern(newer_letters: frozenset[int], newer_numbers: frozenset[int], last: int = sys.maxunicode) -> re.Pattern:
    letters, numbers = _char_class("L", newer_letters, last), _char_class("N", newer_numbers, last)
    return re.compile(f"{_CONTRACTIONS}|[{letters}]+|[{numbers}]|[^{_WHITE}{letters}{numbers}]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 bytes stand for themselves, the others are
    numbered from U+0100 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [], 0
    for b in range(256):
        if b in kept:
            out.append(chr(b))
        else:
            out.append(chr(0x100 + extra))
            extra += 1
    return out


@dataclass(frozen=True)
class Bpe:
    """A merge table in arrays; picklable and bounded by the vocabulary file."""

    tokens: list  # id -> token text
    inner: np.ndarray  # byte -> id inside a word
    last: np.ndarray  # byte -> id at the end of a word
    keys: np.ndarray  # sorted left << 32 | right
    ranks: np.ndarray  # aligned with keys
    merged: np.ndarray  # aligned with keys: id of the merged symbol
    lone: np.ndarray  # aligned with keys: merge one place at a time
    added: dict  # special token text -> id
    letters: frozenset  # code points that Python's Unicode tables don't have
    numbers: frozenset
    lowered: dict


def load(path: str) -> Bpe:
    """Read a tokenizers JSON file of the supported kind: NFC, lower case,
    byte-level BPE with a word-end suffix."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [""] * (max([*vocab.values(), *added.values()]) + 1)
    for text, i in [*vocab.items(), *added.items()]:
        tokens[i] = text
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    left = np.array([vocab[a] for a, _ in pairs], np.int64)
    right = np.array([vocab[b] for _, b in pairs], np.int64)
    merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
    ranks = np.arange(len(pairs), dtype=np.int32)
    # A merge whose product takes part in a pair of lower rank may hand the next
    # turn to that pair: such merges are made one place at a time.
    lowest = np.full(len(tokens), NO_RANK, np.int32)
    np.minimum.at(lowest, left, ranks)
    np.minimum.at(lowest, right, ranks)
    lone = lowest[merged] < ranks
    keys = (left << 32) | right
    order = np.argsort(keys, kind="stable")
    symbols = byte_symbols()
    return Bpe(
        tokens,
        np.array([vocab[s] for s in symbols], np.int32),
        np.array([vocab[s + suffix] for s in symbols], np.int32),
        keys[order], ranks[order], merged[order], lone[order], added, *newer_characters(path),
    )


def _lookup(bpe: Bpe, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Index of each pair in the sorted keys, -1 for pairs that never merge."""
    key = (left.astype(np.int64) << 32) | right
    at = np.searchsorted(bpe.keys, key)
    at[at == len(bpe.keys)] = 0
    return np.where(bpe.keys[at] == key, at, -1).astype(np.int32)


def encode_words(bpe: Bpe, words: list[bytes]) -> list[np.ndarray]:
    """Token ids of each word (non-empty UTF-8 bytes)."""
    out: list = [None] * len(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8)
    sym = bpe.inner[flat]
    ends = np.cumsum(lengths) - 1
    sym[ends] = bpe.last[flat[ends]]
    word = np.repeat(np.arange(len(words)), lengths)
    # pair[i]: the merge of symbols i and i + 1, -1 at the end of a word or if unknown.
    pair = np.full(len(sym), -1, np.int32)
    if len(sym) > 1:
        inside = np.flatnonzero(word[1:] == word[:-1])
        pair[inside] = _lookup(bpe, sym[inside], sym[inside + 1])
    while len(sym):
        rank = np.where(pair >= 0, bpe.ranks[pair], NO_RANK)
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        sizes = np.diff(np.r_[starts, len(word)])
        lowest = np.minimum.reduceat(rank, starts)
        done = lowest == NO_RANK
        if done.any():
            for s, n in zip(starts[done].tolist(), sizes[done].tolist()):
                out[word[s]] = sym[s : s + n]
            keep = np.repeat(~done, sizes)
            sym, word, pair, rank = sym[keep], word[keep], pair[keep], rank[keep]
            lowest, sizes = lowest[~done], sizes[~done]
            if not len(sym):
                break
        at = np.flatnonzero(rank == np.repeat(lowest, sizes))
        # Of places that overlap (a run of one symbol) every second one merges.
        index = np.arange(len(at))
        run = np.r_[True, (np.diff(at) > 1) | (word[at[1:]] != word[at[:-1]])]
        first_of_word = np.r_[True, word[at[1:]] != word[at[:-1]]]
        odd = (index - np.maximum.accumulate(np.where(run, index, 0))) % 2 == 1
        chosen = at[np.where(bpe.lone[pair[at]], first_of_word, ~odd)]
        sym[chosen] = bpe.merged[pair[chosen]]
        keep = np.ones(len(sym), bool)
        keep[chosen + 1] = False
        place = np.cumsum(keep) - 1
        pair[chosen] = pair[chosen + 1]  # whether a symbol follows in the word is settled below
        sym, word, pair = sym[keep], word[keep], pair[keep]
        q = place[chosen]
        touched = np.unique(np.r_[q, q[q > 0] - 1])
        touched = touched[touched < len(sym) - 1]
        pair[q] = -1
        same = word[touched] == word[touched + 1]
        pair[touched] = -1
        touched = touched[same]
        pair[touched] = _lookup(bpe, sym[touched], sym[touched + 1])
    return out


class Splitter:
    """Splits texts into words: special tokens as they stand, the rest normalised
    (NFC, lower case character by character) and split by the pattern."""

    def __init__(self, bpe: Bpe):
        self.specials = re.compile("(" + "|".join(map(re.escape, bpe.added)) + ")") if bpe.added else None
        # Character classes within U+FFFF are tables, those beyond it are long lists of
        # ranges: texts without such characters are split by the former.
        self.pattern = _pattern(bpe.letters, bpe.numbers, 0xFFFF)
        self.wide_pattern = _pattern(bpe.letters, bpe.numbers)
        self.wide = re.compile("[\U00010000-\U0010ffff]")
        self.lowered = bpe.lowered
        # Most texts hold none of these: a search is far cheaper than a translation.
        self.rare = re.compile(f"[{chr(min(bpe.lowered))}-\U0010ffff]") if bpe.lowered else None

    def words(self, text: str) -> list[str]:
        if self.specials is not None and "<" in text:
            found = []
            for i, piece in enumerate(self.specials.split(text)):
                found += [piece] if i % 2 else self._plain(piece)
            return found
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return _ASCII_PATTERN.findall(text.lower())
        # U+03A3 has a second lower-case form at the end of a word, which isn't used here.
        plain = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if self.rare is not None and self.rare.search(plain):
            plain = plain.translate(self.lowered)
        return (self.wide_pattern if self.wide.search(plain) else self.pattern).findall(plain)


class Codec:
    """Encodes texts with a memory of words already seen."""

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        self.split = Splitter(bpe).words
        self.ids: dict[str, bytes] = {}
        self.decoded: dict[str, str] = {}

    def words(self, texts: list) -> list[list[str]]:
        lists = [self.split(t.decode("utf-8", "replace")) if t else [] for t in texts]
        new = set().union(*lists) - self.ids.keys() if lists else set()
        if len(self.ids) + len(new) > REMEMBERED_WORDS:
            self.ids.clear(), self.decoded.clear()
            new = set().union(*lists)
        plain = [w for w in new if w not in self.bpe.added]
        for w in new:
            if w in self.bpe.added:
                self._remember(w, np.array([self.bpe.added[w]], np.int32))
        for w, ids in zip(plain, encode_words(self.bpe, [w.encode("utf-8") for w in plain])):
            self._remember(w, ids)
        return lists

    def _remember(self, word: str, ids: np.ndarray) -> None:
        self.ids[word] = ids.astype("<u4").tobytes()
        self.decoded[word] = decode(self.bpe, ids.tolist())

    def encode(self, words: list[str]) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.ids.__getitem__, words))

    def decode(self, words: list[str]) -> str:
        return " ".join(map(self.decoded.__getitem__, words))


def decode(bpe: Bpe, ids) -> str:
    """Text of token ids. The file names no decoder, so tokens are joined by a
    space as they are written in the vocabulary."""
    return " ".join(bpe.tokens[i] for i in ids)


def encode_decode(
    df: DataFrame, bpe: Bpe, *, text_col: str = "text", keep: list[str] | None = None, ids: bool = False
) -> DataFrame:
    """``df`` (or ``keep`` columns of it) plus n_tokens, ids_sha256 and
    decoded_sha256 of each text, and with ``ids`` the token ids themselves.

    A null text counts as empty: no tokens, digests of nothing. Bytes that are no
    UTF-8 count as U+FFFD. Columns of
    ``df`` with these names are replaced. No shuffle; a task holds one slice of
    texts and a bounded memory of words.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(bpe)
    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    if ids:
        fields.append(T.StructField("token_ids", T.ArrayType(T.IntegerType())))

    def make():
        codec = Codec(shared.value)

        def work(texts):
            counts, id_hashes, text_hashes, arrays = [], [], [], []
            for words in codec.words(texts):
                packed = codec.encode(words)
                counts.append(len(packed) // 4)
                id_hashes.append(hashlib.sha256(packed).hexdigest())
                text_hashes.append(hashlib.sha256(codec.decode(words).encode("utf-8")).hexdigest())
                if ids:
                    arrays.append(np.frombuffer(packed, "<i4"))
            out = [pa.array(counts, pa.int64()), pa.array(id_hashes, pa.string()), pa.array(text_hashes, pa.string())]
            return [*out, pa.array(arrays, pa.list_(pa.int32()))] if ids else out

        return work

    return append_columns(df, text_col, fields, make, keep=keep)
