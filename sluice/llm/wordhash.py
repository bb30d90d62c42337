"""Vectorised word and shingle hashing over many texts at once.

Texts become one flat byte array with a separator after each; words are runs
of non-separator bytes. A word's 64-bit hash is polynomial over random byte
values, taken as a difference of prefix sums, so no Python object is made per
word. All hashes depend on fixed seeds alone, never on the process.
"""

from __future__ import annotations

import functools

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)

_HASH_BLOCK = 1 << 21

_powers = np.ones(1, np.uint64)
_inverse_powers = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse_powers
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        for base, name in ((_BASE, "_powers"), (_BASE_INV, "_inverse_powers")):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
    return _powers[:n], _inverse_powers[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def separator_table(separators: bytes, lower: bool = True) -> tuple[bytes, np.ndarray]:
    """(translation that lower-cases A-Z, mask of the separator bytes)."""
    trans = bytearray(range(256))
    if lower:
        trans[65:91] = bytes(range(97, 123))
    mask = np.zeros(256, bool)
    mask[list(separators)] = True
    return bytes(trans), mask


#: Words [^\x20\x09-\x0D]+ and words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after lower-casing A-Z).
SPACES = bytes([0x20, *range(0x09, 0x0E)])
NON_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


class Words:
    """The words of a list of texts (bytes; None counts as empty).

    ``start``/``end``: byte range of each word in ``buf``; ``first``: index of
    each text's first word and ``bounds``: its first byte (one more entry than
    texts each); ``hash``: per word.
    """

    def __init__(self, texts: list, separators: bytes):
        trans, mask = separator_table(separators)
        sep = separators[:1]
        joined = sep.join([t or b"" for t in texts]) + sep
        self.buf = np.frombuffer(joined.translate(trans), np.uint8)
        inside = np.empty(len(self.buf) + 1, np.int8)
        inside[0] = 0
        np.logical_not(mask[self.buf], out=inside[1:].view(bool))
        edge = np.diff(inside)
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        lengths = np.fromiter((len(t) + 1 if t else 1 for t in texts), np.int64, len(texts))
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(lengths, out=bounds[1:])
        self.bounds = bounds
        self.first = np.searchsorted(self.start, bounds)

    @functools.cached_property
    def hash(self) -> np.ndarray:
        # Block by block, so the tables stay small however long a text is.
        out = np.empty(len(self.start), np.uint64)
        block = self.start // _HASH_BLOCK
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)] if len(block) else [0]
        for i, j in zip(cuts[:-1], cuts[1:]):
            lo = int(self.start[i])
            prefix, inverse = prefix_sums(self.buf[lo : int(self.end[j - 1])])
            s, e = self.start[i:j] - lo, self.end[i:j] - lo
            out[i:j] = mix((prefix[e] - prefix[s]) * inverse[s])
        return out

    def shingles(self, width: int) -> np.ndarray:
        """Hash of the ``width`` words from each word on (runs past the end of
        a text included: callers cut by ``first``); length max(0, n - width + 1)."""
        n = len(self.hash) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        total = np.zeros(n, np.uint64)
        for k in range(width):
            total *= _BASE
            total += self.hash[k : k + n]
        return mix(total)


def prefix_sums(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(polynomial prefix sums with a leading 0, inverse powers): the hash of
    bytes [s, e) is (prefix[e] - prefix[s]) * inverse[s]."""
    powers, inverse = _power_tables(len(buf) + 1)
    prefix = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[buf] * powers[: len(buf)], out=prefix[1:])
    return prefix, inverse


def text_shingles(words: Words, width: int) -> list[np.ndarray]:
    """Per text its distinct shingle hashes, sorted: all runs of ``width``
    words; with fewer words the whole sequence as one; without words none."""
    if len(words.hash) == 0:
        return [np.zeros(0, np.uint64)] * (len(words.first) - 1)
    whole = words.shingles(width)
    out = []
    for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        n = hi - lo
        if n >= width:
            out.append(np.unique(whole[lo : hi - width + 1]))
        elif n:
            short = np.uint64(n)
            for h in words.hash[lo:hi]:
                short = np.uint64((int(short) * int(_BASE) + int(h)) & 0xFFFFFFFFFFFFFFFF)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
