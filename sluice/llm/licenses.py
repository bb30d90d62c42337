"""License scans: phrases, and notice templates compiled to token automata.

A template is a wording with optional regions ``[...]`` and replaceable regions
``{a-b}`` (any a to b words). It compiles to a small nondeterministic automaton
over words; a text is accepted where a run of its words is read from the start
state to an end state, so every mandatory word must match exactly. Runs start
only where the template's leading mandatory words stand.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluice.llm.batches import append_columns
from sluice.llm.wordhash import NON_ALNUM

# Base phrases and their labels (fixed values of the result's contract).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_MIT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation "
    "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
    "permit persons to whom the software is furnished to do so subject to the following conditions the above "
    "copyright notice and this permission notice [including the next paragraph] shall be included in all copies "
    "or substantial portions of the software"
)
_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met [1] redistributions of source code must retain the above copyright notice "
    "this list of conditions and the following disclaimer [2] redistributions in binary form must reproduce the "
    "above copyright notice this list of conditions and the following disclaimer in the documentation and or "
    "other materials provided with the distribution"
)
_PUBLISHED = "[as published by the free software foundation] [either]"

# Notice and license wordings as words (fixed values of the licenses), by label. What a
# license lets its user fill in (holders, years, names, addresses) is replaceable.
TEMPLATES = {
    "agpl-3.0": f"gnu affero general public license {_PUBLISHED} version 3",
    "apache-2.0": "apache license [,] version 2 0",
    "apache-2.0-notice": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license you may obtain a copy of the license at {4-10} unless required by applicable law or agreed "
        "to in writing software distributed under the license is distributed on an as is basis without warranties or "
        "conditions of any kind either express or implied see the license for the specific language governing "
        "permissions and limitations under the license"
    ),
    "boost-1.0": "boost software license version 1 0",
    "bsd-3-clause": (
        f"{_BSD} [3] neither the name of {{1-10}} nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission"
    ),
    "bsd-redistribution": _BSD,
    "cc-by-4.0": "cc by 4 0 [international]",
    "cc-by-nc-4.0": "cc by nc 4 0 [international]",
    "cc-by-nc-nd-4.0": "cc by nc nd 4 0 [international]",
    "cc-by-nc-sa-4.0": "cc by nc sa 4 0 [international]",
    "cc-by-nd-4.0": "cc by nd 4 0 [international]",
    "cc-by-sa-4.0": "cc by sa 4 0 [international]",
    "cc0-1.0": "cc0 1 0 [universal]",
    "gpl-2.0": f"gnu general public license {_PUBLISHED} version 2",
    "gpl-3.0": f"gnu general public license {_PUBLISHED} version 3",
    "isc": (
        "permission to use copy modify and [or] distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "lgpl-2.1": f"gnu lesser general public license {_PUBLISHED} version 2 1",
    "lgpl-3.0": f"gnu lesser general public license {_PUBLISHED} version 3",
    "mit-permission": _MIT,
    "mit-release": "released under the [terms of the] mit license",
    "mit-text": (
        f"copyright [c] {{1-12}} [all rights reserved] {_MIT} the software is provided as is without warranty of any kind "
        "express or implied including but not limited to the warranties of merchantability fitness for a particular "
        "purpose and noninfringement in no event shall {2-8} be liable for any claim damages or other liability "
        "whether in an action of contract tort or otherwise arising from out of or in connection with the software "
        "or the use or other dealings in the software"
    ),
    "mpl-2.0": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was "
        "not distributed with this file you can obtain one at {3-8}"
    ),
    "or-later": f"general public license {_PUBLISHED} version {{1-2}} [of the license] or at your option any later version",
    "public-domain": "released into the public domain [by {1-8}]",
    "spdx-tag": "spdx license identifier {1-4}",
    "unlicense": (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish "
        "use compile sell or distribute this software either in source code form or as a compiled binary for any "
        "purpose commercial or non commercial and by any means"
    ),
    "zlib": (
        "this software is provided as is without any express or implied warranty in no event will the authors be held "
        "liable for any damages arising from the use of this software"
    ),
}


def parse(template: str) -> list:
    """Words, ("optional", parts) and ("any", low, high) in order."""

    def read(tokens: list[str], closing: bool) -> list:
        parts = []
        while tokens:
            t = tokens.pop(0)
            if t == "[":
                parts.append(("optional", read(tokens, True)))
            elif t == "]":
                if not closing:
                    raise ValueError(f"unopened region in template: {template!r}")
                return parts
            elif m := re.fullmatch(r"\{(\d+)-(\d+)\}", t):
                parts.append(("any", int(m[1]), int(m[2])))
            elif re.fullmatch(r"[a-z0-9\u0080-\U0010ffff]+", t):
                parts.append(t)
            elif t != ",":
                raise ValueError(f"unreadable part {t!r} in template")
        if closing:
            raise ValueError(f"unclosed region in template: {template!r}")
        return parts

    return read(re.findall(r"\{[^}]*\}|[\[\]]|[^\s\[\]{}]+", template), False)


@dataclass
class Automaton:
    """Token automaton of one template. ``steps[s]``: (word or None for any
    word, next state); ``skips[s]``: states reached without reading a word."""

    anchor: bytes
    steps: list
    skips: list
    accept: int

    def closure(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for n in self.skips[todo.pop()]:
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        return seen

    def accepts(self, words: list[bytes], start: int) -> bool:
        """Does some run of words from ``start`` on spell the template?"""
        states = self.closure({0})
        for i in range(start, len(words) + 1):
            if self.accept in states:
                return True
            if not states or i == len(words):
                return False
            states = self.closure({n for s in states for w, n in self.steps[s] if w is None or w == words[i]})
        return False


def compile_template(template: str) -> Automaton:
    """Regions before the first mandatory word may be absent, so they are
    dropped; the leading mandatory words become the anchor."""
    parts = parse(template)
    while parts and not isinstance(parts[0], str):
        parts.pop(0)
    if not parts:
        raise ValueError("a template needs a mandatory word")
    anchor = []
    for p in parts:
        if not isinstance(p, str):
            break
        anchor.append(p)
    steps: list = [[]]
    skips: list = [[]]

    def state() -> int:
        steps.append([]), skips.append([])
        return len(steps) - 1

    def build(parts: list, at: int) -> int:
        for p in parts:
            if isinstance(p, str):
                n = state()
                steps[at].append((p.encode("utf-8"), n))
                at = n
            elif p[0] == "optional":
                end = build(p[1], at)
                n = state()
                skips[at].append(n), skips[end].append(n)
                at = n
            else:
                low, high = p[1], p[2]
                leave = []
                for k in range(high):
                    if k >= low:
                        leave.append(at)
                    n = state()
                    steps[at].append((None, n))
                    at = n
                for s in leave:
                    skips[s].append(at)
        return at

    return Automaton(" ".join(anchor).encode("utf-8"), steps, skips, build(parts, 0))


def template_regex(template: str) -> str:
    """The same template as a regular expression over `` word word ... `` text:
    an independent form for SQL engines and tests."""

    def render(parts: list) -> str:
        out = ""
        for p in parts:
            if isinstance(p, str):
                out += f" {p}"
            elif p[0] == "optional":
                out += f"(?:{render(p[1])})?"
            else:
                out += f"(?: [^ ]+){{{p[1]},{p[2]}}}"
        return out

    parts = parse(template)
    while not isinstance(parts[0], str):
        parts.pop(0)
    return render(parts) + "(?: |$)"


def places(text: bytes, phrase: bytes) -> list[int]:
    """Word positions of a phrase in `` word word ... `` text (spaces at both ends)."""
    found, needle, at = [], b" " + phrase + b" ", -1
    word = 0
    last = 0
    while (at := text.find(needle, at + 1)) >= 0:
        word += text.count(b" ", last, at)
        last = at
        found.append(word)
    return found


class Scanner:
    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        self.phrases = [(p.encode(), label) for p, label in phrases.items()]
        self.templates = [(label, compile_template(t)) for label, t in templates.items()]
        table = bytearray(range(256))
        table[65:91] = bytes(range(97, 123))
        for b in NON_ALNUM:
            table[b] = 0x20 if not 65 <= b < 91 else table[b]
        self.table = bytes(table)

    def scan(self, text: bytes | None) -> tuple:
        words = (text or b"").translate(self.table).split()
        spaced = b" " + b" ".join(words) + b" "
        at: list[int] = []
        base: set[str] = set()
        for phrase, label in self.phrases:
            if found := places(spaced, phrase):
                at += found
                base.add(label)
        matched = {
            label
            for label, automaton in self.templates
            if b" " + automaton.anchor + b" " in spaced
            and any(automaton.accepts(words, p) for p in places(spaced, automaton.anchor))
        }
        score = 1.0 if matched else 0.5 if base else 0.0
        return (
            len(words), len(at), min(at, default=None), max(at, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | matched)), score,
        )


FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()),
    T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()),
]


def scan_licenses(
    df: DataFrame,
    *,
    text_col: str = "text",
    keep: list[str] | None = None,
    phrases: dict[str, str] | None = None,
    templates: dict[str, str] | None = None,
) -> DataFrame:
    """``df`` (or its ``keep`` columns) plus n_words, n_base, first_word,
    last_word, base_labels, labels and score per text. No shuffle.

    Words are runs of [a-z0-9] and non-ASCII characters after lower-casing A-Z.
    score: 1 where a template is accepted, 0.5 with base phrases alone, else 0.
    Null and empty texts: no words, null positions, empty labels, score 0.
    Columns of ``df`` with the result's names are replaced.
    """
    phrases, templates = phrases or PHRASES, templates or TEMPLATES

    def make():
        scanner = Scanner(phrases, templates)

        def work(texts):
            rows = list(zip(*map(scanner.scan, texts)))
            return [pa.array(c, t) for c, t in zip(rows, (*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64()))]

        return work

    return append_columns(df, text_col, FIELDS, make, keep=keep)
