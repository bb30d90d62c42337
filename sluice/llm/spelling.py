"""Spelling variants: words one edit apart, by composing finite automata.

The words one edit from each other are what the vocabulary acceptor accepts on
both sides of a one-edit transducer: acceptor o edit o acceptor. The acceptor of
a whole corpus fits no single task, so it is partitioned by initial states. Of
two words one edit apart, the shorter of ``base`` letters, every letter outside
the edit is the same; so they agree outside one of the two halves
[0, base / 2) and [base / 2, base) of positions, and lie together in the
partition of words that have this length (or one letter more), this half open
and this context around it. All words of a partition reach the same state by
their context, the initial state of its acceptor; what is left to accept is the
open part.

A partition with more than ``PARTITION`` words, or with an open part of more
than ``WIDTH`` letters, is cut again: its open half into two, with longer
contexts, until it is small. An open part of one position bounds a partition by
the alphabet, so no partition grows with the corpus, no word is dropped and no
pair lies in two.

In a task a partition becomes two minimised acceptors, of open parts of the
base length and of one letter more. They are composed with the transducer that
replaces one letter, or inserts one at the first place where the two words
differ, and the accepted pairs are enumerated state by state.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.session import shared_path

#: Most words of a partition before it is cut again, and most letters of its open part.
PARTITION, WIDTH = 4096, 256
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Letters of words after A-Z are lower-cased.
_RUN = "[a-zÀ-ÿ]+"
_KEY = ["base", "lo", "hi", "before", "after"]


def runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_length: int = 1) -> DataFrame:
    """(id, run): every maximal run [A-Za-z\\u00C0-\\u00FF]+ of at least
    ``min_length`` letters in a text, with A-Z lower-cased. Null: none."""
    lowered = F.translate(F.col(f"`{text_col}`").cast("string"), _UPPER, _UPPER.lower())
    found = F.filter(F.regexp_extract_all(lowered, F.lit(_RUN), F.lit(0)), lambda w: F.char_length(w) >= min_length)
    return df.select(F.col(f"`{id_col}`").alias("id"), F.explode(found).alias("run"))


def without_letter(run: Column, place: Column) -> Column:
    """``run`` without the letter at ``place`` (from 0)."""
    place = place.cast("int")
    return F.concat(F.substring(run, 1, place), F.substring(run, place + 2, F.char_length(run)))


# --- automata ---------------------------------------------------------------


def minimised(words: list[str]) -> tuple[list[dict[str, int]], list[bool], int]:
    """(edges, finals, root) of the least deterministic acceptor of sorted,
    distinct words: states with the same future are one."""
    edges: list[dict[str, int]] = []
    finals: list[bool] = []
    register: dict = {}

    def close(state) -> int:
        key = (state[1], tuple(state[0].items()))
        if key not in register:
            register[key] = len(edges)
            edges.append(state[0])
            finals.append(state[1])
        return register[key]

    path, last = [[{}, False]], ""
    for word in words:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        while len(path) > same + 1:
            done = path.pop()
            path[-1][0][last[len(path) - 1]] = close(done)
        path.extend([{}, False] for _ in word[same:])
        path[-1][1] = True
        last = word
    while len(path) > 1:
        done = path.pop()
        path[-1][0][last[len(path) - 1]] = close(done)
    return edges, finals, close(path[0])


class Composition:
    """The acceptors of open parts of ``width`` and ``width`` + 1 letters,
    composed with the one-edit transducer."""

    def __init__(self, parts: list[str], width: int):
        # Both in one numbering of states, so that states with the same future are shared.
        self.width = width
        short = sorted(p for p in parts if len(p) == width)
        long = sorted(p for p in parts if len(p) == width + 1)
        self.edges, self.finals, self.short = minimised(short)
        more, finals, root = minimised(long)
        at = len(self.edges)
        self.edges += [{c: q + at for c, q in e.items()} for e in more]
        self.finals += finals
        self.long = root + at
        self._memo: dict[tuple[int, int], list[str]] = {}

    def common(self, p: int, q: int) -> list[str]:
        """What both states accept."""
        key = (p, q) if p <= q else (q, p)
        found = self._memo.get(key)
        if found is None:
            found = [""] if self.finals[p] and self.finals[q] else []
            other = self.edges[q]
            for c, to in self.edges[p].items():
                if c in other:
                    found += [c + rest for rest in self.common(to, other[c])]
            self._memo[key] = found
        return found

    def replaced(self) -> Iterator[tuple[str, str]]:
        """Pairs of ``width`` letters that differ in one place, each once."""
        todo = [(self.short, "")]
        while todo:
            state, read = todo.pop()
            out = list(self.edges[state].items())
            for i, (x, p) in enumerate(out):
                for y, q in out[i + 1 :]:
                    for rest in self.common(p, q):
                        yield read + x + rest, read + y + rest
                todo.append((p, read + x))

    def inserted(self, to_end: bool) -> Iterator[tuple[str, str]]:
        """Pairs of ``width`` letters and one more inserted at the first place
        where they differ; after the last letter only if ``to_end``."""
        todo = [(self.short, self.long, "")]
        while todo:
            short, long, read = todo.pop()
            mine, other = self.edges[short], self.edges[long]
            for y, after in other.items():
                if len(read) == self.width:
                    if to_end and self.finals[short] and self.finals[after]:
                        yield read, read + y
                    continue
                for z, p in mine.items():
                    if z != y and z in self.edges[after]:
                        for rest in self.common(p, self.edges[after][z]):
                            yield read + z + rest, read + y + z + rest
            todo += [(p, other[c], read + c) for c, p in mine.items() if c in other]


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partitions (base, lo, hi, before, after, parts) -> (word, near, near_n),
    both ways."""
    for batch in batches:
        for part in batch.to_pylist():
            n = {p["open"]: p["n"] for p in part["parts"]}
            made = Composition(list(n), part["hi"] - part["lo"])
            pairs = [*made.replaced(), *made.inserted(part["hi"] == part["base"])]
            if not pairs:
                continue
            whole = {p: part["before"] + p + part["after"] for p in n}
            word = [whole[x] for pair in pairs for x in pair]
            near = [whole[x] for pair in pairs for x in reversed(pair)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(word), pa.array(near), pa.array([n[x] for pair in pairs for x in reversed(pair)], pa.int64())],
                ["word", "near", "near_n"],
            )


# --- partitions -------------------------------------------------------------


def _opened(rows: DataFrame) -> DataFrame:
    """Rows (word, n, base, lo, hi) with the context around the open part, and
    the open part (a word of one letter more has it one letter longer)."""
    tail = F.expr("substring(word, char_length(word) - (base - hi) + 1, base - hi)")
    middle = F.expr("substring(word, lo + 1, char_length(word) - (base - hi) - lo)")
    return rows.select(
        "word", "n", "base", "lo", "hi", F.expr("substring(word, 1, lo)").alias("before"), tail.alias("after"), middle.alias("open")
    )


def _halves(base: str, lo: str, hi: str) -> str:
    cut = f"({lo} + ({hi} - {lo}) div 2)"
    return f"struct({base} as base, cast({lo} as int) as lo, cast({cut} as int) as hi), struct({base} as base, cast({cut} as int) as lo, cast({hi} as int) as hi)"


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n), both ways: every two of the distinct ``words``
    (word, n) that differ by one inserted, deleted or replaced code point."""
    spark = words.sparkSession
    root = shared_path(spark, "spelling", uuid.uuid4().hex[:12])

    def save(frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{root}/{name}")

    sized = words.where("char_length(word) > 0").select("word", "n", F.expr("char_length(word)").alias("size"))
    # A word is the shorter of a pair, or the longer one of a shorter word with at least one letter.
    own, longer = _halves("size", "0", "size"), _halves("size - 1", "0", "size - 1")
    places = F.expr(f"inline(case when size > 1 then array({own}, {longer}) else array({own}) end)")
    rows = _opened(sized.select("word", "n", places).where("hi > lo"))
    pairs, level = None, 0
    while True:
        rows = save(rows, f"rows_{level}")
        sizes = rows.groupBy(*_KEY).agg(
            F.count(F.lit(1)).alias("members"), F.min(F.char_length("open")).alias("least")
        ).where("members > 1 and least = hi - lo")
        small = F.expr(f"hi - lo = 1 or (members <= {PARTITION} and hi - lo <= {WIDTH})")
        met = save(rows.join(sizes.select(*_KEY, small.alias("small")), _KEY), f"met_{level}")
        parts = met.where("small").groupBy(*_KEY).agg(F.collect_list(F.struct("open", "n")).alias("parts"))
        found = parts.mapInArrow(_compose, "word string, near string, near_n long")
        pairs = found if pairs is None else pairs.unionByName(found)
        large = met.where("not small")
        if large.isEmpty():
            return pairs
        halves = F.expr(f"inline(array({_halves('base', 'lo', 'hi')}))")
        rows = _opened(large.select("word", "n", halves))
        level += 1


def group_variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for distinct ``words`` (word, n).

    Two words are near if they differ by exactly one inserted, deleted or
    replaced code point. ``form`` is the near word with the largest n (ties: the
    smallest in code-point order) if that is at least twice the word's own n, else
    null; ``form_n`` its n; ``root`` what following forms leads to, the word
    itself if it has none; ``n_near`` counts near words. An empty table gives an
    empty result.
    """
    spark = words.sparkSession
    path = shared_path(spark, "spelling", uuid.uuid4().hex[:12])

    def save(frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(f"{path}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{path}/{name}")

    words = save(words.select("word", "n"), "words")
    near = near_pairs(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    )
    joined = words.join(near, "word", "left")
    common = F.expr("-best.less >= 2 * n")
    forms = save(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(common, F.col("best.form")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    # n at least doubles from a word to its form, so the doubling ends after a few steps.
    roots, step = save(forms.where("form is not null").select("word", F.col("form").alias("root")), "roots_0"), 0
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = save(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), f"roots_{step + 1}")
        if moved.where("next is not null").isEmpty():
            break
        roots, step = moved.select("word", "root"), step + 1
    return forms.join(moved.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def word_counts(words: DataFrame, *, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """(word, n) of the words (column ``word``, one row per occurrence) of at
    least ``min_length`` code points that occur ``min_count`` times or more."""
    long = words.where(F.char_length("word") >= min_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
