"""Token counts under a unigram piece model, by dynamic programming over a trie.

The distinct new words of a slice of texts are put into a trie in sorted order,
so words with a common prefix share a path. The forward score of a prefix (the
best sum of piece log-probabilities that spells it, and the number of pieces in
it) depends on the prefix alone and is computed once per trie node; a word's
node stores its count. Texts then add up the stored counts of their words.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluice.llm.batches import append_columns

#: Words a task remembers; emptied when full, which changes no result.
REMEMBERED_WORDS = 400_000
#: Marks the start of a word in the vocabulary.
WORD_START = "▁"

_WORDS = re.compile(r"\S+")


@dataclass(frozen=True)
class Pieces:
    """Piece -> log-probability, and that of one byte of a character no piece holds."""

    scores: dict
    byte_score: float


def zipf_scores(pieces: list[str]) -> Pieces:
    """Log-probabilities by Zipf's law over the rank in ``pieces``: the r-th of
    n has probability 1 / (r * H_n). A fallback byte is less likely than any."""
    total = math.log(sum(1 / r for r in range(1, len(pieces) + 1))) if pieces else 0.0
    scores = {p: -math.log(r) - total for r, p in enumerate(pieces, 1)}
    return Pieces(scores, min(scores.values(), default=0.0) - 10.0)


def load_pieces(path: str) -> Pieces:
    """The ordinary pieces of a SentencePiece model file, in order of rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        i for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    return zipf_scores([model.id_to_piece(i) for i in plain])


class PieceTrie:
    """Vocabulary as nested dicts; the score of a piece lies under ""."""

    def __init__(self, pieces: Pieces):
        self.root: dict = {}
        self.byte_score = pieces.byte_score
        for piece, score in pieces.scores.items():
            node = self.root
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = score


def count_words(vocabulary: PieceTrie, words: list[str]) -> dict[str, tuple[int, float]]:
    """(pieces, log-probability) of the best segmentation of each word.

    Words in sorted order walk the trie depth first; only the path to the
    current word is kept: per node the forward score, the pieces in it, and the
    vocabulary nodes that pieces begun at earlier nodes have reached. Equal
    scores go to the segmentation with fewer pieces.
    """
    root, byte_score = vocabulary.root, vocabulary.byte_score
    out = {}
    score, count = [0.0], [0]
    open_: list[list] = [[(0, root)]]
    before = ""
    for word in sorted(words):
        spelled = WORD_START + word
        shared = 0
        limit = min(len(before), len(spelled))
        while shared < limit and before[shared] == spelled[shared]:
            shared += 1
        del score[shared + 1 :], count[shared + 1 :], open_[shared + 1 :]
        for at in range(shared, len(spelled)):
            c = spelled[at]
            # A single character can always be spelled by its bytes.
            size = len(c.encode("utf-8", "surrogatepass"))
            best, pieces = score[at] + size * byte_score, count[at] + size
            reached = []
            for start, node in open_[at]:
                after = node.get(c)
                if after is not None:
                    reached.append((start, after))
                    piece = after.get("")
                    if piece is not None:
                        total = score[start] + piece
                        if total > best or (total == best and count[start] + 1 < pieces):
                            best, pieces = total, count[start] + 1
            reached.append((at + 1, root))
            score.append(best), count.append(pieces), open_.append(reached)
        out[word] = (count[-1], score[-1])
        before = spelled
    return out


def count_tokens(
    df: DataFrame, pieces: Pieces, *, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``df`` (or its ``keep`` columns) plus n_words, n_tokens and log_prob of
    each whole text.

    Words are runs of non-space characters, each with a mark for its start.
    Null and empty texts: 0, 0 and 0.0. Columns with these names are replaced.
    No shuffle; memory is bounded by a slice, the words remembered and the
    longest word.
    """
    shared = df.sparkSession.sparkContext.broadcast(pieces)

    def make():
        vocabulary = PieceTrie(shared.value)
        memory: dict[str, tuple[int, float]] = {}

        def work(texts):
            lists = [_WORDS.findall(t.decode("utf-8", "replace")) if t else [] for t in texts]
            new = set().union(*lists) - memory.keys()
            if len(memory) + len(new) > REMEMBERED_WORDS:
                memory.clear()
                new = set().union(*lists)
            memory.update(count_words(vocabulary, list(new)))
            found = [[memory[w] for w in words] for words in lists]
            return [
                pa.array([len(f) for f in found], pa.int64()),
                pa.array([sum(n for n, _ in f) for f in found], pa.int64()),
                pa.array([math.fsum(s for _, s in f) for f in found], pa.float64()),
            ]

        return work

    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("log_prob", T.DoubleType()),
    ]
    return append_columns(df, text_col, fields, make, keep=keep)
