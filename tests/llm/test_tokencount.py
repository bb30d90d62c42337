"""Trie-shared counts against one dynamic programme per word."""

import math
import random

import pytest

from sluice.llm import tokencount
from sluice.llm.queries import tokenizer_path


def brute(pieces, word):
    text = tokencount.WORD_START + word
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(text)
    for end in range(1, len(text) + 1):
        size = len(text[end - 1].encode())
        options = [(best[end - 1][0] + size * pieces.byte_score, best[end - 1][1] + size)]
        for start in range(end):
            if (s := pieces.scores.get(text[start:end])) is not None:
                options.append((best[start][0] + s, best[start][1] + 1))
        best[end] = max(options, key=lambda o: (o[0], -o[1]))
    return best[-1][1], best[-1][0]


@pytest.fixture(scope="module")
def pieces():
    pytest.importorskip("sentencepiece")
    return tokencount.load_pieces(tokenizer_path("piece_bpe_32k.model"))


def test_scores_follow_zipf(pieces):
    assert math.isclose(sum(map(math.exp, pieces.scores.values())), 1, rel_tol=1e-9)
    assert pieces.byte_score < min(pieces.scores.values())


def test_matches_brute_force(pieces):
    rng = random.Random(6)
    words = ["".join(rng.choices(a, k=rng.randrange(1, 14))) for a in ("thereaing", "äöéñßle", "汉字x🙂", "the▁ ") for _ in range(150)]
    got = tokencount.count_words(tokencount.PieceTrie(pieces), words)
    for w in words:
        n, s = brute(pieces, w)
        assert got[w][0] == n and got[w][1] == pytest.approx(s), w


def test_documents(spark, sf, pieces):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    rows = df.select("doc_id", "text").limit(40).collect()
    got = {r["doc_id"]: r for r in tokencount.count_tokens(df, pieces, keep=["doc_id"]).collect()}
    memory = {}
    for r in rows:
        words = r["text"].split()
        for w in words:
            if w not in memory:
                memory[w] = brute(pieces, w)
        g = got[r["doc_id"]]
        assert (g["n_words"], g["n_tokens"]) == (len(words), sum(memory[w][0] for w in words))
        assert g["log_prob"] == pytest.approx(sum(memory[w][1] for w in words))


def test_edge_cases(spark, docs, pieces, monkeypatch):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "word " * 40_000), (4, "word"), (4, "word"), (None, "x" * 30_000)]
    monkeypatch.setattr(tokencount, "REMEMBERED_WORDS", 1)
    got = tokencount.count_tokens(docs(rows, extra=["n_words", "row"]), pieces, keep=["doc_id", "row", "n_words"]).collect()
    assert [(r["n_words"], r["n_tokens"] > 0, r["row"]) for r in got] == [
        (0, False, "mine"), (0, False, "mine"), (0, False, "mine"), (40_000, True, "mine"), (1, True, "mine"), (1, True, "mine"), (1, True, "mine"),
    ]
    assert got[0]["log_prob"] == 0.0
    assert tokencount.count_tokens(docs([]), pieces).collect() == []
