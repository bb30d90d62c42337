"""PPM language identification: code lengths against a direct reading of the
escape rule, and held-out accuracy."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from sluice.llm import langid


def direct_bits(training, text):
    """Code length of ``text`` per language, symbol by symbol."""
    seen = {b for texts in training.values() for t in texts for b in t.lower().encode()}
    out = {}
    for lang, texts in training.items():
        follows = defaultdict(Counter)
        for t in texts:
            data = b"\0" * 3 + t.lower().encode()
            for i in range(3, len(data)):
                for k in range(4):
                    follows[data[i - k : i]][data[i]] += 1

        def probability(context, symbol, follows=follows):
            if context is None:
                return 1 / 256
            shorter = context[1:] if context else None
            n = follows.get(context)
            if not n:
                return probability(shorter, symbol)
            total = sum(n.values()) + len(n)
            if symbol in n:
                return n[symbol] / total
            rest = 1 - sum(probability(shorter, s) for s in n)
            return len(n) / total * probability(shorter, symbol) / rest

        data = b"\0" * 3 + text.lower().encode()
        out[lang] = sum(-math.log2(probability(data[i - 3 : i], data[i])) for i in range(3, len(data)))
    assert seen
    return out


TRAINING = {
    "aa": ["the cat sat", "The hat is that", "at the"],
    "bb": ["le chat est là", "les chats", "à la mer"],
}


def train(docs, rows):
    return langid.train(docs(rows))


def test_code_lengths(spark, docs):
    rows = [(i, t, lang) for lang, texts in TRAINING.items() for i, t in enumerate(texts)]
    model = train(docs, [*rows, (9, None, "aa"), (10, "ignored", None), (11, "", "bb"), (12, "ignored", "")])
    assert model.langs == ["aa", "bb"]
    texts = ["that cat", "là", "zz top", "the mer est là à la hat", "x", "é\x00a"]
    bits = langid.code_lengths(model, [t.lower().encode() for t in texts])
    for t, row in zip(texts, bits):
        want = direct_bits(TRAINING, t)
        assert row == pytest.approx([want["aa"], want["bb"]], rel=1e-4), t


def test_probabilities_sum_to_one(spark, docs):
    rows = [(i, t, lang) for lang, texts in TRAINING.items() for i, t in enumerate(texts)]
    model = train(docs, rows)
    coded = len(np.unique(model.symbol)) - 1  # without the pad
    p = 2.0 ** -model.bits.reshape(-1, coded, 2).astype(float)
    known = coded - 1
    total = p[:, :known].sum(axis=1) + p[:, known] * (256 - known)
    assert np.allclose(total, 1, atol=1e-4)


def test_held_out_accuracy(spark):
    from sluice.llm.queries import op6_language_id

    sf = "/root/testdata/sf0.01"
    got = op6_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    held = got.where("held_out and n_chars > 20").select("lang", "lang_pred").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)


def test_edge_cases(spark, docs):
    rows = [(i, t, lang) for lang, texts in TRAINING.items() for i, t in enumerate(texts)]
    model = train(docs, rows)
    asked = [(1, None), (2, ""), (3, "123 -- !"), (4, "the " * 60_000), (4, "the cat"), (4, "the cat"), (None, "là"), (5, "汉")]
    df = docs(asked, extra=["score", "row", "lang_pred"])
    got = langid.identify(df, model, keep=["doc_id", "row", "score"]).collect()
    assert len(got) == len(asked) and all(r["row"] == "mine" for r in got)
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append((r["lang_pred"], r["score"]))
    assert by[1] == by[2] == by[3] == [("und", 0.0)]
    assert {x for x, _ in by[4]} == {"aa"} and by[None][0][0] == "bb" and by[5][0][0] in ("aa", "bb")
    assert all(0 <= s <= 1 for v in by.values() for _, s in v)
    assert langid.identify(docs([]), model).collect() == []
    assert langid.train(docs([])) is None
    assert langid.identify(docs([(1, "abc")]), None).collect()[0]["lang_pred"] == "und"


def test_a_small_table_falls_back_on_shorter_contexts(spark, docs, monkeypatch):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choices("abcd ", k=200)), "x") for i in range(5)] + [(9, "efgh " * 40, "y")]
    monkeypatch.setattr(langid, "TABLE_BYTES", 4 * 11 * 2 * 20)
    model = train(docs, rows)
    assert len(model.bits) <= 20 * 11
    got = langid.identify(docs([(1, "abca dbca"), (2, "efgh efgh")]), model).collect()
    assert [r["lang_pred"] for r in got] == ["x", "y"]


@pytest.mark.parametrize("room", [1, 3, 12])
def test_every_context_counts_whatever_is_dense(spark, docs, monkeypatch, room):
    rng = random.Random(room)
    training = {x: ["".join(rng.choices(a, k=rng.randrange(1, 80))) for _ in range(n)] for x, a, n in [("p", "abcdé ", 30), ("q", "abxyz ", 9), ("r", "dé汉字 ", 2)]}
    rows = [(i, t, lang) for lang, texts in training.items() for i, t in enumerate(texts)]
    whole = train(docs, rows)
    assert not len(whole.grams)
    coded = len(np.unique(whole.symbol)) - 1
    monkeypatch.setattr(langid, "TABLE_BYTES", 4 * coded * 3 * room)
    model = train(docs, rows)
    assert len(model.bits) <= room * coded and len(model.grams)
    texts = ["abcd abxy", "é汉 dé", "zz\x00q", "a", *["".join(rng.choices("abcdéxyz汉字 ?", k=60)) for _ in range(20)]]
    bits = langid.code_lengths(model, [t.encode() for t in texts])
    assert bits == pytest.approx(langid.code_lengths(whole, [t.encode() for t in texts]), rel=1e-4)
    for t, row in zip(texts, bits):
        want = direct_bits(training, t)
        assert row == pytest.approx([want["p"], want["q"], want["r"]], rel=1e-4), t
