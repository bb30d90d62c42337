"""Exact agreement with the tokenizers library, and the decode rule."""

import hashlib
import random

import numpy as np
import pytest

from sluice.llm import bpe
from sluice.llm.queries import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def model():
    return bpe.load(tokenizer_path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


def same(model, library, texts):
    codec = bpe.Codec(model)
    words = codec.words([t.encode() for t in texts])
    for text, w, e in zip(texts, words, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(codec.encode(w), "<u4").tolist() == e.ids, text[:80]
        assert codec.decode(w) == library.decode(e.ids, skip_special_tokens=False)


def test_documents(spark, sf, model, library):
    same(model, library, [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])


def test_random_texts(model, library):
    rng = random.Random(5)
    alphabets = ["antherio", "aaab ", "It's they'LL we've 019.,!?", "éÉßΣςσİı ﬁ ñ日本語한국  \u0085\x1c\n\t", "<|endoftext|> "]
    same(model, library, ["".join(rng.choices(a, k=rng.randrange(80))) for a in alphabets for _ in range(300)])


def test_every_code_point(model, library):
    points = [chr(i) for i in range(1, 0x110000) if not 0xD800 <= i < 0xE000]
    same(model, library, ["a?b ".replace("?", c) + f"X{c}{c}Y" for c in points[:0x33480]])
    same(model, library, ["a?b".replace("?", c) for c in points[0x33480::997]])


def test_bytes_that_are_no_utf8(model):
    codec = bpe.Codec(model)
    (got, want) = codec.words([b"ab\xff\xfecd \xc3", "ab\ufffd\ufffdcd \ufffd".encode()])
    assert got == want and codec.encode(got)


def test_long_words_specials_and_edges(model, library):
    same(
        model, library,
        ["", " ", "a" * 4000, "ab" * 2000, "!" * 500, "Hi<|endoftext|>there <|startoftext|>", "<|ENDOFTEXT|>", "x<<|endoftext|>>"],
    )


def test_memory_limit_changes_nothing(model, monkeypatch):
    texts = [b"some words repeat some words", b"other words come", b"some again"]
    whole = bpe.Codec(model)
    want = [whole.encode(w) for w in whole.words(texts)]
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 2)
    small = bpe.Codec(model)
    assert [small.encode(small.words([t])[0]) for t in texts] == want


def test_rows_and_digests(spark, docs, model):
    df = docs([(1, None), (2, ""), (3, "Hello, hello"), (3, "Hello, hello"), (None, "x")], extra=["n_tokens", "row"])
    got = bpe.encode_decode(df, model, keep=["doc_id", "n_tokens", "row"], ids=True).collect()
    assert len(got) == 5
    empty = hashlib.sha256(b"").hexdigest()
    for r in got[:2]:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["token_ids"]) == (0, empty, empty, [])
    r = got[2]
    assert r["n_tokens"] == len(r["token_ids"]) == 3 and r["row"] == "mine"
    assert r["ids_sha256"] == hashlib.sha256(np.array(r["token_ids"], "<u4").tobytes()).hexdigest()
    assert r["decoded_sha256"] == hashlib.sha256(bpe.decode(model, r["token_ids"]).encode()).hexdigest()
    assert bpe.decode(model, r["token_ids"]) == "hello</w> ,</w> hello</w>"
    assert bpe.encode_decode(docs([]), model).collect() == []
