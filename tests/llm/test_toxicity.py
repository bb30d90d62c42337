"""Restoration of disguised words, the Viterbi search, and held-out accuracy."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import toxicity

CLEAN = ["the weather is fine and the trains are running on time", "a stupendous idea from a modern idiom class"]
BAD = ["you are an idiot and a moron", "what a stupid loser you are"]


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(4)
    nice = "time weather train water friend house garden river letter window music paper modern idiom close".split()
    bad = "idiot moron stupid loser".split()
    rows, labels = [], []
    for i in range(400):
        words = rng.choices(nice, k=25)
        toxic = i % 4 == 0
        if toxic:
            for w in rng.sample(bad, rng.choice([1, 2])):
                words[rng.randrange(25)] = w
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))


def scores(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["predicted"] for r in toxicity.score(df, model).orderBy("doc_id").collect()]


def test_disguises_are_restored(model):
    r = toxicity.Restorer(model.bits)
    for disguised, word in [
        ("1d10t", "idiot"), ("m0r0n", "moron"), ("i d i o t", "idiot"), ("idiooooot", "idiot"), ("$tup1d", "stupid"),
        ("l.o.s.e.r", "loser"), ("m-o-r-0-n", "moron"), ("I D I 0 T", "idiot"), ("lo53r", "loser"), ("st*upid", "stupid"),
    ]:
        got = r.texts([f"you {disguised} there".encode()])[0].decode()
        assert got == f"you {word} there", disguised


def test_plain_text_stays(model):
    r = toxicity.Restorer(model.bits)
    for text in ["the water, the letter; a garden!", "Über das größte Fenster", "in 2024 we paid 100 for 3", "ends here. Next"]:
        assert r.texts([text.encode()])[0].decode() == text
    assert r.texts([None, b""]) == [b"", b""]


def test_viterbi_is_the_cheapest_reading(model):
    bits = model.bits
    for span in ["1d10t", "a.b@c", "oooh", "7h3 x", "l|l", "é1é"]:
        best = math.inf
        for path in itertools.product(*toxicity.lattice(span)):
            a = b = 0
            cost = 0.0
            for reading, extra in path:
                cost += extra
                if reading == " " and b:
                    cost, a, b = cost + bits[a][b][0], b, 0
                elif reading not in ("", " "):
                    s = toxicity._symbol(reading)
                    cost, a, b = cost + bits[a][b][s], b, s
            cost += bits[a][b][0] if b else 0
            best = min(best, cost)
        got = toxicity.restore(span, bits.tolist())
        a = b = 0
        least = 0.0
        for c in got:
            s = 0 if c == " " else toxicity._symbol(c)
            least, a, b = least + bits[a][b][s], b, s
        assert least <= best + 1e-9, span


def unsplit(span, bits):
    """The search with whole paths in its states, kept to the end."""
    paths = {(0, 0): (0.0, "")}
    for edges in toxicity.lattice(span):
        after = {}
        for (a, b), (cost, text) in paths.items():
            for reading, extra in edges:
                if reading == "" or (reading == " " and b == 0):
                    state, total, now = (a, b), cost + extra, text
                else:
                    s = 0 if reading == " " else toxicity._symbol(reading)
                    state, total, now = (b, s), cost + extra + bits[a][b][s], text + reading
                if state not in after or (total, now) < after[state]:
                    after[state] = total, now
        paths = after
    return min((c + (bits[a][b][0] if b else 0.0), t) for (a, b), (c, t) in paths.items())[1].strip()


def test_spans_of_any_length_are_decoded(spark, model):
    rng = random.Random(3)
    words = [rng.choice(["you", "are", "an", "idiot", "moron", "garden", "window"]) for _ in range(1100)]
    spaced = " ".join("".join(words))[:10_000]
    noisy = "".join(rng.choices("idot10!.-_ e", k=5_000))
    r = toxicity.Restorer(model.bits)
    for text in (spaced, noisy, "1" * 3_000, "o" * 3_000, "i.d-i_o.t+" * 500, "stu pid - lo ser  mo ron " * 90):
        assert toxicity.restore(text, r.bits) == unsplit(text, r.bits)
    assert r.texts([spaced.encode()])[0].decode() == unsplit(spaced, r.bits) != spaced
    assert r.texts([b"id" + b"i" + b"o" * 90 + b"t"])[0] == b"idiot"
    long = " ".join("garden window idiot garden window moron letter water friend".replace(" ", ""))
    assert scores(spark, model, ["_".join("you are a stupid loser and an idiot and a moron now".replace(" ", "")) + "_" * 30]) == [1]
    assert toxicity.restore(long, r.bits) == unsplit(long, r.bits)


def test_the_filter_admits_every_token_with_several_paths(model):
    rng = random.Random(11)
    r = toxicity.Restorer(model.bits)
    r.bits = None  # the search itself must not run where there is one path
    letters = "abiotOT10$@|+(!€£\u200b\u00ad._-*~',;)é“"
    for _ in range(3000):
        token = "".join(rng.choices(letters, k=rng.randrange(2, 7)))
        core = token.lower().strip(toxicity._EDGE)
        several = any(len(e) > 1 for e in toxicity.lattice(core)) and any(c.isalpha() for c in core)
        data = f"x;; {token} y;;".encode()
        admitted = (4, len(data) - 4) in r._spans(toxicity.Words([data], toxicity.SPACES))
        assert admitted or not several, token
        if not several:
            assert r._decode(token.encode()) == token.encode()


def test_every_declared_disguise_is_restored(model):
    r = toxicity.Restorer(model.bits)
    for disguised, word in [
        ("stuupid", "stupid"), ("iddiot", "idiot"), ("id\u200biot", "idiot"), ("st\u00adupid", "stupid"), ("idio+", "idiot"),
        ("!diot", "idiot"), ("los€r", "loser"), ("IDdiot", "idiot"),
    ]:
        assert r.texts([f"you {disguised} there".encode()])[0].decode() == f"you {word} there", disguised
    for plain in ["a letter!", "the weather is fine. A garden"]:
        assert r.texts([plain.encode()]) == [plain.encode()]
    assert r.texts([b"the letter and the weather"]) == [b"the letter and the weather"]


def test_words_set_apart_by_pieces_and_marks(model):
    r = toxicity.Restorer(model.bits)
    for disguised, word in [
        ("i - d - i - o - t", "idiot"), ("i _ d _ 1 _ o _ t", "idiot"), ("stu pid", "stupid"), ("stu p1d", "stupid"),
        ("mo ron", "moron"), ("idi - ot", "idiot"), ("1di ot", "idiot"), ("lo  ser", "loser"), ("I . D . I . O . T", "idiot"),
    ]:
        got = r.texts([f"we know {disguised} there".encode()])[0].decode()
        assert got == f"we know {word} there", disguised
    for plain in ["weather - time train", "river. Modern music - garden", "close window - paper", "friend, water idiom"]:  # words the model knows
        assert r.texts([plain.encode()])[0].decode() == plain


def test_every_dear_break_is_admitted(model):
    """Breaks that the model would rather join are found where a plain reading finds them."""
    rng = random.Random(21)
    r = toxicity.Restorer(model.bits)
    bits = model.bits
    found = 0
    for _ in range(300):
        words = ["".join(rng.choices("idotmrnlse", k=rng.randrange(1, 5))) for _ in range(rng.randrange(2, 6))]
        text = " ".join(words)
        rows = [(s, e) for s, e in r._spans(toxicity.Words([text.encode()], toxicity.SPACES), joins=True) if b" " in text.encode()[s:e]]
        at = 0
        for left, right in zip(words, words[1:]):
            at += len(left) + 1
            a, b = ([0, *map(toxicity._symbol, left)])[-2:]
            c, d = ([*map(toxicity._symbol, right), 0])[:2]
            apart = bits[a][b][0] + bits[b][0][c] + bits[0][c][d]
            dear = apart - bits[a][b][c] - bits[b][c][d] > toxicity.COST["join"]
            both = len(left) == len(right) == 1
            assert any(s < at < e for s, e in rows) == (dear or both), text
            found += dear
    assert found > 20


def test_scores(spark, model):
    assert scores(spark, model, CLEAN) == [0, 0]
    assert scores(spark, model, BAD) == [1, 1]
    assert scores(spark, model, ["such an 1d10t", "you m o r o n", "stuuupid people", "l0$er"]) == [1, 1, 1, 1]


def test_edge_cases(spark, model, docs):
    long = "water " * 50_000
    rows = [(1, None), (2, ""), (3, "!!! ???"), (4, long + "idiot"), (4, long), (5, "idiot"), (5, "idiot"), (None, "moron")]
    got = toxicity.score(docs(rows, extra=["row", "score"]), model, keep=["doc_id", "row", "score"]).collect()
    assert len(got) == len(rows) and all(r["row"] == "mine" and 0 <= r["score"] <= 1 for r in got)
    assert [r["predicted"] for r in got] == [0, 0, 0, 1, 0, 1, 1, 1]
    assert toxicity.score(docs([]), model).collect() == []


def test_no_labels(spark, docs):
    labels = spark.createDataFrame([(1, None), (None, 1), (1, 7)], "doc_id long, toxic int")
    model = toxicity.fit(docs([(1, "some text")]), labels)
    assert toxicity.score(docs([(1, "some text")]), model).collect()[0]["predicted"] == 0
    empty = toxicity.fit(docs([]), labels.limit(0))
    assert toxicity.score(docs([(1, "x")]), empty).collect()[0]["predicted"] == 0


def test_spans_match_token_by_token_reading(model):
    """The vectorised search for disguised tokens finds what a loop finds."""
    rng = random.Random(8)
    r = toxicity.Restorer(model.bits)
    for _ in range(200):
        tokens = ["".join(rng.choices("abot10$.,!-é", k=rng.randrange(1, 7))) for _ in range(rng.randrange(1, 10))]
        text = " ".join(tokens)
        spans = r._spans(toxicity.Words([text.encode()], toxicity.SPACES))
        assert spans == sorted(set(spans)) or len(spans) == len(set(spans))
        for s, e in spans:
            assert not any(a < e and s < b for a, b in spans if (a, b) != (s, e))


def test_held_out_accuracy(spark):
    from sluice.llm.queries import op1_toxicity

    sf = "/root/testdata/sf0.1"
    got = op1_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n.get((0, 1), 0)) > 0.95
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.8
    assert np.isfinite(got.agg(F.max("score")).first()[0])
