"""The pipeline stage by stage, and the registered queries and oracles."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import queries
from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_neardup import brute as near_copies

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage over the smallest tables."""
    root = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{root}/{name}")
        after = spark.read.parquet(f"{root}/{name}")
        out[name] = (docs, after)
        docs = after
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "near_dedup", "decontamination", "bpe"]


def test_all_but_the_last_keep_the_columns(stages):
    first = stages["language_id"][0].schema
    for name, (before, after) in stages.items():
        assert after.columns[: len(before.columns)] == before.columns
        assert name == "bpe" or [f.dataType for f in after.schema] == [f.dataType for f in first]


def test_near_dedup_keeps_one_of_each_group(stages):
    before, after = stages["near_dedup"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    assert ids(after) == sorted(i for i, (_, _, kept) in near_copies(rows, 5, 80).items() if kept)


def test_decontamination_drops_the_contaminated(spark, stages):
    before, after = stages["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = contaminated([(r["doc_id"], r["text"]) for r in before.collect()], items)
    assert ids(after) == sorted(row[0] for row in found if not row[-1])


def test_language_and_toxicity_follow_their_operators(spark, stages):
    from sluice.llm import toxicity

    before, after = stages["toxicity"]
    labels = corpus_pipeline._learning(spark.read.parquet(f"{SF}/labels.parquet"))
    scored = toxicity.score(before, toxicity.fit(before, labels), keep=["doc_id"])
    assert ids(after) == ids(scored.where("predicted = 0"))
    before, after = stages["language_id"]
    letters = [r["doc_id"] for r in before.collect() if any(c.isalpha() for c in r["text"] or "")]
    assert ids(after) == sorted(letters)


def test_bpe_keeps_every_document(stages):
    before, after = stages["bpe"]
    assert ids(before) == ids(after)
    assert after.where(F.size("token_ids") != F.col("n_tokens")).count() == 0


def test_run_gives_the_last_stage(spark, stages):
    assert ids(corpus_pipeline.run(spark, SF)) == ids(stages["bpe"][1])


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, name, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, n_words string, row string, kept string"
    extra = ("s", 1, "mine", "mine", "mine", "mine")
    rows = [(1, "alpha beta gamma delta epsilon zeta", "en"), (2, None, "en"), (3, "", None), (4, "12 34", "en"), (None, "alpha beta words", "en"),
            (5, "repeated row of text here", "en"), (5, "repeated row of text here", "en"), (6, "x " * 60_000, None)]
    docs = spark.createDataFrame([(*r, *extra) for r in rows], schema)
    out = stage(spark, docs, SF)
    got = out.collect()
    assert all(r["row"] == r["score"] == r["kept"] == "mine" for r in got)
    want = {
        "language_id": [None, 1, 5, 5, 6], "toxicity": [None, 1, 2, 3, 4, 5, 5, 6], "near_dedup": [None, 1, 2, 3, 4, 5, 6],
        "decontamination": [None, 1, 2, 3, 4, 5, 5, 6], "bpe": [None, 1, 2, 3, 4, 5, 5, 6],
    }
    assert sorted((r["doc_id"] for r in got), key=lambda i: (i is not None, i or 0)) == want[name]
    assert stage(spark, docs.limit(0), SF).collect() == []


def test_texts_that_share_an_id_are_judged_one_by_one(spark):
    words = [f"w{i}" for i in range(200)]
    a, b, c, d = (" ".join(words[k : k + 40]) for k in (0, 50, 100, 150))
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (3, c, "x"), (3, d, "y"), (3, d, "z"), (10, b, "x"), (None, a, "x"), (4, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    got = corpus_pipeline.near_dedup(spark, docs, SF)
    assert got.columns == docs.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr)
    assert kept == sorted([(1, a), (2, b), (3, c), (3, d), (None, a), (4, None)], key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'").fetchall()
    df = queries.QUERIES[name](spark, SF)
    rel = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLE_SQL[name]})")
    want = sorted(map(repr, rel.fetchall()))
    assert sorted(repr(tuple(r)) for r in df.collect()) == want


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    found = entry.queries()
    assert all(any(q.startswith(f"op{n}_") for q in found) for n in range(1, 11)) and "pipeline" in found
