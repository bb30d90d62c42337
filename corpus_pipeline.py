"""A training-corpus pipeline over the documents table.

Language ID, toxicity, near-duplicate removal, benchmark decontamination, BPE
encoding and decoding, in this order. Every stage takes the documents its
predecessor kept; all but the last return the columns of its input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import bpe, decontam, langid, neardup, toxicity
from sluice.llm.batches import held_out
from sluice.llm.queries import tokenizer_path
from sluice.session import shared_path
from sluice.sources.catalog import read_parquet_table


def _kept(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], condition: Column) -> DataFrame:
    """The rows of ``docs`` for which ``condition`` holds over the judge's
    columns. All columns but the text travel under other names, so none can clash."""
    names = [c if c == "text" else f"column_{i}" for i, c in enumerate(docs.columns)]
    judged = judge(docs.toDF(*names)).where(condition)
    return judged.select(*names).toDF(*docs.columns)


def _learning(df: DataFrame) -> DataFrame:
    return df.where(~F.coalesce(held_out("doc_id"), F.lit(True)))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: rejects those without a letter (null and empty
    texts too), which no language model can place."""
    model = langid.train(_learning(docs.select("doc_id", "text", "lang")))
    if model is None:  # no text with a language: nothing to judge by
        return docs
    return _kept(docs, lambda d: langid.identify(d, model), F.col("lang_pred") != langid.UNKNOWN)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5, by a model of these
    documents and the labels of the learning fold."""
    model = toxicity.fit(docs, _learning(read_parquet_table(spark, sf_dir, "labels")))
    return _kept(docs, lambda d: toxicity.score(d, model), F.col("predicted") == 0)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity
    of 0.8 or more): the one with the least id. Documents without words or id
    stay. Different texts that share an id are different documents; of rows that
    share id and text one stays."""
    with_id = docs.where("doc_id is not null").select("doc_id")
    repeated = with_id.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    path = shared_path(spark, "pipeline", "near_dedup_repeated")
    repeated.write.parquet(path)
    repeated = spark.read.schema(repeated.schema).parquet(path)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if repeated.isEmpty():
        return docs.join(_near_copies(spark, docs, "doc_id"), "doc_id", "left_anti").select(*columns)
    # A number for each id and text, in the order of the ids.
    digest = F.coalesce(F.sha2(F.col("text").cast("string"), 256), F.lit(""))
    keyed = docs.select(F.struct(*columns).alias("document"), "doc_id", "text", digest.alias("digest"))
    nodes = keyed.where("doc_id is not null").select("doc_id", "digest").distinct().orderBy("doc_id", "digest")
    path = shared_path(spark, "pipeline", "near_dedup_nodes")
    nodes.withColumn("node", F.monotonically_increasing_id()).write.parquet(path)
    keyed = keyed.join(spark.read.parquet(path), ["doc_id", "digest"], "left")
    left = keyed.join(_near_copies(spark, keyed.select("node", "text"), "node"), "node", "left_anti")
    once = left.join(repeated, "doc_id", "left_anti").select("document")
    # Any order will do that doesn't change on a retry (maps can't be hashed).
    order = F.xxhash64(*[F.col("document").getField(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()])
    first = left.join(repeated, "doc_id", "left_semi").groupBy("node").agg(F.min_by("document", order).alias("document"))
    rows = once.unionByName(first.select("document"))
    return rows.select(*[F.col("document").getField(c).alias(c) for c in docs.columns])


def _near_copies(spark: SparkSession, docs: DataFrame, id_col: str) -> DataFrame:
    """The ids near_dedup drops, written once."""
    found = neardup.near_duplicates(docs, id_col)
    path = shared_path(spark, "pipeline", "near_dedup")
    found.write.parquet(path)
    return spark.read.parquet(path).where("not kept").select(id_col)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    benchmark = read_parquet_table(spark, sf_dir, "benchmark")
    return _kept(docs, lambda d: decontam.decontaminate(d, benchmark, keep=d.columns), ~F.col("contaminated"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its token ids, their number and the digests of the
    ids and of the decoded text."""
    return bpe.encode_decode(docs, bpe.load(tokenizer_path("word_bpe_49k.json")), ids=True)


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``<sf_dir>/documents.parquet``, each written as Parquet
    in the shared folder and read again by the next."""
    docs = read_parquet_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, "pipeline", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Classifiers, a tokenizer and hashing: no SQL gives these rows.
ORACLE_SQL = None
