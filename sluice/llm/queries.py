"""The registered queries of this subpackage, one thin query per operator."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import (
    ann, bpe, centroids, chat, decontam, html, langid, licenses, neardup, simhash, spelling, sql, tokencount, toxicity,
)
from sluice.llm.batches import held_out
from sluice.sources.catalog import read_parquet_table


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies: under $SLUICE_TOKENIZERS if set,
    else where the installed ``public_tokenizers`` package keeps it."""
    if root := os.environ.get("SLUICE_TOKENIZERS"):
        return os.path.join(root, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_parquet_table(spark, d, name)


def _folded(df: DataFrame) -> DataFrame:
    """``df`` with held_out: crc32 of doc_id as text, modulo 5, is 0. A null id
    teaches nothing."""
    return df.withColumn("held_out", F.coalesce(held_out("doc_id"), F.lit(True)))


def op1_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of the learning fold."""
    docs = _table(spark, d, "documents")
    labels = _folded(_table(spark, d, "labels")).where("not held_out")
    model = toxicity.fit(docs, labels)
    return toxicity.score(_folded(docs.select("doc_id", "text")), model, keep=["doc_id", "held_out"])


def op5_token_counts(spark: SparkSession, d: str) -> DataFrame:
    """Pieces of every document under a unigram model over a public vocabulary."""
    pieces = tokencount.load_pieces(tokenizer_path("piece_bpe_32k.model"))
    return tokencount.count_tokens(_table(spark, d, "documents"), pieces, keep=["doc_id"])


def op6_language_id(spark: SparkSession, d: str) -> DataFrame:
    """Language of every document, learned from the learning fold."""
    docs = _folded(_table(spark, d, "documents").select("doc_id", "text", "lang"))
    model = langid.train(docs.where("not held_out"))
    return langid.identify(docs, model, keep=["doc_id", "held_out"])


def op2_ann(spark: SparkSession, d: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    vectors = _table(spark, d, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op3_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(_table(spark, d, "pages"), keep=["page_id", "url"])


def op4_minhash_neardup(spark: SparkSession, d: str) -> DataFrame:
    """Near-duplicate components on 3-word shingles, Jaccard similarity of 85 % or more."""
    return neardup.near_duplicates(_table(spark, d, "documents"), shingle=3, percent=85)


def op7_chat_perspectives(spark: SparkSession, d: str) -> DataFrame:
    """Every conversation rendered from each speaker's side, with masks."""
    return chat.perspectives(_table(spark, d, "conversations"))


def op8_license_scan(spark: SparkSession, d: str) -> DataFrame:
    """License phrases and template matches of every document."""
    return licenses.scan_licenses(_table(spark, d, "documents"), keep=["doc_id"])


def op9_bpe(spark: SparkSession, d: str) -> DataFrame:
    """Every document encoded and decoded with a public byte-level BPE vocabulary."""
    return bpe.encode_decode(_table(spark, d, "documents"), bpe.load(tokenizer_path("word_bpe_49k.json")), keep=["doc_id"])


def op10_decontamination(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark passages in every document: 13-word windows, exact containment."""
    return decontam.decontaminate(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


def op11_centroid_clustering(spark: SparkSession, d: str) -> DataFrame:
    """Every vector's cluster after three exact Lloyd rounds over 16 centroids."""
    assigned, found = centroids.lloyd(_table(spark, d, "embeddings"), dim=64, k=16, rounds=3, scale=64, seed="1")
    return centroids.with_inertia(assigned, found)


def op12_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    """Spelling variants among the words of all documents. An occurrence whose
    crc32 with its document's id is a multiple of 97 has lost a letter (none has
    where the id is null)."""
    runs = spelling.runs(_table(spark, d, "documents"), min_length=5)
    h = F.crc32(F.concat(F.col("id").cast("string"), F.lit(":"), F.col("run")))
    lost = spelling.without_letter(F.col("run"), h % F.char_length("run"))
    words = runs.select(F.when(h % 97 == 0, lost).otherwise(F.col("run")).alias("word"))
    return spelling.group_variants(spelling.word_counts(words, min_length=5, min_count=3))


def op13_simhash_neardup(spark: SparkSession, d: str) -> DataFrame:
    """Components of documents whose 64-bit SimHash differs in two bits or fewer."""
    return simhash.near_duplicates(_table(spark, d, "documents"), shingle=3)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_ann": op2_ann,
    "op3_html_extraction": op3_html_extraction,
    "op4_minhash_neardup": op4_minhash_neardup,
    "op5_token_counts": op5_token_counts,
    "op6_language_id": op6_language_id,
    "op7_chat_perspectives": op7_chat_perspectives,
    "op8_license_scan": op8_license_scan,
    "op9_bpe": op9_bpe,
    "op10_decontamination": op10_decontamination,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_simhash_neardup": op13_simhash_neardup,
}

ORACLE_SQL: dict[str, str] = {
    "op4_minhash_neardup": sql.NEAR_DUPLICATES,
    "op7_chat_perspectives": sql.CHAT_PERSPECTIVES,
    "op8_license_scan": sql.license_scan(),
    "op10_decontamination": sql.DECONTAMINATION,
    "op11_centroid_clustering": sql.centroid_clustering(),
    "op12_spelling_variants": sql.SPELLING_VARIANTS,
}
