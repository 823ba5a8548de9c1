"""Registered queries of the training-data operators: query name -> function (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlake.llm import (
    ann,
    best_fit,
    collocations,
    decontaminate,
    langid,
    licenses,
    packing,
    prefix_trie,
    quality,
    simhash,
    substrings,
    token_files,
    toxicity,
)
from forumlake.llm.docs import table
from forumlake.llm.sampling import remainder
from forumlake.session import new_dir


def _held_out(divisor: int, remains: int) -> Column:
    return F.coalesce(remainder("doc_id", divisor) == remains, F.lit(False)).alias("held_out")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(remainder("doc_id", 3) != 1))
    return langid.languages(docs, model).select("doc_id", _held_out(3, 1), "lang_pred", "score", "switches")


def op2_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors.where("vec_id % 100 = 0"), vectors, k=10)


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), new_dir(spark, "tokens")
    token_files.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), keeps_space=True, end_id=0)
    return token_files.checksums(token_files.read_tokens(spark, path))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.copies(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs.where(remainder("doc_id", 5) != 0), table(spark, sf_dir, "labels"))
    return toxicity.toxicity(docs, model).select("doc_id", _held_out(5, 0), "score", "predicted")


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeats(table(spark, sf_dir, "documents"), min_words=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.learn(docs.where(remainder("doc_id", 5) != 0), table(spark, sf_dir, "labels"))
    return quality.quality(docs, model).select("doc_id", _held_out(5, 0), "score", "predicted")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, keeps_space=False, end_id=1, window=2048)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns(table(spark, sf_dir, "conversations"))
    head = "crc32(CAST(CAST(conv_id AS STRING) AS BINARY)) % 9"
    return prefix_trie.trie(*prefix_trie.with_heads(turns, base="conv_id - conv_id % 5", head=head, longest=8))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return best_fit.pack(table(spark, sf_dir, "documents"), path, keeps_space=False, end_id=0, window=2048)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=10, top=2000, subsumed_percent=50)


QUERIES = {
    "op1_langid": op1_langid,
    "op2_vectors": op2_vectors,
    "op3_tokens": op3_tokens,
    "op4_decontaminate": op4_decontaminate,
    "op5_toxicity": op5_toxicity,
    "op6_substrings": op6_substrings,
    "op7_quality": op7_quality,
    "op8_licenses": op8_licenses,
    "op9_packing": op9_packing,
    "op10_simhash": op10_simhash,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_best_fit": op12_best_fit,
    "op13_collocations": op13_collocations,
}

#: SQL of the queries that SQL can express.
ORACLE: dict[str, str] = {"op8_licenses": licenses.oracle()}
