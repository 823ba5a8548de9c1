"""A corpus, stage by stage: language, near-duplicates, repeated passages, benchmark copies, packed sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from forumlake.llm import decontaminate, langid, packing, simhash, substrings
from forumlake.llm.docs import prepared, table
from forumlake.session import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in any mix of the labelled languages.

    Texts without letters (null and empty ones too) go, and those of eight words or more that are mostly in none of the
    languages. All columns and repeated rows are kept; an empty table stays empty.
    """
    prepared(spark)
    return langid.accepted(docs, langid.learn(docs, other=True))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near-duplicates.

    Texts without words (null, empty) are near-duplicates of each other. Rows that share the smallest doc_id all stay; an
    empty table stays empty.
    """
    prepared(spark)
    return simhash.keep_one(docs, shingle_words=4, max_bits=4)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 13 words or more that a document with a smaller doc_id holds.

    Every row and column is kept, texts without words as they are; an empty table stays empty.
    """
    prepared(spark)
    return substrings.without_repeats(docs, min_words=13)


def benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item.

    Null and empty texts hold none and stay, as do repeated rows; an empty table stays empty.
    """
    return decontaminate.without_copies(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens, related documents together.

    Null counts as an empty text, every row has a piece of its own, and an empty table gives none.
    """
    prepared(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keeps_space=False, end_id=1, window=2048)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_copies", benchmark_copies),
    ("sequences", sequences),
]

#: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's documents are written and reread as those of the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
