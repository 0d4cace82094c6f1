"""From raw documents to packed sequences: five stages, each written as a table and read again by the next.

Every stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``. What a stage drops
is gone for the next ones. Defined results for missing values, empty tables and repeated rows are those of the
operators; rows without ``doc_id`` go through every stage.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stillwater.llm import decontaminate, near_duplicates, packing, repeats, toxicity
from stillwater.llm.common import new_name, stored, table
from stillwater.llm.tokens import default_vocabulary


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field scores below a half; the model is fitted on labelled rows of these documents."""
    names = new_name(docs, "tox_score"), new_name(docs, "tox_spans")
    scored = toxicity.tag(spark, docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), names)
    return scored.where(F.col(names[0]) < 0.5).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word shingles, a similarity of 0.8 or more."""
    return near_duplicates.without_near_duplicates(docs, shingle=5, percent=80)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of over 50 words or of 250 bytes that occur twice; a text that loses everything goes."""
    had, name = F.octet_length(F.coalesce("text", F.lit(""))), new_name(docs, "_had")
    left = repeats.without_repeats(docs.withColumn(name, had), REPEAT_BYTES, words=REPEAT_WORDS)
    return left.where((F.col(name) == 0) | (F.trim(F.col("text")) != "")).drop(name)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 1024 tokens."""
    return packing.pack_documents(docs, default_vocabulary())


REPEAT_WORDS = 51
REPEAT_BYTES = 250  # of the passages of any number of words; text without blanks has few

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("repeats", without_repeats),
    ("benchmark", without_benchmark),
    ("packing", packed),
]

ORACLE_SQL = None  # a trained chain, a hash family and a packer have no SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
