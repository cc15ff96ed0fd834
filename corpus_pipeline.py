"""A corpus pipeline over the documents table: each stage calls one operator.

Stages take and return whole tables. Rows come with the columns of
``documents`` (doc_id, text, lang, source, n_chars) and leave with the same,
except the last stage, which returns the pieces of packed sequences. Nulls in
any column, empty and very long texts, repeated rows and empty tables pass
through every stage as its operator defines. Each stage sizes its shuffles by
the files of the table it reads.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import read_table, sized_for, stored
from tripflow.llm.exact_dedup import keep_first_texts
from tripflow.llm.language import keep_identified
from tripflow.llm.mixing import Mix
from tripflow.llm.near_dedup import BAND_ROWS_80, keep_one_of_each
from tripflow.llm.packing import pack_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or that no learned language claims, go."""
    return keep_identified(sized_for(docs), public_tokenizers.path("piece_bpe_32k.model"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return keep_first_texts(sized_for(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, of similarity 0.8 or more, stays."""
    return keep_one_of_each(sized_for(docs), percent=80, band_rows=BAND_ROWS_80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as much of them, as the mix of sources takes.

    A document taken twice gives two rows with its id; n_chars follows the text.
    """
    mixed = Mix(sized_for(docs)).texts()
    return mixed.withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens: the rows of ``pack_documents``."""
    return pack_documents(sized_for(docs), public_tokenizers.path("word_bpe_49k.json")).drop("row")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# SQL cannot express the language model and the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again for the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
