"""Corpus pipeline over ``documents``: language ID, exact dedup, SimHash near-dedup, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of ``documents``.  ``run`` writes each stage as Parquet and reads it back as the next
one's input.  No stage depends on ids being unique: rows are told apart by their content, and
identical rows are interchangeable.  An empty table passes through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeframe.llm import exact_dedup, language_id, mixing, packing, simhash
from lakeframe.llm.common import emit_copies, land
from lakeframe.session import read_table

# The smallest source is walked at most this often for each walk of the largest; every document
# that reaches the stage is emitted at least once.
MIXING = {"max_repetition": 2.0}


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those that resemble none of the learned languages."""
    return language_id.keep_identified(docs, language_id.train(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each text (white space aside): the longest, then the smallest id."""
    return emit_copies(docs, exact_dedup.kept_copies(exact_dedup.exact_dedup(docs)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each component of linked fingerprints."""
    return emit_copies(docs, simhash.kept_copies(simhash.simhash_dedup(docs, words_per_shingle=3, radius=2)))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of small sources to the tempered weights; drops none."""
    return emit_copies(docs, mixing.copies(mixing.mix_sources(docs, **MIXING)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, each with its sequence and place."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", identify_language), ("exact_dedup", drop_exact_copies), ("simhash_dedup", drop_near_copies),
          ("mix_sources", mix), ("pack", pack)]

# Language ID is a trained model, SimHash and packing are not SQL: tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
