"""The corpus pipeline: five stages over ``documents``, each one of the operators in
``tidemart.llm``. Every stage's rows are written below the shared folder and read again.

Defined results of a stage: those of its operator. All stages but the last return the columns of
their input, whatever they are called; the input needs doc_id, text and, to learn languages, lang.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import contamination, language, packing, simhash, substrings
from tidemart.llm.common import named, stored, table
from tidemart.session import pin_utc

#: SQL can express neither the language model nor the tokenizer; tests hold run() against brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go."""
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest doc_id stays. Rows that share a
    doc_id are one document and stay or go together; rows without one stay."""
    groups = simhash.near_duplicates(docs, shingle=3, max_bits=3)
    gone = groups.where("component_id <> doc_id").select("doc_id").distinct()
    kept = docs.alias("d").join(gone.alias("g"), F.col("d.doc_id") == F.col("g.doc_id"), "left_anti")
    return kept.select(named(docs, "d"))


def cut_shared_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages stay in the first document that has them and are cut from the later ones."""
    return substrings.cut(docs, substrings.passages(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 2,048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("substring_dedup", cut_shared_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; returns the packed pieces of the last."""
    pin_utc(spark)
    docs = table(spark, sf_dir.rstrip("/"), "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir.rstrip("/")), name)
    return docs
