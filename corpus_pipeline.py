"""The corpus pipeline: five operators over `documents`, each stage working on all that the one before it kept.

Every stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return
the columns of their docs, whatever these are besides doc_id, text, lang, source and n_chars. Texts that a stage shortens
have their n_chars counted again.

Edge cases: a row is known by its doc_id and a hash of its text, so rows of one id with other texts and rows without an
id are decided each by their own text; rows equal in both go or stay together, up to the near-duplicates, of which one
stays. Null and empty texts have no perplexity and pass quality; they are near-duplicates of each other, one stays.
A document that loses all its lines stays, empty, for the next stage. Empty tables pass through. Further columns are kept
as they are, also those named like columns that the stages use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstone.llm import bpe_lexicon, edit_join, kneser_ney, positional_index, simhash_vptree
from loomstone.llm.common import docs_of, fresh, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney model of trusted text accepts."""
    return kneser_ney.accepted(docs, docs_of(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated and near-repeated lines; one that loses all its lines stays, empty."""
    found = edit_join.deduplicated(docs)
    _, removed = fresh(docs.columns, "__lines", "__removed")
    shorter = F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.withColumn("n_chars", shorter).select(*[f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash links over sets of five-word shingles, at a similarity of 0.8 or more."""
    return simhash_vptree.deduplicated(docs, **simhash_vptree.SIMILAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return positional_index.decontaminate(docs, docs_of(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their digest, and that of the text they decode to."""
    return bpe_lexicon.encode(docs)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("encoding", encoding)]

#: SQL cannot express these stages; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = docs_of(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
