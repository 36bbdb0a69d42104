"""A corpus pipeline over `documents`: each stage's result is written as Parquet and read again as the next one's input.

Languages are identified and unknown ones go, one document of each group of near-duplicates stays, personal numbers become
pseudonyms, sources are mixed to target weights, and what is left is cut into pieces of a public vocabulary.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import language, mixing, neardup, pii, sentence_pieces
from meterline.llm.common import remainder, stored, table
from meterline.llm.queries import PII_KEY, VOCABULARY


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without a letter and those of no known language go, each row by its own text."""
    return language.identified(docs, language.fit(docs.where(remainder(F.col("doc_id"), 4) != 2)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class, of the smallest id. Rows that share an id, or have none, are documents of their own."""
    return neardup.representatives(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; those with a null or empty text, or without personal values, unchanged."""
    return pii.pseudonymise(docs, PII_KEY)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the mixture keeps. Rows of one id share a draw; null and empty texts go."""
    return mixing.sampled(docs)


def cut_in_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows (doc_id, ids, n_pieces), one for each row; null and empty texts have no pieces."""
    return sentence_pieces.encode(docs, sentence_pieces.load(VOCABULARY))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", replace_personal_data),
    ("mixing", mix),
    ("sentence_pieces", cut_in_pieces),
]

#: Likelihoods, hashed signatures and the segmentation have no SQL form; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
