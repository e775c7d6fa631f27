"""A training corpus in five stages, from the ``documents`` table to packed sequences.

Each stage works on all that the one before it kept.  All but the last return
the columns of ``documents``; the last returns the pieces of the sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brightweir.llm import exact_dedup, langid, packing, secret_scan, simhash
from brightweir.llm.common import staged, table
from brightweir.session import configure

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter go."""
    return langid.known_language(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.first_of_equal(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints."""
    return simhash.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    return secret_scan.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, along the curve."""
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("secrets", secrets),
    ("packing", packed),
]

# Language models, fingerprints and curves have no SQL; a test holds the rows
# against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again by the next."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
