"""The corpus pipeline: language, exact copies, near copies, the mix, and packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept, read back from Parquet.
All but the last return the columns of ``documents``; a document that the mix repeats is there as often.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from forumlens.llm import exactdedup, langid, mixing, neardup, packing  # noqa: E402
from forumlens.llm.common import table  # noqa: E402
from forumlens.runtime import materialize, ship_package  # noqa: E402


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or at a tie of two languages, go; merely ambiguous ones stay."""
    ship_package(spark)
    return langid.accepted(docs)


def one_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    ship_package(spark)
    return exactdedup.first_of_each(docs)


def one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ship_package(spark)
    return neardup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    ship_package(spark)
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    ship_package(spark)
    return packing.digests(docs, added=packing.ADDED)


STAGES = [
    ("language", known_language),
    ("exact copies", one_of_equal),
    ("near copies", one_of_near),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Language codes, minwise trees and packing are no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"corpus-{name.replace(' ', '-')}")
    return docs
