"""From documents to packed sequences; each stage reads what the one before it wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm.common import table
from tidemill.llm.exact_dedup import drop_exact_copies
from tidemill.llm.mixing import mixed_documents
from tidemill.llm.near_dedup import drop_near_copies
from tidemill.llm.packing import pack_documents
from tidemill.llm.toxicity import drop_toxic
from tidemill.session import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the classifier, trained on the labels beside the documents, lets pass."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share four fifths of their shingles."""
    return drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of small sources up to twice."""
    return mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document is packed."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact dedup", without_exact_copies),
    ("near dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]
ORACLE_SQL = None  # the stages learn, hash and search


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
