"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and all that its predecessor kept; its result is
written as Parquet and read again for the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trastienda.llm import exact_dedup, language, mixing, packing, simhash
from trastienda.llm.common import held_out, table
from trastienda.session import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those that the classifier rejects go."""
    known = language.learn(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    return language.keep_known(docs, known)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup.drop_copies(spark, docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) one row."""
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights, a row for each time a document is taken, in training order."""
    return mixing.training_order(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in the training sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: The first stage is a classifier that SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
