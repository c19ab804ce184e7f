"""Cleans and packs a corpus: the stages, and a run over the documents table.

Each stage takes the documents that the one before kept and returns documents with the
same columns; the last returns the packed pieces. Null or empty texts have no letter
and go in the first stage; repeated rows count as copies of each other in the second;
an empty table passes through as an empty one; extra columns are dropped.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apptflow.llm import decontaminate, language, packing, pii, simhash
from apptflow.session import checkpoint_ready, remove_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that have a letter, so a language of the labelled ones (not ``und``)."""
    docs = docs.select(*COLUMNS)
    return language.accepted(docs, language.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, that with the smallest doc_id if any."""
    return simhash.representatives(docs.select(*COLUMNS))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs.select(*COLUMNS), items)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces entities by surrogates; ``n_chars`` follows the new text."""
    done = pii.anonymize(docs.select(*COLUMNS))
    return done.withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into token sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("pii", without_pii),
    ("packing", packed),
]

#: not expressible in SQL: trained models, tokenizers and keyed surrogates take part
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one keeps is stored and read by the next.

    A stage's folder goes once the next one is written; the last one's stays for the caller.
    """
    if not checkpoint_ready(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
        if k:
            remove_folder(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
    return docs
