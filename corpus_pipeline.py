"""From raw documents to packed sequences: filter, deduplicate, mix, pack.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the
next stage's docs. All but the last return the columns of `docs`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from shoplayers.llm import exact_dedup, mixing, packing, quality_classifier, simhash
from shoplayers.llm.common import table
from shoplayers.session import discard, ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality_classifier.accepted(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of equal texts."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash component."""
    return simhash.deduplicate(docs, width=4, radius=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target weights; a document taken twice is there twice."""
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in sequences of 512 to 4,096 words, end marks included."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("mixing", mix),
    ("best-fit packing", pack),
]

# SQL has no trained classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. A stage's result stays in the shared folder until the next one is written."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        discard(spark, f"{folder}/{number - 1}")
    return docs
