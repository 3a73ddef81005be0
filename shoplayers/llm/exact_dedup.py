"""Exact deduplication by skew-safe combining.

Texts are equal when they are identical after lower-casing A-Z. Three steps find the classes of equal
texts, and each of them groups by the digest *and* the full text, so a digest collision never merges
two texts:

1. every task of the scan merges the equal texts it holds (Spark's map-side aggregation);
2. what the tasks hold is merged by (digest, text, salt). The salt comes from the number of the scan
   partition, so the copies of one text meet in many small groups, never in one large one;
3. the winners of the salts, at most `salts` a text, are merged by (digest, text).

After that only digests, ids and counts move. Rows look up their class by digest, and a class with
many rows is cut into pieces. If two different texts share a digest, their rows are keyed by the text
itself instead (`content_key`).

Defined results: a NULL text equals an empty one. Of equal texts the largest id stays; NULL is smaller
than any id. Rows with equal text and equal id are one document delivered again: each is reported,
one is kept. Very long texts are compared whole. An empty table gives an empty result. Extra columns are not read
(`deduplicate` keeps them), whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shoplayers.functions.skew import join_counted_lookup
from shoplayers.llm.common import ascii_lower
from shoplayers.session import durable

SALTS = 64


def sha256(normalised: Column) -> Column:
    return F.sha2(normalised, 256)


@dataclass(frozen=True)
class TextClasses:
    """`table` has one row per distinct text: key, keep_id, group_size. `collided` lists the digests
    shared by different texts (None when there are none)."""

    table: DataFrame
    collided: DataFrame | None
    digest: Callable[[Column], Column]


def _merge(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.max("id").alias("id"), F.sum("n").alias("n"))


def text_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> TextClasses:
    """Find the classes of equal texts, comparing full texts in every step."""
    rows = docs.select(
        F.col(id_col).alias("id"), ascii_lower(F.col(text_col)).alias("norm"), F.lit(1).cast("long").alias("n")
    ).withColumns({"digest": digest(F.col("norm")), "salt": F.spark_partition_id() % salts})
    salted = _merge(rows, "digest", "norm", "salt")
    # Placed by digest alone: texts that share a digest meet, so collisions are seen without a shuffle.
    winners = _merge(salted.repartition("digest"), "digest", "norm")
    classes = durable(
        winners.groupBy(F.col("digest").alias("key")).agg(
            F.max("id").alias("keep_id"), F.sum("n").alias("group_size"), F.count(F.lit(1)).alias("texts")
        )
    )
    collided = classes.filter("texts > 1").select(F.col("key").alias("digest"))
    single = classes.filter("texts = 1").drop("texts")
    if collided.isEmpty():
        return TextClasses(single, None, digest)
    apart = _merge(rows.join(collided, "digest", "left_semi"), "norm")
    apart = apart.select(F.col("norm").alias("key"), F.col("id").alias("keep_id"), F.col("n").alias("group_size"))
    return TextClasses(single.unionByName(apart), collided, digest)


def content_key(rows: DataFrame, norm: str, classes: TextClasses) -> DataFrame:
    """Add `key`, which is equal for two rows exactly when their normalised texts are."""
    keyed = rows.withColumn("key", classes.digest(F.col(norm)))
    if classes.collided is None:
        return keyed
    hits = classes.collided.select(F.col("digest").alias("key"), F.lit(True).alias("hit"))
    return keyed.join(hits, "key", "left").withColumn("key", F.when(F.col("hit"), F.col(norm)).otherwise(F.col("key"))).drop("hit")


def resolve(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept and the digest of the normalised text."""
    classes = text_classes(docs, id_col, text_col, salts, digest)
    norm = docs.select(F.col(id_col).alias("id"), ascii_lower(F.col(text_col)).alias("norm"))
    rows = content_key(norm, "norm", classes).withColumn("text_sha256", F.sha2("norm", 256))
    # Repeated deliveries of a document travel as one row with a count.
    deliveries = rows.groupBy("id", "key", "text_sha256").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    joined = join_counted_lookup(deliveries, classes.table, "key", "group_size", "id", how="inner")
    nth = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("nth")
    return joined.select("id", "keep_id", "group_size", "text_sha256", nth).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Every class has one winner, so this join has no hot key: rows are placed by key and id.
    """
    classes = text_classes(docs, id_col, text_col)

    def named(id_: Column) -> Column:  # equal for NULL ids too, so the join and what follows share a partitioning
        return F.when(id_.isNull(), F.lit("null")).otherwise(F.concat(F.lit("id "), id_.cast("string"))).alias("name")

    norm = ascii_lower(F.col(text_col)).alias("norm")
    rows = docs.select(F.struct(*docs.columns).alias("row"), named(F.col(id_col)), norm)
    rows = content_key(rows, "norm", classes).drop("norm")
    winners = classes.table.select("key", named(F.col("keep_id")))
    return rows.join(winners, ["key", "name"]).dropDuplicates(["key", "name"]).select("row.*")
