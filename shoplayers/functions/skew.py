"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shoplayers.session import durable


def join_counted_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    count: str,
    spread: str,
    how: str = "left",
    pieces: int = 1000,
) -> DataFrame:
    """Join `lookup` (one row per key) to `facts`, cutting hot keys into many pieces.

    `lookup[count]` says how many fact rows carry the key. A key is hot when it holds at least
    1/`pieces` of all rows; by that definition at most `pieces` keys are hot, which bounds the
    broadcast table. A hot key gets as many salts as it has such shares, so no join task receives
    more than about 1/`pieces` of the rows from one key. `spread` is a fact column that differs
    between rows; its hash picks the salt, so a recomputed task sends rows to the same place. The
    lookup is stored first, because its total, its hot keys and the join all read it.
    """
    lookup = durable(lookup)
    total = lookup.agg(F.sum(count)).scalar()
    shares = F.ceil(F.col(count) * F.lit(pieces) / total).cast("int")
    sized = lookup.withColumn("_salts", F.when(F.col(count) * pieces >= total, shares).otherwise(F.lit(1)))
    hot = sized.filter("_salts > 1").select(F.col(key).alias("_hot_key"), F.col("_salts").alias("_hot_salts"))
    salted_facts = (
        facts.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_salt", F.pmod(F.xxhash64(spread), F.coalesce("_hot_salts", F.lit(1))).cast("int"))
        .drop("_hot_key", "_hot_salts")
    )
    salted_lookup = sized.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    return salted_facts.join(salted_lookup, [key, "_salt"], how).drop("_salt")
