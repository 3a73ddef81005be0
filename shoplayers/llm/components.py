"""Connected components of a graph held as a table of edges.

Alternating large-star and small-star steps (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014) turn every component into a star around its smallest node. Each step sends a node's
smallest neighbour to its edges; minima are pre-aggregated, and the join that brings them to the edges
cuts the edges of a hub into pieces. Nothing is collected but two numbers a round.

The edges of every round are written to the shared folder and read again, so a lost executor costs one
round at most and neither lineage nor plan grows with the number of rounds (a checkpoint keeps what Spark
knows about the plan before it, which grows beyond measure over a long chain). Only the last round stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from shoplayers.functions.skew import join_counted_lookup
from shoplayers.session import discard, durable, ensure_checkpoint_dir


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or the node itself)."""
    both = edges.select(F.col("lo").alias("node"), F.col("hi").alias("other"), F.lit(1).alias("below")).unionAll(
        edges.select("hi", "lo", F.lit(0))
    )
    smallest = both.groupBy("node").agg(
        F.least(F.min("other"), F.col("node")).alias("root"), F.sum("below").alias("edges")
    )
    smallest = smallest.filter("edges > 0").withColumnRenamed("node", "lo")
    moved = join_counted_lookup(edges, smallest, "lo", "edges", "hi", how="inner")
    return moved.select("hi", F.col("root").alias("lo"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    smallest = durable(edges.groupBy("hi").agg(F.min("lo").alias("root"), F.count(F.lit(1)).alias("edges")))
    moved = join_counted_lookup(edges, smallest, "hi", "edges", "lo", how="inner")
    neighbours = moved.filter("lo <> root").select(F.col("lo").alias("hi"), F.col("root").alias("lo"))
    return neighbours.unionByName(smallest.select("hi", F.col("root").alias("lo")))


def _fingerprint(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)).alias("n"), total.alias("total")).first())


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node of an edge; `root` is the smallest node of its component.

    Self-links and NULL ends are ignored; a table without edges gives an empty result.
    """
    ordered = edges.filter(F.col(left) != F.col(right)).select(
        F.greatest(left, right).alias("hi"), F.least(left, right).alias("lo")
    )
    spark = edges.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/components-{uuid.uuid4().hex}"

    def written(rows: DataFrame, number: int) -> DataFrame:
        rows.write.parquet(f"{folder}/{number}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{number}")

    number = 0
    current = written(ordered.distinct(), number)
    seen = _fingerprint(current)
    while seen[0]:
        current = written(_small_star(durable(_large_star(current).distinct())).distinct(), number + 1)
        discard(spark, f"{folder}/{number}")
        number += 1
        now = _fingerprint(current)
        if now == seen:
            break
        seen = now
    leaves = current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return leaves.unionByName(current.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
