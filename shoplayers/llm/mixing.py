"""Mixing sources to target weights by Pareto order sampling.

Sizes are words. Every source gets a share of the budget by its weight, at most `max_repeats` times its
own size; what a capped source leaves is shared again among the others by weight.

A source that wants c whole times its size and a rest takes every document c times for certain. The
rest is a sample of fixed size (in words) with unequal inclusion probabilities: p is proportional to
the document's size, rounded down to a power of two, and documents whose p would reach 1 are certain as
well (this lets the sample end among small documents, so the words taken come close to the target).
Rosén's Pareto order sampling ranks the others by random odds divided by inclusion odds,

    q = (u / (1 - u)) / (p / (1 - p)),    u a hash of seed and id,

and takes the smallest until their words fill the rest; the document on the edge is taken if its middle
lies inside.

No source is ranked in one task. v = q / (1 + q) lies in (0, 1); words are counted in `BINS` bins of v
per source, the bin on the edge is counted again in `BINS` bins, and only the documents of that last bin
(about one in a million of the source) are sorted. What moves per document is narrow and stored once.

Defined results: a NULL text has size 0; documents of size 0 are never taken and take nothing. NULL
sources are a source of their own, last in order. Repeated rows are documents of their own that share u.
Very long texts are counted whole. An empty table gives an empty result. Extra columns are not read (`mixed_rows` keeps
them), whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shoplayers.functions.ordered import with_running_totals
from shoplayers.functions.skew import join_counted_lookup
from shoplayers.llm.common import row_digest, word_count
from shoplayers.session import durable

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
SEED = 42
BINS = 1024
RANDOM_BITS = 48


def uniform(id_: Column, seed: int) -> Column:
    """A number in (0, 1) from the first 48 bits of an MD5 over seed and id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))))
    number = F.conv(F.substring(digest, 1, RANDOM_BITS // 4), 16, 10).cast("bigint")
    return (number + F.lit(0.5)) / F.lit(float(1 << RANDOM_BITS))


def source_targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """Add `target` (words) to a table of sources (source_key, source_size, documents).

    The weights go round over the sources in the order of their key. With sources in the order of
    cap / weight, the level (words per weight) that fills the budget is the largest of the levels that
    treat all sources before some place as capped and leave the source at that place under its cap.
    """
    placed = with_running_totals(sources, [], ["source_key"], {"place": F.lit(1).cast("long")})
    weight = reduce(
        lambda rest, i: F.when((F.col("place") - 1) % len(weights) == i, F.lit(weights[i])).otherwise(rest),
        range(len(weights)),
        F.lit(None).cast("int"),
    )
    weighed = placed.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_repeats)
    weighed = weighed.withColumn("reach", F.col("cap").cast("double") / F.col("weight"))
    filled = durable(
        with_running_totals(
            weighed, [], ["reach", "source_key"], {"caps": F.col("cap"), "weights": F.col("weight").cast("long")}
        )
    )
    totals = filled.agg(F.struct(F.sum("source_size").alias("words"), F.sum("weight").alias("weights"))).scalar()
    level = (F.col("t.words").cast("double") * F.lit(share) - (F.col("caps") - F.col("cap"))) / (
        F.col("t.weights") - (F.col("weights") - F.col("weight"))
    )
    levels = filled.withColumn("t", totals).select("cap", "weight", level.alias("level"))
    best = levels.filter(F.col("cap") >= F.col("weight") * F.col("level")).agg(F.max("level")).scalar()
    target = F.least(F.col("weight") * F.coalesce(best, F.lit(float("inf"))), F.col("cap").cast("double"))
    return filled.select("source_key", "source_size", "documents", target.alias("target"))


def _inclusion(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source and size class: whole copies, the inclusion probability of one more, and the words
    the sample has to fill (`room`). At most 63 rows a source."""
    classes = (
        sized.filter("size > 0")
        .groupBy("source_key", "size_class")
        .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("class_rows"))
        .join(targets.filter("source_size > 0"), "source_key")
        .withColumn("copies", F.floor(F.col("target") / F.col("source_size")).cast("long"))
        .withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
        .withColumn("odds_weight", F.expr("shiftleft(1L, CAST(size_class - 1 AS INT))"))
    )
    largest_first = W.partitionBy("source_key").orderBy(F.desc("size_class"))
    product = F.col("odds_weight").cast("decimal(19,0)") * F.col("words").cast("decimal(19,0)")
    classes = classes.withColumns(
        {
            "larger": F.coalesce(F.sum("words").over(largest_first.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
            "mass": F.sum(product).over(largest_first.rowsBetween(0, W.unboundedFollowing)).cast("double"),
        }
    ).withColumn("scale", (F.col("rest") - F.col("larger")) / F.col("mass"))
    source = W.partitionBy("source_key")
    scale = F.max(F.when(F.col("scale") * F.col("odds_weight") <= 1, F.col("scale"))).over(source)
    classes = classes.withColumn("p", F.least(F.lit(1.0), F.col("odds_weight") * scale))
    sure = F.sum(F.when(F.col("p") >= 1, F.col("words")).otherwise(F.lit(0))).over(source)
    return classes.withColumn("room", F.col("rest") - sure)


def _edge(counted: DataFrame, bin_: str, before: Column) -> DataFrame:
    """Per source, the bin in which the words pass `room`, and the words before it."""
    so_far = W.partitionBy("source_key").orderBy(bin_).rowsBetween(W.unboundedPreceding, W.currentRow)
    passed = counted.withColumn("upto", before + F.sum("words").over(so_far)).filter(F.col("upto") > F.col("room"))
    return passed.groupBy("source_key").agg(
        F.min(F.struct(F.col(bin_), (F.col("upto") - F.col("words")).alias("before"))).alias("edge")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """One row per input row: id, size, source_size, target (its source's), taken (words), copies."""
    source = F.col(source_col).cast("string")
    size = word_count(F.col(text_col))
    sized = durable(
        docs.select(
            F.col(id_col).alias("id"),
            F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source)).alias("source_key"),
            size.alias("size"),
        ).withColumns({"size_class": F.length(F.bin("size")), "u": uniform(F.col("id"), seed)})
    )
    sources = sized.groupBy("source_key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    targets = durable(source_targets(sources, weights, share, max_repeats))

    # Inclusion probabilities, looked up by source and size class.
    class_key = F.concat(F.col("source_key"), F.lit("/"), F.col("size_class").cast("string"))
    inclusion = _inclusion(sized, targets).select(class_key.alias("class_key"), "class_rows", "copies", "p", "room")
    drawn = join_counted_lookup(sized.withColumn("class_key", class_key), inclusion, "class_key", "class_rows", "id")
    against = F.col("u") * (1 - F.col("p"))
    v = against / (against + (1 - F.col("u")) * F.col("p"))
    ranked = durable(
        drawn.withColumn("v", F.when((F.col("p") > 0) & (F.col("p") < 1), v))
        .withColumn("bin", F.floor(F.col("v") * BINS).cast("int"))
        .withColumn("fine", F.floor((F.col("v") * BINS - F.col("bin")) * BINS).cast("int"))
        .select("id", "source_key", "size", "copies", "p", "room", "v", "bin", "fine")
    )

    # The edge of every source, twice refined.
    ordered = ranked.filter("v IS NOT NULL")
    words = F.sum("size").alias("words")
    coarse = ordered.groupBy("source_key", "bin", "room").agg(words)
    first = _edge(coarse, "bin", F.lit(0)).selectExpr("source_key", "edge.bin AS bin", "edge.before AS before")
    in_edge = ordered.join(first, ["source_key", "bin"])
    second = _edge(
        in_edge.groupBy("source_key", "fine", "room", "bin", "before").agg(words), "fine", F.col("before")
    ).selectExpr("source_key", "edge.fine AS edge_fine", "edge.before AS edge_before")
    edges = (
        targets.join(first.selectExpr("source_key", "bin AS edge_bin"), "source_key", "left")
        .join(second, "source_key", "left")
        .select("source_key", "documents", "source_size", "target", "edge_bin", "edge_fine", "edge_before")
    )
    placed = join_counted_lookup(ranked, edges, "source_key", "documents", "id", how="inner")

    # Before the edge a document is in, behind it out; on it, the exact order decides.
    on_edge = (F.col("bin") == F.col("edge_bin")) & (F.col("fine") == F.col("edge_fine"))
    on_edge = F.coalesce(on_edge, F.lit(False))
    before_edge = F.col("edge_bin").isNull() | (F.col("bin") < F.col("edge_bin"))
    before_edge |= (F.col("bin") == F.col("edge_bin")) & (F.col("fine") < F.col("edge_fine"))
    inside = (F.col("p") >= 1) | (F.col("v").isNotNull() & F.coalesce(before_edge, F.lit(False)))
    plain = placed.filter(~on_edge).withColumn("extra", F.coalesce(inside, F.lit(False)).cast("long"))
    exact = W.partitionBy("source_key").orderBy("v", "id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    middle = 2 * (F.col("edge_before") + F.sum("size").over(exact)) - F.col("size")
    edge = placed.filter(on_edge).withColumn("extra", (middle <= 2 * F.col("room")).cast("long"))
    copies = F.coalesce(F.col("copies"), F.lit(0).cast("long")) + F.col("extra")
    return (
        plain.unionByName(edge)
        .withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0).cast("long")))
        .select(
            F.col("id").alias(id_col),
            "size",
            "source_size",
            "target",
            (F.col("copies") * F.col("size")).alias("taken"),
            "copies",
        )
    )


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The mix itself: every row as often as it is taken, with all its columns.

    Rows are matched by id and size, and numbered among the rows that share both by a digest of their columns, so
    the same rows get the same copies every time.
    """

    def named(id_: Column) -> Column:
        return F.when(id_.isNull(), F.lit("null")).otherwise(F.concat(F.lit("id "), id_.cast("string"))).alias("name")

    shares = mix(docs, id_col, **options).groupBy(named(F.col(id_col)), "size")
    shares = shares.agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).filter("copies > 0")
    size = word_count(F.col(options.get("text_col", "text"))).alias("size")
    rows = docs.select(F.struct(*docs.columns).alias("row"), named(F.col(id_col)), size, row_digest(docs).alias("digest"))
    joined = rows.join(shares, ["name", "size"])
    nth = F.row_number().over(W.partitionBy("name", "size").orderBy("digest"))
    own = F.floor(F.col("copies") / F.col("rows")) + (F.col("nth") <= F.col("copies") % F.col("rows")).cast("long")
    own = joined.withColumn("nth", nth).select("row", own.cast("int").alias("own")).filter("own > 0")
    return own.select("row", F.explode(F.sequence(F.lit(1), F.col("own")))).select("row.*")
