"""Review reports over scored reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shoplayers import constants as K
from shoplayers.functions.numbers import percent
from shoplayers.operators.text import clean_reviews, fit_and_score
from shoplayers.plans.reports import frequency_in_order
from shoplayers.sources.files import LayerTables, cache_scores


def build_scored_reviews(tables: LayerTables, marks: DataFrame) -> int:
    """Clean and score the stored raw reviews and keep the result as a table for all later jobs."""
    return cache_scores(fit_and_score(clean_reviews(tables.read("ods_comment")), marks), tables)


def sentiment_distribution(scored: DataFrame) -> DataFrame:
    """Reviews per band in report order, empty bands included."""
    return frequency_in_order(scored, "label", K.BAND_REPORT_ORDER)


def score_histogram(scored: DataFrame, bins: int = K.HISTOGRAM_BINS) -> DataFrame:
    """Equal bins from the lowest to the highest score, the last bin closed; empty bins included."""
    # One row per distinct score; the limits read the same counts.
    per_score = scored.filter("score IS NOT NULL").groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    limits = per_score.agg(F.struct(F.min("score").alias("low"), F.max("score").alias("high"))).scalar()
    numbered = per_score.withColumn("limits", limits)
    low, high = F.col("limits.low"), F.col("limits.high")
    # With a single value the bins span half a unit to each side of it.
    flat = low == high
    start = F.when(flat, low - 0.5).otherwise(low)
    stop = F.when(flat, high + 0.5).otherwise(high)
    position = F.least(F.width_bucket("score", start, stop, F.lit(bins)), F.lit(bins))
    counts = numbered.groupBy(position.cast("int").alias("bin")).agg(F.sum("n").alias("n"))
    listed = scored.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return listed.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("cnt")).orderBy("bin")


def category_negative_rate(
    scored: DataFrame, categories: DataFrame, min_reviews: int = K.MIN_CATEGORY_REVIEWS, top: int = 10
) -> DataFrame:
    """Categories with the highest negative share, with their names; small categories left out."""
    rates = (
        scored.groupBy("category_id")
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("label") == K.NEGATIVE).alias("neg"))
        .filter(F.col("total") >= min_reviews)
        .withColumn("neg_pct", percent(F.col("neg"), F.col("total"), 6))
        .withColumn("share", F.col("neg") / F.col("total"))  # ranks by the exact share, not the rounded one
        .orderBy(F.desc("share"), "category_id")
        .limit(top)
    )
    named = rates.join(categories.select("category_id", "category_label"), "category_id", "left")
    return named.orderBy(F.desc("share"), "category_id").select(
        "category_id", "total", "neg", "neg_pct", F.coalesce("category_label", F.lit(K.UNKNOWN_CATEGORY)).alias("category_label")
    )


def negative_reviews(scored: DataFrame) -> DataFrame:
    """Negative reviews, worst first."""
    return (
        scored.filter(F.col("label") == K.NEGATIVE)
        .orderBy("score", "ingest_id")
        .select("user_id", "goods_id", "category_id", "comment", F.round("score", 4).alias("score"))
    )
