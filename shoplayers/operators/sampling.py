"""Reproducible samples, splits and folds.

Random order comes from SHA-256 of a seed and the row's key: the same rows are drawn whatever the
partitioning, the engine or a retried task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shoplayers import constants as K
from shoplayers.functions.columns import shuffle_key
from shoplayers.functions.ordered import Order, cuts, levels, with_hashed_position, with_stratum_position
from shoplayers.session import durable


def sample_per_band(
    scored: DataFrame, per_band: int = K.SAMPLE_PER_BAND, seed: int = K.SEED, key: str = "ingest_id"
) -> DataFrame:
    """Exactly `per_band` rows of each band (all rows of a smaller band).

    The limit on the row number lets every map task keep only its first `per_band` rows a band.
    """
    rows = scored.filter(F.col("label").isNotNull()).withColumn("_draw", shuffle_key(seed, key))
    drawn = W.partitionBy("label").orderBy("_draw", key)
    return rows.withColumn("_nth", F.row_number().over(drawn)).filter(F.col("_nth") <= per_band).drop("_nth", "_draw")


def labelling_sheet(sample: DataFrame, seed: int = K.SEED, key: str = "ingest_id") -> DataFrame:
    """A blind sheet: shuffled, without score and band, with an empty column to fill in."""
    shuffled = W.orderBy(shuffle_key(seed + 1, key), key)  # a few dozen sampled rows per band
    return sample.select(
        F.row_number().over(shuffled).alias("line_no"), "user_id", "goods_id", "comment", F.lit("").alias("gold")
    ).orderBy("line_no")


def short_bands(scored: DataFrame, per_band: int = K.SAMPLE_PER_BAND) -> DataFrame:
    """Bands with fewer rows than a full sample needs, bands without any row included."""
    bands = scored.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in K.CLASSES])).alias("label"))
    counts = scored.groupBy("label").agg(F.count(F.lit(1)).alias("cnt"))
    listed = bands.join(counts, "label", "left").select("label", F.coalesce("cnt", F.lit(0)).alias("cnt"))
    return listed.filter(F.col("cnt") < per_band)


def equidistant_sheet(
    scored: DataFrame,
    strata: Sequence[tuple[float, float]] = K.SHEET_STRATA,
    per_stratum: int = K.SHEET_ROWS_PER_STRATUM,
) -> DataFrame:
    """Negative reviews at equal distances of the score order in each stratum [low, high).

    A negative review whose score is exactly the upper bound lies in no stratum.
    """
    stratum = F.lit(None).cast("int")
    for number, (low, high) in enumerate(strata):
        stratum = F.when((F.col("score") >= low) & (F.col("score") < high), F.lit(number)).otherwise(stratum)
    pool = (
        scored.filter(F.col("label") == K.NEGATIVE)
        .select("ingest_id", "score", F.substring("comment", 1, K.SHEET_CHARS).alias("comment"), stratum.alias("stratum"))
        .filter("stratum IS NOT NULL")
    )
    placed = with_stratum_position(pool, "stratum", ["score", "ingest_id"])
    wanted = F.least(F.col("stratum_size"), F.lit(per_stratum))
    step = F.greatest(F.lit(1), F.floor(F.col("stratum_size") / wanted))
    offset = F.col("position") - 1
    return (
        placed.filter((offset % step == 0) & (offset / step < wanted))
        .select("ingest_id", "score", "comment", F.lit("").alias("review"))
        .orderBy("score", "ingest_id")
    )


def stratified_split(
    df: DataFrame,
    label: str = "label",
    key: str = "id",
    train_share: float = 0.7,
    seed: int = K.SEED,
    max_fit_rows: int = K.MAX_FIT_ROWS,
) -> DataFrame:
    """Mark every row as train or test with the same share in each label, and mark a train subsample.

    `max_fit_rows` bounds the subsample: it takes the same share of the training rows of every label,
    all of them as long as they are no more than that. No row is ranked: the draws at the shares' ends are found by
    counting (over a stored table of draws), one row per label reaches the driver, and rows stay where they are.
    """
    draw = shuffle_key(seed, key)
    drawn = durable(df.select(F.col(label).alias("label"), F.col(key).alias("key"), draw.alias("draw")))
    sizes = {row["label"]: row["n"] for row in drawn.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    train = {value: _half_up(n * train_share) for value, n in sizes.items()}
    total_train = _half_up(sum(sizes.values()) * train_share)
    fit_share = min(1.0, max_fit_rows / total_train) if total_train else 1.0
    wanted = {value: (train[value], math.floor(train[value] * fit_share)) for value in sizes}
    values = list(sizes)

    def order(of: DataFrame, column: Column, draws: str, keys: str, value: object) -> Order:
        return Order([*levels(of, draws), *levels(of, keys)], column.eqNullSafe(F.lit(value)))

    orders = {str(i): order(drawn, F.col("label"), "draw", "key", value) for i, value in enumerate(values)}
    _, found = cuts(drawn, orders, lambda name, _: [rows - 1 for rows in wanted[values[int(name)]]])
    result = df.withColumn("_draw", draw)
    for at, name in enumerate(("is_train", "in_subsample")):
        taken = F.lit(False)
        for i, value in enumerate(values):
            cut = found.get((str(i), wanted[value][at] - 1))
            if cut:
                own = order(result, F.col(label), "_draw", key, value)
                taken = taken | (own.inside() & own.reaches(cut))
        result = result.withColumn(name, taken.cast("int"))
    return result.drop("_draw")


def _half_up(value: float) -> int:
    """Rounded as SQL rounds."""
    return int(Decimal(repr(value)).quantize(Decimal(1), ROUND_HALF_UP))


def fold_ids(df: DataFrame, label: str = "label", key: str = "id", folds: int = 5, seed: int = K.SEED) -> DataFrame:
    """Fold number per row; every label is spread evenly over the folds."""
    placed = with_hashed_position(df.withColumn("_draw", shuffle_key(seed, key)), label, "_draw", key, "_place")
    return placed.withColumn("fold", ((F.col("_place") - 1) % folds).cast("int")).drop("_draw", "_place")
