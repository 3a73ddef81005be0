"""Row cleaning: deduplication, fills and clamps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shoplayers import constants as K
from shoplayers.functions.columns import clamp
from shoplayers.functions.ordered import exact_quantile
from shoplayers.session import stored

CORE_COLUMNS = ("user_id", "goods_id", "behavior", "timestamp")


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column] = ("ingest_id",)) -> DataFrame:
    """First row per key in stored order.

    The filter on the row number makes Spark keep one row per key and map task before the
    shuffle, so a key with very many rows costs at most one row per task.
    """
    first = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1").drop("_nth")


def drop_duplicate_events(df: DataFrame) -> DataFrame:
    """Remove repeated rows and rows that repeat (user, goods, behaviour, timestamp).

    Rows equal in every column are also equal in the four key columns, so one pass does both.
    """
    return keep_first(df, CORE_COLUMNS)


def most_frequent(df: DataFrame, column: str) -> Column:
    """Smallest most frequent value as a scalar subquery; NULL for an empty column."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(1).select(column).scalar()


def fill_gaps(df: DataFrame) -> DataFrame:
    """Drop rows without a core value, then fill the rest: mode for sex, constants elsewhere."""
    kept = df.dropna("any", subset=list(CORE_COLUMNS))
    mode = most_frequent(kept, "sex")
    return kept.withColumn("sex", F.coalesce("sex", mode, F.lit(0))).fillna(
        {"price": 0, "amount": 0, "address": K.UNKNOWN, "device": K.UNKNOWN, "comment": K.NO_COMMENT}
    )


def clamp_outliers(df: DataFrame, quantile: float = K.PRICE_QUANTILE) -> DataFrame:
    """Cut prices at an exact quantile and amounts at fixed limits.

    The rows are stored once, because the quantile and the result both read them.
    """
    df = stored(df)
    limit = exact_quantile(df, "price", quantile)
    price = F.col("price").cast("double")
    return df.withColumns(
        {
            "price": F.when(price.isNotNull(), F.least(price, limit)),
            "amount": clamp(F.col("amount"), *K.AMOUNT_RANGE),
        }
    )


def preprocess(df: DataFrame) -> DataFrame:
    """The full row cleaning: fill, deduplicate, clamp."""
    return clamp_outliers(drop_duplicate_events(fill_gaps(df)))


def cleaning_effect(df: DataFrame, cleaners: Mapping[str, Column], keys: Sequence[str]) -> DataFrame:
    """Distinct values before and after cleaning, rows before and after key deduplication.

    Each figure is counted from distinct values that were merged before the shuffle.
    """
    measures = {}
    for name, cleaned in cleaners.items():
        measures[f"{name}_before"] = F.col(name)
        measures[f"{name}_after"] = cleaned
    frames = df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_distinct(F.struct(*keys)).alias("rows_after"),
        *[F.count_distinct(value).alias(name) for name, value in measures.items()],
    )
    return frames
