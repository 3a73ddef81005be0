"""Exploration, conversion trends and the modelling table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shoplayers import constants as K
from shoplayers.functions.columns import flag, member_flag, weekend_flag
from shoplayers.functions.numbers import ratio
from shoplayers.functions.ordered import exact_quantile, exact_quantiles, with_running_number
from shoplayers.functions.skew import join_counted_lookup
from shoplayers.operators.cleaning import preprocess
from shoplayers.plans.warehouse import parse_tolerantly
from shoplayers.session import durable

QUARTILES = (0.25, 0.5, 0.75)


def is_purchase() -> Column:
    return (F.col("behavior") == "buy").cast("int")


def prepared_detail(ods: DataFrame) -> DataFrame:
    """Detail rows of the exploration path: any numeric timestamp, gaps filled, deduplicated, clamped.

    Same columns as the warehouse's detail layer as far as the reports here need them, so every
    function of this module takes either. Duplicates are found on the numeric timestamp.
    """
    timed = parse_tolerantly(ods).withColumn("timestamp", F.col("seconds"))
    return preprocess(timed).select(
        F.col("ingest_id").alias("id"), "user_id", "goods_id", "category_id", "behavior",
        F.col("behavior_time").alias("event_time"), F.to_date("behavior_time").alias("event_date"),
        F.col("hour").alias("event_hour"), "sex", "address", "device", "price", "amount", "comment",
    )


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column, to two digits."""
    moments = []
    for c in columns:
        value = F.col(c).cast("double")
        moments.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(value).alias("n"),
                F.round(F.avg(value), 2).alias("mean"),
                F.round(F.stddev_samp(value), 2).alias("std"),
                F.round(F.min(value), 2).alias("min"),
                F.round(F.max(value), 2).alias("max"),
            ).alias(c)
        )
    basics = df.agg(*moments).select(F.inline(F.array(*[F.col(c) for c in columns])))
    quartiles = exact_quantiles(df, columns, QUARTILES).select(
        "column_name", *[F.round(f"q{i}", 2).alias(name) for i, name in enumerate(("q25", "q50", "q75"))]
    )
    return basics.join(quartiles, "column_name", "left")


def hour_histogram(dwd: DataFrame) -> DataFrame:
    return dwd.groupBy("event_hour").agg(F.count(F.lit(1)).alias("cnt")).orderBy("event_hour")


def peak_hour(df: DataFrame, hour: str = "event_hour") -> Column:
    """Busiest hour as a scalar subquery; the lowest hour on ties."""
    counts = df.groupBy(hour).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.desc("cnt"), hour).limit(1).select(hour).scalar()


def sex_behavior_crosstab(dwd: DataFrame) -> DataFrame:
    """Behaviour counts per sex and each row's shares."""
    counts = (
        dwd.filter("sex IS NOT NULL").groupBy("sex").pivot("behavior", list(K.BEHAVIOURS)).count().fillna(0)
    )
    total = sum((F.col(b) for b in K.BEHAVIOURS[1:]), F.col(K.BEHAVIOURS[0]))
    return counts.select(
        "sex", *K.BEHAVIOURS, *[F.round(ratio(F.col(b), total), 6).alias(f"{b}_share") for b in K.BEHAVIOURS]
    )


def sex_behavior_correlation(dwd: DataFrame) -> DataFrame:
    """Point-biserial correlation of sex with each behaviour flag."""
    return dwd.agg(
        *[F.round(F.corr("sex", (F.col("behavior") == b).cast("int")), 6).alias(b) for b in K.BEHAVIOURS]
    )


def daily_conversion(dwd: DataFrame, window: int = K.TREND_WINDOW) -> DataFrame:
    """Behaviours, purchases and conversion per day with a trailing mean over rows."""
    daily = dwd.groupBy("event_date").agg(
        F.count("behavior").alias("total_behavior"), F.sum(is_purchase()).alias("buy_count")
    )
    rated = daily.withColumn("conversion_rate", ratio(F.col("buy_count"), F.col("total_behavior")))
    # One row per day: the window stays small however many events there are.
    trailing = W.orderBy("event_date").rowsBetween(1 - window, W.currentRow)
    return rated.withColumn("trailing_mean", F.avg("conversion_rate").over(trailing))


def daily_conversion_trend(dwd: DataFrame, window: int = K.TREND_WINDOW) -> DataFrame:
    return (
        daily_conversion(dwd, window)
        .withColumns({c: F.round(c, 6) for c in ("conversion_rate", "trailing_mean")})
        .orderBy("event_date")
    )


def conversion_forecast(
    dwd: DataFrame, window: int = K.TREND_WINDOW, growth: float = K.FORECAST_GROWTH
) -> DataFrame:
    """Last trailing mean and its projection."""
    latest = daily_conversion(dwd, window).agg(
        F.coalesce(F.max_by("trailing_mean", "event_date"), F.lit(0.0)).alias("latest")
    )
    rate = F.when(F.col("latest") > 0, F.lit(growth)).otherwise(F.lit(0.0))
    return latest.select(
        F.round("latest", 6).alias("latest_mean"), F.round(F.col("latest") * (1 + rate), 6).alias("predicted_rate")
    )


def peak_lift(dwd: DataFrame) -> DataFrame:
    """Conversion in the busiest hour against the other hours, from one row per hour."""
    hours = dwd.groupBy("event_hour").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum(is_purchase()).alias("buys")
    )
    # 24 rows at most.
    by_size = W.orderBy(F.desc("cnt"), "event_hour")
    marked = hours.withColumn("is_peak", F.row_number().over(by_size) == 1)
    peak, other = F.col("is_peak"), ~F.col("is_peak")

    def rate(which: Column) -> Column:
        return ratio(F.sum(F.when(which, F.col("buys"))), F.sum(F.when(which, F.col("cnt"))))

    rates = marked.agg(
        F.max(F.when(peak, F.col("event_hour"))).alias("peak_hour"),
        rate(peak).alias("peak_rate"),
        rate(other).alias("other_rate"),
    )
    return rates.select(
        "peak_hour",
        F.round("peak_rate", 6).alias("peak_rate"),
        F.round("other_rate", 6).alias("other_rate"),
        F.round(ratio(F.col("peak_rate"), F.col("other_rate")), 6).alias("lift"),
    )


def hot_goods_conversion(dwd: DataFrame, quantile: float = K.HOT_GOODS_QUANTILE) -> DataFrame:
    """Conversion of rows whose product is above a popularity quantile.

    The quantile is over rows, so each product counts with its own number of rows. Everything is
    computed from one row per product; the detail rows are aggregated once and never joined back.
    """
    goods = durable(dwd.groupBy("goods_id").agg(F.count("behavior").alias("hot_score"), F.sum(is_purchase()).alias("buys")))
    threshold = exact_quantile(goods, "hot_score", quantile, F.col("hot_score"))
    hot = F.col("hot_score") > F.col("threshold")
    return (
        goods.withColumn("threshold", threshold)
        .groupBy("threshold")
        .agg(
            F.count_if(hot).alias("hot_goods"),
            F.coalesce(F.sum(F.when(hot, F.col("hot_score"))), F.lit(0)).alias("hot_rows"),
            F.round(
                ratio(F.sum(F.when(hot, F.col("buys"))), F.sum(F.when(hot, F.col("hot_score")))), 6
            ).alias("hot_rate"),
        )
        .withColumn("threshold", F.round("threshold", 6))
    )


def overall_conversion(dwd: DataFrame) -> DataFrame:
    return dwd.agg(
        F.count(F.lit(1)).alias("rows_cnt"),
        F.sum(is_purchase()).alias("buys"),
        F.round(F.avg(is_purchase()), 6).alias("conversion_rate"),
    )


def user_totals(dwd: DataFrame) -> DataFrame:
    """Rows and distinct products per user."""
    return _user_totals(_user_goods(dwd))


def goods_totals(dwd: DataFrame) -> DataFrame:
    """Rows per product."""
    return _goods_totals(_user_goods(dwd))


def _user_goods(dwd: DataFrame) -> DataFrame:
    return dwd.groupBy("user_id", "goods_id").agg(F.count("behavior").alias("n"))


def _user_totals(user_goods: DataFrame) -> DataFrame:
    return user_goods.groupBy("user_id").agg(
        F.sum("n").alias("total_behavior_count"), F.count("goods_id").alias("browse_goods_types")
    )


def _goods_totals(user_goods: DataFrame) -> DataFrame:
    return user_goods.groupBy("goods_id").agg(F.sum("n").alias("goods_hot_score"))


def model_features(dwd: DataFrame, hot_categories: Sequence[int] = K.HOT_CATEGORIES) -> DataFrame:
    """One row per event: eight features and the purchase label, missing values as 0.

    Counts per (user, product) are stored once; the running number, the totals and the cutting of hot
    pairs all come from them. Events are shuffled once for the running number and once for each total,
    with hot keys cut into pieces, so neither a heavy user nor a best-selling product ends up in one task.
    """
    narrow = dwd.select(
        "id", "user_id", "goods_id", "sex", "event_hour", weekend_flag(F.col("event_date")).alias("is_weekend"),
        member_flag(F.col("category_id"), hot_categories).alias("is_hot_category"),
        is_purchase().alias("label"),
    )
    pairs = durable(
        narrow.groupBy("user_id", "goods_id").agg(
            F.count(F.lit(1)).alias("n"), F.min("id").alias("first"), F.max("id").alias("last")
        )
    )
    featured = narrow.withColumn("is_peak_hour", flag(F.col("event_hour") == peak_hour(dwd)))
    featured = with_running_number(featured, ["user_id", "goods_id"], "id", "user_goods_count", pairs)
    featured = join_counted_lookup(featured, _user_totals(pairs), "user_id", "total_behavior_count", "id")
    featured = join_counted_lookup(featured, _goods_totals(pairs), "goods_id", "goods_hot_score", "id")
    return featured.select("id", "user_id", "goods_id", *K.FEATURES, "label").fillna(0, subset=list(K.FEATURES))
