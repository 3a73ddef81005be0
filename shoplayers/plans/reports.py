"""Business reports over the warehouse layers. All results are small tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shoplayers import constants as K
from shoplayers.functions.columns import order_rank, without_spaces
from shoplayers.functions.numbers import money_mean, percent


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Value counts with their share in percent, most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    # The total comes from the same counts, so the rows are aggregated and shuffled once.
    total = counts.agg(F.sum("cnt")).scalar()
    return counts.withColumn("pct", percent(F.col("cnt"), total)).orderBy(F.desc("cnt"), column)


def frequency_in_order(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of a fixed list of values in that order, 0 where a value does not occur."""
    listed = df.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(v) for v in values])).alias("place", column)
    )
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    filled = listed.join(counts, column, "left").withColumn("cnt", F.coalesce("n", F.lit(0)))
    # The window runs over the fixed list, not over the data.
    total = F.sum("cnt").over(W.partitionBy())
    return filled.select(column, "place", "cnt", percent(F.col("cnt"), total).alias("pct")).orderBy("place")


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values; ties by value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.desc("cnt"), column).limit(k)


# --- segments ----------------------------------------------------------------------------------


def segment_share(segments: DataFrame) -> DataFrame:
    """Users and share per segment in business order."""
    counts = frequency(segments, "user_segment").withColumnRenamed("cnt", "users")
    return counts.withColumn("display_order", order_rank(F.col("user_segment"), K.SEGMENT_ORDER)).orderBy(
        "display_order"
    )


def _segment_aggregates(day_digits: int) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("users"),
        F.round(F.avg("r_days"), day_digits).alias("avg_r_days"),
        F.round(F.avg("f_freq"), day_digits).alias("avg_f_freq"),
        money_mean("m_amount").alias("avg_m_amount"),
    ]


def segment_means(segments: DataFrame, day_digits: int = 1) -> DataFrame:
    """Size and mean recency, frequency and money per segment, richest first."""
    means = segments.groupBy("user_segment").agg(*_segment_aggregates(day_digits))
    return means.orderBy(F.desc("avg_m_amount"), "user_segment")


def segment_report(segments: DataFrame) -> DataFrame:
    """Size, share and means per segment in one table, richest first."""
    means = segments.groupBy("user_segment").agg(*_segment_aggregates(1))
    # One row per segment, at most eight rows in this window.
    total = F.sum("users").over(W.partitionBy())
    return means.withColumn("pct", percent(F.col("users"), total)).orderBy(
        F.desc("avg_m_amount"), "user_segment"
    )


def segment_means_scaled(segments: DataFrame) -> DataFrame:
    """Segment means scaled to 0..1 per column; recency is reversed, flat columns give 0."""
    means = segment_means(segments, 2).withColumn("avg_m_amount", F.col("avg_m_amount").cast("double"))
    everything = W.partitionBy()  # at most eight rows

    def scaled(column: str, reverse: bool = False) -> Column:
        value, low, high = F.col(column), F.min(column).over(everything), F.max(column).over(everything)
        distance = (high - value) if reverse else (value - low)
        return F.round(F.when(high > low, F.try_divide(distance, high - low)).otherwise(F.lit(0.0)), 6)

    return means.select(
        "user_segment",
        order_rank(F.col("user_segment"), K.SEGMENT_ORDER).alias("display_order"),
        scaled("avg_r_days", reverse=True).alias("r_scaled"),
        scaled("avg_f_freq").alias("f_scaled"),
        scaled("avg_m_amount").alias("m_scaled"),
    ).orderBy("display_order")


def _high_value() -> Column:
    return F.col("user_segment").isin(*K.HIGH_VALUE_SEGMENTS)


def high_value_by_occupation(segments: DataFrame, profiles: DataFrame, top: int = 10) -> DataFrame:
    """Occupations with most high-value users. Both sides have one row per user."""
    counts = (
        segments.filter(_high_value())
        .select("user_id")
        .join(profiles.select("user_id", "face"), "user_id", "left")
        .groupBy("face")
        .agg(F.count(F.lit(1)).alias("high_value_users"))
    )
    return (
        counts.orderBy(F.desc("high_value_users"), F.asc_nulls_first("face"))
        .limit(top)
        .select(F.coalesce("face", F.lit(K.UNKNOWN)).alias("occupation"), "high_value_users")
    )


def high_value_share_by_occupation(
    segments: DataFrame, profiles: DataFrame, min_users: int = K.MIN_GROUP_USERS
) -> DataFrame:
    """Share of high-value users per occupation, without small occupations."""
    return (
        profiles.select("user_id", "face")
        .join(segments.select("user_id", "user_segment"), "user_id", "left")
        .groupBy(F.col("face").alias("occupation"))
        .agg(
            F.count(F.lit(1)).alias("total_users"),
            F.count_if(F.coalesce(_high_value(), F.lit(False))).alias("high_value"),
        )
        .filter(F.col("total_users") >= min_users)
        .withColumn("high_value_pct", percent(F.col("high_value"), F.col("total_users")))
        .orderBy(F.desc(F.col("high_value") / F.col("total_users")), F.asc_nulls_first("occupation"))
    )


def validation_wide(segments: DataFrame, profiles: DataFrame) -> DataFrame:
    """Row-level table for an independent recomputation, in a fixed column order."""
    return (
        profiles.select(without_spaces(F.col("face")).alias("face"), "user_id")
        .join(segments, "user_id", "left")
        .select(
            "face", "user_id", "r_days", "f_freq", "m_amount", "r_score", "f_score", "m_score", "user_segment"
        )
        .orderBy(F.asc_nulls_first("face"), "user_id")
    )


def validation_totals(wide: DataFrame) -> DataFrame:
    """Control totals of the validation table."""
    return wide.agg(
        F.count(F.lit(1)).alias("rows_cnt"),
        F.count_distinct("face").alias("occupations"),
        F.count_distinct("user_id").alias("users"),
        F.count("r_days").alias("buyers"),
        F.sum("m_amount").cast("decimal(14,2)").alias("amount"),
    )


# --- activity ----------------------------------------------------------------------------------


def buyer_population(user_day: DataFrame) -> DataFrame:
    """All users, days with a purchase, distinct buyers.

    Rows are merged per user before anything is counted, so no distinct set is needed.
    """
    per_user = user_day.groupBy("user_id").agg(F.sum("is_buyer").alias("buyer_days"))
    return per_user.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.sum("buyer_days").alias("buyer_user_days"),
        F.count_if(F.col("buyer_days") > 0).alias("distinct_buyers"),
    )


def daily_active_users(user_day: DataFrame) -> DataFrame:
    """Active users, buyers and buy rate per day."""
    daily = user_day.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("dau"), F.sum("is_buyer").alias("buyers")
    )
    return daily.withColumn("buy_rate_pct", percent(F.col("buyers"), F.col("dau"))).orderBy("event_date")


def user_funnel(dwd: DataFrame) -> DataFrame:
    """Distinct users per stage with the rate against the first and the previous stage.

    Rows are first reduced to one per (user, behaviour); the four stages then fit one row.
    """
    pairs = dwd.select("user_id", "behavior").distinct()
    users = pairs.agg(*[F.count_if(F.col("behavior") == s).alias(s) for s in K.FUNNEL_STAGES])
    stages = ", ".join(f"{i + 1}, '{s}', {s}" for i, s in enumerate(K.FUNNEL_STAGES))
    rows = users.selectExpr(f"stack({len(K.FUNNEL_STAGES)}, {stages}) AS (stage_no, stage, users)")
    in_order = W.orderBy("stage_no")  # four rows
    first, previous = F.first("users").over(in_order), F.lag("users").over(in_order)

    def rate(base: Column) -> Column:
        value = F.coalesce(F.try_divide(F.col("users") * F.lit(100.0), base), F.lit(0.0))
        return F.when(F.col("stage_no") == 1, F.lit(100.0)).otherwise(F.round(value, 6))

    return rows.select(
        "stage_no", "stage", "users", rate(first).alias("overall_pct"), rate(previous).alias("step_pct")
    )


def date_coverage(dwd: DataFrame) -> DataFrame:
    """First day, last day and number of days, from one row per day."""
    days = dwd.select("event_date").distinct()
    return days.agg(
        F.min("event_date").alias("start_date"),
        F.max("event_date").alias("end_date"),
        F.count("event_date").alias("days"),
    )


def last_rows(dwd: DataFrame, n: int = 10) -> DataFrame:
    """The rows with the highest surrogate keys."""
    return (
        dwd.orderBy(F.desc("id"))
        .limit(n)
        .select("id", "user_id", "behavior", "event_time", "event_date", "event_hour", "address")
    )


def layer_totals(user_day: DataFrame) -> DataFrame:
    """Sum of every counter of the daily layer, and money."""
    return user_day.agg(
        *[F.coalesce(F.sum(f"{b}_cnt"), F.lit(0)).alias(f"total_{b}") for b in K.BEHAVIOURS],
        F.coalesce(F.sum("buy_amount"), F.lit(0)).cast("decimal(20,2)").alias("total_gmv"),
    )


def totals_reconciliation(dwd: DataFrame, user_day: DataFrame) -> DataFrame:
    """Counts of the detail layer against sums of the daily layer; `diff` must be 0."""
    spent = F.when(F.col("behavior") == "buy", F.col("price") * F.col("amount"))
    detail = dwd.agg(
        *[F.count_if(F.col("behavior") == b).cast("decimal(20,2)").alias(b) for b in K.BEHAVIOURS],
        F.coalesce(F.sum(spent), F.lit(0)).cast("decimal(20,2)").alias("gmv"),
    )
    summed = user_day.agg(
        *[F.coalesce(F.sum(f"{b}_cnt"), F.lit(0)).cast("decimal(20,2)").alias(b) for b in K.BEHAVIOURS],
        F.coalesce(F.sum("buy_amount"), F.lit(0)).cast("decimal(20,2)").alias("gmv"),
    )
    names = (*K.BEHAVIOURS, "gmv")
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    left = detail.selectExpr(f"stack({len(names)}, {pairs}) AS (metric, dwd_total)")
    right = summed.selectExpr(f"stack({len(names)}, {pairs}) AS (metric, dws_total)")
    return left.join(right, "metric").withColumn("diff", F.col("dwd_total") - F.col("dws_total"))
