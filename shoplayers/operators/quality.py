"""Data-quality checks and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shoplayers.functions.columns import is_digits


def _yes(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def timestamp_health(ods: DataFrame) -> DataFrame:
    """Raw timestamps: total, empty, digits only, anything else (NULL counts as anything else)."""
    stamp = F.col("timestamp")
    return ods.agg(
        F.count(F.lit(1)).alias("total_rows"),
        _yes(stamp.isNull() | (stamp == "")).alias("null_or_empty"),
        F.count_if(is_digits(stamp)).alias("pure_numeric"),
        F.count_if(~is_digits(stamp)).alias("non_numeric"),
    )


def bad_timestamps(ods: DataFrame, top: int = 20) -> DataFrame:
    """Most frequent raw timestamps that are not digits."""
    return (
        ods.filter(~is_digits(F.col("timestamp")))
        .groupBy("timestamp")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), F.asc_nulls_first("timestamp"))
        .limit(top)
    )


def price_amount_audit(ods: DataFrame) -> DataFrame:
    """Rows with a positive price or amount per behaviour."""
    return ods.groupBy("behavior").agg(
        _yes(F.col("price") > 0).alias("has_price"), _yes(F.col("amount") > 0).alias("has_amount")
    )


def reconcile_rows(ods: DataFrame, is_clean: Column) -> DataFrame:
    """Rows of the raw layer, rows its detail layer takes, and the rows lost between them, in one pass."""
    counts = ods.agg(F.count(F.lit(1)).alias("a"), _yes(is_clean).alias("b"))
    return counts.selectExpr("stack(3, 'ods', a, 'dwd', b, 'lost', a - b) AS (layer, rows_cnt)")


def layer_sizes(dwd: DataFrame) -> DataFrame:
    """Rows of the detail and daily layers, and distinct users, from one pass over the detail rows.

    A user's days are counted first, then users; both aggregations combine before their shuffle.
    """
    days = dwd.groupBy("user_id", "event_date").agg(F.count(F.lit(1)).alias("n"))
    users = days.groupBy("user_id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("days"))
    counts = users.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("a"), F.coalesce(F.sum("days"), F.lit(0)).alias("b"), F.count("user_id").alias("c")
    )
    return counts.selectExpr("stack(3, 'dwd', a, 'dws', b, 'users', c) AS (layer, rows_cnt)")


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column that must have none, counted in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counted.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, violations)")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")


def violations(df: DataFrame, columns: Sequence[str], key_sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """NOT NULL and key checks of a table in one report: check name and number of violations."""
    result = not_null_violations(df, columns).select(
        F.concat(F.lit("not_null:"), "column_name").alias("check_name"), "violations"
    )
    for name, keys in key_sets.items():
        repeated = duplicate_keys(df, keys).agg(
            F.lit(f"unique:{name}").alias("check_name"), F.count(F.lit(1)).alias("violations")
        )
        result = result.unionByName(repeated)
    return result


def require(df: DataFrame, condition: Column, message: str, sample: int = 5) -> DataFrame:
    """Raise with a few example rows when any row breaks `condition`; otherwise return `df`."""
    broken = df.filter(~F.coalesce(condition, F.lit(False)))
    examples = broken.limit(sample).collect()
    if examples:
        raise ValueError(f"{message}: {broken.count()} rows, e.g. {[row.asDict() for row in examples]}")
    return df


def require_rows(df: DataFrame, expected: int, message: str) -> DataFrame:
    found = df.count()
    if found != expected:
        raise ValueError(f"{message}: {found} rows instead of {expected}")
    return df


def require_unique(df: DataFrame, keys: Sequence[str], message: str, sample: int = 5) -> DataFrame:
    """Raise when a key occurs twice; otherwise return `df`."""
    examples = duplicate_keys(df, keys).limit(sample).collect()
    if examples:
        raise ValueError(f"{message}: repeated keys, e.g. {[row.asDict() for row in examples]}")
    return df
