"""Layer builds: raw log -> clean detail -> user by day -> scored and segmented users."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from shoplayers import constants as K
from shoplayers.functions.columns import (
    epoch_seconds, epoch_to_timestamp, segment_label, strip, tolerant_seconds,
)
from shoplayers.functions.ordered import Order, levels, tiles_of
from shoplayers.operators.quality import require_unique
from shoplayers.session import durable
from shoplayers.sources.files import LayerTables, Source, null_counts
from shoplayers.sources.schemas import KEYS, MONEY_SUM


def _behaviour_code() -> Column:
    return F.lower(strip(F.col("behavior")))


def is_clean() -> Column:
    """Whether the detail layer takes a raw row."""
    known = _behaviour_code().isin(*K.BEHAVIOURS)
    return epoch_seconds(F.col("timestamp")).isNotNull() & F.coalesce(known, F.lit(False))


def build_dwd(ods: DataFrame, zone: str = "UTC") -> DataFrame:
    """Clean behaviour detail: rows with a digits-only timestamp and a known behaviour.

    Row-wise only, so the scan, filter and projection are one stage without a shuffle. The stored
    `ingest_id` serves as the surrogate key.
    """
    timed = ods.filter(is_clean()).withColumn(
        "event_time", epoch_to_timestamp(F.col("timestamp").try_cast("bigint"), zone=zone)
    )
    return timed.select(
        F.col("ingest_id").alias("id"),
        "user_id",
        "goods_id",
        "category_id",
        _behaviour_code().alias("behavior"),
        "event_time",
        F.to_date("event_time").alias("event_date"),
        F.hour("event_time").alias("event_hour"),
        "sex",
        "address",
        "device",
        "price",
        "amount",
    )


def quarantine(ods: DataFrame) -> DataFrame:
    """The rows the detail layer does not take, with the reason."""
    reason = F.when(epoch_seconds(F.col("timestamp")).isNull(), "timestamp").otherwise("behavior")
    return ods.filter(~is_clean()).withColumn("reason", reason)


def parse_tolerantly(ods: DataFrame) -> DataFrame:
    """The other timestamp rule: keep anything numeric, including fractions and exponents."""
    seconds = tolerant_seconds(F.col("timestamp"))
    timed = ods.withColumn("seconds", seconds).filter("seconds IS NOT NULL")
    micros = F.round(F.col("seconds") * 1_000_000).cast("bigint")
    return timed.withColumn("behavior_time", epoch_to_timestamp(micros, "MICROSECOND")).withColumn(
        "hour", F.hour("behavior_time")
    )


def build_user_day(dwd: DataFrame) -> DataFrame:
    """One row per user and day: behaviour counts, money spent, activity flags."""
    counts = [F.count_if(F.col("behavior") == b).alias(f"{b}_cnt") for b in K.BEHAVIOURS]
    bought = F.col("behavior") == "buy"
    return dwd.groupBy("user_id", "event_date").agg(
        *counts,
        F.coalesce(F.sum(F.when(bought, F.col("price") * F.col("amount"))), F.lit(0))
        .cast(MONEY_SUM)
        .alias("buy_amount"),
        F.lit(1).alias("is_active"),
        F.max(F.when(bought, F.lit(1)).otherwise(F.lit(0))).alias("is_buyer"),
    )


def build_rfm_raw(user_day: DataFrame, reference_date: dt.date | str) -> DataFrame:
    """Days since the last purchase, purchases and money per user, for users who bought."""
    last_buy = F.max(F.when(F.col("is_buyer") == 1, F.col("event_date")))
    return (
        user_day.groupBy("user_id")
        .agg(
            F.datediff(F.lit(str(reference_date)).cast("date"), last_buy).alias("r_days"),
            F.sum("buy_cnt").alias("f_freq"),
            F.sum("buy_amount").cast(MONEY_SUM).alias("m_amount"),
        )
        .filter("f_freq > 0")
    )


def build_rfm_scores(raw: DataFrame, tiles: int = K.TILES) -> DataFrame:
    """Tile score per dimension, 4 = best; ties are ordered by user.

    A tile score needs no user's rank, only the users at the tiles' ends: those are found by counting, and every
    row compares itself with them. The users' table is stored once, because the counting reads it.
    """
    raw = durable(raw)
    user = levels(raw, "user_id")
    tile = tiles_of(
        raw,
        {
            "r_score": Order([-F.col("r_days").cast("double"), *user]),
            "f_score": Order([*levels(raw, "f_freq"), *user]),
            "m_score": Order([*levels(raw, "m_amount"), *user]),
        },
        tiles,
    )
    return raw.select(
        "user_id",
        F.col("r_days").cast("int").alias("r_days"),
        F.col("f_freq").cast("bigint").alias("f_freq"),
        F.col("m_amount").cast(MONEY_SUM).alias("m_amount"),
        *[score.alias(name) for name, score in tile.items()],
    )


def tile_scores(df: DataFrame, value: str, key: str, tiles: int = K.TILES, name: str = "tile") -> DataFrame:
    """NTILE over a whole table in ascending order of `value`, ties by `key`; the rows stay where they are."""
    order = Order([*levels(df, value), *levels(df, key)])
    return df.withColumn(name, tiles_of(df, {name: order}, tiles)[name])


def build_rfm_segments(scores: DataFrame) -> DataFrame:
    """Named segment of every scored user."""
    return scores.withColumn(
        "user_segment", segment_label(F.col("r_score"), F.col("f_score"), F.col("m_score"))
    )


def rfm_segments(user_day: DataFrame, reference_date: dt.date | str) -> DataFrame:
    """User by day -> segments."""
    return build_rfm_segments(build_rfm_scores(build_rfm_raw(user_day, reference_date)))


def check_constraints(tables: LayerTables, built: dict[str, int]) -> None:
    """Raise if a built table breaks a declared NOT NULL or key. NULLs were counted while the tables were written;
    only the key columns are read again."""
    for table in built:
        found = tables.observed.get(table, {})
        broken = {name.removeprefix("null:"): n for name, n in found.items() if name.startswith("null:") and n}
        if broken:
            raise ValueError(f"{table}: NULLs in {broken}")
    for table, keys in KEYS.items():
        if table in built and table != "dwd_user_behavior":  # its key is the load's own row id
            require_unique(tables.read(table), keys, table)


def _totals(daily: bool) -> dict[str, Column]:
    """Counts per behaviour and money spent, as measures of the detail or the daily layer."""
    if daily:
        totals = {b: F.sum(f"{b}_cnt") for b in K.BEHAVIOURS} | {"gmv": F.sum("buy_amount")}
    else:
        spent = F.when(F.col("behavior") == "buy", F.col("price") * F.col("amount"))
        totals = {b: F.count_if(F.col("behavior") == b) for b in K.BEHAVIOURS} | {"gmv": F.sum(spent)}
    return {f"total:{name}": F.coalesce(value.cast("decimal(20,2)"), F.lit(0).cast("decimal(20,2)")) for name, value in totals.items()}


def check_layers(tables: LayerTables, built: dict[str, int]) -> None:
    """Raise if rows or totals get lost between layers: raw = detail + quarantine, detail = daily. All numbers come
    from the jobs that wrote the layers."""
    if built["ods_user_behavior"] != built["dwd_user_behavior"] + built["dwd_quarantine"]:
        raise ValueError(f"raw rows are neither in the detail layer nor in quarantine: {built}")
    detail, daily = tables.observed["dwd_user_behavior"], tables.observed["dws_user_day"]
    differing = {name: (detail[name], daily[name]) for name in _totals(False) if detail.get(name) != daily.get(name)}
    if differing and any(built[t] for t in ("dwd_user_behavior", "dws_user_day")):
        raise ValueError(f"totals differ between layers: {differing}")


def build_warehouse(
    tables: LayerTables,
    sources: list[Source],
    reference_date: dt.date | str,
    zone: str = "UTC",
) -> dict[str, int]:
    """Load the source files, build every layer as a stored table, and check it.

    Each layer is read back from its table, so a later layer never recomputes an earlier one. Rows the
    detail layer does not take are stored with their reason. Declared constraints, row counts and totals
    are checked at the end, by what the writing jobs counted; only keys are read again.
    """
    counts = tables.load(sources)
    raw = tables.read("ods_user_behavior")

    def write(df: DataFrame, table: str, by: str | None = None, totals: dict[str, Column] | None = None) -> None:
        counts[table] = tables.write(df, table, by, null_counts(table) | (totals or {}))

    write(build_dwd(raw, zone), "dwd_user_behavior", "event_date", _totals(False))
    write(quarantine(raw), "dwd_quarantine")
    write(build_user_day(tables.read("dwd_user_behavior")), "dws_user_day", "event_date", _totals(True))
    write(rfm_segments(tables.read("dws_user_day"), reference_date), "ads_rfm_segments")
    check_constraints(tables, counts)
    check_layers(tables, counts)
    return counts


def one_user(table: DataFrame, user_id: int) -> DataFrame:
    """All rows of one user; the filter reaches the Parquet scan."""
    rows = table.filter(F.col("user_id") == user_id)
    return rows.orderBy("event_date") if "event_date" in table.columns else rows
