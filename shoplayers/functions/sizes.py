"""Broadcasts behind a check of their size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shoplayers.session import durable

BROADCAST_BYTES = 64 << 20


def stored_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """`df`, stored once, and whether its rows take no more than `limit` bytes together. For narrow tables."""
    kept = durable(df)
    width = F.lit(16 * len(kept.columns))
    for name, kind in kept.dtypes:
        if kind == "string":
            width = width + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    return kept, (kept.agg(F.sum(width)).first()[0] or 0) <= limit


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """`df` to be broadcast by the join it is used in, if it is small enough. A larger table is left to Spark's own
    choice, which then is a join by shuffle."""
    kept, fits = stored_if_small(df, limit)
    return F.broadcast(kept) if fits else kept
