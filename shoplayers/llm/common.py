"""Text expressions and small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# --- Fixed values: a word is a run of anything but ASCII white space ------------------------------
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables; the path is left to Spark, which may be the only one to reach it."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; a NULL text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; NULL counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def row_digest(df: DataFrame) -> Column:
    """32 bytes that tell rows with different contents apart, whatever their columns."""
    whole = F.to_json(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]), {"ignoreNullFields": "false"})
    return F.unhex(F.sha2(whole, 256))
