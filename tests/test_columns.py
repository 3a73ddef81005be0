import datetime as dt

import pytest
from pyspark.sql import functions as F

from shoplayers import constants as K
from shoplayers.functions import columns as C
from shoplayers.functions.numbers import percent, ratio


def one(spark, expression, **values):
    frame = spark.range(1)
    for name, (value, kind) in values.items():
        frame = frame.withColumn(name, F.lit(value).cast(kind))
    return frame.select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        ("上班族  ", "上班族"),
        ("　农民 / 种植户 ", "农民/种植户"),
        ("a　/ b", "a/b"),
        ("\x1f a b \x85", "a b"),
        ("", ""),
        (None, None),
    ],
)
def test_clean_label(spark, raw, cleaned):
    assert one(spark, C.clean_label(F.col("v")), v=(raw, "string")) == cleaned


def test_without_spaces_keeps_wide_space(spark):
    assert one(spark, C.without_spaces(F.col("v")), v=(" a b　c ", "string")) == "ab　c"


def test_word_characters_keep_what_python_keeps(spark):
    assert one(spark, C.word_characters(F.col("v")), v=("好评!_a²é, x", "string")) == "好评_a²éx"


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("0", 0),
        ("1717430400", 1717430400),
        (str(K.MAX_EPOCH_SECOND), K.MAX_EPOCH_SECOND),
        (str(K.MAX_EPOCH_SECOND + 1), None),
        ("1717430400000", None),
        ("9" * 20, None),
        ("12\n", None),
        ("12.5", None),
        ("-5", None),
        (" 12", None),
        ("", None),
        (None, None),
    ],
)
def test_epoch_seconds(spark, raw, expected):
    assert one(spark, C.epoch_seconds(F.col("v")), v=(raw, "string")) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [("12.5", 12.5), ("-60", -60.0), ("-99999999999999", None), ("99999999999", None), ("1e9", 1e9), (" 12 ", 12.0), ("inf", None), ("NaN", None), ("bad", None), ("", None), (None, None)],
)
def test_tolerant_seconds(spark, raw, expected):
    assert one(spark, C.tolerant_seconds(F.col("v")), v=(raw, "string")) == expected


def test_zone_shifts_the_wall_clock(spark):
    at = F.lit(1717430400).cast("bigint")  # 2024-06-03 16:00 UTC
    assert one(spark, C.epoch_to_timestamp(at)) == dt.datetime(2024, 6, 3, 16)
    assert one(spark, C.epoch_to_timestamp(at, zone="Asia/Shanghai")) == dt.datetime(2024, 6, 4, 0)


@pytest.mark.parametrize(
    "score, band",
    [
        (0.0, K.NEGATIVE), (0.2, K.NEGATIVE), (0.2000001, K.NEUTRAL), (0.8, K.NEUTRAL), (0.81, K.POSITIVE),
        (1.0, K.POSITIVE), (1.2, None), (-0.5, None), (float("nan"), None), (None, None),
    ],
)
def test_sentiment_band(spark, score, band):
    assert one(spark, C.sentiment_band(F.col("v")), v=(score, "double")) == band


def test_every_score_triple_has_one_segment(spark):
    scores = [(r, f, m) for r in range(1, 5) for f in range(1, 5) for m in range(1, 5)]
    rows = (
        spark.createDataFrame(scores, "r int, f int, m int")
        .withColumn("s", C.segment_label(F.col("r"), F.col("f"), F.col("m")))
        .collect()
    )
    for row in rows:
        assert row["s"] == K.SEGMENTS[(row["r"] >= 3, row["f"] >= 3, row["m"] >= 3)]
        assert (row["s"] in K.HIGH_VALUE_SEGMENTS) == (row["m"] >= 3)


def test_small_expressions(spark):
    assert one(spark, C.clamp(F.col("v"), 0, 100), v=(None, "int")) is None
    assert [one(spark, C.clamp(F.col("v"), 0, 100), v=(x, "int")) for x in (-1, 50, 500)] == [0, 50, 100]
    days = [dt.date(2024, 1, d) for d in (5, 6, 7, 8)]
    assert [one(spark, C.weekend_flag(F.lit(d))) for d in days] == [0, 1, 1, 0]
    assert one(spark, C.mapped(F.lit("真负面"), K.GOLD_LABELS)) == K.NEGATIVE
    assert one(spark, C.mapped(F.lit("other"), K.GOLD_LABELS)) is None
    assert one(spark, C.order_rank(F.lit("b"), ("a", "b"))) == 2
    assert one(spark, C.member_flag(F.lit(5), (4, 5))) == 1


def test_guarded_numbers(spark):
    assert one(spark, ratio(F.lit(1), F.lit(0))) == 0.0
    assert one(spark, percent(F.lit(1), F.lit(0))) is None
    assert one(spark, percent(F.lit(201), F.lit(20000))) == 1.01  # an exact tie is rounded up
    assert one(spark, percent(F.lit(1), F.lit(3))) == 33.33
