from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shoplayers import constants as K
from shoplayers.operators import cleaning, quality

SCHEMA = (
    "ingest_id long, user_id long, goods_id long, behavior string, timestamp string, sex int, address string, "
    "device string, price decimal(12,2), amount int, comment string"
)


def events(spark, *rows):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], SCHEMA)


def row(user=1, goods=1, behavior="pv", stamp="1", sex=1, price="1.00", amount=1):
    return (user, goods, behavior, stamp, sex, None, None, None if price is None else Decimal(price), amount, None)


def test_keep_first_uses_stored_order(spark):
    df = spark.createDataFrame([(3, "a", "z"), (1, "a", "x"), (2, "b", "y"), (4, None, "n"), (5, None, "m")], "ingest_id long, k string, v string")
    kept = cleaning.keep_first(df.repartition(3), ["k"]).collect()
    assert {(r["k"], r["v"]) for r in kept} == {("a", "x"), ("b", "y"), (None, "n")}


def test_keep_first_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3).withColumnRenamed("id", "ingest_id")
    plan = cleaning.keep_first(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_drop_duplicate_events(spark):
    df = events(spark, row(), row(), row(price="2.00"), row(stamp="2"), row(stamp=None), row(stamp=None))
    kept = cleaning.drop_duplicate_events(df)
    assert sorted(r["ingest_id"] for r in kept.collect()) == [0, 3, 4]


def test_fill_gaps(spark):
    df = events(
        spark, row(sex=None), row(user=2, sex=0), row(user=3, sex=1), row(user=4, price=None), row(user=5, stamp=None),
        row(user=6, sex=0, amount=None),
    )
    filled = {r["user_id"]: r for r in cleaning.fill_gaps(df).collect()}
    assert 5 not in filled
    assert filled[1]["sex"] == 0  # 0 and 1 are equally frequent: the smaller one
    assert filled[4]["price"] == 0 and filled[6]["amount"] == 0
    assert filled[1]["address"] == K.UNKNOWN and filled[1]["comment"] == K.NO_COMMENT


def test_mode_of_an_empty_column_is_zero(spark):
    filled = cleaning.fill_gaps(events(spark, row(sex=None), row(user=2, sex=None)))
    assert [r["sex"] for r in filled.collect()] == [0, 0]


def test_clamp_outliers(spark):
    df = events(spark, *[row(user=i, price=f"{i}.00", amount=i * 20 - 40) for i in range(1, 11)])
    clamped = {r["user_id"]: r for r in cleaning.clamp_outliers(df).collect()}
    assert clamped[10]["price"] == pytest.approx(9.91)
    assert clamped[9]["price"] == 9.0
    assert clamped[1]["amount"] == 0 and clamped[10]["amount"] == 100


def test_preprocess_runs_in_order(spark):
    result = cleaning.preprocess(events(spark, row(), row(), row(user=2, price=None, stamp=None)))
    assert result.count() == 1


def test_health_and_audit(spark):
    df = events(spark, row(stamp="12"), row(stamp=""), row(stamp=None), row(stamp="x"), row(stamp="12\n", price="0.00"))
    assert tuple(quality.timestamp_health(df).first()) == (5, 2, 1, 4)
    bad = quality.bad_timestamps(df).collect()
    assert [(r["timestamp"], r["cnt"]) for r in bad] == [(None, 1), ("", 1), ("12\n", 1), ("x", 1)]
    assert tuple(quality.price_amount_audit(df).first()) == ("pv", 4, 5)


def test_violations_and_requirements(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "k long, v string")
    found = {r["check_name"]: r["violations"] for r in quality.violations(df, ["k", "v"], {"k": ["k"]}).collect()}
    assert found == {"not_null:k": 0, "not_null:v": 1, "unique:k": 1}
    with pytest.raises(ValueError, match="no value"):
        quality.require(df, F.col("v").isNotNull(), "no value")
    with pytest.raises(ValueError, match="keys"):
        quality.require_unique(df, ["k"], "keys")
    with pytest.raises(ValueError, match="rows"):
        quality.require_rows(df, 4, "rows")
    assert quality.require(df, F.col("k") > 0, "fine") is df


def test_reconcile_rows(spark):
    layers = {r["layer"]: r["rows_cnt"] for r in quality.reconcile_rows(spark.range(10), F.col("id") < 7).collect()}
    assert layers == {"ods": 10, "dwd": 7, "lost": 3}
