import random

import numpy as np
import pytest
from pyspark.sql import Window as W, functions as F

from shoplayers.functions import ordered
from shoplayers.functions.columns import shuffle_key
from shoplayers.functions.ordered import (
    Order, Statistic, exact_quantile, exact_quantiles, levels, order_statistics, tile, tiles_of,
    with_hashed_position, with_running_number, with_running_totals, with_stratum_position,
)
from shoplayers.functions.skew import join_counted_lookup


@pytest.fixture(autouse=True)
def many_partitions(spark):
    """Keep small test tables spread over several sort partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def skewed(spark, n=600, seed=1):
    """Rows of which a good third share one key and one value."""
    rng = random.Random(seed)
    rows = [
        (i, "hot" if rng.random() < 0.4 else rng.choice("abcdefg"), 7 if rng.random() < 0.4 else rng.randrange(50))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "id long, key string, value long").repartition(5)


def test_position_in_the_whole_table(spark):
    df = skewed(spark).withColumn("all", F.lit(0))
    rows = with_stratum_position(df, "all", ["value", "id"]).collect()
    ordered = sorted(rows, key=lambda r: (r["value"], r["id"]))
    assert [r["position"] for r in ordered] == list(range(1, len(rows) + 1))
    assert {r["stratum_size"] for r in rows} == {len(rows)}


def test_partitions_are_really_used(spark):
    spread = skewed(spark).orderBy("value", "id").select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread > 3


def test_stratum_position_with_null_stratum(spark):
    df = skewed(spark).withColumn("key", F.when(F.col("key") != "a", F.col("key")))
    window = W.partitionBy("key").orderBy("value", "id")
    expected = df.withColumn("position", F.row_number().over(window)).withColumn(
        "stratum_size", F.count(F.lit(1)).over(W.partitionBy("key"))
    )
    got = with_stratum_position(df, "key", ["value", "id"])
    columns = ["id", "key", "position", "stratum_size"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, expected.select(columns).collect()))


@pytest.mark.parametrize("groups", [[], ["key"], ["key", "value"]])
def test_running_totals_match_a_window(spark, groups):
    df = skewed(spark).withColumn("key", F.when(F.col("key") != "b", F.col("key")))
    got = with_running_totals(df, groups, ["id"], {"nth": F.lit(1).cast("long"), "total": F.col("value")})
    window = W.partitionBy(*groups).orderBy("id").rowsBetween(W.unboundedPreceding, 0)
    expected = df.withColumn("nth", F.count(F.lit(1)).over(window)).withColumn("total", F.sum("value").over(window))
    columns = ["id", "nth", "total"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, expected.select(columns).collect()))


@pytest.mark.parametrize("size", [0, 1, 2, 3, 4, 5, 7, 8, 101])
@pytest.mark.parametrize("tiles", [1, 4, 5])
def test_tile_equals_ntile(spark, size, tiles):
    df = spark.range(size).withColumn("value", F.col("id") % 3)
    placed = with_stratum_position(df.withColumn("all", F.lit(0)), "all", ["value", "id"])
    got = placed.select("id", tile(F.col("position"), F.col("stratum_size"), tiles).alias("t"))
    expected = df.select("id", F.ntile(tiles).over(W.orderBy("value", "id")).alias("t"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_quantiles_match_numpy(spark):
    df = skewed(spark, 500, 3).withColumn("other", F.when(F.col("id") % 7 > 0, F.col("id") * 1.5))
    probabilities = [0.0, 0.25, 0.5, 0.8, 0.99, 1.0]
    got = {r["column_name"]: list(r)[1:] for r in exact_quantiles(df, ["value", "other"], probabilities).collect()}
    for column in ("value", "other"):
        values = [r[0] for r in df.select(column).filter(F.col(column).isNotNull()).collect()]
        assert got[column] == pytest.approx(list(np.quantile(np.array(values, dtype=float), probabilities)))


def test_quantile_of_one_to_ten(spark):
    df = spark.range(1, 11)
    assert df.select(exact_quantile(df, "id", 0.99).alias("q")).first()["q"] == pytest.approx(9.91)


def test_weighted_quantile_counts_rows(spark):
    counts = spark.createDataFrame([(1, 3), (10, 10)], "v int, n int")
    expected = np.quantile([1] * 3 + [10] * 10, 0.2)
    assert counts.select(exact_quantile(counts, "v", 0.2, F.col("n")).alias("q")).first()["q"] == pytest.approx(expected)


@pytest.mark.parametrize("pieces", [2, 10, 1000])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_key_join_equals_plain_join(spark, pieces, how):
    facts = skewed(spark).withColumn("key", F.when(F.col("key") != "c", F.col("key")))
    lookup = facts.filter("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("s"))
    got = join_counted_lookup(facts, lookup, "key", "n", "id", how=how, pieces=pieces)
    expected = facts.join(lookup, "key", how)
    columns = ["id", "key", "n", "s"]
    rows = [sorted(map(str, map(tuple, d.select(columns).collect()))) for d in (got, expected)]
    assert rows[0] == rows[1]


def test_hot_key_is_cut_into_pieces(spark):
    facts = skewed(spark)
    lookup = facts.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_counted_lookup(facts, lookup, "key", "n", "id", pieces=20)
        parts = joined.filter("key = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert parts > 2


@pytest.mark.parametrize("pieces", [3, 1000])
def test_running_number_with_a_hot_group(spark, pieces):
    rng = random.Random(6)
    rows = [(i, rng.choice(["hot"] * 5 + ["a", "b", None]), rng.choice([1, None])) for i in rng.sample(range(10_000), 900)]
    df = spark.createDataFrame(rows, "id long, g string, h int").repartition(7)
    sizes = df.groupBy("g", "h").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"), F.max("id").alias("last"))
    found = {r["id"]: r["nth"] for r in with_running_number(df, ["g", "h"], "id", "nth", sizes, pieces).collect()}
    expected, seen = {}, {}
    for i, g, h in sorted(rows):
        seen[g, h] = expected[i] = seen.get((g, h), 0) + 1
    assert found == expected
    empty = with_running_number(df.limit(0), ["g", "h"], "id", "nth", sizes.limit(0), pieces)
    assert empty.count() == 0


def test_quantiles_of_extreme_and_dense_values(spark):
    rng = random.Random(9)
    values = [1e308, -1e308, 0.0, 5e-324, -5e-324] + [1 + i * 2.0**-52 for i in range(200)] + [rng.gauss(0, 1e6) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(5)
    found = exact_quantiles(df, ["v"], [0.0, 0.1, 0.5, 0.61, 1.0]).first()
    ordered = sorted(values)
    for i, p in enumerate([0.0, 0.1, 0.5, 0.61, 1.0]):
        exact = p * (len(ordered) - 1)
        low, high = ordered[int(exact)], ordered[min(int(exact) + 1, len(ordered) - 1)]
        assert found[f"q{i}"] == pytest.approx(low + (high - low) * (exact - int(exact)))
    assert exact_quantiles(df.limit(0), ["v"], [0.5]).count() == 0


def test_places_of_an_order_are_found_by_counting(spark):
    rng = random.Random(2)
    values = [rng.choice([7.0, rng.random(), -1e300, 5e-324]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(6)
    places = [0, 1, 749, 1500, 2250, 2999]
    counts, found = order_statistics(df, {"v": F.col("v")}, lambda _, n: [*places, n, -1])
    ordered = sorted(values)
    assert counts == {"v": 3000} and sorted(found) == [("v", p) for p in places]
    for place in places:
        value = ordered[place]
        assert found["v", place] == Statistic(value, ordered.index(value), ordered.count(value))


def test_a_wrong_estimate_and_dense_bins_are_searched_again(spark, monkeypatch):
    values = [float(i * i % 4001) for i in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    monkeypatch.setattr(ordered, "LAST_VALUES", 1)  # never few enough to list
    monkeypatch.setattr(ordered, "BINS", 4)
    monkeypatch.setattr(ordered, "SKETCH_MARGIN", -0.2)  # brackets beside their places
    _, found = order_statistics(df, {"v": F.col("v")}, lambda _, n: [5, 2000, 3999])
    assert [found["v", p].value for p in (5, 2000, 3999)] == [sorted(values)[p] for p in (5, 2000, 3999)]


@pytest.mark.parametrize("tiles", [1, 3, 4])
@pytest.mark.parametrize("size", [0, 1, 3, 700])
def test_tiles_without_ranks_equal_ntile(spark, size, tiles):
    big = 2**62
    df = spark.range(size).select((F.col("id") * 37 % 11).alias("v"), (F.lit(big) + F.col("id") * 7919 % 1009).alias("k")).repartition(4)
    df = df.withColumn("v", F.when(F.col("v") > 0, F.col("v"))).withColumn("d", F.expr("cast(v as decimal(20,2)) / 3"))
    orders = {"a": Order([*levels(df, "v"), *levels(df, "k")]), "b": Order([*levels(df, "d"), *levels(df, "k")], F.col("k") % 2 == 0)}
    got = tiles_of(df, orders, tiles)
    rows = df.select("k", got["a"].alias("a"), got["b"].alias("b"))
    expected = df.select("k", F.ntile(tiles).over(W.orderBy("v", "k")).alias("a"))
    half = df.filter("k % 2 = 0").select("k", F.ntile(tiles).over(W.orderBy("d", "k")).alias("b"))
    assert sorted(map(tuple, rows.select("k", "a").collect())) == sorted(map(tuple, expected.collect()))
    assert sorted(map(tuple, rows.filter("b IS NOT NULL").select("k", "b").collect())) == sorted(map(tuple, half.collect()))


def test_tiles_move_no_rows(spark):
    df = spark.range(5000).withColumn("v", F.col("id") % 13)
    tiles = tiles_of(df, {"t": Order([*levels(df, "v"), *levels(df, "id")])}, 4)
    plan = df.select(tiles["t"].alias("t"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_position_in_the_order_of_a_hash(spark):
    df = spark.range(900).select("id", F.when(F.col("id") % 3 > 0, F.lit("x")).alias("g"), shuffle_key(1, "id").alias("draw"))
    got = with_hashed_position(df.repartition(4), "g", "draw", "id", bin_bits=5)
    expected = df.withColumn("position", F.row_number().over(W.partitionBy("g").orderBy("draw", "id")))
    assert sorted(map(str, got.select("id", "position").collect())) == sorted(map(str, expected.select("id", "position").collect()))
    assert "rangepartitioning" not in got._jdf.queryExecution().executedPlan().toString()


def test_only_numbers_have_levels(spark):
    with pytest.raises(TypeError):
        levels(spark.createDataFrame([("a",)], "s string"), "s")
