from pyspark.sql import functions as F

from shoplayers.functions.membership import bitmap_of, may_be_member


def candidates(spark, rows, keys, bits):
    bitmap = bitmap_of(keys, F.xxhash64("id"), bits)
    found = rows.withColumn("maybe", may_be_member(bitmap, F.xxhash64("id"), bits)).filter("maybe")
    return {r["id"] for r in found.collect()}


def test_no_member_is_missed_and_few_others_get_in(spark):
    rows, keys = spark.range(20_000), spark.range(0, 20_000, 40)
    found = candidates(spark, rows, keys, 16)
    assert found >= set(range(0, 20_000, 40)) and len(found) < 800


def test_a_full_bitmap_lets_everything_through(spark):
    assert len(candidates(spark, spark.range(500), spark.range(3000), 8)) == 500


def test_no_keys_and_null_keys(spark):
    rows = spark.createDataFrame([(None,), (1,)], "id long")
    bitmap = bitmap_of(spark.range(0), F.xxhash64("id"), 12)
    assert rows.filter(may_be_member(bitmap, F.xxhash64("id"), 12)).count() == 0
    null_hash = F.when(F.col("id").isNotNull(), F.xxhash64("id"))
    bitmap = bitmap_of(rows, null_hash, 12)
    assert [r["id"] for r in rows.filter(may_be_member(bitmap, null_hash, 12)).collect()] == [1]


def test_a_stretch_makes_its_map_once(spark):
    keys = spark.range(10).select(F.xxhash64("id").alias("h"))
    plan = spark.range(1).select(bitmap_of(keys, F.col("h")))._jdf.queryExecution().optimizedPlan().toString()
    assert "map_from_entries" in plan and "element_at(map_from_entries" not in plan
