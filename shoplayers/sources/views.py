"""Input views: the given tables reshaped into behaviour logs, profiles, categories and reviews.

Every view keeps all rows of its table. Irregular values (bad timestamps, missing values, second
deliveries of a row) are derived from the row ids, so cleaning steps have something to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplayers.functions.columns import sentiment_band

SECOND_DELIVERY = 1_000_000_000_000
# Phrases in which shop terms stand at even and odd places, after stop words and next to each other.
PHRASES = ("的物流快", "京东的物流很快", "这快递员好", "性价比高的正品", "第三方卖家发货速度慢", "不好的客服和售后", "包装破损")
GAPS = {
    "sex": "IF(ingest_id % 13 = 0, NULL, sex)",
    "price": "IF(ingest_id % 17 = 0, NULL, price)",
    "amount": "CASE WHEN ingest_id % 19 = 0 THEN -1 WHEN ingest_id % 23 = 0 THEN 500 ELSE amount END",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def behaviour(spark: SparkSession, folder: str) -> DataFrame:
    """Raw behaviour log from `events`."""
    goods = "CAST(get_json_object(props, '$.k') AS BIGINT)"
    seconds = "CAST(timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS STRING)"
    return _table(spark, folder, "events").selectExpr(
        "event_id AS ingest_id",
        "user_id",
        f"{goods} AS goods_id",
        f"{goods} % 10 AS category_id",
        "CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'fav' "
        "WHEN 'purchase' THEN 'buy' ELSE event_type END AS behavior",
        "CASE WHEN event_id % 97 = 0 THEN 'bad' WHEN event_id % 101 = 0 THEN '' "
        f"WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 107 = 0 THEN concat({seconds}, '.5') "
        f"WHEN event_id % 109 = 0 THEN concat('-', {seconds}) ELSE {seconds} END AS timestamp",
        "CAST(user_id % 2 AS INT) AS sex",
        "CAST(NULL AS STRING) AS address",
        "concat('dev', user_id % 7) AS device",
        "CAST(value AS DECIMAL(12,2)) AS price",
        "CAST(1 + event_id % 3 AS INT) AS amount",
        "CAST(NULL AS STRING) AS comment",
    )


def behaviour_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """The log with missing and out-of-range values."""
    return behaviour(spark, folder).withColumns({name: F.expr(sql) for name, sql in GAPS.items()})


def behaviour_delivered_twice(spark: SparkSession, folder: str) -> DataFrame:
    """The log in which every fiftieth row arrived a second time."""
    return (
        behaviour(spark, folder)
        .withColumn("delivery", F.explode(F.expr("sequence(0, IF(ingest_id % 50 = 0, 1, 0))")))
        .withColumn("ingest_id", F.col("ingest_id") + F.col("delivery") * F.lit(SECOND_DELIVERY))
        .drop("delivery")
    )


def profile_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Uncleaned user profiles from `customer`; some users come twice."""
    face = (
        "CASE WHEN c_custkey % 7 = 0 THEN concat('\\u3000', c_mktsegment, '  ') "
        "WHEN c_custkey % 5 = 0 THEN concat(c_mktsegment, ' / x') "
        "WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END"
    )
    return (
        _table(spark, folder, "customer")
        .selectExpr("c_custkey", f"{face} AS face", "explode(sequence(0, IF(c_custkey % 50 = 0, 1, 0))) AS delivery")
        .selectExpr(
            f"c_custkey + delivery * {SECOND_DELIVERY} AS ingest_id",
            "c_custkey AS user_id",
            "IF(delivery = 1, 'later row', face) AS face",
        )
    )


def category_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Category names with one category missing and one delivered twice."""
    counts = behaviour(spark, folder).groupBy("category_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        counts.filter("category_id <> 9")
        .selectExpr("*", "explode(sequence(0, IF(category_id = 3, 1, 0))) AS delivery")
        .selectExpr(
            f"category_id + delivery * {SECOND_DELIVERY} AS ingest_id",
            "category_id",
            "CAST(n AS INT) AS category_count",
            "concat('cat', category_id, IF(delivery = 1, ' later', '')) AS category_label",
        )
    )


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Raw reviews from `documents`: whole texts, a third of them with a Chinese phrase behind, plus near
    copies, missing and too short ones."""
    phrases = ", ".join(f"'{phrase}'" for phrase in PHRASES)
    said = f"IF(doc_id % 3 = 0, concat(text, ' ', element_at(array({phrases}), CAST(doc_id % {len(PHRASES)} AS INT) + 1)), text)"
    return (
        _table(spark, folder, "documents")
        .selectExpr(
            "doc_id",
            f"{said} AS text",
            "CASE WHEN doc_id % 25 = 0 THEN 1 WHEN doc_id % 100 = 1 THEN 2 WHEN doc_id % 100 = 2 THEN 3 "
            "WHEN doc_id % 100 = 3 THEN 4 ELSE 0 END AS extra",
        )
        .selectExpr("*", "explode(sequence(0, IF(extra > 0, 1, 0))) AS delivery")
        .selectExpr(
            f"doc_id + delivery * {SECOND_DELIVERY} AS ingest_id",
            "doc_id % 50 AS user_id",
            "doc_id % 20 AS goods_id",
            "doc_id % 10 AS category_id",
            "CASE WHEN delivery = 0 THEN text WHEN extra = 1 THEN concat(text, '!') WHEN extra = 2 THEN NULL "
            "WHEN extra = 3 THEN 'ok' ELSE '    ' END AS comment",
        )
    )


def labels(spark: SparkSession, folder: str) -> DataFrame:
    """Quality and toxicity marks per review, as a training class and as people's gold label."""
    return _table(spark, folder, "labels").selectExpr(
        "doc_id AS ingest_id",
        "IF(toxic = 1 OR quality = 0, 0, 1) AS is_positive",
        "CASE WHEN doc_id % 40 = 0 THEN '模糊' WHEN toxic = 1 THEN '真负面' "
        "WHEN quality = 0 THEN '真中性' ELSE '真正面' END AS gold",
    )


def gold_sheet(cleaned: DataFrame, marks: DataFrame) -> DataFrame:
    """The filled-in labelling sheet: marks of the reviews that survived cleaning."""
    return cleaned.join(marks.select("ingest_id", "gold"), "ingest_id").select(
        "user_id", "goods_id", "comment", "gold"
    )


def fixed_predictions(cleaned: DataFrame) -> DataFrame:
    """Reviews with two exact scores on a coarse grid (ties included) and their bands."""
    return cleaned.withColumns(
        {
            "score": (F.col("ingest_id") * 7919 % 100).cast("double") / 100,
            "score_b": (F.col("ingest_id") * 104729 % 100).cast("double") / 100,
        }
    ).withColumns({"label": sentiment_band(F.col("score")), "label_b": sentiment_band(F.col("score_b"))})


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their price in cents-exact form, for tile scoring over a large table."""
    return _table(spark, folder, "orders").selectExpr("o_orderkey", "CAST(o_totalprice AS DECIMAL(14,2)) AS price")


