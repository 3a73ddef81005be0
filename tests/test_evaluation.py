import math
import random

import pytest
from pyspark.sql import functions as F

from shoplayers import constants as K
from shoplayers.operators import evaluation as E

N, M, P = K.CLASSES


def predictions(spark, rows):
    return spark.createDataFrame(rows, "gold_std string, label string, label_b string, score double")


def random_rows(n=80, seed=2):
    rng = random.Random(seed)
    return [(rng.choice(K.CLASSES), rng.choice(K.CLASSES), rng.choice(K.CLASSES), rng.randrange(10) / 10) for _ in range(n)]


def test_confusion_is_zero_filled_and_ordered(spark):
    rows = E.confusion_matrix(predictions(spark, [(N, N, N, 0.1), (N, P, N, 0.9), (P, P, N, 0.9)])).collect()
    assert [tuple(r) for r in rows] == [(0, N, 1, 0, 1), (1, M, 0, 0, 0), (2, P, 0, 0, 1)]


def test_class_report_by_hand(spark):
    rows = {r["class"]: r for r in E.class_report(predictions(spark, [(N, N, N, 0.1), (N, P, N, 0.9), (P, P, N, 0.9)])).collect()}
    assert tuple(rows[N])[1:] == (1.0, 0.5, 0.6667, 2)
    assert tuple(rows[M])[1:] == (0.0, 0.0, 0.0, 0)
    assert tuple(rows[P])[1:] == (0.5, 1.0, 0.6667, 1)
    assert rows["accuracy"]["precision"] == 0.6667 and rows["macro avg"]["precision"] == 0.5
    assert rows["weighted avg"]["precision"] == pytest.approx(0.8333)


def test_band_weighted_recall(spark):
    df = predictions(spark, [(N, N, N, 0.1), (N, N, N, 0.1), (M, N, N, 0.1), (N, M, N, 0.5), (M, M, N, 0.5), (P, P, N, 0.9)])
    sizes = spark.createDataFrame([(N, 30), (M, 100), (P, 50)], "label string, cnt long")
    row = E.band_weighted_recall(df, sizes).first()
    expected = 20 / (20 + 50 + 0)
    assert row["recall_w"] == pytest.approx(expected, abs=1e-6)
    assert row["f1_w"] == pytest.approx(2 * (2 / 3) * expected / (2 / 3 + expected), abs=1e-6)


def test_band_without_sample_rows_gives_null(spark):
    df = predictions(spark, [(N, N, N, 0.1), (P, P, N, 0.9)])
    sizes = spark.createDataFrame([(N, 30), (M, 100), (P, 50)], "label string, cnt long")
    row = E.band_weighted_recall(df, sizes).first()
    assert row["recall_w"] is None and row["f1_w"] is None and row["precision"] == 1.0
    assert E.band_weighted_recall(df, sizes.filter(F.col("label") != M)).first()["recall_w"] == 1.0


def p_value(spark, a, b):
    return spark.range(1).select(E.mcnemar_p_value(F.lit(a).cast("long"), F.lit(b).cast("long")).alias("p")).first()["p"]


@pytest.mark.parametrize("a, b", [(8, 2), (0, 0), (1, 0), (0, 24), (12, 12), (11, 13)])
def test_exact_p_value(spark, a, b):
    n = a + b
    expected = min(1.0, 2 * sum(math.comb(n, k) for k in range(min(a, b) + 1)) / 2**n)
    assert p_value(spark, a, b) == pytest.approx(expected, rel=1e-12)
    if (a, b) == (8, 2):
        assert expected == 0.109375


@pytest.mark.parametrize("a, b", [(13, 12), (20, 5), (100, 60), (400, 300), (1000, 10), (5000, 4900)])
def test_chi_square_p_value(spark, a, b):
    statistic = (abs(a - b) - 1) ** 2 / (a + b)
    assert p_value(spark, a, b) == pytest.approx(math.erfc(math.sqrt(statistic / 2)), abs=1e-12)


def test_mcnemar_counts(spark):
    rows = random_rows()
    got = E.mcnemar(predictions(spark, rows)).first()
    a = [(r[1] == N) == (r[0] == N) for r in rows]
    b = [(r[2] == N) == (r[0] == N) for r in rows]
    assert got["only_a_right"] == sum(x and not y for x, y in zip(a, b))
    assert got["only_b_right"] == sum(y and not x for x, y in zip(a, b))
    assert got["both_right"] + got["both_wrong"] + got["only_a_right"] + got["only_b_right"] == len(rows)


def brute_curve(rows):
    positives = sum(r[0] == N for r in rows)
    points = []
    for threshold in sorted({1 - r[3] for r in rows}, reverse=True):
        above = [r for r in rows if 1 - r[3] >= threshold]
        hits = sum(r[0] == N for r in above)
        points.append((threshold, hits / len(above), hits / positives))
    return points


def test_curve_average_precision_and_area(spark):
    rows = random_rows(60, 9)
    df = predictions(spark, rows)
    target, score = F.col("gold_std") == N, F.lit(1.0) - F.col("score")
    points = brute_curve(rows)
    got = sorted(tuple(r) for r in E.precision_recall_curve(df, target, score).collect() if r["threshold"] is not None)
    for a, b in zip(got, sorted(points)):
        assert a == pytest.approx(b, abs=1e-6)
    assert len(got) == len(points)
    recalls = [0.0] + [p[2] for p in points]
    area = sum((p[2] - r) * p[1] for p, r in zip(points, recalls))
    assert E.average_precision(df, target, score).first()["average_precision"] == pytest.approx(area, abs=1e-6)
    yes = [1 - r[3] for r in rows if r[0] == N]
    no = [1 - r[3] for r in rows if r[0] != N]
    wins = sum((y > x) + 0.5 * (y == x) for y in yes for x in no) / (len(yes) * len(no))
    assert E.roc_auc(df, target, score).first()["roc_auc"] == pytest.approx(wins, abs=1e-6)


def test_one_class_only(spark):
    df = predictions(spark, [(P, P, P, 0.9), (P, N, P, 0.2)])
    target, score = F.col("gold_std") == N, F.lit(1.0) - F.col("score")
    assert E.roc_auc(df, target, score).first()["roc_auc"] == 0.5
    assert E.average_precision(df, target, score).first()["average_precision"] == 0.0
    nothing = E.binary_metrics(df, target, F.lit(False)).first()
    assert tuple(nothing) == (1.0, 1.0, 0.0, 0.0)


GOLD = "user_id long, goods_id long, comment string, gold string"
SCORED = "user_id long, goods_id long, comment string, score double, label string"


def test_gold_join_checks(spark):
    gold = spark.createDataFrame([(1, 1, "a", "真负面"), (1, 1, "b", "模糊"), (2, 1, "a", "真正面")], GOLD)
    scored = spark.createDataFrame([(1, 1, "a", 0.1, N), (1, 1, "b", 0.5, M), (2, 1, "a", 0.9, P), (3, 1, "x", 0.2, N)], SCORED)
    joined = E.join_gold(gold, scored)
    assert {(r["user_id"], r["gold_std"]) for r in joined.collect()} == {(1, N), (2, P)}
    assert E.ambiguous_share(gold).first()["ambiguous_pct"] == 33.33
    with pytest.raises(ValueError, match="unique"):
        E.join_gold(gold, scored.union(scored.limit(1)))
    with pytest.raises(ValueError, match="without a score"):
        E.join_gold(gold, scored.filter("user_id < 2"))
    with pytest.raises(ValueError, match="whitelist"):
        E.join_gold(gold.withColumn("gold", F.lit("?")), scored)


def test_leak_guard_matches_null_keys(spark):
    gold = spark.createDataFrame([(1, None, "a", "真负面"), (1, None, "a", "真负面")], GOLD)
    scored = spark.createDataFrame([(1, None, "a", 0.1, N), (1, 2, "a", 0.1, N)], SCORED)
    assert [r["goods_id"] for r in E.exclude_gold(scored, gold).collect()] == [2]


def test_decision_needs_gain_and_significance(spark):
    rows = [(N, P, N, 0.9)] * 60 + [(P, P, P, 0.9)] * 60 + [(N, N, N, 0.1)] * 10 + [(P, N, P, 0.1)] * 10 + [(M, M, M, 0.5)] * 5
    df = predictions(spark, rows)
    sizes = [E.band_sizes(df, c) for c in ("label", "label_b")]
    decided = E.model_decision(df, *sizes).first()
    assert decided["decision"] == "switch" and decided["gain_points"] > 5 and decided["p_value"] < 0.05
    assert E.model_decision(df, *sizes[::-1], "label_b", "label").first()["decision"] == "keep"


def test_only_candidates_move_to_the_gold_join(spark):
    """Rows that are no gold rows by the bitmap take no part in a shuffle of texts."""
    scored = spark.range(4000).selectExpr("id AS ingest_id", "id AS user_id", "id % 7 AS goods_id", "concat('text ', id) AS comment", "0.5D AS score", "'中性' AS label")
    gold = scored.filter("ingest_id % 400 = 0").selectExpr("user_id", "goods_id", "comment", "'真中性' AS gold")
    kept = E.exclude_gold(scored, gold)
    assert kept.count() == 3990 and kept.filter("ingest_id % 400 = 0").count() == 0
    assert kept.columns == scored.columns
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = E.join_gold(gold, scored)
        assert joined.count() == 10 and {r["gold_std"] for r in joined.collect()} == {"中性"}
        again = E.exclude_gold(scored, gold)
        assert again.count() == 3990
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
