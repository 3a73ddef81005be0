import random

import numpy as np
import pytest
from pyspark.ml.linalg import DenseMatrix, DenseVector, Vectors
from pyspark.sql import functions as F

from shoplayers import constants as K
from shoplayers.operators import learning as L, sampling, softmax
from shoplayers.plans import catalog

FEATURES = K.FEATURES


@pytest.fixture(scope="module")
def prepared(spark):
    """Events whose label depends on two of the features."""
    rng = random.Random(4)
    rows = []
    for i in range(600):
        values = [rng.randrange(2), rng.randrange(20), rng.randrange(50), rng.randrange(30), rng.randrange(2), 0, rng.randrange(5), 1]
        label = int(values[1] + 4 * values[4] + rng.gauss(0, 3) > 14)
        rows.append((i, *values, label))
    schema = "id long, " + ", ".join(f"{f} long" for f in FEATURES) + ", label int"
    split = sampling.stratified_split(spark.createDataFrame(rows, schema))
    return L.scale_features(split, L.feature_moments(split.filter("is_train = 1"))).persist()


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1, 5), (3, 5)], "a int, b int")
    moments = L.feature_moments(df, ("a", "b"))
    vectors = [r["features"].toArray().tolist() for r in L.scale_features(df, moments, ("a", "b")).collect()]
    assert vectors == [[-1.0, 0.0], [1.0, 0.0]]


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "label int")
    assert {r["label"]: r["weight"] for r in L.class_weights(df).collect()} == {0: pytest.approx(4 / 6), 1: 2.0}


def test_logistic_regression_is_at_the_optimum(spark, prepared):
    """The gradient of the penalised, class-weighted loss vanishes at the fitted coefficients."""
    train = prepared.filter("is_train = 1")
    model = L.fit_logistic(train)
    weighted, n = L.with_class_weights(train)
    rows = weighted.select("features", "label", "weight").collect()
    assert n == len(rows)
    x = np.array([r["features"].toArray() for r in rows])
    y = np.array([r["label"] for r in rows])
    w = np.array([r["weight"] for r in rows])
    beta = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ beta + model.intercept)))
    gradient = x.T @ (w * (p - y)) + beta
    assert np.abs(gradient).max() / len(rows) < 1e-4


def test_models_learn_and_reports_are_complete(spark, prepared):
    test = prepared.filter("is_train = 0")
    model = L.fit_logistic(prepared.filter("is_train = 1"))
    logistic = L.evaluate_binary(L.predict(model, test))
    svm = L.evaluate_binary(L.predict(L.fit_linear_svm(prepared.filter("is_train = 1")), test))
    assert logistic.first()["roc_auc"] > 0.85 and svm.first()["roc_auc"] > 0.85
    importance = L.feature_importance(model, spark).collect()
    assert importance[0]["feature"] == "browse_goods_types" and len(importance) == len(FEATURES)
    validation = L.cross_validate(prepared)
    report = L.model_report(logistic, svm, validation).collect()
    assert [r["metric"] for r in report] == ["accuracy", "precision", "recall", "f1", "roc_auc"]
    assert report[-1]["logistic_cross_validated"] is None and report[0]["logistic_cross_validated"] > 0.7


def test_out_of_fold_covers_every_row_once(prepared):
    predicted = L.out_of_fold(prepared)
    assert predicted.count() == 600 and predicted.select("id").distinct().count() == 600


def test_clusters_cover_all_rows(prepared):
    report = L.cluster_report(L.cluster_rows(prepared)).collect()
    assert len(report) == 3 and sum(r["cnt"] for r in report) == 600
    assert [r["is_best"] for r in report] == [1, 0, 0]
    assert [r["rate"] for r in report] == sorted((r["rate"] for r in report), reverse=True)


def gold_reviews(spark, n=90):
    rng = random.Random(8)
    lead = {K.NEGATIVE: "terrible broken", K.NEUTRAL: "average okay", K.POSITIVE: "great lovely"}
    rows = []
    for i in range(n):
        c = K.CLASSES[i % 3]
        noise = " ".join(rng.choices(["parcel", "shop", "colour", "size", "price"], k=4))
        rows.append((i, i, 1, f"{lead[c]} {noise}", c, c, 0.5))
    return spark.createDataFrame(rows, "ingest_id long, user_id long, goods_id long, comment string, label string, gold_std string, score double")


def test_text_model_keeps_gold_out_and_learns(spark):
    reviews = gold_reviews(spark)
    gold = reviews.filter("ingest_id < 30")
    model = L.fit_on_bands(reviews, gold)
    judged = model.predict(gold, "model_label")
    assert judged.filter("model_label = gold_std").count() >= 28
    top = L.text_top_features(model, reviews, 5).collect()
    assert {"terrible", "broken"} <= {r["term"] for r in top if r["side"] == "negative"}
    assert len(top) == 10


def test_few_buckets_still_give_a_model(spark):
    model = L.fit_text_classifier(gold_reviews(spark), "label", num_features=16)
    assert model.classifier.coefficientMatrix.numCols == 16
    assert model.predict(gold_reviews(spark), "p").count() == 90


def test_text_model_is_at_the_optimum(spark):
    """The gradient of the penalised multinomial loss vanishes at the fitted coefficients."""
    reviews = gold_reviews(spark)
    model = L.fit_text_classifier(reviews, "label", num_features=256, tol=1e-9)
    rows = model.features(reviews).select("features", "label").collect()
    x = np.array([r["features"].toArray() for r in rows])
    y = np.array([K.CLASSES.index(r["label"]) for r in rows])
    beta, offset = model.classifier.coefficientMatrix.toArray(), model.classifier.interceptVector.toArray()
    odds = np.exp(x @ beta.T + offset)
    error = odds / odds.sum(axis=1, keepdims=True) - np.eye(3)[y]  # classes are of equal size: weight 1
    assert np.abs(error.T @ x + beta).max() / len(rows) < 1e-4


def test_margin_model_is_at_the_optimum(spark, prepared):
    """No small step from the fitted coefficients lowers the penalised, class-weighted hinge loss."""
    train = prepared.filter("is_train = 1")
    model = L.fit_linear_svm(train)
    weighted, n = L.with_class_weights(train)
    rows = weighted.select("features", "label", "weight").collect()
    x = np.array([r["features"].toArray() for r in rows])
    sign = np.array([2 * r["label"] - 1 for r in rows])
    w = np.array([r["weight"] for r in rows])

    def loss(beta, offset):
        return (w * np.maximum(0, 1 - sign * (x @ beta + offset))).sum() / n + beta @ beta / (2 * n)

    beta, offset = model.coefficients.toArray(), model.intercept
    best, rng = loss(beta, offset), np.random.default_rng(1)
    for _ in range(300):
        step = rng.normal(size=len(beta) + 1) * 10 ** rng.uniform(-3, -0.5)
        assert loss(beta + step[:-1], offset + step[-1]) > best - 1e-3


def test_clusters_are_numbered_by_their_label_rate(prepared):
    rows = L.cluster_rows(prepared).groupBy("cluster").agg(F.avg("label").alias("rate")).orderBy("cluster").collect()
    assert [r["cluster"] for r in rows] == [0, 1, 2]
    assert [r["rate"] for r in rows] == sorted((r["rate"] for r in rows), reverse=True)


def test_text_folds(spark):
    predicted = L.text_out_of_fold(gold_reviews(spark))
    assert predicted.count() == 90 and predicted.select("ingest_id").distinct().count() == 90
    scores = {r["metric"]: r["mean"] for r in L.fold_f1(predicted).collect()}
    assert scores["f1_macro"] > 0.9 and scores["f1_weighted"] > 0.9


def test_comparison_of_two_models(spark):
    from shoplayers.plans.comparison import compare_models, cross_check

    scored = gold_reviews(spark).withColumn("score", F.when(F.col("label") == K.NEGATIVE, 0.1).otherwise(0.9)).drop("gold_std")
    gold = scored.filter("ingest_id % 3 = 0 OR ingest_id < 45").select(
        "user_id", "goods_id", "comment", F.concat(F.lit("真"), "label").alias("gold")
    )
    result = compare_models(scored, gold)
    rows = {r["model"]: r for r in result.summary.collect()}
    assert rows["baseline"]["f1_w"] == 1.0 and rows["baseline"]["average_precision"] == 1.0
    assert rows["candidate"]["precision"] >= 0
    assert result.decision.first()["decision"] == "keep"
    check = cross_check(result.judged, folds=2)
    assert check.both_wrong.count() == 0 and check.folds.count() == 2


def test_calibrated_probabilities(spark, prepared):
    """Platt's loss has no better slope and offset, and probabilities rise with the margins."""
    model = L.fit_calibrated_svm(prepared.filter("is_train = 1"))
    predicted = model.predict(prepared.filter("is_train = 0"))
    rows = sorted((r["ranking_score"], r["probability"]) for r in predicted.collect())
    assert model.slope > 0 and all(a[1] <= b[1] for a, b in zip(rows, rows[1:])) and all(0 < p < 1 for _, p in rows)
    assert tuple(L.calibration_certificate(predicted).first()) == (len(rows), 0)
    turned = predicted.withColumn("probability", F.lit(1.5) - F.col("probability"))
    assert L.calibration_certificate(turned).first()["violations"] > 0


def test_calibration_is_at_the_optimum(spark):
    rng = random.Random(3)
    margins = [(int(rng.random() < 1 / (1 + np.exp(-2 * m))), float(m)) for m in np.linspace(-2, 2, 200)]
    rows = L.calibration_rows(spark.createDataFrame(margins, "label int, margin double")).collect()
    ones = sum(label for label, _ in margins)
    assert len(rows) == 400 and sum(r["weight"] for r in rows) == pytest.approx(200)
    expected = {1: (ones + 1) / (ones + 2), 0: 1 / (200 - ones + 2)}
    found = sorted((float(r["features"][0]), r["weight"]) for r in rows if r["label"] == 1)
    assert found == [(m, pytest.approx(expected[label])) for label, m in margins]


def test_certificates_see_a_model_that_is_not_the_optimum(spark, prepared):
    train = prepared.filter("is_train = 1")
    assert L.logistic_certificate(L.fit_logistic(train), train).first()["at_optimum"] == 1
    assert L.logistic_certificate(L.fit_logistic(train, max_iter=1), train).first()["at_optimum"] == 0
    reviews = gold_reviews(spark)
    assert L.text_certificate(L.fit_text_classifier(reviews, "label"), reviews).first()["at_optimum"] == 1
    assert L.text_certificate(L.fit_text_classifier(reviews, "label", max_iter=1), reviews).first()["at_optimum"] == 0
    good, early = L.fit_clusters(prepared), L.KMeans(k=3, seed=42, maxIter=1, predictionCol="cluster").fit(prepared)
    assert tuple(L.cluster_certificate(good, prepared).first()) == (600, 3, 0, 1)
    assert L.cluster_certificate(early, prepared).first()["centred"] == 0


def test_terms_that_share_a_bucket_share_its_coefficient(spark):
    reviews = gold_reviews(spark)
    words = L.term_dictionary(reviews, buckets=8).collect()
    for row in words:
        own = [r for r in words if r["bucket"] == row["bucket"]]
        assert row["bucket_terms"] == len(own) and row["bucket_df"] == sum(r["df"] for r in own)
    assert any(r["bucket_terms"] > 1 for r in words)
    model = L.fit_text_classifier(reviews, "label", num_features=8)
    whole = {r["bucket"]: r["coefficient"] for r in model.coefficients(spark).collect()}
    share = {r["term"]: r["coefficient"] for r in L.text_top_features(model, reviews, k=1000).collect()}
    for row in words:
        assert share[row["term"]] == pytest.approx(whole[row["bucket"]] * row["df"] / row["bucket_df"])


def test_softmax_with_a_class_that_has_no_rows(spark):
    reviews = gold_reviews(spark).filter(F.col("label") != K.NEUTRAL)
    model = L.fit_text_classifier(reviews, "label")
    assert model.predict(reviews, "p").filter("p = label").count() == reviews.count()


def test_predictions_after_a_job_was_observed(spark, prepared):
    """An observed job leaves something in the session that no task can take along; predictions must not need it."""
    from pyspark.sql import Observation

    watch = Observation()
    spark.range(3).observe(watch, F.count(F.lit(1)).alias("n")).collect()
    assert watch.get == {"n": 3}
    train = prepared.filter("is_train = 1")
    model = L.fit_logistic(train)
    raw = {r["id"]: r["prediction"] for r in model.setFeaturesCol("features").transform(prepared.limit(0)).collect()}
    found = L.predict(model, prepared).collect()
    assert raw == {} and len(found) == 600 and all(r["predicted"] == int(r["ranking_score"] > 0.5) for r in found)


def test_the_solver_takes_few_tasks_and_packed_rows(spark, monkeypatch):
    assert [L.solver_tasks(cells, 12) for cells in (0, 200_001, 60_000_000, 400_000_000)] == [1, 2, 24, 100]
    seen = []
    monkeypatch.setattr(L, "fit_softmax", lambda rows, *rest: seen.append(rows) or softmax.fit_softmax(rows, *rest))
    reviews = gold_reviews(spark).repartition(6)
    L.fit_text_classifier(reviews, "label")
    assert seen[0].rdd.getNumPartitions() == 1 and seen[0].count() < reviews.count()
    packed = seen[0].collect()
    assert sum(len(row["label"]) // 8 for row in packed) == 90
    assert sum(len(row["places"]) for row in packed) == sum(sum(np.frombuffer(row["sizes"], np.int64)) for row in packed)


def test_long_reviews_and_reviews_without_terms_are_blocks_too(spark, monkeypatch):
    monkeypatch.setattr(softmax, "BLOCK", 10)
    assert list(softmax._stretches(np.array([3, 7, 0, 11, 0, 25]))) == [(0, 3), (3, 4), (4, 5), (5, 6)]
    rows = [([1, 5, 1, 7], 0, 1.0), ([], 1, 1.0), (None, 2, 1.0), ([5] * 300, 1, 2.0), ([9], 2, 1.0)]
    df = spark.createDataFrame(rows, "buckets array<int>, label int, weight double").coalesce(1)
    numbered = softmax.Scaling(np.array([-1, 0, -1, -1, -1, 1, -1, 2, -1, -1], np.int32), np.array([1.0, 2.0, 3.0]))
    x = np.array([[2, 2, 3], [0, 0, 0], [0, 0, 0], [0, 600, 0], [0, 0, 0]], float)
    x /= np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None]
    weights = np.arange(12.0).reshape(3, 4) / 10
    odds = np.exp(x @ weights[:, :-1].T + weights[:, -1])
    p, y, w = odds / odds.sum(axis=1, keepdims=True), np.eye(3)[[0, 1, 2, 1, 2]], np.array([1.0, 1, 1, 2, 1])
    loss, slope = softmax._gradient(numbered.blocks(df), numbered.scale, weights)
    assert loss == pytest.approx(-(w * np.log((p * y).sum(axis=1))).sum())
    error = (p - y) * w[:, None]
    assert slope == pytest.approx(np.c_[error.T @ x, error.sum(axis=0)])
    model = softmax.SoftmaxModel(DenseMatrix(3, 3, weights[:, :-1].reshape(-1, order="F")), DenseVector(weights[:, -1]))
    found = [r[0] for r in df.select(model.probabilities_of(F.col("buckets"), numbered, spark)).collect()]
    assert np.array(found) == pytest.approx(p)


def test_margin_model_gathers_its_rows_once(prepared, monkeypatch):
    seen = []
    fit = L.LinearSVC.fit
    monkeypatch.setattr(L.LinearSVC, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    L.fit_linear_svm(prepared.repartition(7))
    assert seen == [1]


def test_models_of_all_folds_share_the_passes_and_equal_models_fitted_alone(spark, monkeypatch):
    rows = gold_reviews(spark).filter("ingest_id % 4 <> 2 OR label <> '中性'")
    numbered = L.with_buckets(sampling.fold_ids(rows, key="ingest_id", folds=3)).persist()
    passes = []
    one_pass = softmax._gradients
    monkeypatch.setattr(softmax, "_gradients", lambda *given: passes.append(len(given[-1])) or one_pass(*given))
    models, together = L.fit_on_folds(numbered, "label", 3, tol=1e-6), len(passes)
    assert passes[0] == 3 and sum(passes) > 2 * together
    for fold, model in enumerate(models):
        alone = L.fit_text_classifier(numbered.filter(F.col("fold") != fold), "label", tol=1e-6)
        values = model.classifier.coefficientMatrix.toArray()
        own = {bucket: values[:, model.numbered.places[bucket]] for bucket in alone.vocabulary}
        assert np.array(list(own.values())).T == pytest.approx(alone.classifier.coefficientMatrix.toArray(), abs=1e-4)
        assert model.classifier.interceptVector.toArray() == pytest.approx(alone.classifier.interceptVector.toArray(), abs=1e-4)
        expected = {r["ingest_id"]: r["p_negative"] for r in alone.predict(numbered, "p").collect()}
        assert {r["ingest_id"]: r["p_negative"] for r in model.predict(numbered, "p").collect()} == pytest.approx(expected, abs=1e-4)
    assert len(passes) - together > 2 * together


def test_folds_without_rows_or_terms(spark):
    few = gold_reviews(spark, 2).withColumn("comment", F.when(F.col("ingest_id") == 0, F.col("comment")))
    assert sorted((r["ingest_id"], r["cv_label"]) for r in L.text_out_of_fold(few).collect()) == [(0, K.NEGATIVE), (1, K.NEGATIVE)]
    assert L.text_out_of_fold(few.filter("false")).count() == 0


def test_buckets_that_are_known_need_no_texts(spark):
    reviews = gold_reviews(spark)
    known = L.with_buckets(reviews).drop("comment").persist()
    model, same = L.fit_text_classifier(reviews, "label"), L.fit_text_classifier(known, "label")
    assert np.array_equal(model.vocabulary, same.vocabulary)
    assert same.classifier.coefficientMatrix.toArray() == pytest.approx(model.classifier.coefficientMatrix.toArray())
    assert L.text_certificate(same, known).collect() == L.text_certificate(model, reviews).collect()
    p = [{r["ingest_id"]: r["p_negative"] for r in model.predict(df, "p").collect()} for df in (reviews, known)]
    assert p[0] == pytest.approx(p[1])
    lacking = L.with_buckets(reviews).withColumn("buckets", F.when(F.col("ingest_id") < 9, F.col("buckets")))
    assert {r["ingest_id"]: r["p_negative"] for r in model.predict(lacking, "p").collect()} == pytest.approx(p[0])


def test_top_features_of_few_buckets_are_those_of_all(spark, monkeypatch):
    reviews = gold_reviews(spark)
    model = L.fit_text_classifier(reviews, "label")
    counted = []
    dictionary = L.term_dictionary
    monkeypatch.setattr(L, "term_dictionary", lambda *given: counted.append(given[-1]) or dictionary(*given))
    everything = [tuple(r) for r in L.text_top_features(model, reviews, 2, ends=1 << 16).collect()]
    assert counted == [None] and len(everything) == 4
    assert [tuple(r) for r in L.text_top_features(model, reviews, 2, ends=8).collect()] == everything
    assert len(counted) == 2 and len(counted[1]) == 16  # buckets at both ends were enough
    assert [tuple(r) for r in L.text_top_features(model, reviews, 20, ends=3).collect()] == [
        tuple(r) for r in L.text_top_features(model, reviews, 20, ends=1 << 16).collect()
    ]
    assert [c and len(c) for c in counted[2:]] == [6, None, None]  # 20 terms are not there: all are counted
    some = {r["term"]: tuple(r) for r in dictionary(reviews, 8, 2, [1, 5]).collect()}
    assert some == {r["term"]: tuple(r) for r in dictionary(reviews, 8, 2).collect() if r["bucket"] in (1, 5)}


def test_margin_curve_comes_from_all_training_rows(spark, monkeypatch):
    """The rows of the subsample say the opposite of the other training rows."""
    rows = [(i, Vectors.dense([float(i % 2)]), i % 2 if i >= 10 else 1 - i % 2, int(i < 60), int(i < 10)) for i in range(80)]
    table = spark.createDataFrame(rows, ["id", "features", "label", "is_train", "in_subsample"])
    monkeypatch.setattr(catalog, "_prepared", lambda *_: table)
    points = [p for p in catalog.svm_pr_curve(spark, "").collect() if p["threshold"] is not None]
    best = max(points, key=lambda p: p["threshold"])
    assert len(points) == 2 and (best["precision"], best["recall"]) == (1.0, 1.0)


def test_rows_told_from_gold_rows_take_no_texts_along(spark, monkeypatch):
    reviews = gold_reviews(spark)
    seen = []
    fit = L.fit_text_classifier
    monkeypatch.setattr(L, "fit_text_classifier", lambda train, *rest, **more: seen.append(train) or fit(train, *rest, **more))
    gold = reviews.filter("ingest_id < 9")
    models = [L.fit_on_bands(scored, gold) for scored in (reviews, L.with_buckets(reviews).persist())]
    alone = fit(reviews.filter("ingest_id >= 9"), "label")
    for train, model in zip(seen, models):
        assert train.columns == ["label", "buckets"] and train.count() == reviews.count() - 9
        assert model.vocabulary == alone.vocabulary
        assert model.classifier.coefficientMatrix.toArray() == pytest.approx(alone.classifier.coefficientMatrix.toArray(), abs=1e-4)
