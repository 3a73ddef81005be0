"""Model fitting on Spark ML: purchase models on event features, sentiment models on text.

Training data stays distributed. What reaches the driver is what a linear model is made of:
moments, coefficients and cluster centres; for text a fixed number of hashed buckets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import TypeVar

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.classification import LinearSVC, LinearSVCModel, LogisticRegression, LogisticRegressionModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from shoplayers import constants as K
from shoplayers.functions.columns import order_rank
from shoplayers.functions.numbers import ratio
from shoplayers.operators.evaluation import GOLD_KEY, binary_metrics, exclude_gold, roc_auc
from shoplayers.operators.sampling import fold_ids
from shoplayers.operators.softmax import Scaling, SoftmaxModel, fit_each_softmax, fit_softmax, fold_blocks, probabilities_by
from shoplayers.operators.text import document_frequencies, terms
from shoplayers.session import durable, stored

METRICS = ("accuracy", "precision", "recall", "f1")


# --- preparation -------------------------------------------------------------------------------


def feature_moments(df: DataFrame, features: Sequence[str] = K.FEATURES) -> DataFrame:
    """Mean and population deviation per feature, one pass."""
    cells = [
        F.struct(
            F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")
        ).alias(c)
        for c in features
    ]
    return df.agg(*cells).select(F.inline(F.array(*[F.col(c) for c in features])))


def scale_features(df: DataFrame, moments: DataFrame, features: Sequence[str] = K.FEATURES) -> DataFrame:
    """Features to mean 0 and population deviation 1, as a vector; a constant feature becomes 0."""
    by_name = {row["feature"]: row for row in moments.collect()}  # one row per feature
    scaled = df
    for c in features:
        spread = by_name[c]["std"] or 1.0
        scaled = scaled.withColumn(f"_scaled_{c}", (F.col(c) - F.lit(by_name[c]["mean"])) / F.lit(spread))
    assembler = VectorAssembler(inputCols=[f"_scaled_{c}" for c in features], outputCol="features")
    return assembler.transform(scaled).drop(*[f"_scaled_{c}" for c in features])


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("cnt"))
    totals = counts.agg(F.struct(F.sum("cnt").alias("rows"), F.count(F.lit(1)).alias("classes"))).scalar()
    return counts.withColumn("t", totals).select(
        label, "cnt", (F.col("t.rows").cast("double") / (F.col("t.classes") * F.col("cnt"))).alias("weight")
    )


def with_class_weights(df: DataFrame, label: str = "label") -> tuple[DataFrame, int]:
    """Attach balanced weights as `weight`; also returns the number of rows.

    One row per class reaches the driver and becomes a constant per class, so nothing is joined.
    """
    classes = class_weights(df, label).collect()
    weight = F.lit(None).cast("double")
    for row in classes:
        weight = F.when(F.col(label) == row[label], F.lit(row["weight"])).otherwise(weight)
    return df.withColumn("weight", weight), sum(row["cnt"] for row in classes)


# --- fitting -----------------------------------------------------------------------------------

T = TypeVar("T")
GRADIENT = 1e-4
ROWS_PER_TASK = 12_500


def concurrently(jobs: Sequence[Callable[[], T]]) -> list[T]:
    """Results of independent fits that share the cluster instead of waiting for each other."""
    inherited = inheritable_thread_target(SparkSession.getActiveSession())
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        return [found.result() for found in [pool.submit(inherited(job)) for job in jobs]]


def largest_gradient(scored: DataFrame, coefficients: np.ndarray, penalty: float) -> float:
    """The largest entry of the gradient of the penalised, weighted mean log loss. Near 0, a model is the optimum.

    `scored` has features, label, weight and the class probabilities `_p`; `coefficients` has a row per class, or one
    for class 1 of two. Per class the weighted features are summed once by probability and once by label, in one
    pass; a few vectors as wide as the model come back.
    """
    classes = [1] if len(coefficients) == 1 else list(range(len(coefficients)))
    sums = [F.sum("weight").alias("weight")]
    for c in classes:
        belongs = (F.col("label") == c).cast("double")
        for name, share in (("expected", F.get("_p", F.lit(c))), ("found", belongs)):
            value = F.col("weight") * share + F.lit(1e-300)  # a class without rows has a sum as well
            sums += [Summarizer.metrics("sum").summary(F.col("features"), value).alias(f"{name}{c}"), F.sum(value).alias(f"{name}_offset{c}")]
    row = scored.agg(*sums).first()
    largest = 0.0
    for at, c in enumerate(classes):
        total = row[f"expected{c}"]["sum"].toArray() - row[f"found{c}"]["sum"].toArray()
        entries = np.abs(total / row["weight"] + penalty * coefficients[at])
        offset = abs(row[f"expected_offset{c}"] - row[f"found_offset{c}"]) / row["weight"]
        largest = max(largest, float(entries.max(initial=0.0)), offset)
    return largest


# --- purchase models ---------------------------------------------------------------------------


def fit_logistic(train: DataFrame, c: float = 1.0, max_iter: int = 1000) -> LogisticRegressionModel:
    """L2 logistic regression with balanced classes. `c` weighs the summed loss against the penalty."""
    weighted, rows = with_class_weights(train)  # balanced weights add up to the number of rows
    return LogisticRegression(
        weightCol="weight", regParam=1.0 / (c * rows), elasticNetParam=0.0, standardization=False, maxIter=max_iter
    ).fit(weighted)


def logistic_certificate(model: LogisticRegressionModel, train: DataFrame, c: float = 1.0) -> DataFrame:
    """Rows and features that `fit_logistic` saw, and whether its coefficients are the optimum."""
    weighted, rows = with_class_weights(train)
    share = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin_of(model)))
    scored = weighted.withColumn("_p", F.array(F.lit(1.0) - share, share))
    flat = largest_gradient(scored, model.coefficientMatrix.toArray(), 1.0 / (c * rows)) <= GRADIENT
    return train.sparkSession.createDataFrame([(rows, model.numFeatures, int(flat))], "rows_cnt long, features int, at_optimum int")


def fit_linear_svm(train: DataFrame, c: float = 1.0, max_iter: int = 5000, tol: float = 1e-6) -> LinearSVCModel:
    """Linear support vector machine with balanced classes; its raw score ranks, it gives no probability.

    The solver goes over its rows hundreds of times, so they are first gathered in tasks of ROWS_PER_TASK rows: a small sample of
    a large table is not left in as many tasks as the table.
    """
    weighted, rows = with_class_weights(train)
    weighted = durable(weighted.select("features", "label", "weight")).coalesce(max(1, math.ceil(rows / ROWS_PER_TASK)))
    return LinearSVC(
        weightCol="weight", regParam=1.0 / (c * rows), standardization=False, maxIter=max_iter, tol=tol
    ).fit(weighted)


@dataclass(frozen=True)
class CalibratedMargin:
    """A margin model with a sigmoid that turns margins into probabilities."""

    model: LinearSVCModel
    slope: float
    offset: float

    def predict(self, df: DataFrame) -> DataFrame:
        """Predictions with the margin as ranking score and the probability of class 1."""
        logit = F.lit(self.slope) * F.col("ranking_score") + F.lit(self.offset)
        return predict(self.model, df).withColumn("probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-logit)))


def calibration_rows(margins: DataFrame) -> DataFrame:
    """(features, label, weight): every margin once per class, weighed by smoothed targets.

    A class of n rows gets the target (n + 1) / (n + 2) instead of 1, so that separable margins don't make a step.
    """
    sizes = margins.agg(F.count_if(F.col("label") == 1).alias("ones"), F.count_if(F.col("label") == 0).alias("zeros")).first()
    high, low = (sizes["ones"] + 1) / (sizes["ones"] + 2), 1 / (sizes["zeros"] + 2)
    target = F.when(F.col("label") == 1, F.lit(high)).otherwise(F.lit(low))
    rest = (F.lit(1.0) - target).alias("weight")
    both = F.inline(F.array(F.struct(F.lit(1).alias("label"), target.alias("weight")), F.struct(F.lit(0).alias("label"), rest)))
    return VectorAssembler(inputCols=["margin"], outputCol="features").transform(margins.select("margin", both)).drop("margin")


def fit_calibrated_svm(train: DataFrame, folds: int = 5, key: str = "id", c: float = 1.0) -> CalibratedMargin:
    """A margin model, and a sigmoid fitted to the margins of rows by models that did not see them."""
    numbered = durable(fold_ids(train, key=key, folds=folds))

    def margins(fold: int) -> DataFrame:
        model = fit_linear_svm(numbered.filter(F.col("fold") != fold), c)
        return numbered.filter(F.col("fold") == fold).select("label", margin_of(model).alias("margin"))

    parts = concurrently([lambda: fit_linear_svm(train, c), *[lambda fold=fold: margins(fold) for fold in range(folds)]])
    rows = durable(calibration_rows(durable(reduce(DataFrame.unionByName, parts[1:]))))
    sigmoid = LogisticRegression(weightCol="weight", regParam=0.0, tol=1e-9).fit(rows)
    return CalibratedMargin(parts[0], float(sigmoid.coefficients[0]), float(sigmoid.intercept))


def calibration_certificate(predicted: DataFrame) -> DataFrame:
    """Rows, and how many have no probability between 0 and 1 or one that contradicts the order of their margins.

    Two rows contradict each other only if neighbours in the order of margins do; order statistics of 1,000 equal parts
    of the margins stand for the rows between them.
    """
    parts = predicted.groupBy(F.round("ranking_score", 3).alias("at")).agg(
        F.min("probability").alias("low"), F.max("probability").alias("high"), F.count(F.lit(1)).alias("n"),
        F.count_if(~F.coalesce(F.col("probability").between(0, 1), F.lit(False))).alias("outside"),
    )
    before = F.max("high").over(W.orderBy("at").rowsBetween(W.unboundedPreceding, -1))
    tested = parts.withColumn("falls", (F.col("low") < before).cast("int"))
    return tested.agg(F.sum("n").alias("rows_cnt"), (F.sum("outside") + F.coalesce(F.sum("falls"), F.lit(0))).alias("violations"))


def margin_of(model: LogisticRegressionModel | LinearSVCModel) -> Column:
    """A linear model's score of the column `features`, as an expression: what a model carries along from fitting stays
    on the driver."""
    weights = F.lit([float(v) for v in model.coefficients])
    products = F.zip_with(vector_to_array("features"), weights, lambda value, weight: value * weight)
    return F.aggregate(products, F.lit(0.0), lambda total, product: total + product) + F.lit(float(model.intercept))


def predict(model: LogisticRegressionModel | LinearSVCModel, df: DataFrame) -> DataFrame:
    """Predictions with the class and a ranking score (probability, or margin where there is none), without the vectors."""
    margin = margin_of(model)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)) if isinstance(model, LogisticRegressionModel) else margin
    kept = [c for c in df.columns if c not in ("features", "weight")]
    return df.select(*kept, (margin > 0).cast("int").alias("predicted"), score.alias("ranking_score"))


def evaluate_binary(predicted: DataFrame, label: str = "label") -> DataFrame:
    """Accuracy, precision, recall, F1 and area under the ROC curve, one row."""
    truth = F.col(label) == 1
    area = roc_auc(predicted, truth, F.col("ranking_score")).select("roc_auc").scalar()
    return binary_metrics(predicted, truth, F.col("predicted") == 1).withColumn("roc_auc", area)


def feature_importance(model: LogisticRegressionModel, spark: SparkSession, features: Sequence[str] = K.FEATURES) -> DataFrame:
    """Absolute coefficients, largest first."""
    pairs = [(name, abs(float(value))) for name, value in zip(features, model.coefficients)]
    return spark.createDataFrame(pairs, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def fit_clusters(scaled: DataFrame, k: int = 3, seed: int = K.SEED) -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster", maxIter=300, tol=1e-9).fit(scaled)


def distances_to(centres: Sequence[np.ndarray]) -> Column:
    """Squared distances of the column `features` to every centre."""

    def distance(centre: np.ndarray) -> Column:
        gaps = F.zip_with(vector_to_array("features"), F.lit(centre.tolist()), lambda a, b: (a - b) * (a - b))
        return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap)

    return F.array(*[distance(centre) for centre in centres])


def cluster_certificate(model: KMeansModel, scaled: DataFrame, slack: float = 1e-6) -> DataFrame:
    """Rows, clusters, rows that are nearer to another centre than to their own, and whether every centre is the mean
    of its rows: both together are what k-means looks for."""
    clustered, distances = model.transform(scaled), distances_to(model.clusterCenters())
    wrong = F.get(distances, F.col("cluster")) > F.array_min(distances) + F.lit(slack)
    means = clustered.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(wrong).alias("wrong"), Summarizer.mean(F.col("features")).alias("mean")
    ).collect()  # one row a cluster
    centres = model.clusterCenters()
    central = all(np.abs(row["mean"].toArray() - centres[row["cluster"]]).max() <= math.sqrt(slack) for row in means)
    counts = (sum(r["n"] for r in means), len(centres), sum(r["wrong"] for r in means), int(central))
    return scaled.sparkSession.createDataFrame([counts], "rows_cnt long, clusters int, misplaced long, centred int")


def cluster_rows(scaled: DataFrame, k: int = 3, seed: int = K.SEED, label: str = "label") -> DataFrame:
    """K-means cluster per row; clusters are numbered by their label rate, highest first."""
    clustered = fit_clusters(scaled, k, seed).transform(scaled)
    rates = clustered.groupBy("cluster").agg(F.avg(F.col(label).cast("double")).alias("rate"))
    order = [row["cluster"] for row in rates.orderBy(F.desc("rate"), "cluster").collect()]  # k rows at most
    return clustered.withColumn("cluster", F.array_position(F.array(*[F.lit(c) for c in order]), F.col("cluster")).cast("int") - 1)


def cluster_report(clustered: DataFrame, label: str = "label") -> DataFrame:
    """Size and label rate per cluster, best first, with the best one marked."""
    rates = clustered.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("cnt"), F.avg(F.col(label).cast("double")).alias("rate")
    )
    best = rates.agg(F.max_by("cluster", F.struct("rate", (-F.col("cluster")).alias("first")))).scalar()
    return rates.select(
        "cluster", "cnt", F.round("rate", 6).alias("rate"), (F.col("cluster") == best).cast("int").alias("is_best")
    ).orderBy(F.desc("rate"), "cluster")


def cross_validate(scaled: DataFrame, folds: int = 5, key: str = "id") -> DataFrame:
    """Mean and population deviation of the metrics over stratified folds.

    Out-of-fold predictions are made first; the metrics of all folds are then one aggregate.
    """
    return fold_metrics(out_of_fold(scaled, folds, key))


def fold_metrics(predicted: DataFrame) -> DataFrame:
    """Mean and population deviation over folds of the metrics of each fold, in one aggregate."""
    truth, positive = F.col("label") == 1, F.col("predicted") == 1
    tp, pp, ap = F.count_if(truth & positive), F.count_if(positive), F.count_if(truth)
    per_fold = predicted.groupBy("fold").agg(
        ratio(F.count_if(truth == positive), F.count(F.lit(1))).alias("accuracy"),
        ratio(tp, pp).alias("precision"),
        ratio(tp, ap).alias("recall"),
        ratio(F.lit(2) * tp, pp + ap).alias("f1"),
    )
    cells = [
        F.struct(F.lit(m).alias("metric"), F.avg(m).alias("mean"), F.stddev_pop(m).alias("std")).alias(m)
        for m in METRICS
    ]
    return per_fold.agg(*cells).select(F.inline(F.array(*[F.col(m) for m in METRICS])))


def out_of_fold(scaled: DataFrame, folds: int = 5, key: str = "id", max_iter: int = 1000) -> DataFrame:
    """Prediction for every row from the model that did not see its fold."""
    numbered = durable(fold_ids(scaled, key=key, folds=folds))

    def held_out(fold: int) -> DataFrame:
        model = fit_logistic(numbered.filter(F.col("fold") != fold), max_iter=max_iter)
        return predict(model, numbered.filter(F.col("fold") == fold))

    return reduce(DataFrame.unionByName, concurrently([lambda fold=fold: held_out(fold) for fold in range(folds)]))


def model_report(logistic: DataFrame, svm: DataFrame, validation: DataFrame) -> DataFrame:
    """Both models' metrics side by side with the cross-validated means, one row per metric."""
    names = (*METRICS, "roc_auc")
    pairs = ", ".join(f"'{n}', {n}" for n in names)
    left = logistic.selectExpr(f"stack({len(names)}, {pairs}) AS (metric, logistic_regression)")
    right = svm.selectExpr(f"stack({len(names)}, {pairs}) AS (metric, linear_svm)")
    means = validation.select("metric", F.col("mean").alias("logistic_cross_validated"))
    return left.join(right, "metric").join(means, "metric", "left").orderBy(order_rank(F.col("metric"), names))


# --- text models -------------------------------------------------------------------------------


# Buckets that terms are hashed into, whatever the vocabulary. A model has one coefficient per class and bucket that
# passes `min_df`, in a dense index of those: three times 2^16 numbers at most, 1.5 MB.
TEXT_FEATURES = 1 << 16
# Cells of a task of the solver: at least, so that small tables take few tasks, and at most. A task sends a whole gradient, so
# between the two there are two tasks a core.
CELLS_PER_TASK = (200_000, 4_000_000)


def solver_tasks(cells: int, cores: int) -> int:
    fewest, most = (math.ceil(cells / size) for size in reversed(CELLS_PER_TASK))
    return max(1, fewest, min(most, 2 * cores))


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.hash(term), F.lit(buckets))


def _buckets(reviews: DataFrame, buckets: int) -> Column:
    """The buckets of a review's terms. Where `with_buckets` has found them, texts are not searched again."""
    known = [F.col("buckets")] if buckets == TEXT_FEATURES and "buckets" in reviews.columns else []
    if not known or "comment" in reviews.columns:
        known.append(F.transform(terms(F.col("comment")), lambda term: term_bucket(term, buckets)))
    return F.coalesce(*known)


def with_buckets(reviews: DataFrame) -> DataFrame:
    """Attach the buckets of every review's terms as `buckets`, for tables that are stored and then read by several steps."""
    return reviews.withColumn("buckets", _buckets(reviews, TEXT_FEATURES))


def _class_of(probabilities: Column) -> Column:
    """The class of the largest probability, the first one of equals."""
    best = F.array_position(probabilities, F.array_max(probabilities)).cast("int")
    return F.element_at(F.array(*[F.lit(c) for c in K.CLASSES]), best)


@dataclass(frozen=True)
class TextModel:
    """Fitted text classifier: buckets of terms, the places of those that count, their weights, classifier."""

    buckets: int
    numbered: Scaling
    classifier: SoftmaxModel

    def features(self, df: DataFrame) -> DataFrame:
        """The vectors as Spark's own transformers make them, apart from what the solver was given."""
        vocabulary = [str(b) for b in self.vocabulary] or ["none"]
        named = F.transform(_buckets(df, self.buckets), lambda bucket: bucket.cast("string"))
        index = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="terms", outputCol="counts")
        scaling = ElementwiseProduct(scalingVec=Vectors.dense(self.numbered.scale), inputCol="counts", outputCol="weighted")
        weighted = scaling.transform(index.transform(df.withColumn("terms", named)))
        return Normalizer(p=2.0, inputCol="weighted", outputCol="features").transform(weighted).drop(
            "terms", "counts", "weighted"
        )

    @property
    def vocabulary(self) -> list[int]:
        """The buckets that count, in the order of their places."""
        return np.flatnonzero(self.numbered.places >= 0).tolist()

    def predict(self, df: DataFrame, name: str) -> DataFrame:
        """Attach the predicted class and the probability of the negative class."""
        return self.predict_from(df, _buckets(df, self.buckets), name)

    def predict_from(self, df: DataFrame, buckets: Column, name: str) -> DataFrame:
        """`predict` where the buckets of the terms are known."""
        predicted = df.withColumn("_p", self.classifier.probabilities_of(buckets, self.numbered, df.sparkSession))
        return (
            predicted.withColumn(name, _class_of(F.col("_p")))
            .withColumn(f"{name}_negative", F.get("_p", F.lit(K.CLASSES.index(K.NEGATIVE))))
            .drop("_p")
        )

    def coefficients(self, spark: SparkSession, label: str = K.NEGATIVE) -> DataFrame:
        """(bucket, coefficient) of one class, one row per bucket that counts."""
        values = self.classifier.coefficientMatrix.toArray()[K.CLASSES.index(label)]
        rows = [(int(bucket), float(value)) for bucket, value in zip(self.vocabulary, values)]
        return spark.createDataFrame(rows, "bucket int, coefficient double")


def _class_index(label: str) -> Column:
    return (order_rank(F.col(label), K.CLASSES) - 1).cast("double")


def _training_vectors(model: TextModel, train: DataFrame, label: str) -> DataFrame:
    known = [c for c in ("comment", "buckets") if c in train.columns]
    marked = train.filter(F.col(label).isNotNull()).select(*known, _class_index(label).alias("label"))
    return model.features(marked).select("features", "label")


def fit_text_classifier(
    train: DataFrame,
    label: str,
    min_df: int = 2,
    max_iter: int = 1000,
    tol: float = GRADIENT,
    num_features: int = TEXT_FEATURES,
) -> TextModel:
    """Three-class logistic regression on weighted terms, classes balanced.

    Terms are hashed into `num_features` buckets; no vocabulary is kept anywhere, so the model's size
    does not depend on the texts. Buckets in fewer than `min_df` reviews are left out, and the others numbered without
    gaps, so the solver's vectors are as long as what the reviews hold. A bucket's weight is count *
    (ln((n + 1) / (df + 1)) + 1); each review is scaled to length 1. Rows are spread over as many tasks as their cells
    need. The solver stops when no entry of the gradient is beyond `tol`.
    """
    marked = train.filter(F.col(label).isNotNull())
    marked = durable(marked.select(_buckets(marked, num_features).alias("buckets"), _class_index(label).alias("label")))
    weighted, rows = with_class_weights(marked)
    seen = marked.select(F.explode(F.array_distinct("buckets")).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("df"))
    # At most one row a bucket.
    frequent = sorted((r["bucket"], r["df"]) for r in seen.filter(F.col("df") >= min_df).collect())
    places = np.full(num_features, -1, np.int32)
    places[[b for b, _ in frequent]] = np.arange(len(frequent))
    numbered = Scaling(places, np.array([math.log((rows + 1) / (df + 1)) + 1.0 for _, df in frequent] or [0.0]))
    tasks = solver_tasks(sum(df for _, df in frequent), train.sparkSession.sparkContext.defaultParallelism)
    table = durable(numbered.blocks(weighted).coalesce(tasks))
    # Balanced weights add up to the number of rows.
    fitted = fit_softmax(table, numbered.scale, float(max(rows, 1)), len(K.CLASSES), 1.0 / max(rows, 1), tol, max_iter)
    return TextModel(num_features, numbered, fitted)


def text_certificate(model: TextModel, train: DataFrame, label: str = "label") -> DataFrame:
    """Rows that a text model was fitted to, and whether its coefficients are the optimum."""
    weighted, rows = with_class_weights(_training_vectors(model, train, label))
    scored = weighted.withColumn("_p", model.classifier.probabilities(F.col("features"), train.sparkSession))
    flat = largest_gradient(scored, model.classifier.coefficientMatrix.toArray(), 1.0 / max(rows, 1)) <= GRADIENT * 1.01
    return train.sparkSession.createDataFrame([(rows, int(flat))], "rows_cnt long, at_optimum int")


def fit_on_bands(scored: DataFrame, gold: DataFrame, max_iter: int = 1000) -> TextModel:
    """Train on the scorer's own bands, with every gold row kept out of the training set.

    Rows that move to be told from gold rows take the buckets of their terms along, not their texts.
    """
    needed = [c for c in (*GOLD_KEY, "label", "buckets") if c in scored.columns]
    train = exclude_gold(with_buckets(scored.select(*needed)), gold).select("label", "buckets")
    return fit_text_classifier(train, "label", max_iter=max_iter)


def term_dictionary(
    reviews: DataFrame, buckets: int = TEXT_FEATURES, min_df: int = 2, only: Sequence[int] | None = None
) -> DataFrame:
    """(term, bucket, df, bucket_terms, bucket_df): every term in `min_df` reviews or more, the bucket it is hashed into, and
    how many such terms, and reviews of them, share that bucket. The dictionary stays distributed. With `only`, the part of it
    for these buckets: other terms are not counted."""
    wanted = None
    if only is not None:
        flags = np.zeros(buckets, np.uint8)  # a byte per bucket, read by its place
        flags[list(only)] = 1
        listed, marked = F.lit(bytearray(flags.tobytes())), F.lit(bytearray(b"\x01"))
        wanted = lambda term: F.substring(listed, term_bucket(term, buckets) + 1, F.lit(1)) == marked
    placed = document_frequencies(reviews, min_df, wanted).withColumn("bucket", term_bucket(F.col("term"), buckets))
    shared = W.partitionBy("bucket")  # some terms of the vocabulary, not rows
    return placed.select(
        "term", "bucket", "df", F.count(F.lit(1)).over(shared).alias("bucket_terms"), F.sum("df").over(shared).alias("bucket_df")
    )


def text_top_features(model: TextModel, reviews: DataFrame, k: int = 20, min_df: int = 2, ends: int = 4096) -> DataFrame:
    """The terms of `reviews` that point most and least to the negative class.

    A bucket's coefficient belongs to all terms in it; each gets the share that its reviews have. `bucket_terms` tells
    where that happened. Terms in fewer than `min_df` reviews are left out.

    A share is never beyond its bucket's coefficient. So the terms of the `ends` buckets with the largest and smallest coefficients
    are counted first; if the k-th of them is beyond every other bucket's coefficient, no other term can be among the
    k, else all terms are counted.
    """
    own = model.coefficients(reviews.sparkSession)  # as many rows as the model has coefficients
    share = F.col("coefficient") * F.col("df") / F.col("bucket_df")
    found = sorted((row["coefficient"], row["bucket"]) for row in own.collect())
    rest = found[ends : len(found) - ends]
    for only in [[bucket for _, bucket in found[:ends] + found[len(found) - ends :]], None] if rest else [None]:
        named = term_dictionary(reviews, model.buckets, min_df, only).join(own, "bucket").select("term", share.alias("coefficient"), "bucket_terms")
        named = durable(named)  # both sides read it
        most = named.orderBy(F.desc("coefficient"), "term").limit(k).withColumn("side", F.lit("negative"))
        least = named.orderBy("coefficient", "term").limit(k).withColumn("side", F.lit("not negative"))
        if only is not None:
            high, low = (sorted(row["coefficient"] for row in side.collect()) for side in (most, least))
            if len(high) == k and high[0] > max(rest[-1][0], 0.0) and low[-1] < min(rest[0][0], 0.0):
                break
    return most.unionByName(least)


def fit_on_folds(
    numbered: DataFrame, label: str, folds: int, min_df: int = 2, max_iter: int = 1000, tol: float = GRADIENT
) -> list[TextModel]:
    """`fit_text_classifier` once per fold, on the rows of the other folds; `numbered` has `buckets` and `fold`.

    A fold's model differs in the reviews per bucket, the balance of the classes and the rows it sees. The first two come from
    counts per fold, so the rows are packed and stored once for all models, and a pass over them gives every model's gradient.
    """
    marked = numbered.filter(F.col(label).isNotNull()).select("buckets", "fold", _class_index(label).cast("int").alias("label"))
    counts = marked.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per fold and class
    sizes = np.zeros((folds, len(K.CLASSES)))
    for row in counts:
        sizes[row["fold"], row["label"]] = row["n"]
    sizes = sizes.sum(axis=0) - sizes  # of the rows that a fold's model sees
    rows, present = sizes.sum(axis=1), (sizes > 0).sum(axis=1)
    weights = np.divide(rows[:, None], present[:, None] * sizes, out=np.zeros_like(sizes), where=sizes > 0)

    # At most one row per fold and bucket.
    seen = marked.select("fold", F.explode(F.array_distinct("buckets")).alias("bucket")).groupBy("fold", "bucket").agg(F.count(F.lit(1)).alias("df"))
    found = seen.toArrow()
    df = np.zeros((folds, TEXT_FEATURES))
    df[found["fold"].to_numpy(), found["bucket"].to_numpy()] = found["df"].to_numpy()
    df = df.sum(axis=0) - df
    frequent = np.flatnonzero((df >= min_df).any(axis=0))
    places = np.full(TEXT_FEATURES, -1, np.int32)
    places[frequent] = np.arange(len(frequent))
    scales = np.where(df >= min_df, np.log((rows[:, None] + 1) / (df + 1)) + 1.0, 0.0)[:, frequent]
    scales = scales if len(frequent) else np.zeros((folds, 1))

    cells = int(df[:, frequent].max(axis=0, initial=0).sum())
    tasks = solver_tasks(cells // folds, numbered.sparkSession.sparkContext.defaultParallelism)  # a task sends `folds` gradients
    table = durable(fold_blocks(marked, places, scales, weights).coalesce(tasks))
    totals = np.maximum(rows, 1)  # balanced weights add up to the number of rows
    fitted = fit_each_softmax(table, scales, totals.tolist(), len(K.CLASSES), (1.0 / totals).tolist(), tol, max_iter)
    return [TextModel(TEXT_FEATURES, Scaling(places, scale), model) for scale, model in zip(scales, fitted)]


def text_out_of_fold(gold: DataFrame, folds: int = 5, label: str = "gold_std", max_iter: int = 1000) -> DataFrame:
    """Gold rows with the class predicted by a model that did not see them."""
    numbered = fold_ids(gold, label=label, key="ingest_id", folds=folds)
    numbered = stored(numbered.withColumn("buckets", _buckets(gold, TEXT_FEATURES)))  # all steps read them
    models = fit_on_folds(numbered, label, folds, max_iter=max_iter)
    classifiers, scalings = [m.classifier for m in models], [m.numbered for m in models]
    p = probabilities_by(classifiers, scalings, F.col("buckets"), F.col("fold"), gold.sparkSession)
    predicted = numbered.withColumn("_p", p)
    return predicted.withColumn("cv_label", _class_of(F.col("_p"))).drop("_p", "buckets")


def fold_f1(predicted: DataFrame, label: str = "gold_std", pred: str = "cv_label") -> DataFrame:
    """Macro and weighted F1 over the folds: mean and population deviation."""
    counts = predicted.groupBy("fold").agg(
        F.array(
            *[
                F.struct(
                    F.count_if((F.col(label) == c) & (F.col(pred) == c)).alias("hits"),
                    F.count_if(F.col(pred) == c).alias("predicted"),
                    F.count_if(F.col(label) == c).alias("support"),
                )
                for c in K.CLASSES
            ]
        ).alias("classes")
    )
    rows = counts.select("fold", F.inline("classes"))
    f1 = ratio(F.lit(2) * F.col("hits"), F.col("predicted") + F.col("support"))
    occurs = (F.col("predicted") + F.col("support")) > 0
    per_fold = rows.withColumn("f1", f1).groupBy("fold").agg(
        F.avg(F.when(occurs, F.col("f1"))).alias("f1_macro"),
        ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1_weighted"),
    )
    names = ("f1_macro", "f1_weighted")
    cells = [
        F.struct(F.lit(m).alias("metric"), F.avg(m).alias("mean"), F.stddev_pop(m).alias("std")).alias(m) for m in names
    ]
    return per_fold.agg(*cells).select(F.inline(F.array(*[F.col(m) for m in names])))
