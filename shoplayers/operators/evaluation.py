"""Model evaluation against gold labels. Every metric is an aggregate; results are small tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shoplayers import constants as K
from shoplayers.functions.columns import mapped
from shoplayers.functions.membership import bitmap_of, may_be_member
from shoplayers.functions.numbers import f_score, ratio
from shoplayers.functions.ordered import with_running_totals
from shoplayers.operators.quality import require, require_rows, require_unique
from shoplayers.session import durable

GOLD_KEY = ("user_id", "goods_id", "comment")


def _hashed(df: DataFrame, *, prefix: str = "") -> DataFrame:
    """Add a digest of the key, so that joins move 32 bytes a row instead of the review's text.

    NULL and empty parts of the key give different digests.
    """
    parts = [F.when(F.col(k).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(k).cast("string"))) for k in GOLD_KEY]
    return df.withColumn(f"{prefix}_key", F.unhex(F.sha2(F.concat_ws("|", *[F.concat(F.length(p), F.lit(":"), p) for p in parts]), 256)))


def join_gold(gold: DataFrame, scored: DataFrame, check: bool = True) -> DataFrame:
    """Attach scores to gold rows one to one, map the labels, drop ambiguous rows.

    Rows meet by a digest of the key; the columns of the key are compared as well. A bitmap of the sheet's
    digests comes first: scored rows whose bit is not set are left where they are, so only candidates move. The joined
    rows, no more than people labelled, are stored once: every metric reads them again. With `check` the jobs raise
    on repeated keys, lost rows, missing scores and labels outside the whitelist.
    """
    sheet = durable(_hashed(gold.filter(F.col("user_id").isNotNull() & F.col("goods_id").isNotNull() & F.col("comment").isNotNull())))
    rest = [c for c in scored.columns if c not in GOLD_KEY]
    wanted = sheet.select("_key").distinct()
    bitmap = bitmap_of(sheet, F.xxhash64("_key"))
    candidates = _hashed(scored).filter(may_be_member(bitmap, F.xxhash64("_key")))
    matches = candidates.join(wanted, "_key", "left_semi")
    other = matches.select("_key", *[F.col(k).alias(f"_{k}") for k in GOLD_KEY], *rest)
    same = (F.col("g._key") == F.col("s._key")) & (F.col("g.user_id") == F.col("s._user_id"))
    same &= (F.col("g.goods_id") == F.col("s._goods_id")) & (F.col("g.comment") == F.col("s._comment"))
    found = sheet.alias("g").join(other.alias("s"), same, "left").select(*[F.col(f"g.{c}") for c in gold.columns], *[F.col(f"s.{c}") for c in rest])
    incomplete = gold.filter(F.col("user_id").isNull() | F.col("goods_id").isNull() | F.col("comment").isNull())
    mapping = mapped(F.col("gold"), K.GOLD_LABELS)
    joined = durable(found.unionByName(incomplete, allowMissingColumns=True).withColumn("gold_std", mapping))
    if check:
        # A key that is unique after the join was unique on both sides.
        require_unique(joined, GOLD_KEY, "gold and scored keys must be unique")
        require_rows(joined, gold.count(), "gold rows after the join")
        require(joined, F.col("score").isNotNull(), "gold row without a score")
        require(joined, F.col("gold_std").isNotNull(), "gold label outside the whitelist")
    return joined.filter(F.col("gold_std") != K.AMBIGUOUS)


def ambiguous_share(gold: DataFrame) -> DataFrame:
    """Gold rows, ambiguous rows and their share in percent."""
    return gold.agg(
        F.count(F.lit(1)).alias("rows_cnt"),
        F.count_if(F.col("gold") == K.AMBIGUOUS).alias("ambiguous"),
        F.round(F.avg((F.col("gold") == K.AMBIGUOUS).cast("int")) * 100, 2).alias("ambiguous_pct"),
    )


def exclude_gold(scored: DataFrame, gold: DataFrame) -> DataFrame:
    """Training rows: everything that is not a gold row. NULL keys match NULL keys.

    Rows meet by a 256-bit digest of the key. Rows whose bit in a bitmap of the gold digests is not set are no gold
    rows and stay where they are; only the others are moved to find out.
    """
    keys = durable(_hashed(gold.select(*GOLD_KEY)).select("_key").distinct())
    hashed, bitmap = _hashed(scored), bitmap_of(keys, F.xxhash64("_key"))
    maybe = may_be_member(bitmap, F.xxhash64("_key"))
    others = hashed.filter(maybe).join(keys, "_key", "left_anti")
    return hashed.filter(~maybe).unionByName(others).drop("_key")


def confusion_matrix(df: DataFrame, gold: str = "gold_std", pred: str = "label") -> DataFrame:
    """Counts per gold class (rows) and predicted class (columns), 0 where nothing occurs."""
    cells = [
        F.count_if(F.coalesce((F.col(gold) == g) & (F.col(pred) == p), F.lit(False))).alias(f"c{i}{j}")
        for i, g in enumerate(K.CLASSES)
        for j, p in enumerate(K.CLASSES)
    ]
    size = len(K.CLASSES)
    rows = ", ".join(
        f"{i}, '{g}', " + ", ".join(f"c{i}{j}" for j in range(size)) for i, g in enumerate(K.CLASSES)
    )
    names = ", ".join(f"pred_{name}" for name in ("negative", "neutral", "positive"))
    return df.agg(*cells).selectExpr(f"stack({size}, {rows}) AS (class_no, gold_class, {names})")


def _class_counts(df: DataFrame, gold: str, pred: str) -> DataFrame:
    """One row per class: hits, predicted rows, gold rows."""
    cells = []
    for i, c in enumerate(K.CLASSES):
        is_gold = F.coalesce(F.col(gold) == c, F.lit(False))
        is_pred = F.coalesce(F.col(pred) == c, F.lit(False))
        cells += [
            F.count_if(is_gold & is_pred).alias(f"h{i}"),
            F.count_if(is_pred).alias(f"p{i}"),
            F.count_if(is_gold).alias(f"g{i}"),
        ]
    rows = ", ".join(f"'{c}', h{i}, p{i}, g{i}" for i, c in enumerate(K.CLASSES))
    return df.agg(*cells).selectExpr(f"stack({len(K.CLASSES)}, {rows}) AS (class, hits, predicted, support)")


def _class_scores(df: DataFrame, gold: str, pred: str) -> DataFrame:
    precision = ratio(F.col("hits"), F.col("predicted"))
    recall = ratio(F.col("hits"), F.col("support"))
    return _class_counts(df, gold, pred).select(
        "class", "hits", "support", precision.alias("precision"), recall.alias("recall"),
        f_score(precision, recall).alias("f1"),
    )


def class_scores(df: DataFrame, target: str = K.NEGATIVE, gold: str = "gold_std", pred: str = "label") -> DataFrame:
    """Precision, recall and F1 of one class."""
    return _class_scores(df, gold, pred).filter(F.col("class") == target).drop("hits")


def class_report(df: DataFrame, gold: str = "gold_std", pred: str = "label") -> DataFrame:
    """Scores per class with support, then accuracy, macro and weighted averages, to four digits."""
    scores = _class_scores(df, gold, pred)
    metrics = ("precision", "recall", "f1")
    accuracy = ratio(F.sum("hits"), F.sum("support"))
    support = F.sum("support")
    summary = scores.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("class"), *[accuracy.alias(m) for m in metrics], support.alias("support")
            ),
            F.struct(
                F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in metrics], support.alias("support")
            ),
            F.struct(
                F.lit("weighted avg").alias("class"),
                *[ratio(F.sum(F.col(m) * F.col("support")), support).alias(m) for m in metrics],
                support.alias("support"),
            ),
        ).alias("rows")
    ).select(F.inline("rows"))
    report = scores.select("class", *metrics, "support").unionByName(summary)
    return report.withColumns({m: F.round(m, 4) for m in metrics})


def band_weighted_recall(
    df: DataFrame, band_sizes: DataFrame, gold: str = "gold_std", pred: str = "label"
) -> DataFrame:
    """Negative precision, and recall and F1 corrected for a sample drawn per band.

    `band_sizes` has the columns `label` and `cnt` over all scored rows. The share of true
    negatives per predicted band is scaled to the band's size. A band that has scored rows but no
    row in `df` has no known share, so the corrected figures are NULL.
    """
    shares = df.groupBy(F.col(pred).alias("label")).agg(
        F.avg((F.col(gold) == K.NEGATIVE).cast("double")).alias("share")
    )
    scaled = band_sizes.join(shares, "label", "left").withColumn("expected", F.col("share") * F.col("cnt"))
    corrected = ratio(F.sum(F.when(F.col("label") == K.NEGATIVE, F.col("expected"))), F.sum("expected"))
    unknown = F.count_if(F.col("share").isNull())
    recall_w = scaled.agg(F.when(unknown == 0, corrected).alias("recall_w")).scalar()
    scores = class_scores(df, K.NEGATIVE, gold, pred).withColumn("recall_w", recall_w)
    f1_w = F.when(F.col("recall_w").isNotNull(), f_score(F.col("precision"), F.col("recall_w")))
    return scores.select(
        F.round("precision", 6).alias("precision"),
        F.round("recall", 6).alias("recall"),
        F.round("recall_w", 6).alias("recall_w"),
        F.round(f1_w, 6).alias("f1_w"),
    )


def band_sizes(scored: DataFrame, label: str = "label") -> DataFrame:
    banded = scored.filter(F.col(label).isNotNull())
    return banded.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("cnt"))


# --- paired test -------------------------------------------------------------------------------


def mcnemar_p_value(only_a: Column, only_b: Column) -> Column:
    """Exact two-sided binomial for few disagreements, else chi-square with continuity correction.

    Both sums are short loops inside the expression, over the two counts of one row.
    """
    n = (only_a + only_b).cast("double")
    pair = lambda term, total: F.struct(term.alias("term"), total.alias("total"))
    one, zero = F.lit(1.0), F.lit(0.0)
    # Sum of binomial coefficients up to the smaller count.
    fewer = F.least(only_a, only_b, F.lit(K.EXACT_TEST_BELOW))
    tail = F.aggregate(
        F.sequence(F.lit(0).cast("bigint"), fewer.cast("bigint")),
        pair(one, zero),
        lambda acc, k: pair(acc["term"] * (n - k) / (k + 1.0), acc["total"] + acc["term"]),
        lambda acc: acc["total"],
    )
    exact = F.least(one, tail * 2.0 / F.pow(F.lit(2.0), n))
    # Upper tail of chi-square with one degree of freedom: 1 - erf(z), by the series of erf.
    z = F.sqrt(F.pow(F.abs(only_a - only_b) - 1.0, F.lit(2.0)) / F.greatest(n, one) / 2.0)
    series = F.aggregate(
        F.sequence(F.lit(0), F.lit(200)),
        pair(z, zero),
        lambda acc, k: pair(acc["term"] * 2.0 * z * z / (k * 2 + 3.0), acc["total"] + acc["term"]),
        lambda acc: acc["total"],
    )
    erf = 2.0 / math.sqrt(math.pi) * F.exp(-z * z) * series
    approximate = F.when(z > 6, zero).otherwise(F.greatest(zero, 1.0 - erf))
    return F.when(n < K.EXACT_TEST_BELOW, exact).otherwise(approximate)


def mcnemar(df: DataFrame, pred_a: str = "label", pred_b: str = "label_b", gold: str = "gold_std") -> DataFrame:
    """Paired test of two models on the question "negative or not"; counts come from one pass."""
    truth = F.col(gold) == K.NEGATIVE
    a_right = (F.col(pred_a) == K.NEGATIVE) == truth
    b_right = (F.col(pred_b) == K.NEGATIVE) == truth
    counts = df.agg(
        F.count_if(a_right & b_right).alias("both_right"),
        F.count_if(a_right & ~b_right).alias("only_a_right"),
        F.count_if(~a_right & b_right).alias("only_b_right"),
        F.count_if(~a_right & ~b_right).alias("both_wrong"),
    )
    return counts.withColumn("p_value", F.round(mcnemar_p_value(F.col("only_a_right"), F.col("only_b_right")), 6))


# --- ranking metrics ---------------------------------------------------------------------------


def _by_score(df: DataFrame, target: Column, score: Column, descending: bool = True) -> DataFrame:
    """One row per distinct score with hits and rows, and running totals from the best score on."""
    rank = -score if descending else score
    per_score = (
        df.select(rank.alias("rank"), score.alias("score"), F.coalesce(target.cast("long"), F.lit(0)).alias("hit"))
        .groupBy("rank")
        .agg(F.max("score").alias("score"), F.sum("hit").alias("hits"), F.count(F.lit(1)).alias("n"))
    )
    return with_running_totals(per_score, [], ["rank"], {"hits_upto": F.col("hits"), "n_upto": F.col("n")})


def average_precision(df: DataFrame, target: Column, score: Column) -> DataFrame:
    """Step-wise area under the precision-recall curve; equal scores form one step."""
    steps = _by_score(df, target, score)
    weighted = F.sum(F.col("hits") * (F.col("hits_upto") / F.col("n_upto")))
    return steps.agg(
        F.sum("hits").alias("positives"),
        F.sum("n").alias("rows_cnt"),
        F.round(ratio(weighted, F.sum("hits")), 6).alias("average_precision"),
    )


def precision_recall_curve(df: DataFrame, target: Column, score: Column) -> DataFrame:
    """One point per distinct score, and the end point at recall 0 and precision 1."""
    steps = _by_score(df, target, score)
    total = steps.agg(F.sum("hits")).scalar()
    points = steps.select(
        F.col("score").alias("threshold"),
        F.round(F.col("hits_upto") / F.col("n_upto"), 6).alias("precision"),
        F.round(F.when(total == 0, F.lit(1.0)).otherwise(F.try_divide(F.col("hits_upto"), total)), 6).alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def roc_auc(df: DataFrame, target: Column, score: Column) -> DataFrame:
    """Area under the ROC curve from average ranks; 0.5 when only one class is present."""
    steps = _by_score(df, target, score, descending=False)
    rank = F.col("n_upto") - F.col("n") + (F.col("n") + 1) / 2
    sums = steps.agg(
        F.sum(F.col("hits") * rank).alias("rank_sum"), F.sum("hits").alias("pos"), F.sum("n").alias("rows_cnt")
    )
    pos, neg = F.col("pos").cast("double"), (F.col("rows_cnt") - F.col("pos")).cast("double")
    area = F.try_divide(F.col("rank_sum") - pos * (pos + 1) / 2, pos * neg)
    return sums.select("rows_cnt", F.round(F.coalesce(area, F.lit(0.5)), 6).alias("roc_auc"))


def binary_metrics(df: DataFrame, target: Column, predicted: Column) -> DataFrame:
    """Accuracy, precision, recall and F1; precision is 1 when nothing is predicted positive."""
    t, p = F.coalesce(target, F.lit(False)), F.coalesce(predicted, F.lit(False))
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(t & p).alias("tp"),
        F.count_if(p).alias("pp"),
        F.count_if(t).alias("ap"),
        F.count_if(t == p).alias("ok"),
    )
    tp, pp, ap = F.col("tp"), F.col("pp"), F.col("ap")
    shown = F.coalesce(F.try_divide(tp.cast("double"), pp), F.lit(1.0))
    recall = ratio(tp, ap)
    return counts.select(
        F.round(ratio(F.col("ok"), F.col("n")), 6).alias("accuracy"),
        F.round(shown, 6).alias("precision"),
        F.round(recall, 6).alias("recall"),
        F.round(ratio(F.lit(2) * tp, pp + ap), 6).alias("f1"),
    )


def both_wrong(df: DataFrame, pred_a: str = "label", pred_b: str = "label_b", gold: str = "gold_std") -> DataFrame:
    """Rows both models get wrong."""
    wrong = (F.col(pred_a) != F.col(gold)) & (F.col(pred_b) != F.col(gold))
    return df.filter(wrong).select("user_id", "goods_id", "comment", gold, pred_a, pred_b, "score")


def model_decision(
    df: DataFrame,
    sizes_a: DataFrame,
    sizes_b: DataFrame,
    pred_a: str = "label",
    pred_b: str = "label_b",
    gold: str = "gold_std",
) -> DataFrame:
    """Two-model summary and the pre-registered decision: switch only on a large and significant gain."""
    summary = band_weighted_recall(df, sizes_a, gold, pred_a).select(
        F.lit("baseline").alias("model"), "precision", "recall_w", "f1_w"
    ).unionByName(
        band_weighted_recall(df, sizes_b, gold, pred_b).select(
            F.lit("candidate").alias("model"), "precision", "recall_w", "f1_w"
        )
    )
    p_value = mcnemar(df, pred_a, pred_b, gold).select("p_value").scalar()
    f1_a = F.max(F.when(F.col("model") == "baseline", F.col("f1_w")))
    f1_b = F.max(F.when(F.col("model") == "candidate", F.col("f1_w")))
    gain = F.round((f1_b - f1_a) * 100, 4)
    return summary.agg(f1_a.alias("baseline_f1_w"), f1_b.alias("candidate_f1_w"), gain.alias("gain_points")).withColumn(
        "p_value", p_value
    ).withColumn(
        "decision",
        F.when(
            (F.col("gain_points") >= K.DECISION_MIN_GAIN_POINTS) & (F.col("p_value") < K.DECISION_MAX_P), "switch"
        ).otherwise("keep"),
    )
