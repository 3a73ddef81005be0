import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shoplayers import constants as K
from shoplayers.operators import sampling, text
from shoplayers.plans import reviews as review_reports

SCHEMA = "ingest_id long, user_id long, goods_id long, category_id long, comment string"


def review_rows(spark, *comments):
    return spark.createDataFrame([(i, 1, 1, 1, c) for i, c in enumerate(comments)], SCHEMA)


def words_of(spark, comment):
    return review_rows(spark, comment).select(text.tokens(F.col("comment")).alias("w")).first()["w"]


def test_shop_terms_stay_whole(spark):
    assert words_of(spark, "京东商城发货速度快，性价比高") == ["京东商城", "发货速度", "性价比"]
    assert words_of(spark, "快递小哥和快递员") == ["快递小哥", "快递员"]
    assert words_of(spark, "的物流快") == ["物流"]
    assert words_of(spark, "京东的物流") == ["物流"]
    assert words_of(spark, "这快递员好") == ["快递员"]
    assert words_of(spark, "物流客服售后x1正品") == ["物流", "客服", "售后", "x1", "正品"]
    assert words_of(spark, "味道鲜美的性价比abc高") == ["味道", "鲜美", "性价比", "abc"]


def test_stop_words_digits_and_single_characters_go(spark):
    assert words_of(spark, "a bb 123 x1 好评 ٣٤ übel") == ["bb", "x1", "übel"]
    assert words_of(spark, "我abc") == ["abc"]
    assert words_of(spark, "") == []


def test_terms_add_neighbouring_pairs(spark):
    rows = review_rows(spark, "Aa bb cc", "one", "!").select(text.terms(F.col("comment")).alias("t")).collect()
    assert [r["t"] for r in rows] == [["aa", "bb", "cc", "aa bb", "bb cc"], ["one"], []]


def test_cleaning_and_funnel(spark):
    raw = spark.createDataFrame(
        [
            (1, 1, 1, 1, "很好很好吃"), (2, 1, 1, 1, "很好，很好吃！"), (3, 2, 1, 1, "很好很好吃"), (4, 1, 2, 1, "很好很好吃"),
            (5, 1, 1, 1, "　abcd　"), (6, 1, 1, 1, None), (7, None, 1, 1, "other text"), (8, None, 1, 1, "other  text"),
        ],
        SCHEMA,
    )
    kept = {r["ingest_id"]: r for r in text.clean_reviews(raw.repartition(4)).collect()}
    assert sorted(kept) == [1, 3, 4, 7]
    funnel = [r["rows_cnt"] for r in text.review_funnel(raw).orderBy("step_no").collect()]
    assert funnel == [8, 7, 6, 4]


def test_templates_count_before_deduplication(spark):
    raw = review_rows(spark, "first one!", "first one", "first-one?", "second text")
    found = text.review_templates(raw, 2).collect()
    assert [tuple(r) for r in found] == [("firstone", 3, "first one!")]


def labelled(spark, n=60):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)]
    rows = [(i, 1, i, 1, " ".join(rng.choices(vocabulary, k=rng.randrange(3, 30)) + ["common"] * 5)) for i in range(n)]
    reviews = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame([(i, i % 3 % 2) for i in range(0, n, 2)], "ingest_id long, is_positive int")
    return rows, reviews, marks


@pytest.mark.parametrize("broadcast_limit", [0, 1_000_000])
def test_scores_equal_brute_force_on_both_paths(spark, broadcast_limit):
    rows, reviews, marks = labelled(spark)
    model = text.fit_sentiment(reviews, marks)
    got = {r["ingest_id"]: r for r in text.score_reviews(reviews, model, broadcast_limit).collect()}

    positive, negative, classes = Counter(), Counter(), Counter()
    mark = {r["ingest_id"]: r["is_positive"] for r in marks.collect()}
    for i, *_, comment in rows:
        if i in mark:
            (positive if mark[i] else negative).update(comment.split())
            classes[mark[i]] += 1
    size = len(set(positive) | set(negative))

    def odds(w):
        return math.log((positive[w] + 1) / (sum(positive.values()) + size)) - math.log(
            (negative[w] + 1) / (sum(negative.values()) + size)
        )

    for i, *_, comment in rows:
        known = [w for w in comment.split() if w in positive or w in negative]
        logit = math.log(classes[1] / classes[0]) + sum(odds(w) for w in known)
        assert got[i]["score"] == pytest.approx(1 / (1 + math.exp(-logit)), abs=2e-6)
    assert len(got) == len(rows)


def test_review_without_known_token_gets_the_prior(spark):
    _, reviews, marks = labelled(spark)
    model = text.fit_sentiment(reviews, marks)
    row = text.score_reviews(review_rows(spark, "zz yy"), model).first()
    assert row["score"] == pytest.approx(1 / (1 + math.exp(-model.prior)), abs=1e-6)


def test_one_class_cannot_be_fitted(spark):
    _, reviews, marks = labelled(spark)
    with pytest.raises(ValueError):
        text.fit_sentiment(reviews, marks.withColumn("is_positive", F.lit(1)))


def test_term_weights_equal_brute_force(spark):
    comments = ["aa bb aa", "bb cc", "aa bb", "dd"]
    got = {r["ingest_id"]: dict(map(tuple, r["weights"])) for r in text.tfidf_weights(review_rows(spark, *comments)).collect()}
    documents = [re.findall(r"\w+", c) for c in comments]
    documents = [d + [f"{a} {b}" for a, b in zip(d, d[1:])] for d in documents]
    df = Counter(t for d in documents for t in set(d))
    for i, d in enumerate(documents):
        raw = {t: c * (math.log((len(comments) + 1) / (df[t] + 1)) + 1) for t, c in Counter(d).items() if df[t] >= 2}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        assert got.get(i, {}) == pytest.approx({t: w / norm for t, w in raw.items()})
    stats = text.tfidf_stats(review_rows(spark, *comments)).first()
    filled = sum(len({t for t in d if df[t] >= 2}) for d in documents)
    features = sum(n >= 2 for n in df.values())
    assert (stats["features"], stats["filled_cells"], stats["rows_cnt"]) == (features, filled, 4)
    assert stats["sparsity"] == pytest.approx(1 - filled / (4 * features), abs=1e-6)


# --- reports and samples on scored reviews -----------------------------------------------------


def scored(spark, scores):
    rows = [(i, i % 5, i % 3, i % 4, f"text number {i} " * 10, s) for i, s in enumerate(scores)]
    from shoplayers.functions.columns import sentiment_band

    return spark.createDataFrame(rows, SCHEMA + ", score double").withColumn("label", sentiment_band(F.col("score")))


def test_histogram_edges(spark):
    bins = [r["cnt"] for r in review_reports.score_histogram(scored(spark, [0.0, 0.05, 0.5, 1.0, 1.0])).collect()]
    assert len(bins) == 20 and bins[0] == 1 and bins[1] == 1 and bins[10] == 1 and bins[19] == 2
    flat = [r["cnt"] for r in review_reports.score_histogram(scored(spark, [0.3, 0.3])).collect()]
    assert flat[10] == 2 and sum(flat) == 2


def test_distribution_lists_every_band(spark):
    rows = [(r["label"], r["cnt"]) for r in review_reports.sentiment_distribution(scored(spark, [0.1, 0.9, 0.95])).collect()]
    assert rows == [(K.POSITIVE, 2), (K.NEUTRAL, 0), (K.NEGATIVE, 1)]


def test_category_rates(spark):
    df = scored(spark, [0.1, 0.9, 0.1, 0.9, 0.1, 0.1, 0.9, 0.9])
    names = spark.createDataFrame([(0, "zero")], "category_id long, category_label string")
    rows = [tuple(r) for r in review_reports.category_negative_rate(df, names, 2, 2).collect()]
    assert rows == [(0, 2, 2, 100.0, "zero"), (1, 2, 1, 50.0, K.UNKNOWN_CATEGORY)]


def test_sample_is_exact_and_repeatable(spark):
    df = scored(spark, [0.1] * 50 + [0.5] * 7 + [0.9] * 90)
    sample = sampling.sample_per_band(df, 40)
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    assert counts == {K.NEGATIVE: 40, K.NEUTRAL: 7, K.POSITIVE: 40}
    ids = {r["ingest_id"] for r in sample.collect()}
    assert ids == {r["ingest_id"] for r in sampling.sample_per_band(df.repartition(9), 40).collect()}
    assert ids != {r["ingest_id"] for r in sampling.sample_per_band(df, 40, seed=1).collect()}
    sheet = sampling.labelling_sheet(sample)
    assert sheet.columns == ["line_no", "user_id", "goods_id", "comment", "gold"]
    assert [r["line_no"] for r in sheet.collect()] == list(range(1, 88))
    assert {(r["label"], r["cnt"]) for r in sampling.short_bands(df, 40).collect()} == {(K.NEUTRAL, 7)}
    one_band = scored(spark, [0.1] * 50 + [None])
    assert {(r["label"], r["cnt"]) for r in sampling.short_bands(one_band, 40).collect()} == {(K.NEUTRAL, 0), (K.POSITIVE, 0)}


def test_equidistant_sheet(spark):
    low = [i / 1000 for i in range(35)]
    df = scored(spark, low + [0.1, 0.15, 0.2, 0.5])
    rows = sampling.equidistant_sheet(df).collect()
    assert [r["score"] for r in rows] == [i / 1000 for i in range(0, 30, 3)] + [0.1, 0.15]
    assert all(len(r["comment"]) == K.SHEET_CHARS and r["review"] == "" for r in rows)


def test_split_and_folds(spark):
    df = spark.range(1000).withColumn("label", (F.col("id") % 4 == 0).cast("int"))
    split = sampling.stratified_split(df)
    counts = {(r["label"], r["is_train"]): r["count"] for r in split.groupBy("label", "is_train").count().collect()}
    assert counts == {(0, 1): 525, (0, 0): 225, (1, 1): 175, (1, 0): 75}
    assert split.filter("in_subsample = 1 AND is_train = 0").count() == 0
    assert split.filter("in_subsample = 1").count() == 700
    bounded = sampling.stratified_split(df, max_fit_rows=200)
    sizes = {r["label"]: r["count"] for r in bounded.filter("in_subsample = 1").groupBy("label").count().collect()}
    assert sizes == {0: 150, 1: 50} and bounded.filter("in_subsample = 1 AND is_train = 0").count() == 0
    folds = sampling.fold_ids(df)
    sizes = [r["count"] for r in folds.groupBy("label", "fold").count().collect()]
    assert sorted(sizes) == [50] * 5 + [150] * 5


# --- tokens in one pass ----------------------------------------------------------------------------


def times_evaluated(expression, df) -> int:
    return df.select(expression.alias("found"))._jdf.queryExecution().analyzed().toString().count("regexp_")


def test_a_text_is_searched_for_tokens_once(spark):
    df = spark.createDataFrame([("a b",)], "comment string")
    assert times_evaluated(text.tokens(F.col("comment")), df) == 1
    assert times_evaluated(text.terms(F.col("comment")), df) == 1


def test_tokens_are_those_of_terms_set_apart_first(spark):
    parts = ["aZ_9", "é", "ß3", "٣٤", "12", "½", "Ⅷ", "一", "好", "的", "𠀀", "カ", " ", "\n", "\x01", "，", "物流", "发货速度", "快递小哥", "快", "没有"]
    texts = ["".join(parts[(i * 7 + k * (i % 11 + 1) + k * k) % len(parts)] for k in range(i % 9)) for i in range(600)]
    df = spark.createDataFrame([(t,) for t in [None, *texts]], "comment string")
    shop = "|".join(sorted(K.DOMAIN_TERMS, key=len, reverse=True))
    apart = F.regexp_replace("comment", f"({shop})", "\x01$1\x01")
    pattern = rf"{shop}|\p{{IsHan}}{{2}}|[\p{{L}}\p{{N}}_&&\P{{IsHan}}]{{2,}}"
    found = F.filter(F.regexp_extract_all(apart, F.lit(pattern), F.lit(0)), lambda w: ~w.isin(*K.STOP_WORDS) & ~w.rlike(r"^\p{Nd}+$"))
    both = df.select("comment", found.alias("expected"), text.tokens(F.col("comment")).alias("found"))
    assert both.filter(F.size("expected") > 0).count() > 300
    assert both.filter(~F.col("expected").eqNullSafe(F.col("found"))).collect() == []


def test_pairs_follow_the_words(spark):
    df = spark.createDataFrame([(1, "Ab 12 cd EF"), (2, "ab"), (3, ""), (4, None)], "id int, comment string")
    found = {r["id"]: r["terms"] for r in df.select("id", text.terms(F.col("comment")).alias("terms")).collect()}
    assert found == {1: ["ab", "cd", "ef", "ab cd", "cd ef"], 2: ["ab"], 3: [], 4: None}


def test_terms_are_counted_by_as_many_tasks_as_the_texts_need(spark):
    rows = [(None if i % 7 == 0 else i, f"{'word' * 40} t{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "ingest_id long, comment string").coalesce(1)
    spread = text.spread_texts(df, "ingest_id", "comment", bytes_per_task=1000)
    assert spread.rdd.getNumPartitions() == math.ceil(sum(len(t) for _, t in rows) / 1000)
    assert spread.rdd.glom().map(len).max() < 40
    assert sorted(map(str, spread.collect())) == sorted(map(str, df.collect()))
    assert text.spread_texts(df.filter("false"), "ingest_id").count() == 0


def test_ascii_words_need_no_ranges_and_no_tables_of_scripts(spark):
    """A word of ASCII is found by the first branch alone; all branches together find what sets in the other order found."""
    shop, han = text._SHOP_TERMS, text._HAN
    other = r"[[A-Za-z0-9_][\p{L}\p{N}&&\P{IsHan}]]"
    before = rf"\p{{Nd}}++(?!{other})|({other}{other}+|(?={han})(?:{shop}|{han}(?!{shop}){han}))"
    assert "A-Z" not in text._TOKEN and r"\p{" not in text._ASCII_WORD
    parts = ["a", "Z9", "_", "1", "12", "é", "٣", "½", "Ⅷ", "好", "的物流", "快递员", "々", "⺀", "𠀀", "一", " ", "-", "\x85", "１", "ab", "カ"]
    texts = ["".join(parts[(i // len(parts) ** k) % len(parts)] for k in range(3)) for i in range(len(parts) ** 3)]
    df = spark.createDataFrame([(t,) for t in texts], "comment string")
    found = [F.filter(F.regexp_extract_all("comment", F.lit(p), F.lit(1)), lambda w: w != "") for p in (before, text._TOKEN)]
    assert df.filter(found[0] != found[1]).collect() == [] and df.filter(F.size(found[1]) > 0).count() > 5000
    ascii_only = df.filter(F.octet_length("comment") == F.length("comment"))
    starts = F.filter(F.regexp_extract_all("comment", F.lit(rf"({text._ASCII_WORD})"), F.lit(1)), lambda w: w != "")
    assert ascii_only.filter(F.col("comment").rlike("^[a-zA-Z_]{2,}$") & (starts != found[1])).collect() == []


def test_term_weights_move_texts_and_a_row_per_place_and_term(spark):
    rows = [(None if i % 9 == 0 else i % 40, None if i == 7 else f"aa bb t{i % 5} aa x{i} bb") for i in range(60)]
    df = spark.createDataFrame(rows, "ingest_id long, comment string")
    wanted = {}
    for i, comment in rows:
        words = (comment or "").split()
        wanted.setdefault(i, Counter()).update(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
    seen = Counter(t for _, c in rows if c for t in {*c.split(), *(f"{a} {b}" for a, b in zip(c.split(), c.split()[1:]))})
    found = text.tfidf_weights(df, bytes_per_task=100)
    got = {r["ingest_id"]: dict(map(tuple, r["weights"])) for r in found.collect()}
    for i, counts in wanted.items():
        raw = {t: n * (math.log(61 / (seen[t] + 1)) + 1) for t, n in counts.items() if seen[t] >= 2}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        assert got.get(i, {}) == pytest.approx({t: w / norm for t, w in raw.items()})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(term") == plan.count("hashpartitioning(place") // 2 and "hashpartitioning(ingest_id" not in plan
    places, tasks = text._placed_texts(df, 100)
    dealt = places.repartition(tasks, "place").rdd.glom().map(lambda part: len({r["place"] for r in part})).collect()
    assert tasks > 5 and max(dealt) == 1
