"""Review text: cleaning, tokens, sentiment scores, term weights."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shoplayers import constants as K
from shoplayers.functions.columns import let, sentiment_band, strip, word_characters
from shoplayers.functions.skew import join_counted_lookup
from shoplayers.operators.cleaning import keep_first
from shoplayers.session import durable, stored

# A fitted token table of up to this many bytes may be broadcast.
BROADCAST_BYTES = 64 << 20
# Text whose terms a task counts at a time.
BYTES_PER_TASK = 16 << 20
_SHOP_TERMS = "|".join(sorted(K.DOMAIN_TERMS, key=len, reverse=True))  # all of Han characters
# The engine's own sets of ASCII come first: they settle a character by one look at a table, sets of ranges by a chain of calls.
_OTHER = r"[\w[[^\x00-\x7F]&&[\p{L}\p{N}]&&\P{IsHan}]]"
_HAN = r"[[^\x00-\x7F]&&\p{IsHan}]"
_ASCII_WORD = r"(?!\d)\w\w++(?![^\x00-\x7F])"
_ANY_WORD = rf"(?!\p{{Nd}}++(?!{_OTHER})){_OTHER}{_OTHER}++"
_HAN_WORD = rf"(?={_HAN})(?:{_SHOP_TERMS}|{_HAN}(?!{_SHOP_TERMS}){_HAN})"
# Nothing begins at ASCII that is no word character. A run of digits alone is passed over: it leaves the group empty.
_TOKEN = rf"(?=[\w[^\x00-\x7F]])(?:({_ASCII_WORD}|{_ANY_WORD}|{_HAN_WORD})|\p{{Nd}}++)"


def tokens(text: Column) -> Column:
    """Tokens of two or more characters that are neither stop words nor digits.

    Shop terms come first, the longest first, and nothing before a term can take part of it.
    What remains gives pairs of Han characters and words of other characters. One pass over the text.
    """
    found = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(1))
    return F.filter(found, lambda w: ~w.isin("", *K.STOP_WORDS))


def terms(text: Column) -> Column:
    """Lower-case tokens and pairs of neighbouring tokens."""

    def with_pairs(words: Column) -> Column:
        pairs = F.zip_with(
            words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b)
        )
        return F.concat(words, F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(0))))

    return let(tokens(F.lower(text)), with_pairs)


# --- cleaning ----------------------------------------------------------------------------------


def _long_enough(raw: DataFrame, min_chars: int) -> DataFrame:
    kept = raw.filter("comment IS NOT NULL").withColumn("comment", strip(F.col("comment")))
    kept = kept.filter(F.length("comment") >= min_chars)
    return kept.withColumn("norm", word_characters(F.col("comment")))


def clean_reviews(raw: DataFrame, min_chars: int = K.MIN_REVIEW_CHARS) -> DataFrame:
    """Reviews with text, long enough, one per user, product and normalised text.

    The shuffle key holds a SHA-256 of the normalised text instead of the text itself.
    """
    kept = _long_enough(raw, min_chars)
    return keep_first(kept, ["user_id", "goods_id", F.sha2("norm", 256)])


def review_funnel(raw: DataFrame, min_chars: int = K.MIN_REVIEW_CHARS) -> DataFrame:
    """Rows left after every cleaning step, in one pass over the reviews.

    Rows that fail a step share one NULL key, merged before the shuffle.
    """
    text = strip(F.col("comment"))
    long_enough = F.coalesce(F.length(text) >= min_chars, F.lit(False))
    key = F.struct("user_id", "goods_id", F.sha2(word_characters(text), 256).alias("norm"))
    keyed = raw.select(
        F.col("comment").isNotNull().alias("has_text"), long_enough.alias("long_enough"), F.when(long_enough, key).alias("key")
    )
    merged = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("has_text").alias("has_text"),
        F.count_if("long_enough").alias("long_enough"),
    )
    totals = merged.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw"),
        F.coalesce(F.sum("has_text"), F.lit(0)).alias("with_text"),
        F.coalesce(F.sum("long_enough"), F.lit(0)).alias("long_enough"),
        F.count("key").alias("deduplicated"),
    )
    return totals.selectExpr(
        "stack(4, 1, 'raw', raw, 2, 'with_text', with_text, 3, 'long_enough', long_enough, "
        "4, 'deduplicated', deduplicated) AS (step_no, step, rows_cnt)"
    )


def review_templates(
    raw: DataFrame, threshold: int = K.TEMPLATE_THRESHOLD, min_chars: int = K.MIN_REVIEW_CHARS
) -> DataFrame:
    """Normalised texts seen more than `threshold` times before deduplication, with an example.

    Counting moves only hashes and ids. The suspects, one id each, are stored and counted; up to
    BROADCAST_BYTES of them are broadcast to a second scan, so no text but a suspect's ever moves. More of
    them meet the texts by a shuffle.
    """
    kept = _long_enough(raw, min_chars)
    suspects = (
        kept.select(F.sha2("norm", 256).alias("hash"), "ingest_id")
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("occurrences"), F.min("ingest_id").alias("ingest_id"))
        .filter(F.col("occurrences") > threshold)
        .drop("hash")
    )
    suspects = durable(suspects)
    if suspects.count() * 64 <= BROADCAST_BYTES:  # two numbers a row
        suspects = F.broadcast(suspects)
    return (
        kept.select("ingest_id", "norm", F.col("comment").alias("example"))
        .join(suspects, "ingest_id")
        .select("norm", "occurrences", "example")
        .orderBy(F.desc("occurrences"), "norm")
    )


# --- tokens ------------------------------------------------------------------------------------


def with_words(reviews: DataFrame) -> DataFrame:
    return reviews.withColumn("words", tokens(F.col("comment")))


def exploded_words(reviews: DataFrame) -> DataFrame:
    """One row per token and review, without the text."""
    return reviews.select("ingest_id", F.explode(tokens(F.col("comment"))).alias("token"))


def top_words(reviews: DataFrame, k: int = 20) -> DataFrame:
    """Most frequent tokens; ties by token."""
    counts = exploded_words(reviews).groupBy("token").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.desc("cnt"), "token").limit(k)


# --- sentiment ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class SentimentModel:
    """Fitted evidence per token (a durable table), its bytes, and the evidence before any token."""

    log_odds: DataFrame
    size: int
    prior: float


def token_log_odds(reviews: DataFrame, marks: DataFrame) -> DataFrame:
    """Naive-Bayes evidence of every training token: ln P(token | positive) - ln P(token | negative).

    Counts are smoothed by one over the training vocabulary.
    """
    labelled = reviews.select("ingest_id", "comment").join(
        marks.select("ingest_id", "is_positive"), "ingest_id"
    )
    counts = (
        labelled.select("is_positive", F.explode(tokens(F.col("comment"))).alias("token"))
        .groupBy("token")
        .agg(
            F.count_if(F.col("is_positive") == 1).alias("positive"),
            F.count_if(F.col("is_positive") == 0).alias("negative"),
        )
    )
    total = counts.agg(
        F.struct(F.sum("positive").alias("pos"), F.sum("negative").alias("neg"), F.count(F.lit(1)).alias("size"))
    ).scalar()

    def likelihood(count: str, name: str) -> Column:
        return F.ln((F.col(count) + 1) / (F.col(f"t.{name}") + F.col("t.size")).cast("double"))

    return counts.withColumn("t", total).select(
        "token", "positive", "negative", (likelihood("positive", "pos") - likelihood("negative", "neg")).alias("log_odds")
    )


def fit_sentiment(reviews: DataFrame, marks: DataFrame) -> SentimentModel:
    """Fit the token evidence on marked reviews and store it."""
    log_odds = durable(token_log_odds(reviews, marks))
    classes = (
        reviews.select("ingest_id")
        .join(marks.select("ingest_id", "is_positive"), "ingest_id")
        .agg(
            F.count_if(F.col("is_positive") == 1).alias("positive"),
            F.count_if(F.col("is_positive") == 0).alias("negative"),
        )
        .first()
    )
    if not classes["positive"] or not classes["negative"]:
        raise ValueError("both classes need at least one marked review")
    size = log_odds.agg(F.coalesce(F.sum(F.octet_length("token") + 16), F.lit(0)).alias("size")).first()["size"]
    return SentimentModel(log_odds, size, math.log(classes["positive"] / classes["negative"]))


def score_reviews(reviews: DataFrame, model: SentimentModel, broadcast_limit: int = BROADCAST_BYTES) -> DataFrame:
    """Sentiment score in [0, 1] per review (probability of positive) and its band.

    Tokens outside the training vocabulary carry no evidence. A model of up to `broadcast_limit`
    bytes is broadcast, so tokens are never shuffled; a larger one is joined by shuffle with
    frequent tokens cut into pieces. Either way only ids and sums move until the text is attached.
    """
    words = exploded_words(reviews)
    evidence = model.log_odds.select("token", "log_odds")
    if model.size <= broadcast_limit:
        known = words.join(F.broadcast(evidence), "token")
    else:
        seen = words.groupBy("token").agg(F.count(F.lit(1)).alias("seen"))
        known = join_counted_lookup(words, seen.join(evidence, "token"), "token", "seen", "ingest_id", how="inner")
    sums = known.groupBy("ingest_id").agg(F.sum("log_odds").alias("evidence"))
    logit = F.coalesce("evidence", F.lit(0.0)) + F.lit(model.prior)
    score = F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-logit)), 6)
    return (
        reviews.join(sums, "ingest_id", "left")
        .withColumn("score", score)
        .withColumn("label", sentiment_band(F.col("score")))
        .drop("evidence")
    )


def fit_and_score(reviews: DataFrame, marks: DataFrame) -> DataFrame:
    """Store the cleaned reviews once, then fit on the marked ones and score all of them."""
    kept = stored(reviews.drop("norm"))
    return score_reviews(kept, fit_sentiment(kept, marks))


# --- term weights ------------------------------------------------------------------------------


def spread_texts(reviews: DataFrame, *keys: str, bytes_per_task: int = BYTES_PER_TASK) -> DataFrame:
    """(ingest_id, comment), placed by `keys` over as many tasks as the texts need.

    A task that reads a whole file split has more distinct terms than its memory holds, and sorts them on disk.
    """
    size = reviews.agg(F.coalesce(F.sum(F.octet_length("comment")), F.lit(0)).alias("size")).first()["size"]
    return reviews.select("ingest_id", "comment").repartition(max(1, math.ceil(size / bytes_per_task)), *keys)


def document_frequencies(reviews: DataFrame, min_df: int, wanted: Callable[[Column], Column] | None = None) -> DataFrame:
    """Reviews per term. Terms are made distinct inside the review's row, so counting takes one shuffle.

    With `wanted`, a condition on a term, only the terms it holds for are counted; all of their reviews are.
    """
    spread = spread_texts(reviews, "ingest_id", "comment")
    found = terms(F.col("comment"))
    each = spread.select(F.explode(F.array_distinct(F.filter(found, wanted) if wanted else found)).alias("term"))
    return each.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= min_df)


def _placed_texts(reviews: DataFrame, bytes_per_task: int) -> tuple[DataFrame, int]:
    """(ingest_id, comment, place) and the number of places, which follow from the id. Once rows are dealt by `place`, steps that are
    grouped by `place` and more need no shuffle.

    The numbers of places are chosen so that every task gets one; a task with two would be right as well.
    """
    spark = reviews.sparkSession
    size = reviews.agg(F.coalesce(F.sum(F.octet_length("comment")), F.lit(0)).alias("size")).first()["size"]
    tasks = max(1, math.ceil(size / bytes_per_task))
    numbers = spark.range(32 * tasks).groupBy(F.pmod(F.hash("id"), F.lit(tasks)).alias("task")).agg(F.min("id").alias("place"))
    places = [row["place"] for row in numbers.collect()]  # a row a task
    own = F.get(F.lit(places).cast("array<bigint>"), F.pmod(F.xxhash64("ingest_id"), F.lit(len(places))).cast("int"))
    return reviews.select("ingest_id", "comment", own.alias("place")), tasks


def tfidf_stats(reviews: DataFrame, min_df: int = 2) -> DataFrame:
    """Rows, features, filled cells and sparsity of the term matrix, without building it."""
    frequencies = document_frequencies(reviews, min_df)
    rows = reviews.agg(F.count(F.lit(1))).scalar()
    sizes = frequencies.agg(
        F.count(F.lit(1)).alias("features"), F.coalesce(F.sum("df"), F.lit(0)).alias("filled_cells")
    ).withColumn("rows_cnt", rows)
    cells = F.col("rows_cnt").cast("double") * F.col("features")
    return sizes.withColumn("sparsity", F.round(F.lit(1.0) - F.try_divide(F.col("filled_cells"), cells), 6))


def tfidf_weights(reviews: DataFrame, min_df: int = 2, bytes_per_task: int = BYTES_PER_TASK // 2) -> DataFrame:
    """Weighted terms per review: `weights` is an array of (term, weight) of length 1.

    The weight is count * (ln((n + 1) / (df + 1)) + 1) before scaling. Gathering a review's terms
    is bounded by the review's own text.

    Texts are placed once, and the terms of a review stay where its text is. What moves is a row per place and distinct term: to
    the term, where the reviews of all places are added up, and back with their number. A term has no more such rows than there
    are places, so frequent terms need no care.
    """
    placed, tasks = _placed_texts(reviews, bytes_per_task)
    rows = reviews.agg(F.count(F.lit(1))).scalar()
    found = terms(F.col("comment"))
    each = placed.repartition(tasks, "place").select("place", F.explode(F.array_distinct(found)).alias("term"))
    local = each.groupBy("place", "term").agg(F.count(F.lit(1)).alias("n"))
    known = local.withColumn("df", F.sum("n").over(W.partitionBy("term"))).filter(F.col("df") >= min_df).drop("n")
    # Texts and the numbers for their places go to the places by one shuffle, so that nothing moves to meet there.
    both = placed.unionByName(known, allowMissingColumns=True).repartition(tasks, "place")
    listed = F.explode(F.when(F.col("df").isNull(), found).otherwise(F.array("term"))).alias("term")
    counts = both.select("place", "ingest_id", "df", listed).groupBy("place", "ingest_id", "df", "term").agg(F.count(F.lit(1)).alias("tf"))
    met = counts.withColumn("found", F.max("df").over(W.partitionBy("term", "place"))).filter(F.col("df").isNull() & F.col("found").isNotNull())
    weighted = met.select("place", "ingest_id", "term", (F.col("tf") * (F.ln((rows + 1) / (F.col("found") + 1)) + 1)).alias("weight"))
    gathered = weighted.groupBy("ingest_id", "place").agg(
        F.collect_list(F.struct("term", "weight")).alias("raw"), F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm")
    )
    scaled = F.transform("raw", lambda t: F.struct(t["term"].alias("term"), (t["weight"] / F.col("norm")).alias("weight")))
    return gathered.select("ingest_id", scaled.alias("weights"))
