"""Quality rules: counts with fixed limits, and a log-likelihood ratio against the raw corpus.

Every count of a document comes from its own row, by array functions; no text is shuffled for them. Runs
of eight words that occur twice are first looked for by 64-bit hashes, of four words and then of eight; where
two hashes agree the words themselves are compared, so hashing costs no exactness.

The ratio follows importance resampling with hashed n-grams (Xie et al., "Data Selection for Language Models
via Importance Resampling", 2023): a document's words and its pairs of neighbouring words are hashed into 2^BUCKET_BITS
buckets, whatever the size of the table; one multinomial is counted over all documents, one over the trusted ones.
The trusted one is smoothed towards the raw one by SMOOTHING n-grams,

    P(bucket | trusted) = (trusted count + SMOOTHING * P(bucket | raw)) / (trusted n-grams + SMOOTHING)

so that few trusted documents say little. A document's score is the mean over its n-grams of

    ln P(bucket | trusted) - ln P(bucket | raw)

and the document is kept if the score reaches `MIN_SCORE`. (The paper draws documents by chance; here every
document gets the same verdict every time.) Ratios are rounded to multiples of 2^-20 and summed as whole
numbers, so no order of summing can change a verdict. The table of ratios has 2^BUCKET_BITS numbers (8 MB),
whatever the corpus; it is all that is sent to every task, beside a bitmap of the trusted ids (1 MB).

Texts are counted where they are read. Only those whose id may be a trusted one, by the bitmap, are moved to find out;
an id that many of them share is cut into pieces.

Texts beyond `LONG_TEXT` bytes would need arrays of millions of words in one row. They are cut into pieces between
words, the words become rows, and the same numbers come from aggregates and windows over rows, which spill. The rows of
one text are sorted in one task; there a run of eight words is known by two 64-bit hashes together.

Defined results: a NULL text has no words, fails the base rules and has no score (0). Repeated rows get the same
verdict; ties do not occur. Very long texts give the same results as others. Without trusted documents the ratio says
nothing and every document passes it. An empty table gives an empty result. Extra columns are not read, whatever their
names.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shoplayers.functions.columns import let as _let
from shoplayers.functions.membership import bitmap_of, may_be_member
from shoplayers.functions.skew import join_counted_lookup
from shoplayers.llm.common import WORD
from shoplayers.session import durable, stored

# --- Fixed values: the base rules -------------------------------------------------------------------
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

BUCKET_BITS = 20
LANE_BITS = 4
PLACE_BITS = 24
SMOOTHING = 16384.0
MIN_SCORE = -0.5
UNIT = 1 << 20
LONG_TEXT = 1 << 21
PIECE_CHARS = 1 << 16


def _after(values: Column, places: int) -> Column:
    """The array without its first `places` elements."""
    return F.slice(values, places + 1, F.greatest(F.size(values), F.lit(1)))


def _shifted(values: Column, first: Column) -> Column:
    """The array moved on by one place, with `first` in front."""
    return F.slice(F.concat(F.array(first), values), 1, F.size(values))


def _covered(ordered: Column, as_next: Column) -> Column:
    """Words covered by the runs that equal a neighbour. `ordered` holds their places, equal runs side by side, and
    `as_next` whether a run is equal to the next."""

    def covered(places: Column) -> Column:
        lengths = F.zip_with(
            places, _after(places, 1), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))
        )
        return F.aggregate(lengths, F.lit(0), lambda total, n: total + n)

    twice = F.zip_with(as_next, _shifted(as_next, F.lit(False)), lambda a, b: a | b)
    places = F.zip_with(ordered, twice, lambda place, two: F.when(two, place))
    return _let(F.sort_array(F.filter(places, lambda place: place.isNotNull())), covered)


def _repeated_words(words: Column) -> Column:
    """Words in runs of eight that occur twice or more: sort (run, place), mark runs equal to a
    neighbour, unite the places they cover."""

    def compared(ordered: Column) -> Column:
        equal = F.zip_with(ordered, _after(ordered, 1), lambda a, b: F.coalesce(a["run"] == b["run"], F.lit(False)))
        return _let(equal, lambda as_next: _covered(ordered["place"], as_next))

    def placed(runs: Column) -> Column:
        return F.sort_array(F.transform(runs, lambda run, i: F.struct(run.alias("run"), i.alias("place"))))

    def doubled(runs: Column, places: int) -> Column:
        """Runs of eight words, by doubling into pairs, fours and eights."""
        if places == WINDOW:
            return _let(placed(F.slice(runs, 1, F.greatest(F.size(runs) - (WINDOW - 1), F.lit(0)))), compared)
        longer = F.zip_with(runs, _after(runs, places), lambda a, b: F.concat(a, F.lit(" "), b))
        return _let(longer, lambda joined: doubled(joined, 2 * places))

    return _let(words, lambda single: doubled(single, 1))


def _four_hashes(hashes: Column) -> Column:
    """Hashes of all runs of four words, from the hashes of the words."""

    def fours(pairs: Column) -> Column:
        runs = F.zip_with(pairs, _after(pairs, 2), lambda a, b: F.xxhash64(a, b))
        return F.slice(runs, 1, F.greatest(F.size(pairs) - 3, F.lit(0)))

    return _let(F.zip_with(hashes, _after(hashes, 1), lambda a, b: F.xxhash64(a, b)), fours)


def _repeated_by_hash(words: Column, fours: Column) -> Column:
    """What `_repeated_words` says, by the hashes of runs: a hash and its place share a number, as numbers sort far faster
    than structs or words. Neighbours with one hash compare their words. NULL if those differ, or places have no room."""
    places = F.lit((1 << PLACE_BITS) - 1).cast("long")
    hashes = F.lit(-(1 << PLACE_BITS)).cast("long")

    def equal(a: Column, b: Column) -> Column:
        first, second = a.bitwiseAND(places).cast("int"), b.bitwiseAND(places).cast("int")
        pairs = [F.get(words, first + i) == F.get(words, second + i) for i in range(WINDOW)]
        return F.when(a.bitwiseAND(hashes) == b.bitwiseAND(hashes), reduce(and_, pairs))

    def compared(ordered: Column) -> Column:
        return _let(F.zip_with(ordered, _after(ordered, 1), equal), lambda known: checked(ordered, known))

    def checked(ordered: Column, same: Column) -> Column:
        as_next = F.transform(same, lambda known: known.isNotNull())
        proven = F.forall(same, lambda known: F.coalesce(known, F.lit(True)))
        at = F.transform(ordered, lambda number: number.bitwiseAND(places).cast("int"))
        return F.when(proven, _let(as_next, lambda marks: _covered(at, marks)))

    eights = F.zip_with(fours, _after(fours, 4), lambda a, b: F.xxhash64(a, b))
    eights = F.slice(eights, 1, F.greatest(F.size(fours) - 4, F.lit(0)))
    numbers = F.transform(eights, lambda run, i: run.bitwiseAND(hashes).bitwiseOR(i.cast("long")))
    return F.when(F.size(fours) <= 1 << PLACE_BITS, _let(F.sort_array(numbers), compared))


def _repeats(words: Column, fours: Column) -> Column:
    """Words in runs of eight that occur twice or more. A run that occurred before brings five fours that did, so texts
    with fewer have none."""
    some = F.size(fours) - F.size(F.array_distinct(fours)) >= WINDOW - 3
    return F.when(some, F.coalesce(_repeated_by_hash(words, fours), _repeated_words(words))).otherwise(F.lit(0))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _gram_numbers(hashes: Column) -> Column:
    """0 to 2 * words - 2: even ones stand for words, odd ones for pairs. NULL without words."""
    return F.when(F.size(hashes) > 0, F.sequence(F.lit(0), 2 * F.size(hashes) - 2))


def _gram(hashes: Column, number: Column) -> Column:
    """The hash of a word, or of a word and the next, by `_gram_numbers`."""
    here = F.get(hashes, F.shiftright(number, 1))
    return F.when(number.bitwiseAND(1) == 0, here).otherwise(F.xxhash64(here, F.get(hashes, F.shiftright(number, 1) + 1)))


def _line_and_sign_counts(content: Column) -> list[Column]:
    lines = F.filter(F.split(content, "\n", -1), lambda line: line.rlike(WORD))
    return [
        F.regexp_count(content, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        _let(lines, lambda all_: (F.size(all_) - F.size(F.array_distinct(all_))).cast("long")).alias("n_dup_lines"),
    ]


def _measures(short: DataFrame, table: Column, bits: int) -> DataFrame:
    """The base counts, n_grams and ratio_sum of every row. `table` holds the ratios by bucket.

    Arrays are columns of their own before anything reads them twice, so each is evaluated once. The words of a row
    become rows next to each other, whose ratios are summed where they are; only counts and sums are shuffled.
    """
    words = short.select("id", F.coalesce("text", F.lit("")).alias("text"), _words(F.col("text")).alias("words"))
    hashed = words.select("id", "text", "words", _word_hashes(F.col("words")).alias("hashes"))
    runs = hashed.select("id", "text", "words", "hashes", _four_hashes(F.col("hashes")).alias("fours"))
    counted = runs.select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        "hashes",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        *_line_and_sign_counts(F.col("text")),
        _repeats(F.col("words"), F.col("fours")).cast("long").alias("n_repeat_words"),
    )
    base = [name for name in MEASURES if name not in ("n_grams", "ratio_sum")]
    number = F.when(F.size("hashes") > 0, F.sequence(F.lit(0), F.size("hashes") - 1))
    places = counted.select("row", "id", *base, "hashes", F.explode_outer(number).alias("place"))

    def ratio(at: Column) -> Column:
        return F.coalesce(F.get(table, _bucket(at, bits)), F.lit(0).cast("long"))

    here, following = F.get("hashes", F.col("place")), F.get("hashes", F.col("place") + 1)
    both = ratio(here) + F.when(following.isNotNull(), ratio(F.xxhash64(here, following))).otherwise(F.lit(0).cast("long"))
    ratios = places.select("row", "id", *base, F.when(F.col("place").isNotNull(), both).alias("ratio"))
    sums = ratios.groupBy("row", "id").agg(F.sum("ratio").alias("ratio_sum"), *[F.max(name).alias(name) for name in base])
    return sums.withColumn("n_grams", F.greatest(2 * F.col("n_words") - 1, F.lit(0).cast("long"))).select(
        "id", *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in MEASURES]
    )


# --- long texts ------------------------------------------------------------------------------------


def _is_long(text: Column, long_text: int) -> Column:
    return F.coalesce(F.octet_length(text) > long_text, F.lit(False))


def _word_rows(long: DataFrame) -> DataFrame:
    """(key, place, single, pair, run_a, run_b) per word: its place in the text, the hashes of the word, of it with
    the next one (NULL for the last word), and two hashes of the eight words from here (NULL where fewer follow)."""
    pattern = F.lit(rf"(?s).{{1,{PIECE_CHARS}}}[^\x20\x09-\x0D]*")  # a piece ends where a word does
    pieces = long.select("key", F.posexplode(F.regexp_extract_all("text", pattern, F.lit(0))).alias("piece", "part"))
    words = pieces.select("key", "piece", F.posexplode(F.regexp_extract_all("part", F.lit(WORD), F.lit(0))).alias("at", "word"))
    hashed = words.select("key", "piece", "at", F.xxhash64("word").alias("single"), F.xxhash64(F.reverse("word")).alias("other"))
    order = W.partitionBy("key").orderBy("piece", "at")
    following = [F.lead("single", i).over(order) for i in range(1, WINDOW)]
    others = [F.lead("other", i).over(order) for i in range(1, WINDOW)]
    complete = following[-1].isNotNull()
    return hashed.select(
        "key",
        F.row_number().over(order).alias("place"),
        "single",
        F.when(following[0].isNotNull(), F.xxhash64("single", following[0])).alias("pair"),
        F.when(complete, F.xxhash64("single", *following)).alias("run_a"),
        F.when(complete, F.xxhash64("other", *others)).alias("run_b"),
    )


def _long_measures(long: DataFrame, words: DataFrame, ratios: DataFrame, bits: int) -> DataFrame:
    """What `_measures` says of short texts, one row per key."""
    grams = _gram_rows(words).select("key", _bucket(F.col("hash"), bits).alias("bucket"))
    sums = grams.groupBy("key", "bucket").agg(F.count(F.lit(1)).alias("n")).join(ratios, "bucket")
    sums = sums.groupBy("key").agg(F.sum("n").alias("n_grams"), F.sum(F.col("n") * F.col("ratio")).alias("ratio_sum"))
    runs = words.filter("run_a IS NOT NULL").select("key", "place", "run_a", "run_b")
    twice = runs.groupBy("key", "run_a", "run_b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    places = runs.join(twice, ["key", "run_a", "run_b"], "left_semi")
    gap = F.lead("place").over(W.partitionBy("key").orderBy("place")) - F.col("place")
    covered = places.select("key", F.least(F.lit(WINDOW), F.coalesce(gap, F.lit(WINDOW))).alias("n"))
    covered = covered.groupBy("key").agg(F.sum("n").alias("n_repeat_words"))
    counts = words.groupBy("key").agg(F.count(F.lit(1)).alias("n_words"))
    lines = long.select("key", F.explode(F.split("text", "\n", -1)).alias("line")).filter(F.col("line").rlike(WORD))
    lines = lines.groupBy("key", F.sha2("line", 256).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    lines = lines.groupBy("key").agg(F.sum(F.col("n") - 1).alias("n_dup_lines"))
    of_text = long.select(
        "key",
        "id",
        F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    for part in (counts, lines, covered, sums):
        of_text = of_text.join(part, "key", "left")
    return of_text.na.fill(0, [name for name in MEASURES if name != "word_chars"]).select("id", *MEASURES)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_grams", "ratio_sum")


# --- the ratio -------------------------------------------------------------------------------------


def _bucket(hash_: Column, bits: int) -> Column:
    return hash_.bitwiseAND(F.lit((1 << bits) - 1).cast("long")).cast("int")


def _gram_rows(words: DataFrame) -> DataFrame:
    """A row per n-gram of word rows: the words and the pairs that exist."""
    kept = [c for c in words.columns if c in ("key", "marked")]
    return words.select(*kept, F.explode(F.array("single", "pair")).alias("hash")).filter("hash IS NOT NULL")


def _marked(rows: DataFrame, trusted: DataFrame) -> DataFrame:
    """Add `marked`, 1 where the id is a trusted one, to rows with an id. Rows that cannot be trusted stay in place."""
    bitmap = bitmap_of(trusted, F.xxhash64("id"))
    known = F.col("id").isNotNull() & may_be_member(bitmap, F.xxhash64("id"))
    no = F.lit(None).cast("int")
    counts = rows.filter(known).groupBy("id").agg(F.count(F.lit(1)).alias("rows"))
    marks = counts.join(trusted, "id").withColumn("marked", F.lit(1))
    moved = join_counted_lookup(rows.filter(known).withColumn("spread", F.xxhash64("text")), marks, "id", "rows", "spread")
    return rows.filter(~known).select("id", "text", no.alias("marked")).unionByName(moved.select("id", "text", "marked"))


def gram_counts(
    docs: DataFrame, trusted: DataFrame, long: DataFrame | None, bits: int = BUCKET_BITS, long_text: int = LONG_TEXT
) -> DataFrame:
    """(bucket, raw, trusted) of the buckets that occur. `docs` has id and text, `trusted` ids, and `long` the word
    rows of the texts beyond `long_text` with their mark."""
    marked = _marked(docs.filter(~_is_long(F.col("text"), long_text)), trusted)
    hashed = marked.select("marked", _word_hashes(_words(F.col("text"))).alias("hashes"))
    numbered = hashed.select("marked", "hashes", F.explode(_gram_numbers(F.col("hashes"))).alias("number"))
    grams = numbered.select("marked", _gram(F.col("hashes"), F.col("number")).alias("hash"))
    if long is not None:
        grams = grams.unionByName(_gram_rows(long).select("marked", "hash"))
    return _bucket_counts(grams.select(F.coalesce("marked", F.lit(0)).alias("marked"), _bucket(F.col("hash"), bits).alias("bucket")))


def _bucket_counts(buckets: DataFrame) -> DataFrame:
    """(bucket, raw, trusted) of rows with `bucket` and `marked`, 1 or 0.

    A row counts 2^LANE_BITS neighbouring buckets, a column each: a task then holds 2^16 rows, which stay in Spark's fast
    hash map, instead of 2^20.
    """
    lanes = range(1 << LANE_BITS)
    lane = F.col("bucket").bitwiseAND(F.lit(len(lanes) - 1))
    spread = buckets.select("marked", F.shiftright("bucket", LANE_BITS).alias("stretch"), lane.alias("lane"))
    counts = spread.groupBy("marked", "stretch").agg(*[F.count(F.when(F.col("lane") == i, 1)).alias(f"lane{i}") for i in lanes])

    def both(i: int) -> list[Column]:
        trusted = F.sum(F.when(F.col("marked") == 1, F.col(f"lane{i}")).otherwise(F.lit(0).cast("long")))
        return [F.sum(f"lane{i}").alias(f"raw{i}"), trusted.alias(f"trusted{i}")]

    whole = counts.groupBy("stretch").agg(*[column for i in lanes for column in both(i)])
    first = F.shiftleft("stretch", LANE_BITS)
    cells = [
        F.struct((first + i).alias("bucket"), F.col(f"raw{i}").alias("raw"), F.col(f"trusted{i}").alias("trusted")) for i in lanes
    ]
    return whole.select(F.inline(F.array(*cells))).filter("raw > 0")


def likelihood_ratios(counts: DataFrame) -> DataFrame:
    """(bucket, ratio) of the buckets that occur; `ratio` counts units of 2^-20."""
    total = counts.agg(F.struct(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))).scalar()
    share = F.col("raw") / F.col("total.raw")
    ratio = F.ln((F.col("trusted") + SMOOTHING * share) / (F.col("total.trusted") + F.lit(SMOOTHING))) - F.ln(share)
    ratio = F.round(ratio * UNIT).cast("long")
    ratio = F.when(F.col("total.trusted") > 0, ratio).otherwise(F.lit(0).cast("long"))
    return counts.withColumn("total", total).select("bucket", ratio.alias("ratio"))


def _ratio_table(ratios: DataFrame, bits: int) -> Column:
    """The 2^bits ratios in order of bucket, 0 where none occurs: one array, as a scalar subquery.

    Stretches of 2^(bits / 2) buckets are put together first, so the last task gets few rows.
    """
    every = ratios.sparkSession.range(1 << bits).select(F.col("id").cast("int").alias("bucket"))
    every = every.join(ratios, "bucket", "left").na.fill(0, ["ratio"])
    pairs = F.sort_array(F.collect_list(F.struct("bucket", "ratio")))
    stretches = every.groupBy(F.shiftright("bucket", bits // 2).alias("stretch")).agg(pairs.alias("pairs"))
    numbered = F.struct("stretch", F.transform("pairs", lambda pair: pair["ratio"]).alias("ratios"))
    whole = stretches.agg(F.sort_array(F.collect_list(numbered)).alias("all"))
    return whole.select(F.flatten(F.transform("all", lambda stretch: stretch["ratios"]))).scalar()


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_score: float = MIN_SCORE,
    bits: int = BUCKET_BITS,
    long_text: int = LONG_TEXT,
) -> DataFrame:
    """One row per input row: id, the counts, base_failed, kept, n_grams and score. `trusted` holds ids.

    `long_text` decides which way a text is measured, not what comes out.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    trusted = durable(trusted.select(F.col(id_col).alias("id")).filter("id IS NOT NULL").distinct())
    long = stored(rows.filter(_is_long(F.col("text"), long_text)).withColumn("key", F.monotonically_increasing_id()))
    words = None
    if not long.isEmpty():
        marks = long.select("key", "id").join(trusted.withColumn("marked", F.lit(1)), "id", "left").select("key", "marked")
        words = durable(_word_rows(long).join(marks, "key"))
    ratios = durable(likelihood_ratios(durable(gram_counts(rows, trusted, words, bits, long_text))))
    measured = _measures(rows.filter(~_is_long(F.col("text"), long_text)), _ratio_table(ratios, bits), bits)
    if words is not None:
        measured = measured.unionByName(_long_measures(long, words, ratios, bits))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    reaches = F.col("ratio_sum") >= F.col("n_grams") * F.lit(round(min_score * UNIT))
    return measured.select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & reaches).alias("kept"),
        "n_grams",
        (F.col("ratio_sum") / F.greatest(F.col("n_grams"), F.lit(1)) / UNIT).alias("score"),
    )
