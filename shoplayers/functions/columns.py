"""Cleaning and feature expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, functions as F

from shoplayers import constants as K

# --- Fixed values: Unicode white space; Spark's plain trim() removes ASCII spaces only -----------
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_SPACE = f"[{WHITE_SPACE}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def clean_label(label: Column) -> Column:
    """Strip a label and write its slash separators without spaces; NULL stays NULL."""
    return F.regexp_replace(strip(label), f"{_SPACE}*/{_SPACE}*", "/")


def without_spaces(label: Column) -> Column:
    """Remove every ASCII space inside a label."""
    return F.trim(F.replace(label, F.lit(" "), F.lit("")))


def word_characters(text: Column) -> Column:
    """Keep letters, digits and underscores: texts with equal results say the same thing."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}_]+", "")


def is_digits(text: Column) -> Column:
    """True for a non-empty run of ASCII digits, false for anything else and for NULL."""
    return F.coalesce(text.rlike(r"^[0-9]+\z"), F.lit(False))


def epoch_seconds(text: Column) -> Column:
    """Whole epoch seconds, NULL unless the text is digits within the convertible range."""
    seconds = text.try_cast("bigint")
    return F.when(is_digits(text) & seconds.between(0, K.MAX_EPOCH_SECOND), seconds)


def epoch_to_timestamp(quantity: Column, unit: str = "SECOND", zone: str = "UTC") -> Column:
    """Whole epoch seconds (or another unit) to a wall-clock timestamp in `zone`.

    The arithmetic is zone-free, so the session zone cannot change a date or an hour.
    """
    utc = F.timestamp_add(unit, quantity, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def tolerant_seconds(text: Column) -> Column:
    """Epoch seconds from anything numeric, e.g. `12.5`, `-60` or `1e9`; NULL for text, NaN and what
    lies outside the years 1 to 3001 and has no timestamp."""
    number = text.try_cast("double")
    return F.when(number.between(K.MIN_EPOCH_SECOND, K.MAX_EPOCH_SECOND) & ~F.isnan(number), number)


def clamp(value: Column, low: float | int, high: float | int) -> Column:
    """Limit to [low, high]; NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(value, F.lit(high))))


def flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def member_flag(value: Column, members: Sequence) -> Column:
    return flag(value.isin(*members))


def weekend_flag(date: Column) -> Column:
    """1 on Saturday and Sunday; Monday counts as day 0."""
    return flag(F.weekday(date) >= 5)


def mapped(value: Column, mapping: Mapping[str, str]) -> Column:
    """Value through a whitelist; anything else becomes NULL."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(table, value)


def sentiment_band(score: Column) -> Column:
    """Band of a score: up to 0.2 negative, up to 0.8 neutral, above positive."""
    low, high = K.SCORE_RANGE
    return (
        F.when((score <= low) | (score > high) | F.isnan(score), F.lit(None).cast("string"))
        .when(score <= K.NEGATIVE_MAX, F.lit(K.NEGATIVE))
        .when(score <= K.NEUTRAL_MAX, F.lit(K.NEUTRAL))
        .when(score.isNotNull(), F.lit(K.POSITIVE))
    )


def segment_label(r_score: Column, f_score: Column, m_score: Column) -> Column:
    """Segment name from the three tile scores, by the rule table."""
    result = F.lit(None).cast("string")
    for highs, label in K.SEGMENTS.items():
        condition = F.lit(True)
        for score, high in zip((r_score, f_score, m_score), highs):
            condition = condition & ((score >= K.HIGH_SCORE) if high else (score < K.HIGH_SCORE))
        result = F.when(condition, F.lit(label)).otherwise(result)
    return result


def order_rank(value: Column, order: Sequence[str]) -> Column:
    """Place of a value in a business order, 0 when absent."""
    return F.array_position(F.array(*[F.lit(x) for x in order]), value).cast("int")


def shuffle_key(seed: int, *columns: str) -> Column:
    """Repeatable random-looking number: the first 60 bits of SHA-256 over the seed and the row's key.

    A number sorts and shuffles far cheaper than the 64-character digest.
    """
    digest = F.sha2(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
