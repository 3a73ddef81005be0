"""Which rows can have a partner: a bitmap of key hashes, small and of fixed size whatever the tables.

A bit per hash value says that some key has it. A row whose bit is not set has no partner for certain, so it need not
be moved to a join that finds out; the others are candidates. The bitmap is one array of 2^BITS bits that a scalar
subquery brings to every task: a fixed size, not one that grows with the keys. Many keys fill it up and make more rows
candidates, which costs moving them but changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shoplayers.functions.columns import let

BITS = 23  # a megabyte
_WORD_BITS = 6


def _place(key_hash: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key_hash, 64 - bits)


def bitmap_of(keys: DataFrame, key_hash: Column, bits: int = BITS) -> Column:
    """The bitmap of 64-bit hashes: an array of 2^bits / 64 longs, as a scalar subquery.

    Bits are united per word before anything is shuffled, words in stretches before the last task puts
    together what is at most 2^bits bits.
    """
    words = 1 << (bits - _WORD_BITS)
    place = _place(key_hash, bits)
    bit = F.expr("shiftleft(1L, cast(_place & 63 as int))")
    united = keys.filter(key_hash.isNotNull()).select(place.alias("_place")).select(
        F.shiftright("_place", _WORD_BITS).alias("word"), bit.alias("bit")
    )
    united = united.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    half = (bits - _WORD_BITS) // 2
    stretch = F.sort_array(F.collect_list(F.struct("word", "bits")))
    stretches = united.groupBy(F.shiftright("word", half).alias("stretch")).agg(stretch.alias("held"))
    # Words that no key has are 0; a stretch becomes an array of all its words.
    number = F.sequence(F.lit(0), F.lit((1 << half) - 1))
    zero = F.lit(0).cast("long")

    def all_words(known: Column) -> Column:
        return F.transform(number, lambda i: F.coalesce(F.try_element_at(known, F.shiftleft(F.col("stretch"), half) + i), zero))

    filled = stretches.select("stretch", let(F.map_from_entries("held"), all_words).alias("bits"))
    every = keys.sparkSession.range(words >> half).select(F.col("id").alias("stretch"))
    empty = F.array_repeat(zero, 1 << half)
    whole = every.join(filled, "stretch", "left").select("stretch", F.coalesce("bits", empty).alias("bits"))
    ordered = whole.agg(F.sort_array(F.collect_list(F.struct("stretch", "bits"))).alias("all"))
    return ordered.select(F.flatten(F.transform("all", lambda s: s["bits"]))).scalar()


def may_be_member(bitmap: Column, key_hash: Column, bits: int = BITS) -> Column:
    """False for a hash that no key has, and for NULL; true for every key's hash and, rarely, for another."""
    place = _place(key_hash, bits)
    word = F.get(bitmap, F.shiftright(place, _WORD_BITS).cast("int"))
    low = place.bitwiseAND(F.lit((1 << _WORD_BITS) - 1).cast("long"))
    # The wanted bit becomes the lowest one; a shift by a column needs SQL.
    return F.coalesce(F.call_function("shiftright", word, low.cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1, F.lit(False))
