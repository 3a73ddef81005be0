"""SimHash near-duplicate detection by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 2k bits have a common variant: a bit string at most k flips
away from each. So every distinct fingerprint emits all variants within k flips, variants are grouped,
and fingerprints that meet in a variant are linked after their distance has been checked.

With 64 bits and k = 2 that is 2,081 variants a fingerprint. They are not shuffled one by one. A
variant is its first P bits plus the rest; a row (fingerprint, first P bits of the variant, flips left)
stands for all variants that begin so, and the task that gets the group writes out the rest. P grows
with the number of fingerprints such that a group holds a quarter of `limit` variants on average. Groups
beyond `limit`, because many fingerprints are alike, go on for `STEP` more bits, until every group fits. A
group of full variants holds at most 2,081 fingerprints, so this ends; no group is cut.

All fingerprints that share a variant are linked to the smallest of them: any two are within 2k bits,
so links to one say the same as all pairs. Of an odd radius r = 2k - 1 two may be r + 1 apart, so there the
smallest that is at most k - 1 flips away takes this place: it is within r of all others. A variant without one
says nothing: its members are an even number of bits apart, so those within r meet in a nearer variant too.
Inside a task links are reduced to one star a component.

Defined results: a text without words (NULL, empty) has fingerprint zero and is linked like any other;
a text with fewer words than a shingle is one shingle. Component ids are the smallest id of the
component, NULL only if all its ids are NULL. Repeated rows come out as often as they came in. Very long texts are hashed
whole, with about 20 bytes of memory a word beside the text. An empty table gives an empty result. Extra columns are not
read (`deduplicate` keeps them), whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from shoplayers.functions.skew import join_counted_lookup
from shoplayers.llm.common import row_digest, type_of
from shoplayers.llm.components import connected_components
from shoplayers.session import durable

BITS = 64
SEED = 42
STEP = 8
VARIANTS_PER_GROUP = 1 << 21


# --- fingerprints --------------------------------------------------------------------------------


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of every run of `width` words, joined by single spaces, of the ASCII-lower-cased text."""
    words = text.lower().split()  # on bytes: lowers A-Z, splits at ASCII white space
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)] if words else [], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())), np.uint64, len(starts)
    )


def simhash(hashes: np.ndarray) -> int:
    """Bits that are set in over half the hashes, as a signed 64-bit number; 0 without hashes."""
    ones = np.zeros(BITS, np.int64)
    for begin in range(0, len(hashes), 1 << 16):
        part = hashes[begin : begin + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(id, fingerprint) of every row, from its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [simhash(shingle_hashes(text.as_py() or b"", width)) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], ["id", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {type_of(docs, id_col)}, fingerprint long")


# --- links ---------------------------------------------------------------------------------------


def _masks(bits: int, flips: int) -> list[tuple[int, int]]:
    """(mask, number of flips) of every choice of at most `flips` out of `bits` bits."""
    return [
        (sum(1 << bit for bit in chosen), k) for k in range(min(flips, bits) + 1) for chosen in combinations(range(bits), k)
    ]


def _ball(bits: int, flips: int) -> int:
    return sum(math.comb(bits, k) for k in range(flips + 1))


def _extend(rows: DataFrame, done: int, more: int, flips: int) -> DataFrame:
    """Write `more` further bits of the variants: a row for every choice of flips among them."""
    choices = F.explode(
        F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(k).alias("used")) for m, k in _masks(more, flips)])
    )
    bits = F.shiftrightunsigned("fingerprint", BITS - done - more).bitwiseAND(F.lit((1 << more) - 1).cast("long"))
    written = F.shiftleft("prefix", more).bitwiseOR(bits.bitwiseXOR(F.col("choice.mask")))
    return (
        rows.select("*", choices.alias("choice"))
        .filter("choice.used <= left")
        .select("fingerprint", written.alias("prefix"), (F.col("left") - F.col("choice.used")).alias("left"))
    )


def _links_of(group: pd.DataFrame, rest: int, flips: int, radius: int) -> pd.DataFrame:
    """Links between the fingerprints of one group of variants, as one star a component.

    `rest` bits of the variants are still to be written, in `left` flips at most.
    """
    group = group.sort_values("fingerprint")  # a group has a fingerprint once: places stand for fingerprints
    prints = group["fingerprint"].to_numpy(np.int64).view(np.uint64)
    low = np.uint64((1 << rest) - 1)
    prefix = group["prefix"].to_numpy(np.int64).view(np.uint64)
    base = (prints & low) | (prefix << np.uint64(rest) if rest < BITS else np.uint64(0))
    left = group["left"].to_numpy()
    total = sum(int((left == k).sum()) * _ball(rest, k) for k in range(flips + 1))
    variant, owner, at = np.empty(total, np.uint64), np.empty(total, np.int32), 0
    centre = np.empty(total, bool) if radius % 2 else None  # of an even radius every owner can be one
    for flips_left in range(flips + 1):
        rows = np.flatnonzero(left == flips_left).astype(np.int32)
        masks = np.array([m for m, _ in _masks(rest, flips_left)], np.uint64)
        end = at + len(rows) * len(masks)
        np.bitwise_xor(base[rows][:, None], masks[None, :], out=variant[at:end].reshape(len(rows), len(masks)))
        owner[at:end] = np.repeat(rows, len(masks))
        if centre is not None:
            used = np.array([k for _, k in _masks(rest, flips_left)]) + flips - flips_left
            centre[at:end] = np.tile(used <= radius // 2, len(rows))
        at = end
    order = np.argsort(variant)
    variant, owner = variant[order], owner[order]
    heads = owner if centre is None else np.where(centre[order], owner, np.int32(len(prints)))
    del order
    starts = np.flatnonzero(np.r_[True, variant[1:] != variant[:-1]]) if len(variant) else np.empty(0, int)
    sizes = np.diff(np.r_[starts, len(variant)])
    shared = np.repeat(sizes > 1, sizes)
    if not shared.any():
        return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
    heads, owner, sizes = heads[shared], owner[shared], sizes[sizes > 1]
    del variant, shared
    first = np.repeat(np.minimum.reduceat(heads, np.r_[0, np.cumsum(sizes)[:-1]]), sizes)
    first, owner = first[first < len(prints)], owner[first < len(prints)]
    pairs = np.unique((first.astype(np.int64) << 32) | owner)
    ends = np.stack([pairs >> 32, pairs & 0xFFFFFFFF], axis=1)
    near = (ends[:, 0] != ends[:, 1]) & (np.bitwise_count(prints[ends[:, 0]] ^ prints[ends[:, 1]]) <= radius)
    ends = ends[near]
    root = np.arange(len(prints))
    while True:  # smallest label over links, then pointer jumping
        best = np.minimum(root[ends[:, 0]], root[ends[:, 1]])
        after = root.copy()
        np.minimum.at(after, root[ends[:, 0]], best)
        np.minimum.at(after, root[ends[:, 1]], best)
        after = after[after]
        if (after == root).all():
            break
        root = after
    loose = root != np.arange(len(prints))
    return pd.DataFrame({"a": prints[root[loose]].view(np.int64), "b": prints[loose].view(np.int64)})


def _linker(rest: int, flips: int, radius: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda group: _links_of(group, rest, flips, radius)


def near_links(prints: DataFrame, radius: int = 4, limit: int = VARIANTS_PER_GROUP) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints at most `radius` bits apart.

    `prints` has one row per distinct fingerprint. `limit` bounds the variants a task holds at a time
    and with it memory, not the result.
    """
    flips = (radius + 1) // 2
    count = prints.count()
    done = max(1, math.ceil(math.log2(max(2, 4 * count * _ball(BITS, flips) / limit))))
    done = min(done, 24)
    start = prints.select("fingerprint", F.lit(0).cast("long").alias("prefix"), F.lit(flips).alias("left"))
    rows = _extend(start, 0, done, flips)
    links = None
    while True:
        rest = BITS - done
        weight = F.lit(0)
        for flips_left in range(flips + 1):
            weight = F.when(F.col("left") == flips_left, F.lit(_ball(rest, flips_left))).otherwise(weight)
        sizes = rows.groupBy("prefix").agg(F.sum(weight).alias("variants"))
        large = durable(sizes.filter(F.col("variants") > limit).select("prefix")) if rest else None
        done_here = large is None or large.isEmpty()
        small = rows if done_here else rows.join(large, "prefix", "left_anti")

        found = small.groupBy("prefix").applyInPandas(_linker(rest, flips, radius), "a long, b long")
        links = found if links is None else links.unionByName(found)
        if done_here:
            return links
        more = min(STEP, rest)
        rows = durable(_extend(rows.join(large, "prefix", "left_semi"), done, more, flips))
        done += more


# --- components ----------------------------------------------------------------------------------


def near_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4
) -> DataFrame:
    """One row per input row: id, fingerprint (signed) and component_id."""
    prints = durable(fingerprints(docs, id_col, text_col, width))
    distinct = durable(
        prints.groupBy("fingerprint").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("rows"))
    )
    links = durable(near_links(distinct.select("fingerprint"), radius).distinct())
    roots = connected_components(links, "a", "b").withColumnRenamed("node", "fingerprint")
    rooted = durable(
        distinct.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    )
    members = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("prints"))
    named = join_counted_lookup(rooted, members, "root", "prints", "fingerprint", how="inner")
    lookup = named.select("fingerprint", "component_id", "rows")
    joined = join_counted_lookup(prints, lookup, "fingerprint", "rows", "id", how="inner")
    return joined.select(F.col("id").alias(id_col), "fingerprint", "component_id")


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4
) -> DataFrame:
    """The rows that stay, with all their columns: of every component the row with the smallest id, once.

    Rows may share an id: a row is known by a digest of all its columns, so each component keeps a row of its own, the
    one with the smallest digest among those of its smallest id. Rows without id come after all others. Digests,
    ids and fingerprints decide; then each text is moved once, to the digests that stay.
    """
    marked = docs.withColumn("_digest", row_digest(docs))
    rows = marked.select(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), "_digest").alias("own"), text_col)
    prints = durable(fingerprints(rows, "own", text_col, width))
    distinct = durable(prints.groupBy("fingerprint").agg(F.min("id").alias("first")))
    links = durable(near_links(distinct.select("fingerprint"), radius).distinct())
    roots = connected_components(links, "a", "b").withColumnRenamed("node", "fingerprint")
    rooted = distinct.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    keepers = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first._digest").alias("_digest"))
    # Equal rows are merged where they are read before any is moved.
    return marked.dropDuplicates(["_digest"]).join(keepers, "_digest", "left_semi").select(*docs.columns)
