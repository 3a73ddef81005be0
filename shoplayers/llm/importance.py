"""Target-distribution importance resampling over an Aho-Corasick dictionary.

Features are all runs of 1 to 3 consecutive words, hashed into `BUCKETS` buckets by CRC-32. A bucket's gain is
the log ratio of its shares in the target and in the corpus; a document's weight is the sum of its features'
gains, its score adds seeded Gumbel noise, and the highest scores are drawn: sampling without replacement in
proportion to exp(weight / 1000).

Texts are read in groups of about `GROUP_BYTES`. The distinct words of a group, each between two delimiters,
are the patterns of an automaton; a word's payload is its CRC and its length. One scan over the group emits a
payload a word, in order. CRCs of longer runs are never computed from text: CRC-32 is linear over bits, so

    crc(a + " " + b) = advance(crc(a + " "), length of b) ^ crc(b)

where `advance`, the effect of so many zero bytes, is read from a table by length; adjacent payloads are
composed so for a whole group at a time. A dictionary never outgrows its group (one text at least), so nothing
that grows with the corpus's vocabulary is sent anywhere. Words of more than `LONG_WORD` bytes take part under
a short stand-in with their own payload, so no pattern is long.

Every text is scanned once: its buckets are stored (two bytes a feature), counted from there and scored
from there. The table of gains has `BUCKETS` numbers and is all that is broadcast. What is drawn is
cut off at the score of the last place, found by counting, and only rows from there on are sorted.

Defined results: a NULL or empty text, or one without words, has no features, weight 0 and a score of noise
alone. Very long texts are groups of their own; a text is held whole, with about 60 bytes of memory a word. Rows
that share an id share their noise; equal rows are drawn one by one. A NULL id has the noise of an empty id and
comes first among ties. An empty target leaves every t at 0. An empty table gives an empty result. Extra columns
are not read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shoplayers.functions.ordered import order_statistics, with_stratum_position
from shoplayers.llm.common import type_of
from shoplayers.session import durable, stored

BUCKETS = 10_000
LONGEST_RUN = 3
MIN_WORDS = 20
DRAW_PERCENT = 5
SEED = 42
GROUP_BYTES = 1 << 20
LONG_WORD = 255
# --- Fixed values: words are runs of ASCII letters and digits and of anything beyond ASCII --------
_NORMAL = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
_POLYNOMIAL = 0xEDB88320


# --- CRC arithmetic --------------------------------------------------------------------------------


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_BYTE = _byte_table()


def _apply(operator: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear operator, given as its values for every byte at every place, on many CRCs at once."""
    return (
        operator[..., 0, :][crc & 255] ^ operator[..., 1, :][crc >> 8 & 255] ^ operator[..., 2, :][crc >> 16 & 255] ^ operator[..., 3, :][crc >> 24]
    )


def _operators() -> tuple[np.ndarray, np.ndarray]:
    """The operators of 0 to 255 zero bytes, and of 2^8, 2^9 ... 2^31 zero bytes."""
    places = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    short = np.empty((256, 4, 256), np.uint32)
    short[0] = places
    for n in range(1, 256):
        short[n] = _BYTE[short[n - 1] & 255] ^ short[n - 1] >> 8
    power, large = _BYTE[short[255] & 255] ^ short[255] >> 8, []
    for _ in range(24):
        large.append(power)
        power = _apply(power, power)
    return short, np.stack(large)


_SHORT, _LARGE = _operators()
_SHORT_FLAT = _SHORT.reshape(-1)


def advance(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRCs after `length` zero bytes each."""
    at = (length & 255).astype(np.int64) << 10
    moved = (
        _SHORT_FLAT[at + (crc & 255)]
        ^ _SHORT_FLAT[at + (256 + (crc >> 8 & 255))]
        ^ _SHORT_FLAT[at + (512 + (crc >> 16 & 255))]
        ^ _SHORT_FLAT[at + (768 + (crc >> 24))]
    )
    for bit in range(int(length.max(initial=0)).bit_length() - 8):
        moved = np.where(length >> (8 + bit) & 1, _apply(_LARGE[bit], moved), moved)
    return moved


def compose(first: np.ndarray, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs of `first`, a space and another run, from the CRCs of both and the length of the other."""
    spaced = ~(_BYTE[(~first ^ np.uint32(32)) & 255] ^ ~first >> 8)
    return advance(spaced, length) ^ crc


# --- scanning --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Payloads:
    """Words of a group of texts in order, as CRCs and lengths, and the number of words of every text."""

    crc: np.ndarray
    length: np.ndarray
    words: np.ndarray


def scan(texts: Sequence[bytes]) -> Payloads:
    """One dictionary, one automaton and one scan for all `texts`."""
    normal = [text.translate(_NORMAL) for text in texts]
    split = [text.split() for text in normal]
    words = np.fromiter(map(len, split), np.int64, len(split))
    distinct = set().union(*split)
    del split
    payloads = {word: len(word) << 32 | zlib.crc32(word) for word in distinct}
    long = sorted(word for word in distinct if len(word) > LONG_WORD)
    whole = b" ".join(normal)
    if long:
        # No text holds the byte 1 any more; it marks a stand-in.
        names = {word: b"\x01%d" % place for place, word in enumerate(long)}
        payloads = {names.get(word, word): payload for word, payload in payloads.items()}
        whole = re.sub(rb"[^ ]{%d,}" % (LONG_WORD + 1), lambda found: names[found[0]], whole)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
    for word in sorted(payloads):  # in order, so that neighbours in the trie are neighbours in memory
        automaton.add_word(f" {word.decode('latin-1')} ", payloads[word])
    total = int(words.sum())
    if not total:
        return Payloads(np.empty(0, np.uint32), np.empty(0, np.int64), words)
    automaton.make_automaton()
    emitted = automaton.iter(f" {whole.decode('latin-1')} ")
    found = np.fromiter((payload for _, payload in emitted), np.int64, total)
    return Payloads((found & 0xFFFFFFFF).astype(np.uint32), found >> 32, words)


def features(found: Payloads, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs of 1 to LONGEST_RUN words, text by text, and the number of them per text."""
    total = len(found.crc)
    ends = np.cumsum(found.words)
    left = np.repeat(ends, found.words) - np.arange(total)  # words from here to the end of the text
    table = np.full((total, LONGEST_RUN), -1, np.int16 if buckets <= 1 << 15 else np.int32)
    run = found.crc
    table[:, 0] = run % np.uint32(buckets)
    for extra in range(1, LONGEST_RUN):
        run = compose(run[: max(total - extra, 0)], found.crc[extra:], found.length[extra:])
        inside = left[: len(run)] > extra
        table[: len(run), extra][inside] = (run % np.uint32(buckets))[inside]
    sizes = sum(np.maximum(found.words - extra, 0) for extra in range(LONGEST_RUN))
    return table[table >= 0], sizes


def groups(texts: Iterator[bytes], size: int = GROUP_BYTES) -> Iterator[list[bytes]]:
    held, total = [], 0
    for text in texts:
        held.append(text)
        total += len(text)
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def document_features(docs: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, n_features, buckets as bytes) of every row, from its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in groups(text.as_py() or b"" for text in batch.column(1)):
                found = scan(texts)
                numbers, sizes = features(found, buckets)
                width = numbers.dtype.itemsize
                edges = np.r_[0, np.cumsum(sizes)] * width
                data = numbers.tobytes()
                cells = [data[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.array(found.words, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(cells, pa.binary()),
                    ],
                    ["id", "n_words", "n_features", "buckets"],
                )
                at += len(texts)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {type_of(docs, id_col)}, n_words long, n_features long, buckets binary")


def _kind(buckets: int) -> type:
    return np.int16 if buckets <= 1 << 15 else np.int32


def bucket_counts(found: DataFrame, name: str, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, count) of the buckets that occur; a task adds its rows up before anything is shuffled."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for cell in batch.column(0):
                counts += np.bincount(np.frombuffer(cell.as_py(), kind), minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(counts[held], pa.int64())], ["bucket", "n"])

    each = found.select("buckets").mapInArrow(run, "bucket long, n long")
    return each.groupBy("bucket").agg(F.sum("n").alias(name))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket, from the counts `s` in the corpus and `t` in the target."""
    every = corpus.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    counts = every.join(corpus, "bucket", "left").join(target, "bucket", "left").na.fill(0, ["s", "t"])
    totals = counts.agg(F.struct(F.sum("s").alias("s"), F.sum("t").alias("t"))).scalar()
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = ((t + 1) * (F.col("all.s") + F.lit(float(buckets)))) / ((s + 1) * (F.col("all.t") + F.lit(float(buckets))))
    return counts.withColumn("all", totals).select("bucket", F.floor(F.lit(1000.0) * F.ln(ratio)).alias("gain"))


def weigh(found: DataFrame, table: np.ndarray) -> DataFrame:
    """(id, n_words, n_features, weight) from stored features and the gains of all buckets."""
    shared = found.sparkSession.sparkContext.broadcast(table)
    kind = _kind(len(table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(shared.value[np.frombuffer(cell.as_py(), kind)].sum()) for cell in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sums, pa.int64())], ["id", "n_words", "n_features", "weight"]
            )

    rows = found.select("id", "n_words", "n_features", "buckets")
    return rows.mapInArrow(run, f"id {type_of(found, 'id')}, n_words long, n_features long, weight long")


def noise(id_: Column, seed: int = SEED) -> Column:
    """Seeded Gumbel noise of an id, in thousandths, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    buckets: int = BUCKETS,
    percent: int = DRAW_PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """One row per input row: id, n_features, weight, score and rank (NULL where not drawn)."""
    found = stored(document_features(docs, id_col, text_col, buckets))
    wanted = document_features(target.withColumn("_none", F.lit(None).cast("int")), "_none", target_text_col, buckets)
    rows = gains(bucket_counts(found, "s", buckets), bucket_counts(wanted, "t", buckets), buckets).collect()
    table = np.zeros(buckets, np.int64)  # as many numbers as there are buckets, whatever the corpus
    for row in rows:
        table[row["bucket"]] = row["gain"]
    scored = weigh(found, table).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    scored = durable(scored)

    enough = F.col("n_words") >= min_words
    # Scores are whole numbers below 2^53, which doubles hold exactly.
    counts, found_at = order_statistics(scored, {"score": F.when(enough, F.col("score"))}, lambda _, n: [n - n * percent // 100])
    drawn = counts["score"] * percent // 100
    cut = [int(stat.value) for stat in found_at.values()]
    high = F.coalesce(enough & (F.col("score") >= F.lit(cut[0])), F.lit(False)) if cut else F.lit(False)
    order = [F.desc("score"), F.asc_nulls_first("id")]
    ranked = with_stratum_position(scored.filter(high).withColumn("all", F.lit(0)), "all", order, "rank")
    ranked = ranked.select("id", "n_features", "weight", "score", F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    rest = scored.filter(~high).select("id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest).withColumnRenamed("id", id_col)
