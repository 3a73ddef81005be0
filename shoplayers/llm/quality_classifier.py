"""Quality classifier with supervised subword embeddings.

A document is the mean of learned vectors of its features: every word, every run of two and of three words, and every
run of 3 to 5 characters of a word with its edges marked (the white space around it), hashed into 2^BUCKET_BITS
buckets. Words are also read without their spelling, as how many words ago the same word stood (in powers of two, below
REACH words; otherwise new): such signs and pairs of them are hashed as words and their pairs are, so that an order of
words can be learned from other words than those it is met with. A softmax layer turns the mean into class probabilities. Vectors and layer are trained together
by stochastic gradient descent in numpy, one document a step, with a falling learning rate.

Fitting uses at most `max_rows` labelled documents, drawn by a hash of their id: a documented bound on
the labelled sample. Their features are counted on the executors; one task then trains, on at most
max_rows x 2^BUCKET_BITS counts. The model is one number a bucket, two megabytes, and is what
gets broadcast. Scoring reads every whole text. Because the softmax of a mean is linear before the softmax, a
trained feature is one number when scoring: the difference it makes to the two classes.

Defined results: a NULL or empty text has no features; its score is what the layer's bias says. Without
labelled rows, or with one class only, every score is the smoothed share of label 1. Labels other than 0
and 1 and rows without label are ignored; a document with several labels counts with each. Repeated rows score alike.
Very long texts are read whole, in pieces of about PIECE_CHARS characters that end between words, so memory is that of
a piece. An empty table gives an empty result. Extra columns are not read (`accepted` keeps them), whatever their names.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoplayers.session import durable

BUCKET_BITS = 18
DIMENSIONS = 8
SIZES = (3, 4, 5)
LONGEST_RUN = 3  # words
REACH = 64  # words
PIECE_CHARS = 1 << 18
EPOCHS = 8
LEARNING_RATE = 20.0
MAX_ROWS = 4000
THRESHOLD = 0.3
FOLDS = 5
SEED = 42
_SPACE = re.compile("[ \t-\r]")
_MIX = np.uint64(0x9E3779B97F4A7C15)  # 2^64 / golden ratio, odd: multiplying by it spreads the bits
_BASE = np.uint64(0x100000001B3)
_INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(max(count - 1, 0), base, np.uint64)], dtype=np.uint64)


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(31))) * _MIX
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _pieces(text: str, size: int) -> Iterator[str]:
    """`text` in pieces of about `size` characters that end before white space."""
    begin = 0
    while len(text) - begin > size and (found := _SPACE.search(text, begin + size)):
        yield text[begin : found.start()]
        begin = found.start()
    yield text[begin:]


def _recurrences(words: np.ndarray) -> np.ndarray:
    """Per word 1 + log2 of the distance to the same word before it, 0 where there is none within REACH."""
    order = np.argsort(words, kind="stable")
    same = words[order[1:]] == words[order[:-1]]
    gap = np.zeros(len(words), np.int64)
    gap[order[1:][same]] = (order[1:] - order[:-1])[same]
    gap[gap >= REACH] = 0
    return np.frexp(gap.astype(float))[1].astype(np.uint64)  # the number of binary digits


def feature_pieces(text: str | None, bits: int = BUCKET_BITS, size: int = PIECE_CHARS) -> Iterator[np.ndarray]:
    """Buckets of all words, runs of words and character runs of a text, piece by piece."""
    before = np.empty(0, np.uint64)  # the last words of the pieces so far
    for piece in _pieces(text or "", size):
        chars = np.frombuffer(f" {piece} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        space = (chars == 32) | ((chars >= 9) & (chars <= 13))
        chars[space] = 32
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1  # word begins and ends in turn
        starts, ends = edge[::2], edge[1::2]
        if not len(starts):
            continue
        # A word's hash is a difference of running sums of char * base^position, moved to position 0.
        sums = np.r_[np.uint64(0), np.cumsum(chars * _powers(_BASE, len(chars)), dtype=np.uint64)]
        words = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(chars))[starts] + np.uint64(1)
        found = [words]
        known, words = len(before), np.r_[before, words]
        run = words
        for longer in range(1, LONGEST_RUN):
            run = (run[:-1] ^ (run[:-1] >> np.uint64(29))) * _MIX + words[longer:]
            found.append(run[max(known - longer, 0) :])  # runs that end in this piece
        again = _recurrences(words)
        found.append(again[known:])
        found.append((again[:-1] * np.uint64(REACH) + again[1:] + np.uint64(REACH))[max(known - 1, 0) :])
        before = words[-2 * REACH :]
        for count in SIZES:
            last = len(chars) - count + 1
            if last <= 0:
                continue
            hashes = np.full(last, count, np.uint64)
            inner = np.zeros(last, bool)
            for k in range(count):
                hashes = hashes * _BASE + chars[k : last + k]
                if 0 < k < count - 1:
                    inner |= space[k : last + k]
            found.append(hashes[~inner])
        yield _bucket(np.concatenate(found), bits)


def features(text: str | None, bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that occur in a text, and how often."""
    buckets, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for piece in feature_pieces(text, bits):
        buckets, place = np.unique(np.r_[buckets, piece], return_inverse=True)
        counts = np.bincount(place, np.r_[counts, np.ones(len(piece), np.int64)], len(buckets)).astype(np.int64)
    return buckets, counts


@dataclass(frozen=True)
class Model:
    """`effect[b]` is what bucket b adds to the log odds of label 1 for a document of that one feature."""

    effect: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        total, count = 0.0, 0
        for piece in feature_pieces(text, len(self.effect).bit_length() - 1):
            total += float(self.effect[piece].sum())
            count += len(piece)
        mean = total / max(count, 1)
        return 1.0 / (1.0 + float(np.exp(-np.clip(mean + self.bias, -700, 700))))

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, effect=self.effect, bias=self.bias)
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> Model:
        stored = np.load(io.BytesIO(data))
        return Model(stored["effect"], float(stored["bias"]))


def train(
    bags: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    bits: int = BUCKET_BITS,
    epochs: int = EPOCHS,
    rate: float = LEARNING_RATE,
    seed: int = SEED,
) -> Model:
    """Train on bags of (bucket, count). Same input, same model."""
    ones = int((labels == 1).sum())
    prior = (ones + 1) / (len(labels) + 2)
    bias = float(np.log(prior / (1 - prior)))
    if ones in (0, len(labels)):
        return Model(np.zeros(1 << bits), bias)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << bits, DIMENSIONS))
    layer = np.zeros((2, DIMENSIONS))
    offset = np.array([0.0, bias])
    steps, done = epochs * len(bags), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            pace = rate * (1 - done / steps)
            done += 1
            buckets, counts = bags[i]
            shares = counts / max(counts.sum(dtype=float), 1)
            hidden = shares @ vectors[buckets]
            logits = layer @ hidden + offset
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[int(labels[i])] -= 1
            back = error @ layer
            layer -= 0.1 * pace * error[:, None] * hidden[None, :]
            offset -= 0.01 * pace * error
            vectors[buckets] -= (pace * shares)[:, None] * back[None, :]
    return Model(vectors @ (layer[1] - layer[0]), float(offset[1] - offset[0]))


def held_out(id_: Column, folds: int = FOLDS) -> Column:
    """True for the documents no label is learned from."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_rows: int = MAX_ROWS,
    bits: int = BUCKET_BITS,
) -> Model:
    """Train on at most `max_rows` labelled documents outside the held-out fold."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    # A text is fetched for labelled ids that exist; the bound holds for the joined rows.
    present = docs.select(F.col(id_col).alias("id")).join(known, "id")
    drawn = durable(
        present.withColumn("draw", F.xxhash64(F.lit(SEED), "id")).orderBy("draw", "id", "label").limit(max_rows)
    )
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # At most max_rows rows of two numbers.
    sample = sample.join(F.broadcast(drawn.dropDuplicates(["id", "label"])), "id").select("draw", "id", "label", "text")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = [features(text.as_py(), bits) for text in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([b.astype(np.int32) for b, _ in counted], pa.list_(pa.int32())),
                    pa.array([c.astype(np.float32) for _, c in counted], pa.list_(pa.float32())),
                ],
                ["draw", "label", "buckets", "counts"],
            )

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(size=group["buckets"].map(len)).sort_values(["draw", "label", "size"], kind="stable")
        pairs = list(zip(group["buckets"], group["counts"]))
        return pd.DataFrame({"model": [train(pairs, group["label"].to_numpy(), bits).to_bytes()]})

    counted = sample.mapInArrow(bags, "draw long, label int, buckets array<int>, counts array<float>")
    trained = counted.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(learn, "model binary").first()
    if trained is None:
        return Model(np.zeros(1 << bits), 0.0)
    return Model.from_bytes(bytes(trained["model"]))


def score_of(text: Column, model: Model, spark: SparkSession) -> Column:
    """Score of a whole text. Only texts travel to Python and only scores come back."""
    shared = spark.sparkContext.broadcast(model.to_bytes())

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model.from_bytes(shared.value)
        for texts in batches:
            yield pa.array([own.score(text.as_py()) for text in texts], pa.float64())

    return run(text)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """One row per input row: id, held_out, score (probability of label 1) and predicted."""
    model = fit(docs, labels, id_col, text_col, label_col, max_rows)
    scored = docs.select(F.col(id_col).alias("id"), score_of(F.col(text_col), model, docs.sparkSession).alias("score"))
    return scored.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows the classifier doesn't reject, with all their columns."""
    model = fit(docs, labels, id_col, text_col)
    return docs.filter(score_of(F.col(text_col), model, docs.sparkSession) >= threshold)
