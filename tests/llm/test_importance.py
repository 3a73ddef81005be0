"""Importance resampling against brute force over whole texts."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplayers.llm import importance as I

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(lowered)
    found = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(f.encode()) % 10_000 for f in found]


def brute(rows, target):
    """(id, n_features, weight, score, rank) in any order."""
    found = [(id_, *runs(text)) for id_, text in rows]
    s = Counter(b for _, _, buckets in found for b in buckets)
    t = Counter(b for text in target for b in runs(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)]
    scored = []
    for id_, words, buckets in found:
        weight = sum(gain[b] for b in buckets)
        h = int(hashlib.sha256(f"42:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append([id_, len(buckets), weight, score, None, words])
    able = sorted((r for r in scored if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for place, row in enumerate(able[: 5 * len(able) // 100]):
        row[4] = place + 1
    return sorted((tuple(r[:5]) for r in scored), key=repr)


def got(spark, docs, target):
    texts = spark.createDataFrame([(t,) for t in target], "text string")
    return sorted(map(tuple, I.resample(docs, texts).collect()), key=repr)


TARGET = ["The house of the casa", None, "", "der Haus 42 end x-ray", "of and the of"]


def test_equals_brute_force(spark, documents, rows):
    assert got(spark, documents, TARGET) == brute([(r[0], r[1]) for r in rows], TARGET)


def test_partitions_and_extra_columns_change_nothing(spark, clashing, rows):
    expected = brute([(r[0], r[1]) for r in rows], TARGET)
    assert got(spark, clashing.withColumn("all", F.lit(1)).withColumn("buckets", F.lit("x")).repartition(7), TARGET) == expected


def test_empty_tables(spark, nothing, documents, rows):
    assert got(spark, nothing, TARGET) == []
    assert got(spark, documents, []) == brute([(r[0], r[1]) for r in rows], [])


def test_ties_are_drawn_by_id(spark):
    text = " ".join(["same", "words"] * 10)
    rows = [(i, text) for i in range(40)] + [(7, text)] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(spark, docs, [text]) == brute(rows, [text])


def test_scan_of_odd_texts():
    long = "q" * 5000
    texts = ["", "  ", "a", "A\x01b\x00c", f"x {long} y {long}z {long}", "é東 É1_2", "\x01" + "1 0", "w" * 255 + " " + "w" * 256, " ".join(["ab"] * 300)]
    found = I.scan([t.encode() for t in texts])
    numbers, sizes = I.features(found)
    expected = [runs(t) for t in texts]
    assert found.words.tolist() == [n for n, _ in expected] and sizes.tolist() == [len(b) for _, b in expected]
    at = 0
    for size, (_, buckets) in zip(sizes, expected):
        assert Counter(numbers[at : at + size].tolist()) == Counter(buckets)
        at += size


@pytest.mark.parametrize("length", [0, 1, 255, 256, 257, 70_000, 1 << 20])
def test_composed_crc(length):
    first, second = b"some bytes", b"z" * length
    crc = I.compose(np.array([zlib.crc32(first)], np.uint32), np.array([zlib.crc32(second)], np.uint32), np.array([length]))
    assert crc[0] == zlib.crc32(first + b" " + second)


def test_a_text_of_many_megabytes(spark):
    docs = spark.createDataFrame([(1,), (2,)], "doc_id long").withColumn(
        "text", F.when(F.col("doc_id") == 1, F.repeat(F.lit("one two "), 1_500_000)).otherwise(F.repeat(F.lit("x"), 9_000_000))
    )
    found = {r["doc_id"]: r["n_features"] for r in I.resample(docs, docs.limit(0)).collect()}
    assert found == {1: 3 * 3_000_000 - 3, 2: 1}
