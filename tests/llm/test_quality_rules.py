import math
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from shoplayers.llm import quality_rules as qr


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered.update(range(i, i + 8))
    counts = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
    return (*counts, counts[0] < 20 or 100 * counts[4] > 30 * counts[0])


def test_base_counts(documents, rows):
    draw, texts = random.Random(2), [r[1] for r in rows]
    for _ in range(60):  # runs that overlap themselves and each other
        words = [draw.choice("a b".split()) for _ in range(draw.randint(8, 60))]
        texts.append(draw.choice([" ", "\n", "\t "]).join(words))
    texts += ["same line\nsame line\n\n\n \n \nother", "#a*b$c%d&e|f<g>h#", "w " * 5000]
    docs = documents.sparkSession.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for long_text in (qr.LONG_TEXT, 40, 0):  # words in arrays, some or nearly all as rows
        judged = qr.judge(docs, docs.select("doc_id").limit(0), long_text=long_text)
        found = {r["doc_id"]: tuple(r[n] for n in names) for r in judged.collect()}
        assert found == {i: base(t) for i, t in enumerate(texts)}


TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def bytes_of(number):
    return number.to_bytes(8, "little")


def grams(text, bits):
    """Spark's xxhash64 has seed 42; of several values, each hash seeds the next."""
    hashes = [xxhash.xxh64_intdigest(t.encode(), 42) for t in TOKEN.findall(text or "")]
    pairs = [xxhash.xxh64_intdigest(bytes_of(b), xxhash.xxh64_intdigest(bytes_of(a), 42)) for a, b in zip(hashes, hashes[1:])]
    return [h % (1 << bits) for h in hashes + pairs]


LIMIT = -0.01  # so few words stay close to the raw corpus


def test_ratio_equals_brute_force(spark):
    draw, words = random.Random(4), "the of and a river house 42 go".split()
    rows = [(i, " ".join(draw.choice(words) + ("&&&" if i % 5 == 0 else "") for _ in range(draw.randint(0, 90)))) for i in range(80)]
    rows += [(80, None), (81, ""), (3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = [i for i in range(80) if i % 5 and i % 2]
    bits, smooth = 8, qr.SMOOTHING
    raw, good = Counter(), Counter()
    for i, text in rows:
        raw.update(grams(text, bits))
        if i in trusted:
            good.update(grams(text, bits))
    share = {b: raw[b] / sum(raw.values()) for b in raw}
    trust = {b: (good[b] + smooth * share[b]) / (sum(good.values()) + smooth) for b in raw}
    ratio = {b: round((math.log(trust[b]) - math.log(share[b])) * qr.UNIT) for b in raw}
    marks = spark.createDataFrame([(i,) for i in trusted * 2] + [(None,)], "doc_id long")
    found = qr.judge(docs, marks, bits=bits, min_score=LIMIT).collect()
    assert len(found) == len(rows)
    rowwise = qr.judge(docs, marks, bits=bits, min_score=LIMIT, long_text=60).collect()
    assert sorted(map(repr, rowwise)) == sorted(map(repr, found))
    by_id = dict(rows)
    for row in found:
        own = grams(by_id[row["doc_id"]], bits)
        mean = sum(ratio[b] for b in own) / max(len(own), 1) / qr.UNIT
        assert row["n_grams"] == len(own) and row["score"] == pytest.approx(mean, abs=2e-6)
        assert row["kept"] == (not row["base_failed"] and sum(ratio[b] for b in own) >= round(LIMIT * qr.UNIT) * len(own))
    assert not any(r["kept"] for r in found if r["doc_id"] % 5 == 0)


def test_stuttered_ordinary_words_are_rejected(spark):
    draw = random.Random(6)
    words = [f"w{i}" for i in range(3000)]
    follows = {w: draw.sample(words, 8) for w in words}

    def prose():
        out = [draw.choice(words)]
        while len(out) < 300:
            out.append(draw.choice(follows[out[-1]]))
        return out

    def stutter():
        return [w for w in draw.sample(words, 60) for _ in range(5)]

    rows = [(i, " ".join(stutter() if i % 10 == 0 else prose())) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = qr.judge(docs, docs.select("doc_id").filter("doc_id % 10 > 0 AND doc_id % 3 > 0")).collect()
    assert not any(r["base_failed"] for r in found)
    assert {r["doc_id"] for r in found if not r["kept"]} == set(range(0, 1000, 10))


def test_defined_cases(documents, clashing, nothing):
    none = documents.select("doc_id").limit(0)
    judged = qr.judge(documents, none).collect()
    assert len(judged) == documents.count()
    assert all(r["score"] == 0 and r["kept"] == (not r["base_failed"]) for r in judged)
    trusted = documents.select("doc_id").filter("doc_id < 50")
    assert sorted(map(repr, qr.judge(clashing, trusted).collect())) == sorted(map(repr, qr.judge(documents.repartition(5), trusted).collect()))
    assert qr.judge(nothing, none).count() == 0


def test_no_python_in_the_plan(documents):
    plan = qr.judge(documents, documents.select("doc_id"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_a_score_does_not_depend_on_rows_that_repeat_the_corpus(spark):
    draw = random.Random(8)
    rows = [(i, " ".join(f"w{draw.randint(0, 50)}" for _ in range(60))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    often = docs.crossJoin(spark.range(4).withColumnRenamed("id", "copy"))
    none = spark.createDataFrame([], "doc_id long")
    assert {r["score"] for r in qr.judge(often, none).collect()} == {0.0}


def test_a_long_text_with_one_id_beside_others(spark):
    text = " ".join(f"w{i % 4000}" for i in range(500_000))  # 2.9 MB
    rows = [(1, text), (1, "short one"), (None, text), (2, " " * 3_000_000), (3, "x" * 3_000_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r["doc_id"], r["n_words"], r["n_repeat_words"], r["n_grams"]) for r in qr.judge(docs, docs.select("doc_id").limit(1)).collect()), key=repr)
    expected = [(1, 500_000, 500_000, 999_999), (1, 2, 0, 3), (None, 500_000, 500_000, 999_999), (2, 0, 0, 0), (3, 1, 0, 1)]
    assert found == sorted(expected, key=repr)


def test_runs_with_one_hash_are_told_apart_by_their_words(spark):
    draw, texts = random.Random(11), []
    for _ in range(20):
        texts.append(" ".join(draw.choice("abc") for _ in range(draw.randint(20, 60))))
    texts += [" ".join(f"w{i}" for i in range(40)), " ".join(f"w{i % 12}" for i in range(40)), "w " * 30]
    docs = spark.createDataFrame([(i, text.split()) for i, text in enumerate(texts)], "i long, words array<string>")
    for seen in ("transform(words, w -> xxhash64(w))", "array_repeat(7L, size(words))"):  # the second: all hashes are equal
        fours = docs.withColumn("hashes", F.expr(seen)).withColumn("fours", qr._four_hashes(F.col("hashes")))
        by_hash = qr._repeated_by_hash(F.col("words"), F.col("fours")).alias("by_hash")
        found = fours.select("i", by_hash, qr._repeats(F.col("words"), F.col("fours")).alias("n")).collect()
        assert {r["i"]: r["n"] for r in found} == {i: base(text)[4] for i, text in enumerate(texts)}
        alike = {r["i"] for r in found if r["by_hash"] is None}
        assert all(r["by_hash"] in (None, r["n"]) for r in found)
        assert len(texts) - 1 not in alike and bool(alike) == seen.startswith("array_repeat")


def test_a_row_counts_neighbouring_buckets(spark):
    draw = random.Random(12)
    rows = [(draw.randint(0, 3000), " ".join(f"w{draw.randint(0, 900)}" for _ in range(draw.randint(0, 40)))) for _ in range(90)]
    docs, trusted = spark.createDataFrame(rows, "id long, text string"), sorted({i for i, _ in rows if i % 3 == 0})
    marks = spark.createDataFrame([(i,) for i in trusted], "id long")
    for bits in (2, 9, 12):
        counts = qr.gram_counts(docs, marks, None, bits)
        raw, good = Counter(), Counter()
        for i, text in rows:
            raw.update(grams(text, bits))
            good.update(grams(text, bits) if i in trusted else [])
        assert {r["bucket"]: (r["raw"], r["trusted"]) for r in counts.collect()} == {b: (raw[b], good[b]) for b in raw}
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[bucket#", plan) and re.search(r"Aggregate \[marked#\d+, stretch#", plan)
