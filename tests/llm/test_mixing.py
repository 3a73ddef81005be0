import hashlib
import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shoplayers.llm import mixing


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets_of(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Share the budget, cap, share the excess again, until nothing is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, target, free = share * sum(sizes.values()), {}, set(order)
    while free:
        level = (budget - sum(target.values())) / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level > cap * sizes[s]}
        if not above:
            target |= {s: weight[s] * level for s in free}
            break
        target |= {s: float(cap * sizes[s]) for s in above}
        free -= above
    return target


def expected(rows):
    docs = [(r[0], size_of(r[1]), r[3]) for r in rows]
    sizes = defaultdict(int)
    for _, size, source in docs:
        sizes[source] += size
    target, result = targets_of(sizes), []
    for source, total in sizes.items():
        own = [(i, s) for i, s, where in docs if where == source]
        if not total:
            result += [(i, s, total, target[source], 0) for i, s in own]
            continue
        copies = math.floor(target[source] / total)
        rest = target[source] - copies * total
        weigh = {s: 1 << (s.bit_length() - 1) for _, s in own if s}
        # The scale at which the inclusion probabilities, cut off at 1, hold `rest` words.
        certain = set()
        while True:
            mass = sum(weigh[s] * s for _, s in own if s and weigh[s] not in certain)
            scale = (rest - sum(s for _, s in own if s and weigh[s] in certain)) / mass if mass else 0.0
            more = {w for w in weigh.values() if w not in certain and w * scale > 1}
            if not more:
                break
            certain.add(max(more))
        room = rest - sum(s for _, s in own if s and (weigh[s] in certain or weigh[s] * scale >= 1))
        ranked = []
        for i, s in own:
            p = 1.0 if s and weigh[s] in certain else min(1.0, weigh[s] * scale) if s else 0.0
            if p >= 1 or p <= 0:
                result.append((i, s, total, target[source], (copies + (p >= 1)) * s))
                continue
            number = int(hashlib.md5(f"42:{'' if i is None else i}".encode()).hexdigest()[:12], 16)
            u = (number + 0.5) / 2**48
            ranked.append(((u / (1 - u)) / (p / (1 - p)), -1 if i is None else i, s, i))
        upto = 0
        for _, _, s, i in sorted(ranked, key=lambda x: x[:3]):
            upto += s
            result.append((i, s, total, target[source], (copies + (2 * upto - s <= 2 * room)) * s))
    return result


def rounded(rows):
    return sorted(((i, s, t, round(g, 3), taken) for i, s, t, g, taken in rows), key=repr)


def test_equals_brute_force(documents, rows):
    found = mixing.mix(documents).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert rounded(map(tuple, found)) == rounded(expected(rows))


def test_order_is_the_ratio_of_odds():
    for u in (0.01, 0.3, 0.9):
        for p in (0.001, 0.5, 0.99):
            q = (u / (1 - u)) / (p / (1 - p))
            against = u * (1 - p)
            assert against / (against + (1 - u) * p) == pytest.approx(q / (1 + q))


def test_targets_and_limits_of_many_small_documents(spark):
    rows = [(i, "w " * (1 + i * 7919 % 50), "x", f"s{i % 5}", 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = mixing.mix(docs.repartition(7)).join(docs.select("doc_id", "source"), "doc_id")
    again = mixing.mix(docs.coalesce(1))
    assert sorted(map(tuple, found.select("doc_id", "taken").collect())) == sorted(
        map(tuple, again.select("doc_id", "taken").collect())
    )
    assert found.filter("taken > 2 * size").count() == 0
    for row in found.groupBy("source").agg(F.max("target").alias("t"), F.sum("taken").alias("n")).collect():
        assert abs(row["n"] - row["t"]) <= 25


def test_mixed_rows_are_there_as_often_as_taken(clashing, rows):
    mixed = mixing.mixed_rows(clashing)
    assert mixed.columns == clashing.columns
    taken = defaultdict(int)
    for i, _, _, _, words in expected(rows):
        taken[i] += words
    found = defaultdict(int)
    for row in mixed.collect():
        found[row["doc_id"]] += size_of(row["text"])
    assert dict(found) == {i: n for i, n in taken.items() if n}


def test_empty_and_wordless(spark, nothing):
    assert mixing.mix(nothing).count() == 0
    assert mixing.mixed_rows(nothing).count() == 0
    blank = spark.createDataFrame([(1, None, "en", None, 0), (2, " ", "en", "a", 1)], nothing.schema)
    assert sorted(map(tuple, mixing.mix(blank).select("doc_id", "size", "target", "taken").collect())) == [
        (1, 0, 0.0, 0),
        (2, 0, 0.0, 0),
    ]
