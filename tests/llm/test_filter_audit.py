"""Filter audit against walking every order over every document."""

import re
from collections import defaultdict
from itertools import permutations
from math import factorial

from pyspark.sql import functions as F

from shoplayers.llm import filter_audit as A

LABELS = "doc_id long, quality int, toxic int"


def failures(rows):
    first = defaultdict(list)
    for id_, text, _ in rows:
        if id_ is not None:
            first[text or ""].append(id_)
    for id_, text, source in rows:
        content = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", content)
        failed = set()
        if len(words) < 200:
            failed.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            failed.add("B")
        if 100 * len(re.findall("[A-Z]", content)) > 2 * len(content):
            failed.add("C")
        if re.search(r"[#$%&*|]", content):
            failed.add("D")
        if id_ is not None and min(first[content]) < id_:
            failed.add("E")
        yield id_, source or "", failed


def brute(rows, labels):
    good = {id_ for id_, q, _ in labels if q == 1 and id_ is not None}
    toxic = {id_ for id_, _, t in labels if t == 1 and id_ is not None}
    found, removed_in_all = {}, defaultdict(int)
    judged = list(failures(rows))
    for part in {part for _, part, _ in judged}:
        for order in map("".join, permutations("ABCDE")):
            left = [(id_, failed) for id_, p, failed in judged if p == part]
            everything = left
            for step, letter in enumerate(order, 1):
                gone = [id_ for id_, failed in left if letter in failed]
                left = [(id_, failed) for id_, failed in left if letter not in failed]
                removed_in_all[part, letter] += len(gone)
                failing = sum(letter in failed for _, failed in everything)
                found[part, order, step] = [
                    len(left), len(gone), failing - len(gone), sum(failed == {letter} for _, failed in everything),
                    sum(id_ in good for id_ in gone), sum(id_ in toxic for id_ in gone),
                ]
    return sorted((*key, *values, removed_in_all[key[0], key[1][key[2] - 1]]) for key, values in found.items())


def cases(rows):
    long = " ".join(f"word{i}" for i in range(300))
    extra = [(600 + i, text, f"s{i % 3}") for i, text in enumerate([long, long + " #", long.upper(), "a " * 400, long, long + " #"])]
    return [(r[0], r[1], r[3]) for r in rows] + extra + [(None, long, "s0"), (600, long, "s1"), (700, long, None), (701, long, "")]


LABELLED = [(600, 1, 0), (601, 0, 1), (601, 1, 0), (604, 1, 1), (None, 1, 1), (5, 1, None), (9999, 1, 1), (700, None, 1), (500, 1, 1)]


def test_equals_walking_every_order(spark, rows):
    given = cases(rows)
    docs = spark.createDataFrame(given, "doc_id long, text string, source string").repartition(5)
    labels = spark.createDataFrame(LABELLED, LABELS)
    assert sorted(map(tuple, A.audit(docs, labels).collect())) == brute(given, LABELLED)


def test_extra_columns_and_nothing(spark, clashing, nothing, rows):
    labels = spark.createDataFrame([], LABELS)
    named = clashing.withColumns({n: F.lit("x") for n in ("part", "failed", "digest", "docs", "rows", "first_id", "good", "toxic")})
    assert sorted(map(tuple, A.audit(named, labels).collect())) == brute([(r[0], r[1], r[3]) for r in rows], [])
    assert A.audit(nothing, labels).count() == 0


def test_paths_through_the_lattice():
    forward, backward = A.path_counts(5)
    for state in range(32):
        size = state.bit_count()
        assert forward[state] == factorial(size) and backward[state] == factorial(5 - size)
    assert sum(forward[s] * backward[s | 1] for s in range(32) if not s & 1) == 120


def test_a_very_long_text(spark):
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("wort "), 4_000_000).alias("text"), F.lit("s").alias("source"))
    row = A.audit(docs, spark.createDataFrame([], LABELS)).filter("filter_order = 'BACDE' AND step = 1").first()
    assert (row["kept"], row["removed"], row["unique_fails"], row["shapley"]) == (0, 1, 1, 120)
