import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shoplayers.llm import exact_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normal(text):
    return (text or "").translate(LOWER)


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[normal(row[1])].append(row[0])
    result, seen = [], set()
    for row in rows:
        text = normal(row[1])
        ids = [i for i in groups[text] if i is not None]
        keep = max(ids) if ids else None
        kept = row[0] == keep and text not in seen
        if kept:
            seen.add(text)
        result.append((row[0], keep, len(groups[text]), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(result, key=repr)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_equals_brute_force(documents, rows):
    assert result(exact_dedup.resolve(documents)) == expected(rows)


def test_partitioning_changes_nothing(documents, rows):
    assert result(exact_dedup.resolve(documents.repartition(23), salts=3)) == expected(rows)


@pytest.mark.parametrize("length", [0, 1])
def test_colliding_digests_never_merge_texts(documents, rows, length):
    def weak(norm):
        return F.substring(F.sha2(norm, 256), 1, length)

    assert result(exact_dedup.resolve(documents, digest=weak)) == expected(rows)


def test_deduplicate_keeps_one_row_of_every_text_with_all_columns(clashing, rows):
    kept = exact_dedup.deduplicate(clashing)
    assert kept.columns == clashing.columns
    found = sorted(((r["doc_id"], normal(r["text"])) for r in kept.collect()), key=repr)
    best = {}
    for row in rows:
        ids = [i for i in (best.get(normal(row[1])), row[0]) if i is not None]
        best[normal(row[1])] = max(ids) if ids else None
    assert found == sorted(((i, t) for t, i in best.items()), key=repr)


def test_empty(nothing):
    assert exact_dedup.resolve(nothing).count() == 0
    assert exact_dedup.deduplicate(nothing).count() == 0
