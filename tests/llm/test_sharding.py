import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from shoplayers.llm import sharding


def test_every_record_in_one_place_of_equal_shards(spark, documents, rows, clashing):
    for docs in (documents, clashing):
        written = sharding.shuffle_into_shards(docs, sharding.new_folder(spark), bucket_bytes=4096)
        found = sharding.digests(written).collect()
        expected = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == expected
        assert Counter((r["id"], r["text"]) for r in written.collect()) == Counter((r[0], r[1]) for r in rows)
        slots = defaultdict(list)
        for r in found:
            slots[r["shard"]].append(r["slot"])
        assert set(slots) == set(range(8))
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        sizes = [len(s) for s in slots.values()]
        assert max(sizes) - min(sizes) <= 1


def places(df):
    return sorted(map(repr, df.select("id", "text", "shard", "slot").collect()))


def test_reruns_agree_and_seeds_differ(spark, documents):
    first = sharding.shuffle_into_shards(documents, sharding.new_folder(spark), bucket_bytes=4096)
    again = sharding.shuffle_into_shards(documents.repartition(11), sharding.new_folder(spark), bucket_bytes=4096)
    other = sharding.shuffle_into_shards(documents, sharding.new_folder(spark), bucket_bytes=4096, seed=1)
    assert places(first) == places(again) != places(other)


def test_copies_are_spread(spark, documents, rows):
    written = sharding.shuffle_into_shards(documents, sharding.new_folder(spark), bucket_bytes=4096)
    assert written.filter("id >= 200 AND id < 240").select("shard").distinct().count() >= 6


def test_fisher_yates_is_uniform():
    counts = Counter(tuple(sharding.fisher_yates(4, np.random.default_rng(seed))) for seed in range(12_000))
    assert len(counts) == 24 and min(counts.values()) > 380 and max(counts.values()) < 630
    assert len(sharding.fisher_yates(0, np.random.default_rng(1))) == 0


@pytest.mark.parametrize("count", [0, 1, 5, 8, 9])
def test_few_records(spark, documents, count):
    docs = documents.filter(f"doc_id < {count}")
    found = sharding.digests(sharding.shuffle_into_shards(docs, sharding.new_folder(spark))).collect()
    sizes = Counter(r["shard"] for r in found)
    assert len(found) == count and (not sizes or max(sizes.values()) - min(sizes.get(s, 0) for s in range(8)) <= 1)
