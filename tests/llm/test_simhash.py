import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from shoplayers.llm import simhash
from shoplayers.llm.components import connected_components


def fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def roots_of(values, radius):
    """Smallest position reachable from every position, by trying all pairs."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if bin(a ^ values[j]).count("1") <= radius:
                a_root, b_root = find(i), find(j)
                root[max(a_root, b_root)] = min(a_root, b_root)
    return [find(i) for i in range(len(values))]


def expected(rows, radius=4):
    prints = [fingerprint(r[1]) for r in rows]
    roots = roots_of(prints, radius)
    smallest = {}
    for row, root in zip(rows, roots):
        ids = [i for i in (smallest.get(root), row[0]) if i is not None]
        smallest[root] = min(ids) if ids else None
    return sorted(((r[0], format(p, "016x"), smallest[root]) for r, p, root in zip(rows, prints, roots)), key=repr)


def result(df):
    df = df.withColumn("fingerprint", simhash.as_hex(F.col("fingerprint")))
    return sorted(map(tuple, df.collect()), key=repr)


def test_equals_brute_force(documents, rows):
    assert result(simhash.near_components(documents)) == expected(rows)


def test_spark_hash_is_the_hash_of_the_contract(spark):
    words = ["", "a", "the quick brown fox", "é東京" * 20]
    for row in spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h")).collect():
        assert row["h"] % 2**64 == xxhash.xxh64_intdigest(row["w"].encode(), 42)


def clustered(seed):
    """Fingerprints in chains and balls, so that links matter and buckets are uneven."""
    draw = random.Random(seed)
    values = [draw.getrandbits(64) for _ in range(60)]
    for _ in range(240):
        value = draw.choice(values)
        for _ in range(draw.choice([1, 2, 4, 5, 7])):
            value ^= 1 << draw.randrange(64)
        values.append(value)
    return sorted(set(values) | {0, 1, 3, 7, 15, 31, 2**64 - 1})


def test_small_groups_and_deep_prefixes_find_the_same_links(spark):
    values = clustered(5)
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    partition = sorted(map(sorted, groups(dict(zip(signed, roots_of(values, 4))))))
    for limit in (simhash.VARIANTS_PER_GROUP, 20_000, 2_500):
        links = simhash.near_links(prints, 4, limit)
        roots = {v: v for v in signed} | {r["node"]: r["root"] for r in connected_components(links, "a", "b").collect()}
        assert sorted(map(sorted, groups(roots))) == partition


def groups(root_of):
    found = {}
    for value, root in root_of.items():
        found.setdefault(root, []).append(value)
    return found.values()


def test_odd_radius(spark):
    values = clustered(6)
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    links = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), 3)
    roots = {v: v for v in signed} | {r["node"]: r["root"] for r in connected_components(links, "a", "b").collect()}
    assert sorted(map(sorted, groups(roots))) == sorted(map(sorted, groups(dict(zip(signed, roots_of(values, 3))))))


def test_odd_radius_links_members_that_only_meet_behind_smaller_ones(spark):
    for radius, values in ((1, [4, 9, 12, 13]), (3, clustered(7))):
        signed = [int(np.uint64(v).astype(np.int64)) for v in values]
        links = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), radius)
        roots = {v: v for v in signed} | {r["node"]: r["root"] for r in connected_components(links, "a", "b").collect()}
        assert sorted(map(sorted, groups(roots))) == sorted(map(sorted, groups(dict(zip(signed, roots_of(values, radius))))))


def partition(rows):
    """Rows (id, text) by the components of their fingerprints."""
    found = {}
    for row, root in zip(rows, roots_of([fingerprint(text) for _, text in rows], 4)):
        found.setdefault(root, []).append(row)
    return found.values()


def test_deduplicate_keeps_a_row_of_every_component(clashing, rows):
    kept = simhash.deduplicate(clashing)
    assert kept.columns == clashing.columns
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    components = list(partition([(r[0], r[1]) for r in rows]))
    assert len(found) == len(components)
    for component in components:
        (own,) = [row for row in found if row in component]
        ids = [i for i, _ in component if i is not None]
        assert own[0] == (min(ids) if ids else None)


def test_no_text_is_lost_where_ids_repeat(spark):
    texts = {name: " ".join(f"{name}{i}" for i in range(40)) for name in ("alpha", "beta")}
    given = [(1, "alpha"), (1, "beta"), (2, "alpha"), (3, "beta"), (None, "alpha"), (None, "beta"), (1, "beta")]
    docs = spark.createDataFrame([(i, texts[name], {"k": name}) for i, name in given], "doc_id long, text string, more map<string,string>")
    for parts in (1, 6):
        kept = [(r["doc_id"], r["text"]) for r in simhash.deduplicate(docs.repartition(parts)).collect()]
        assert sorted(kept) == [(1, texts["alpha"]), (1, texts["beta"])]


def test_empty(nothing):
    assert simhash.near_components(nothing).count() == 0
    assert simhash.deduplicate(nothing).count() == 0


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, 1000 + i) for i in range(1, 300)] + [(1299, 900)]
    edges = spark.createDataFrame([*chain, *star, *star, (5, 5), (None, 3)], "a long, b long")
    roots = {r["node"]: r["root"] for r in connected_components(edges, "a", "b").collect()}
    assert roots == {i: 0 for i in range(41)} | {i: 900 for i in range(1000, 1300)} | {900: 900}
    assert connected_components(edges.limit(0), "a", "b").count() == 0
    words = spark.createDataFrame([("b", "a"), ("c", "b"), ("z", "y")], "a string, b string")
    roots = {r["node"]: r["root"] for r in connected_components(words, "a", "b").collect()}
    assert roots == {"a": "a", "b": "a", "c": "a", "y": "y", "z": "y"}
