"""Byte-level BPE against the library that defines its results, and round trips."""

import hashlib
import os
import random
import re

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from shoplayers.llm import byte_bpe as B

VOCABULARY = B.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
ODD = "abstrevmld'’  \n\t 　é東\U0001f600 19!?.,''' ٣Ⅷ́\x00\x85​"


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=B.ranks_of(VOCABULARY), special_tokens={}
    )


@pytest.fixture(scope="module")
def classes():
    return B.character_classes()


@pytest.mark.parametrize("block, cache", [(B.BLOCK, B.CACHE), (7, 20)])
def test_texts_of_odd_signs(reference, classes, block, cache):
    encoder, decoder, rng = B.Encoder(VOCABULARY, classes, cache, block), B.Decoder(VOCABULARY), random.Random(5)
    for _ in range(400):
        texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(40))) for _ in range(rng.randrange(1, 6))]
        ids, offsets, sizes = encoder.encode(texts)
        at = 0
        for text, size in zip(texts, sizes):
            own = slice(at, at + size)
            assert ids[own].tolist() == reference.encode_ordinary(text)
            data, ends = decoder.decode(ids[own])
            assert data.tobytes() == text.encode()
            assert offsets[own].tolist() == [0, *ends.tolist()][:size]
            at += size


def test_every_code_point(reference, classes):
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    ids, _, _ = B.Encoder(VOCABULARY, classes).encode([every])
    assert ids.tolist() == reference.encode_ordinary(every)


@pytest.mark.parametrize("text", ["a" * 30_000, "ab" * 9000, "\n" * 30_000 + "x", "'s" * 9000, "é" * 9000, " " * 30_000, "!?" * 9000])
def test_long_runs(reference, classes, text):
    ids, _, _ = B.Encoder(VOCABULARY, classes).encode(["x", text, ""])
    assert ids.tolist() == reference.encode_ordinary("x") + reference.encode_ordinary(text)


def test_a_run_that_no_regular_expression_survives(classes):
    encoder, decoder = B.Encoder(VOCABULARY, classes), B.Decoder(VOCABULARY)
    text = " " * 2_000_000 + "end"
    ids, _, _ = encoder.encode([text])
    assert decoder.decode(ids)[0].tobytes() == text.encode()


def test_scan_is_associative():
    rng = random.Random(3)
    for total in (0, 1, 63, 64, 65, 1000, 5003):
        symbols = [rng.randrange(len(B._SYMBOLS)) for _ in range(total)]
        products = B.prefix_products(B._MACHINE.of_symbol[symbols] if total else B._MACHINE.of_symbol[:0])
        state, states = B.FRESH, []
        for symbol in symbols:
            states.append(state)
            state = B._step(state, symbol)[0]
        assert B._MACHINE.values[products, B.FRESH].tolist() == [*states, state]


def expected(reference, text):
    ids = reference.encode_ordinary(text or "")
    digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()


def test_operator_equals_the_library(reference, documents, clashing, rows):
    wanted = sorted(((r[0], *expected(reference, r[1])) for r in rows), key=repr)
    for docs in (documents, clashing.withColumn("ids", F.lit(1)).repartition(7)):
        encoded = B.encode(docs, VOCABULARY)
        assert sorted(map(tuple, B.digests(encoded, VOCABULARY).collect()), key=repr) == wanted


def test_offsets_cut_texts(spark, documents):
    encoded = B.encode(documents.filter("doc_id < 40"), VOCABULARY).join(documents.select("doc_id", "text"), "doc_id")
    decoder = B.Decoder(VOCABULARY)
    for row in encoded.collect():
        data, edges = row["text"].encode(), [*row["offsets"], len(row["text"].encode())]
        assert len(row["offsets"]) == len(row["ids"])
        for id_, a, b in zip(row["ids"], edges, edges[1:]):
            assert decoder.data[decoder.starts[id_] :][: decoder.lengths[id_]].tobytes() == data[a:b]


def test_nothing_and_unknown_ids(spark, nothing):
    assert B.digests(B.encode(nothing, VOCABULARY), VOCABULARY).count() == 0
    lists = spark.createDataFrame([([72, None, 10**8, -5, 72],), (None,), ([],)], "ids array<int>")
    one = B.Decoder(VOCABULARY).decode(__import__("numpy").array([72]))[0].tobytes()
    found = lists.select(B.decoded(F.col("ids"), VOCABULARY, spark).alias("d")).collect()
    assert [bytes(r["d"]) for r in found] == [one + one, b"", b""]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not present")
def test_query_equals_the_library(spark, reference):
    from shoplayers.llm.queries import op12_byte_bpe

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    wanted = sorted((r["doc_id"], *expected(reference, r["text"])) for r in docs)
    assert sorted(map(tuple, op12_byte_bpe(spark, "/root/testdata/sf0.001").collect())) == wanted


def test_pattern_is_the_one_described():
    assert re.sub(r"'(s|t|re|ve|m|ll|d)\|", "", public_tokenizers.PATTERN).startswith(r" ?\p{L}+| ?\p{N}+")
