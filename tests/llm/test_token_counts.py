import random

import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shoplayers.llm import token_counts as tc

COUNT = tc.token_counter(tc.read_vocabulary())
PIECES = ["the", " house", "'s", "  ", "\n", "\n\n", "\t", " 12", "3", "!!", " ?", "é", "東京", "\x1c", "\x85", "\u2003", "\u00a0", " ", "a" * 40, "x\r\n", ""]


def applied(text, edits):
    for position, deleted, inserted in edits:
        position = min(max(position, 0), len(text))
        text = text[:position] + inserted + text[min(position + max(deleted, 0), len(text)) :]
    return text


texts = st.lists(st.sampled_from(PIECES), max_size=60).map("".join)


@settings(max_examples=300, deadline=None)
@given(texts, st.lists(st.tuples(st.integers(-3, 400), st.integers(-1, 200), texts), max_size=6), st.sampled_from([1, 4, 32]))
def test_counts_equal_a_full_encoding_after_every_edit(text, edits, size):
    tree = tc.SegmentTree(text, COUNT, size)
    for edit in [None, *edits]:
        if edit:
            tree.edit(*edit)
            text = applied(text, [edit])
        assert "".join(tree.segments) == text
        assert (tree.chars, tree.tokens) == (len(text), COUNT(text))
        for below, level in zip(tree.levels, tree.levels[1:]):
            assert level == [tuple(map(sum, zip(*below[i : i + 2]))) for i in range(0, len(below), 2)]
        assert [chars for chars, _ in tree.levels[0]] == [len(s) for s in tree.segments]


def test_only_the_surroundings_are_encoded_again():
    text = "many words of prose " * 20_000
    tree = tc.SegmentTree(text, COUNT)
    before = tree.encoded_chars
    tree.edit(200_000, 3, "new words")
    assert tree.encoded_chars - before < 8 * tc.SEGMENT_CHARS
    assert tree.tokens == COUNT(applied(text, [(200_000, 3, "new words")]))


def test_operator_equals_brute_force(documents, rows, clashing):
    draw = random.Random(1)
    edits = [(draw.randint(0, 300), draw.randint(0, 60), draw.choice(PIECES)) for _ in range(4)]
    column = F.array(*[F.struct(F.lit(p).alias("position"), F.lit(d).alias("deleted"), F.lit(i).alias("inserted")) for p, d, i in edits])
    for docs in (documents, clashing):
        found = tc.count_edited(docs, column, tc.read_vocabulary()).collect()
        expected = [(r[0], COUNT(r[1] or ""), COUNT(applied(r[1] or "", edits)), len(applied(r[1] or "", edits))) for r in rows]
        assert sorted(((r["doc_id"], r["tokens_before"], r["tokens_after"], r["chars_after"]) for r in found), key=repr) == sorted(expected, key=repr)
        assert all(sum(r["segments"]) == r["tokens_after"] for r in found)


def test_defined_cases(documents, nothing):
    none = F.lit(None)
    assert tc.count_edited(nothing, none, tc.read_vocabulary()).count() == 0
    unchanged = tc.count_edited(documents, none, tc.read_vocabulary()).collect()
    assert all(r["tokens_before"] == r["tokens_after"] and r["reencoded_chars"] == 0 for r in unchanged)


@pytest.mark.parametrize("position,node", [(0, 0), (4, 0), (5, 1), (14, 2), (15, 2), (99, 2)])
def test_locate(position, node):
    tree = tc.SegmentTree("aaaaa bbbb cccc", len, 1)
    assert tree.segments == ["aaaaa", " bbbb", " cccc"]
    assert tree.locate(position) == (node, 5 * node)


@pytest.mark.parametrize("sign", [" ", "\t", "\n", "\u3000"])
def test_white_space_of_any_length(sign):
    for before, size, after in (("word", 2_000_000, "end"), ("", 2_000_000, ""), ("x ", 1500, " y"), ("", 999, "z"), ("a", 1000, "")):
        text = before + sign * size + after
        if size < 5000:
            plain = tiktoken.Encoding("plain", pat_str=tc.PATTERN, mergeable_ranks=tc.ranks_of(tc.read_vocabulary()), special_tokens={})
            assert COUNT(text) == len(plain.encode_ordinary(text))
        else:
            tree = tc.SegmentTree(text, COUNT)
            assert tree.tokens == COUNT(text) and 0 < COUNT(text) <= len(text.encode())


def test_two_rounds_of_edits_encode_only_what_they_touch(spark, documents, rows):
    draw = random.Random(3)

    def drawn():
        edits = [(draw.randint(0, 300), draw.randint(0, 60), draw.choice(PIECES)) for _ in range(3)]
        return edits, F.array(*[F.struct(F.lit(p).alias("position"), F.lit(d).alias("deleted"), F.lit(i).alias("inserted")) for p, d, i in edits])

    (first, first_column), (second, second_column) = drawn(), drawn()
    vocabulary = tc.read_vocabulary()
    kept = tc.count_edited(documents, first_column, vocabulary, keep=True).withColumnRenamed("text_after", "text")
    again = tc.count_edited(kept, second_column, vocabulary, leaves=F.col("leaves"), keep=True).collect()
    expected = []
    for r in rows:
        text = applied(applied(r[1] or "", first), second)
        expected.append((r[0], text, COUNT(text)))
    assert sorted(((r["doc_id"], r["text_after"], r["tokens_after"]) for r in again), key=repr) == sorted(expected, key=repr)
    assert all(r["encoded_chars"] == r["reencoded_chars"] for r in again)
    long = next(r for r in again if r["doc_id"] == 502)
    assert long["chars_after"] > 100_000 and long["encoded_chars"] < 20 * tc.SEGMENT_CHARS
    assert all(sum(leaf["tokens"] for leaf in r["leaves"]) == r["tokens_after"] for r in again)


def test_leaves_of_another_text_are_made_anew(spark):
    docs = spark.createDataFrame([(1, "some words", [(3, 9)]), (2, "more words", [(10, 2)]), (3, "x", None)], f"doc_id long, text string, leaves {tc.LEAVES}")
    found = {r["doc_id"]: r for r in tc.count_edited(docs, F.lit(None), tc.read_vocabulary(), leaves=F.col("leaves")).collect()}
    assert [(found[i]["tokens_after"], found[i]["encoded_chars"]) for i in (1, 2, 3)] == [(2, 10), (2, 0), (1, 1)]
