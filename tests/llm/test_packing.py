import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shoplayers.llm import packing


def plain_pack(pieces, lengths):
    """The same rules with a list of open bins that is searched from end to end."""
    lengths, bins, opened, to_come = sorted(lengths), [], [], sum(pieces)
    for piece in pieces:
        room = min((b["room"] for b in opened if b["room"] >= piece), default=None)
        if room is not None:
            chosen = [b for b in opened if b["room"] == room][-1]
        else:
            fits = [n for n in lengths if n >= piece]
            length = min(fits, key=lambda n: (packing.cost(n) / min(n, to_come), n))
            chosen = {"room": length, "items": [], "length": length}
            bins.append(chosen)
        opened = [b for b in opened if b is not chosen]
        chosen["items"].append(piece)
        chosen["room"] -= piece
        opened.append(chosen)  # the bin touched last is tried first among equals
        to_come -= piece
    return [(b["items"], min(n for n in lengths if n >= sum(b["items"]))) for b in bins]


@pytest.mark.parametrize("seed", range(8))
def test_equals_plain_search(seed):
    draw = random.Random(seed)
    lengths = draw.choice([(8, 16, 32), (64,), (5, 7, 100), packing.LENGTHS])
    pieces = sorted((draw.randint(1, max(lengths)) for _ in range(draw.choice([0, 1, 30, 200]))), reverse=True)
    bins, offsets, finals = packing.pack(pieces, lengths)
    found = defaultdict(list)
    for piece, number, offset in zip(pieces, bins, offsets):
        assert offset == sum(found[number])
        found[number].append(piece)
    assert [(found[i], finals[i]) for i in range(len(finals))] == plain_pack(pieces, lengths)


def test_close_to_the_least_cost_on_small_inputs():
    lengths, draw = (8, 16, 32), random.Random(3)

    def least(pieces):
        """Least cost over all ways to put pieces into bins."""
        best = {(): 0.0}

        def solve(rest):
            if rest in best:
                return best[rest]
            first, others, found = rest[0], rest[1:], float("inf")
            for size in range(len(others) + 1):
                for chosen in set(itertools.combinations(others, size)):
                    total = first + sum(chosen)
                    if total <= max(lengths):
                        left = list(others)
                        for piece in chosen:
                            left.remove(piece)
                        own = packing.cost(min(n for n in lengths if n >= total))
                        found = min(found, own + solve(tuple(left)))
            best[rest] = found
            return found

        return solve(tuple(pieces))

    for _ in range(20):
        pieces = sorted((draw.randint(1, 32) for _ in range(7)), reverse=True)
        finals = packing.pack(pieces, lengths)[2]
        assert sum(map(packing.cost, finals)) <= 1.5 * least(pieces)


def check(packed, expected, lengths=packing.LENGTHS):
    """Pieces tile the documents, bins hold their pieces without gaps, and no bin could be shorter."""
    documents, bins = defaultdict(list), defaultdict(list)
    for r in packed:
        documents[r["doc_id"], r["copy"], r["total"] if "total" in r else None].append((r["start"], r["length"]))
        bins[r["bin_id"]].append((r["bin_offset"], r["length"], r["bin_length"]))
    totals = defaultdict(int)
    for r in packed:
        totals[r["doc_id"]] += r["length"]
    assert dict(totals) == expected
    for pieces in bins.values():
        pieces.sort()
        end = 0
        for offset, length, _ in pieces:
            assert offset == end
            end += length
        assert {p[2] for p in pieces} == {min(n for n in lengths if n >= end)}


def test_documents_are_whole(documents, rows):
    expected = defaultdict(int)
    for row in rows:
        expected[row[0]] += len((row[1] or "").encode().split()) + 1
    packed = packing.pack_documents(documents).collect()
    check(packed, dict(expected))
    assert sum(r["doc_id"] == 500 for r in packed) == 5
    assert max(r["piece"] for r in packed if r["doc_id"] == 502) == 30_001 // 4096


def test_many_groups_and_reruns(documents, rows):
    first = packing.pack_documents(documents, group_rows=20)
    again = packing.pack_documents(documents.repartition(9), group_rows=20)
    assert sorted(map(repr, first.collect())) == sorted(map(repr, again.collect()))
    assert first.select(F.shiftright("bin_id", 32)).distinct().count() > 3


def test_own_lengths_and_empty(documents, nothing):
    packed = packing.pack_documents(documents, length=F.lit(3), lengths=(4, 8)).collect()
    assert {r["bin_length"] for r in packed} <= {4, 8}
    assert packing.pack_documents(documents, length=F.lit(0)).count() == 0
    assert packing.pack_documents(nothing).count() == 0
