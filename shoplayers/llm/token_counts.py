"""Token counts that follow edits.

A document is cut into segments of about `SEGMENT_CHARS` characters, always in front of white space that
follows a character other than white space. The pre-tokenizer never joins such a pair, so the tokens of a
text are the tokens of its segments. Per document a tree is kept: its leaves hold the characters and the
tokens of a segment, every inner node the sums below it.

The leaves are what is kept: (chars, tokens) of every segment, as a column. Together with the text they came from
they make up the tree again without encoding anything, so a later round of edits encodes no more than it touches
(`leaves=`, `keep=True`).

An edit replaces `deleted` characters at `position` by `inserted`. The tree is descended by character sums
to the leaves that the edit touches; those and the neighbour on either side (the context that a changed
edge could join) are cut and encoded anew. If the new leaves are as many as the old ones, sums change along
their paths only; otherwise the leaves are spliced and the sums above them built again. Nothing else is
encoded a second time.

The vocabulary is a file of byte-level BPE ranks whose path is a parameter; it is read on the driver once and
reaches the executors by broadcast (about a megabyte).

A run of white space of any length is one token's worth of pre-tokenizing (but for its last character, which may belong
to what follows); runs of `LONG_RUN` characters and more are merged directly, because the library's pattern
matcher gives up on runs of a million.

Defined results: a NULL text is empty; an empty text has one empty leaf and no tokens. Edits are applied in
order, each to the result of the one before. Positions and lengths beyond the text are cut to it. Repeated
rows are documents of their own. Stored leaves that don't add up to the text, or NULL, are made anew. Very long texts are held
whole, with their tree. An empty table gives an empty result. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoplayers.llm.byte_bpe import merge_long, ranks_of

SEGMENT_CHARS = 512
LONG_RUN = 1000
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# --- Fixed values: the pre-tokenizer pattern that belongs to the vocabulary ------------------------
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A cut lies between something that no definition of white space includes and an ASCII white space.
_CUT = re.compile(r"(?<=[^\s\x85])(?=[ \t\n\r])")
# --- Fixed values: white space as the pattern knows it ---------------------------------------------
_SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LONG_SPACE = re.compile(f"[{_SPACES}]{{{LONG_RUN},}}")
LEAVES = "array<struct<chars:long,tokens:long>>"
EDITS = "array<struct<position:long,deleted:long,inserted:string>>"

Counter = Callable[[str], int]


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def token_counter(vocabulary: bytes) -> Counter:
    import tiktoken

    ranks = ranks_of(vocabulary)
    encoding = tiktoken.Encoding("counting", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def count(text: str) -> int:
        total, begin = 0, 0
        for run in _LONG_SPACE.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            total += len(encoding.encode_ordinary(text[begin : run.start()]))
            total += len(merge_long(run[0][: end - run.start()].encode(), ranks))
            begin = end
        return total + len(encoding.encode_ordinary(text[begin:]))

    return count


def cut(text: str, size: int = SEGMENT_CHARS) -> list[str]:
    """Segments of at least `size` characters (but for the last), cut where no token can cross."""
    pieces, begin = [], 0
    while len(text) - begin > size and (found := _CUT.search(text, begin + size)):
        pieces.append(text[begin : found.start()])
        begin = found.start()
    return [*pieces, text[begin:]]


class SegmentTree:
    """Sums of characters and tokens over the segments of one document."""

    def __init__(
        self, text: str, count: Counter, size: int = SEGMENT_CHARS, leaves: Sequence[tuple[int, int]] | None = None
    ):
        """`leaves` are those of an earlier tree over the same text."""
        self.count, self.size = count, size
        self.encoded_chars = 0
        if leaves and sum(chars for chars, _ in leaves) == len(text):
            ends = list(accumulate(chars for chars, _ in leaves))
            self.segments = [text[begin:end] for begin, end in zip([0, *ends], ends)]
            self._build(list(leaves))
        else:
            self.segments = cut(text, size)
            self._build([self._encode(segment) for segment in self.segments])

    def _encode(self, segment: str) -> tuple[int, int]:
        self.encoded_chars += len(segment)
        return len(segment), self.count(segment)

    def _build(self, leaves: list[tuple[int, int]]) -> None:
        self.levels = [leaves]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append(
                [tuple(map(sum, zip(*below[i : i + 2]))) for i in range(0, len(below), 2)]
            )

    @property
    def chars(self) -> int:
        return self.levels[-1][0][0]

    @property
    def tokens(self) -> int:
        return self.levels[-1][0][1]

    def locate(self, position: int) -> tuple[int, int]:
        """The leaf that holds the character at `position` (or the last one) and where the leaf begins."""
        node, begin = 0, 0
        for level in reversed(self.levels[:-1]):
            node *= 2
            if position >= begin + level[node][0] and node + 1 < len(level):
                begin += level[node][0]
                node += 1
        return node, begin

    def edit(self, position: int, deleted: int, inserted: str) -> None:
        position = min(max(position, 0), self.chars)
        end = min(position + max(deleted, 0), self.chars)
        first, begin = self.locate(position)
        last, _ = self.locate(end)
        left, right = max(first - 1, 0), min(last + 1, len(self.segments) - 1)
        if left < first:
            begin -= self.levels[0][left][0]
        region = "".join(self.segments[left : right + 1])
        region = region[: position - begin] + inserted + region[end - begin :]
        # The region must begin and end where no token crosses; context is added until it does.
        while left > 0 and not _CUT.match(self.segments[left - 1][-1:] + region[:1], 1):
            left -= 1
            region = self.segments[left] + region
        while right < len(self.segments) - 1 and not _CUT.match(region[-1:] + self.segments[right + 1][:1], 1):
            right += 1
            region += self.segments[right]
        fresh = cut(region, self.size)
        leaves = [self._encode(segment) for segment in fresh]
        same = len(fresh) == right + 1 - left
        self.segments[left : right + 1] = fresh
        if not same:
            self._build([*self.levels[0][:left], *leaves, *self.levels[0][right + 1 :]])
            return
        self.levels[0][left : right + 1] = leaves
        low, high = left, right
        for below, level in zip(self.levels, self.levels[1:]):
            low, high = low // 2, high // 2
            for node in range(low, high + 1):
                level[node] = tuple(map(sum, zip(*below[2 * node : 2 * node + 2])))


def count_edited(
    docs: DataFrame,
    edits: Column,
    vocabulary: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SEGMENT_CHARS,
    leaves: Column | None = None,
    keep: bool = False,
) -> DataFrame:
    """One row per input row: id, tokens_before, tokens_after, chars_after, segments (the leaves' token
    counts after the edits), reencoded_chars (what the edits made necessary) and encoded_chars (with building the tree).

    `edits` is a column of the docs: an array of (position, deleted, inserted), applied in order. `leaves` is a
    column with the stored leaves of the text. With `keep` come `text_after` and `leaves`, to be stored for the next round.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    long, text_type = T.LongType(), T.StringType()
    fields = {
        "tokens_before": long, "tokens_after": long, "chars_after": long, "segments": T.ArrayType(T.IntegerType()),
        "reencoded_chars": long, "encoded_chars": long,
    }
    if keep:
        fields |= {"text_after": text_type, "leaves": T.DataType.fromDDL(LEAVES)}
    names = list(fields)
    out = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *map(T.StructField, names, fields.values())])
    arrow = to_arrow_schema(out)

    def measure(text: str | None, changes: Sequence[dict] | None, stored: Sequence[dict] | None, count: Counter) -> tuple:
        known = [(leaf["chars"], leaf["tokens"]) for leaf in stored] if stored and all(stored) else None
        tree = SegmentTree(text or "", count, size, known)
        before, encoded = tree.tokens, tree.encoded_chars
        for change in changes or ():
            if change:
                tree.edit(change["position"] or 0, change["deleted"] or 0, change["inserted"] or "")
        result = (
            before, tree.tokens, tree.chars, [tokens for _, tokens in tree.levels[0]],
            tree.encoded_chars - encoded, tree.encoded_chars,
        )
        if keep:
            result += ("".join(tree.segments), [{"chars": chars, "tokens": tokens} for chars, tokens in tree.levels[0]])
        return result

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = token_counter(shared.value)
        for batch in batches:
            rows = [measure(*(cell.as_py() for cell in cells), count) for cells in zip(*batch.columns[1:])]
            columns = zip(*rows) if rows else [()] * len(names)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], arrow.names)

    stored = (F.lit(None) if leaves is None else leaves).cast(LEAVES).alias("stored")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), edits.cast(EDITS).alias("edits"), stored)
    return rows.mapInArrow(run, out).withColumnRenamed("id", id_col)
