"""Best-fit packing of documents into sequences of several permitted lengths.

A document longer than the largest length is cut into pieces of that length and a rest. Pieces are dealt
at random into groups of about `group_rows`, and every group is packed on its own: with tens of thousands
of pieces a group fills its sequences as well as the whole table would, and no task holds more.

Inside a group pieces go in from the longest to the shortest. A piece goes into the open bin it fills
best, whatever that bin's length. If none has room, a bin opens with the length that costs least per
unit it can still receive,

    cost(length) = overhead + length * (1 + length / attention_length),

a fixed part per sequence, a linear part and attention's quadratic part. At the end every bin shrinks to
the shortest permitted length that holds its contents.

The unit of lengths is whatever `length` counts: words and an end mark unless it says otherwise. A model's
context is counted in tokens, which are more than words: pass a column of token counts (`token_counts` or `byte_bpe`
make them) to fill contexts of that many tokens.

Defined results: without `length`, a document has its number of words plus one for the end mark, so a NULL or
empty text has length 1. Repeated rows are packed as often as they come. Ties are broken by id and piece. Very long
texts are counted whole and cut into pieces. An empty table gives an empty result. Extra columns are not read, whatever
their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoplayers.llm.common import word_count
from shoplayers.session import durable

LENGTHS = (512, 1024, 2048, 4096)
OVERHEAD = 64
ATTENTION_LENGTH = 32768
GROUP_ROWS = 50_000
SEED = 42


def cost(length: int, overhead: int = OVERHEAD, attention_length: int = ATTENTION_LENGTH) -> float:
    return overhead + length * (1 + length / attention_length)


def pack(pieces: Sequence[int], lengths: Sequence[int] = LENGTHS) -> tuple[list[int], list[int], list[int]]:
    """Bins of pieces given from the longest to the shortest, none longer than the largest length.

    Returns the bin and the offset of every piece, and the final length of every bin. Open bins are kept
    by free room: `stacks[r]` lists the bins with room r, and bit r of `rooms` says that there are any.
    """
    lengths = sorted(lengths)
    costs = [cost(length) for length in lengths]
    rooms = 0
    stacks: list[list[int]] = [[] for _ in range(lengths[-1] + 1)]
    capacity: list[int] = []
    used: list[int] = []
    bins, offsets = [], []
    to_come = sum(pieces)
    for piece in pieces:
        fitting = rooms >> piece
        if fitting:
            room = piece + (fitting & -fitting).bit_length() - 1
            chosen = stacks[room].pop()
            if not stacks[room]:
                rooms ^= 1 << room
        else:
            first = bisect_left(lengths, piece)
            best = min(range(first, len(lengths)), key=lambda i: (costs[i] / min(lengths[i], to_come), i))
            room, chosen = lengths[best], len(capacity)
            capacity.append(room)
            used.append(0)
        bins.append(chosen)
        offsets.append(used[chosen])
        used[chosen] += piece
        if left := room - piece:
            stacks[left].append(chosen)
            rooms |= 1 << left
        to_come -= piece
    return bins, offsets, [lengths[bisect_left(lengths, n)] for n in used]


def word_length(text: Column) -> Column:
    """Words and an end mark."""
    return word_count(text) + 1


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    length: Column | None = None,
    lengths: Sequence[int] = LENGTHS,
    group_rows: int = GROUP_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """One row per piece: id, copy (number under repeated rows), piece, start and length in the document,
    bin_id, bin_offset and bin_length."""
    longest = max(lengths)
    length = word_length(F.col("text")) if length is None else length
    # Repeated rows travel as one row with a count and are numbered when they are unfolded.
    measured = docs.select(F.col(id_col).alias("id"), length.cast("long").alias("total"))
    counted = durable(measured.groupBy("id", "total").agg(F.count(F.lit(1)).cast("int").alias("rows")))
    pieces = F.col("rows") * F.ceil(F.col("total") / longest)
    groups = F.greatest(F.lit(1), F.ceil(counted.agg(F.coalesce(F.sum(pieces), F.lit(0))).scalar() / group_rows))
    unfolded = (
        counted.filter("total > 0")
        .select("id", "total", F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("copy"))
        .select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("total") - 1) / longest).cast("int"))).alias("piece"))
        .withColumn("start", F.col("piece").cast("long") * longest)
        .withColumn("length", F.least(F.lit(longest), F.col("total") - F.col("start")).cast("int"))
        .withColumn("group", F.pmod(F.xxhash64(F.lit(seed), "id", "total", "copy", "piece"), groups.cast("long")))
        .select("group", "id", "copy", "piece", "start", "length")
    )

    names = ["copy", "piece", "start", "length", "bin_id", "bin_offset", "bin_length"]
    kinds = [T.IntegerType(), T.IntegerType(), T.LongType(), T.IntegerType(), T.LongType(), T.IntegerType(), T.IntegerType()]
    out = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *map(T.StructField, names, kinds)])
    arrow = to_arrow_schema(out)

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("id", "ascending"), ("start", "ascending"), ("copy", "ascending")])
        bins, offsets, finals = pack(group["length"].to_pylist(), lengths)
        number = np.array(bins, np.int64)
        first = group["group"][0].as_py() << 32
        found = group.select(["id", "copy", "piece", "start", "length"])
        found = found.append_column("bin_id", pa.array(first | number))
        found = found.append_column("bin_offset", pa.array(offsets, pa.int32()))
        return found.append_column("bin_length", pa.array(np.array(finals, np.int32)[number])).cast(arrow)

    packed = unfolded.groupBy("group").applyInArrow(run, out)
    return packed.withColumnRenamed("id", id_col) if id_col != "id" else packed
