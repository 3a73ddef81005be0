"""Multi-line CSV read by many tasks: files cut at the ends of records, wherever line breaks are quoted.

Whether a line break ends a record depends on the number of quotes before it in the file. A file is read in blocks, as any
text is. Every block counts its quotes; the parities of the blocks before, one row per block, say whether a block begins
inside a quoted cell. With that, each block finds its own records. What it holds of a record that began in an earlier
block, or goes on in a later one, is a fragment: only fragments move, to be joined in the order of their blocks.

A quote and a line feed are single bytes that no other character of the encoding contains, which holds for UTF-8, GB18030
and its subsets, and all single-byte encodings. Lines are handled as bytes and decoded once a record is whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from shoplayers.functions.sizes import BROADCAST_BYTES, small, stored_if_small
from shoplayers.session import durable, stored

SELF_SYNCHRONISING = ("UTF-8", "US-ASCII", "ISO-8859-1", "GB18030", "GBK", "GB2312")
WHOLE, BEGINS, GOES_ON, ENDS = range(4)
_RECORDS = "file string, block long, nth long, kind int, record binary"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Physical lines as bytes with their file, the block they begin in, and their number of quotes."""
    value = F.col("value")
    quotes = F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"'), F.lit("")))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        quotes.alias("quotes"),
        value.cast("binary").alias("line"),
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and fragments of records from lines that come block by block, in order.

    `nth` numbers the records that begin in a block; a fragment that goes on has the number 0.
    """
    here: tuple | None = None
    held: list[bytes] = []  # lines of an unfinished record
    began = False  # whether that record began in this block
    nth = 0
    rows: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "block", "nth", "kind", "record"])

    def close(finished: bool) -> None:
        nonlocal held, nth
        if not held:
            return
        if began:
            nth += 1
        kind = (WHOLE if finished else BEGINS) if began else (ENDS if finished else GOES_ON)
        rows.append((*here, nth if began else 0, kind, b"\n".join(held)))
        held = []

    for batch in batches:
        files, blocks, quotes, odds = (batch.column(name).to_pylist() for name in ("file", "block", "quotes", "odd"))
        lines = batch.column("line")
        for at in range(len(files)):
            if (files[at], blocks[at]) != here:
                if here is not None:
                    close(False)
                here, nth = (files[at], blocks[at]), 0
                inside, began = bool(odds[at]), not odds[at]
            line = lines[at].as_py()
            open_after = inside ^ bool(quotes[at] & 1)
            if not inside:
                began = True
                if not open_after and not line.strip(b"\r"):
                    continue  # an empty line is no record
            held.append(line)
            inside = open_after
            if not inside:
                close(True)
                began = True
        yield flush()
    if here is not None:
        close(False)
        yield flush()


def read_records(spark: SparkSession, path: str | list[str], broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(file, block, nth, record) of every record: where it begins, and its bytes without the last line feed.

    Lines are read twice, first for their quotes alone. Pieces are stored, so that later steps read them once each.
    """
    lines = _lines(spark, path)
    counted = durable(lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes")))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    odd = (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).cast("int")
    parities, fits = stored_if_small(counted.select("file", "block", odd.alias("odd")), broadcast_bytes)
    if fits:  # lines stay where they are, and in order
        marked = lines.join(F.broadcast(parities), ["file", "block"])
    else:
        marked = lines.join(parities, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "at")
    pieces = stored(marked.select("file", "block", "quotes", "odd", "line").mapInArrow(_pieces, _RECORDS))
    whole = pieces.filter(F.col("kind") == WHOLE).select("file", "block", "nth", "record")
    # One fragment or two a block: what belongs together begins with the same record.
    order = W.partitionBy("file").orderBy("block", F.when(F.col("kind") == BEGINS, 1).otherwise(0))
    begun = F.sum(F.when(F.col("kind") == BEGINS, 1).otherwise(0)).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    parts = pieces.filter(F.col("kind") != WHOLE).withColumn("_of", begun)
    parts = parts.groupBy("file", "_of").agg(
        F.min("block").alias("block"),
        F.max("nth").alias("nth"),
        F.sort_array(F.collect_list(F.struct("block", "record"))).alias("parts"),
    )
    feed = F.lit(b"\n")
    joined = F.aggregate(
        "parts", F.lit(None).cast("binary"), lambda whole, part: F.coalesce(F.concat(whole, feed, part["record"]), part["record"])
    )
    return whole.unionByName(parts.select("file", "block", "nth", joined.alias("record")))


def read_quoted_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, encoding: str, options: dict[str, str]
) -> DataFrame:
    """CSV records with their declared types and `ingest_id`: their number by file name and place in the file.

    The first record of a file is its header. One number per block is what places the records.
    """
    records = read_records(spark, path)
    counts = durable(records.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n")))
    by_file = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n").over(by_file), F.lit(0))  # records of the file before the block
    files = W.orderBy("file", "block").rowsBetween(W.unboundedPreceding, -1)
    headers = F.dense_rank().over(W.orderBy("file"))
    begins = counts.select(
        "file", "block", first.alias("_first"), (F.coalesce(F.sum("n").over(files), F.lit(0)) - headers).alias("_begin")
    )
    placed = records.join(small(begins), ["file", "block"]).filter(F.col("_first") + F.col("nth") > 1)
    text = F.regexp_replace(F.decode("record", encoding), "\r$", "")
    cells = F.from_csv(text, schema.simpleString()[len("struct<") : -1].replace(":", " "), options)
    parsed = placed.select((F.col("_begin") + F.col("nth") - 1).alias("ingest_id"), cells.alias("c"))
    return parsed.select("ingest_id", *[F.col("c").getField(name).alias(name) for name in schema.names])
