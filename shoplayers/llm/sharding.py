"""Two-pass external shuffle into shards.

Pass one scatters records into buckets by a seeded hash of id and text. There are as many buckets as it
takes for one to fit in a task's memory (`bucket_bytes`); their number comes from the measured sizes. A
count per bucket (a few numbers a bucket) turns into the position at which each bucket begins.

Pass two reads one bucket per group, puts it into a fixed order and shuffles it with Fisher-Yates, seeded
by seed and bucket. Position in the shuffled table = start of the bucket + place in it, and consecutive
stretches of positions are the shards: their row counts differ by one at most (law `rows`). Records are
written as Parquet, partitioned by shard, with their slot. Same input, same seed: same shards.

Copies of one text have different ids and so different buckets. Rows that agree in both id and text share a
bucket.

Defined results: a NULL text has no bytes, size 1 and the checksum of nothing. Repeated rows are records of
their own. An empty table gives an empty result. With fewer records than shards some shards stay empty. A very long text
is moved whole; a bucket is never smaller than its longest text. Ties do not occur. Extra columns are not read,
whatever their names.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoplayers.session import durable, ensure_checkpoint_dir

SHARDS = 8
SEED = 42
BUCKET_BYTES = 32 << 20


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def fisher_yates(count: int, rng: np.random.Generator) -> np.ndarray:
    """A uniformly random order of `count` places: every place swaps with one not yet left behind."""
    order = np.arange(count)
    picks = rng.integers(np.arange(count), count) if count else np.empty(0, int)
    for place, pick in enumerate(picks.tolist()):
        order[place], order[pick] = order[pick], order[place]
    return order


def shuffle_into_shards(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Write `docs` to `folder`, partitioned by shard, and return what can be read there: id, text, slot, shard.

    A shard is read in order by sorting its files by slot.
    """
    size = record_size(F.col(text_col))
    total = docs.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()["bytes"]
    buckets = max(1, -(-total // bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), F.lit(buckets))
    scattered = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), bucket.alias("bucket"))

    # One row a bucket: where it begins. `spans` is bounded by the number of buckets.
    counts = scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))
    ordered = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = durable(counts.withColumn("start", F.coalesce(F.sum("rows").over(ordered), F.lit(0))))
    records = starts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()["rows"]
    smaller, longer = divmod(records, shards)
    kind = docs.schema[id_col].dataType
    out = T.StructType(
        [
            T.StructField("id", kind),
            T.StructField("text", T.StringType()),
            T.StructField("slot", T.LongType()),
            T.StructField("shard", T.IntegerType()),
        ]
    )

    arrow = to_arrow_schema(out)

    def run(bucket: pa.Table) -> pa.Table:
        fixed = bucket.sort_by([("id", "ascending"), ("text", "ascending")])
        order = fisher_yates(len(fixed), np.random.default_rng([seed, fixed["bucket"][0].as_py()]))
        position = fixed["start"][0].as_py() + np.arange(len(fixed))
        edge = longer * (smaller + 1)
        shard = np.where(position < edge, position // (smaller + 1), longer + (position - edge) // max(smaller, 1))
        slot = position - shard * smaller - np.minimum(shard, longer)
        shuffled = fixed.select(["id", "text"]).take(pa.array(order))
        return shuffled.append_column("slot", pa.array(slot)).append_column("shard", pa.array(shard, pa.int32())).cast(arrow)

    placed = scattered.join(starts.select("bucket", "start"), "bucket")
    shuffled = placed.groupBy("bucket").applyInArrow(run, out)
    shuffled.write.partitionBy("shard").parquet(folder)
    return docs.sparkSession.read.schema(out).parquet(folder)


def digests(written: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per record read back: id, size, text_crc32, law, shard, slot, grown_shard."""
    return written.select(
        F.col("id").alias(id_col),
        record_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def new_folder(spark: SparkSession) -> str:
    """A folder of its own in the shared place."""
    return f"{ensure_checkpoint_dir(spark)}/shards-{uuid.uuid4().hex}"
