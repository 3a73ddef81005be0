"""File sources, layer tables and report sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window as W, functions as F, types as T

from shoplayers.functions.columns import clean_label
from shoplayers.functions.sizes import small
from shoplayers.operators.cleaning import keep_first
from shoplayers.sources import schemas
from shoplayers.sources.quoted import SELF_SYNCHRONISING, read_quoted_csv

BOM = "\ufeff"
CORRUPT = "_corrupt_record"


CSV_OPTIONS = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": CORRUPT}


def _allow(spark: SparkSession, encoding: str) -> None:
    """Encodings outside Spark's short list need a setting, which is made where it is missing."""
    if encoding.upper() not in {"UTF-8", "US-ASCII", "ISO-8859-1", "UTF-16", "UTF-16BE", "UTF-16LE", "UTF-32"}:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")


def _csv(spark: SparkSession, path: str | list[str], schema: T.StructType, encoding: str, multi_line: bool) -> DataFrame:
    _allow(spark, encoding)
    options = CSV_OPTIONS | {"header": True, "encoding": encoding, "multiLine": multi_line}
    return spark.read.schema(schema).options(**options).csv(path)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> DataFrame:
    """CSV files with a header, declared types and a declared text encoding, plus `ingest_id`.

    `ingest_id` numbers the rows by file name, place of the split in its file and place in the split,
    whatever order Spark reads splits in. Only the number of rows per split is needed for that: one row a split, which
    is broadcast behind a check of its size, so the rows themselves never move. `multi_line` keeps quoted line breaks; such
    files are cut at the ends of records and read by many tasks (`quoted`), except in encodings of two bytes or more
    a character, where each file is one task's.
    """
    if multi_line and encoding.upper() in SELF_SYNCHRONISING:
        _allow(spark, encoding)
        return read_quoted_csv(spark, path, schema, encoding, CSV_OPTIONS)
    rows = _csv(spark, path, schema, encoding, multi_line).select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    splits = rows.groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = W.orderBy("_file", "_block").rowsBetween(W.unboundedPreceding, -1)
    begins = splits.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_begin"))
    placed = rows.join(small(begins), ["_file", "_block"])
    return placed.select((F.col("_begin") + F.col("_at") - F.col("_first")).alias("ingest_id"), *schema.names)


def malformed_records(
    spark: SparkSession, path: str | list[str], schema: T.StructType, encoding: str = "UTF-8", multi_line: bool = False
) -> DataFrame:
    """(file, record) of every record with a cell that does not have its declared type.

    Reading turns such a cell into NULL; this is the trace of it.
    """
    watched = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = _csv(spark, path, watched, encoding, multi_line).select("*", F.col("_metadata.file_path").alias("file"))
    parsed = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in schema.names])) >= 0  # makes Spark parse the cells
    return rows.filter(F.col(CORRUPT).isNotNull() & parsed).select("file", F.col(CORRUPT).alias("record"))


@dataclass(frozen=True)
class Source:
    """One file source and how it becomes a table."""

    table: str
    path: str
    schema: T.StructType
    encoding: str = "UTF-8"
    multi_line: bool = False
    keys: Sequence[str] = ()
    cleaners: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)


def standard_sources(behaviour: str, comments: str, categories: str, profiles: str) -> list[Source]:
    """The four sources of the warehouse: a GB18030 behaviour log and three UTF-8 files.

    The log is read line by line; a log whose comments hold line breaks needs `dataclasses.replace(source,
    multi_line=True)`. Comments are read with them. Either way a large file is split over many tasks.
    """
    return [
        Source("ods_user_behavior", behaviour, schemas.BEHAVIOUR_FILE, "GB18030"),
        Source("ods_comment", comments, schemas.COMMENT_FILE, multi_line=True),
        Source("dim_category", categories, schemas.CATEGORY_FILE, keys=("category_id",)),
        Source("dim_user_profile", profiles, schemas.PROFILE_FILE, keys=("user_id",), cleaners={"face": clean_label}),
    ]


def null_counts(table: str) -> dict[str, Column]:
    """NULLs per column of a table that must have none, as measures of its writing job."""
    return {f"null:{c}": F.count_if(F.col(c).isNull()) for c in schemas.NOT_NULL.get(table, ())}


class LayerTables:
    """Parquet tables under one root, each fully replaced by a load.

    A load writes a folder of its own; readers take the newest folder whose job has committed.
    A failed load therefore leaves the table as it was, and a repeated load never doubles rows. The
    Hadoop file system is reached through the session's JVM, so this class needs a classic session.
    """

    def __init__(self, spark: SparkSession, root: str, keep_loads: int = 2):
        """`keep_loads` committed loads of a table stay, at least one: readers may still be on the last but one."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep_loads = max(1, keep_loads)
        self.observed: dict[str, dict[str, object]] = {}

    def _folder(self, path: str):
        jvm_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm_path

    def loads(self, table: str) -> list[str]:
        """Committed loads of a table, oldest first."""
        fs, path = self._folder(f"{self.root}/{table}")
        if not fs.exists(path):
            return []
        names = sorted(status.getPath().getName() for status in fs.listStatus(path))
        done = []
        for name in names:
            marker_fs, marker = self._folder(f"{self.root}/{table}/{name}/_SUCCESS")
            if marker_fs.exists(marker):
                done.append(name)
        return done

    def write(
        self, df: DataFrame, table: str, partition_by: str | None = None, measures: Mapping[str, Column] | None = None
    ) -> int:
        """Replace a table; returns the rows written.

        Rows, and the aggregates of `measures`, are counted by the job that writes them: they are in
        `observed[table]` afterwards, and nothing is read again for them. Partitioned tables are rebalanced on the
        partition column first: small partitions share a task, and one that holds many rows is split over several
        tasks and files.
        """
        stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        path = f"{self.root}/{table}/load-{stamp}-{uuid.uuid4().hex[:8]}"
        watch = Observation()
        rows = df.hint("rebalance", F.col(partition_by)) if partition_by else df
        values = [value.alias(name) for name, value in (measures or {}).items()]
        writer = rows.observe(watch, F.count(F.lit(1)).alias("rows"), *values).write
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        for old in self.loads(table)[: -self.keep_loads]:
            fs, folder = self._folder(f"{self.root}/{table}/{old}")
            fs.delete(folder, True)
        self.observed[table] = {"rows": 0} | watch.get
        return self.observed[table]["rows"]

    def read(self, table: str) -> DataFrame:
        loads = self.loads(table)
        if not loads:
            raise FileNotFoundError(f"no committed load of {table} under {self.root}")
        return self.spark.read.parquet(f"{self.root}/{table}/{loads[-1]}")

    def load(self, sources: Iterable[Source], only: set[str] | None = None) -> dict[str, int]:
        """Load the sources (or only the named tables) and return the rows written per table."""
        counts = {}
        for source in sources:
            if only and source.table not in only:
                continue
            rows = read_csv(self.spark, source.path, source.schema, source.encoding, source.multi_line)
            for column, cleaner in source.cleaners.items():
                rows = rows.withColumn(column, cleaner(F.col(column)))
            if source.keys:
                rows = keep_first(rows, source.keys).drop("ingest_id")
            counts[source.table] = self.write(rows, source.table, measures=null_counts(source.table))
        return counts

    def row_counts(self, tables: Iterable[str]) -> DataFrame:
        """Rows now readable per table, to compare with what the load reported."""
        frames = [
            self.read(t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("rows_cnt")) for t in tables
        ]
        result = frames[0]
        for frame in frames[1:]:
            result = result.unionByName(frame)
        return result


def write_report(df: DataFrame, path: str, single_file: bool = True) -> None:
    """CSV with a byte-order mark in the header, so that spreadsheets read it as UTF-8.

    `single_file` is for small report results; row-level exports pass False and get one file
    (with its own header) per task.
    """
    first, *rest = df.columns
    marked = df.withColumnRenamed(first, BOM + first)
    if single_file:
        marked = marked.coalesce(1)
    marked.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_gold_csv(spark: SparkSession, path: str) -> DataFrame:
    """The sheet people filled in, with its key types forced."""
    return read_csv(spark, path, schemas.GOLD_FILE, multi_line=True).drop("ingest_id")


def cache_scores(scored: DataFrame, tables: LayerTables, table: str = "scored_reviews") -> int:
    """Keep scored reviews for later jobs without the bulky helper columns."""
    return tables.write(scored.drop("words", "norm"), table)
