"""Files in, tables out: the given tables written as source files and read back by the loaders.

Everything goes to a new folder in the shared place, in several files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplayers.functions.columns import clean_label
from shoplayers.plans import warehouse
from shoplayers.session import ensure_checkpoint_dir
from shoplayers.sources import schemas, views
from shoplayers.sources.files import (
    BOM, LayerTables, Source, cache_scores, malformed_records, read_csv, read_gold_csv, write_report,
)

ROWS_PER_FILE = 20_000
# A cell with a line break, quotes and Chinese text, and the text NA, which is no missing value.
COMMENT = """CASE WHEN ingest_id % 7 = 0 THEN concat('第一行', chr(10), 'says "', ingest_id, '"') WHEN ingest_id % 7 = 1 THEN 'NA' END"""


def new_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"


def _write(df: DataFrame, path: str, encoding: str = "UTF-8", order: str | None = None) -> str:
    """CSV with a header in as many files as the rows need; with `order`, names and places follow that column."""
    df.sparkSession.conf.set("spark.sql.legacy.javaCharsets", "true")
    spread = df.repartitionByRange(order).sortWithinPartitions(order) if order else df
    (spread.drop(order) if order else spread).write.options(
        maxRecordsPerFile=ROWS_PER_FILE, header=True, encoding=encoding, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path


def _log(spark: SparkSession, folder: str) -> DataFrame:
    return views.behaviour(spark, folder).withColumn("comment", F.expr(COMMENT))


def behaviour_file(spark: SparkSession, folder: str) -> DataFrame:
    """A GB18030 log with quoted line breaks, read back."""
    path = _write(_log(spark, folder), f"{new_folder(spark)}/log", "GB18030", order="ingest_id")
    return read_csv(spark, path, schemas.BEHAVIOUR_FILE, "GB18030", multi_line=True)


def _profile_source(spark: SparkSession, folder: str, root: str) -> Source:
    path = _write(views.profile_raw(spark, folder), f"{root}/profiles", order="ingest_id")
    return Source("dim_user_profile", path, schemas.PROFILE_FILE, keys=("user_id",), cleaners={"face": clean_label})


def _category_source(spark: SparkSession, folder: str, root: str) -> Source:
    path = _write(views.category_raw(spark, folder), f"{root}/categories", order="ingest_id")
    return Source("dim_category", path, schemas.CATEGORY_FILE, keys=("category_id",))


def _log_source(spark: SparkSession, folder: str, root: str) -> Source:
    path = _write(views.behaviour(spark, folder), f"{root}/log", "GB18030", order="ingest_id")
    return Source("ods_user_behavior", path, schemas.BEHAVIOUR_FILE, "GB18030")


def dimension_load(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles from several files: cleaned, the first row of a user kept, loaded twice."""
    root = new_folder(spark)
    tables, source = LayerTables(spark, f"{root}/layers"), _profile_source(spark, folder, root)
    tables.load([source])
    tables.load([source])
    return tables.read("dim_user_profile")


def overwritten_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log loaded three times: rows readable, loads kept."""
    root = new_folder(spark)
    tables, source = LayerTables(spark, f"{root}/layers", keep_loads=2), _log_source(spark, folder, root)
    for _ in range(3):
        tables.load([source])
    kept = F.lit(len(tables.loads("ods_user_behavior"))).alias("loads_kept")
    return tables.read("ods_user_behavior").agg(F.count(F.lit(1)).alias("rows_cnt"), kept)


def _all_sources(spark: SparkSession, folder: str, root: str) -> list[Source]:
    return [f(spark, folder, root) for f in (_log_source, _profile_source, _category_source)]


def named_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Loads per table after loading two of three by name."""
    root = new_folder(spark)
    tables, sources = LayerTables(spark, f"{root}/layers"), _all_sources(spark, folder, root)
    tables.load(sources, only={"dim_user_profile", "dim_category"})
    loads = [F.struct(F.lit(s.table).alias("table_name"), F.lit(len(tables.loads(s.table))).alias("loads")) for s in sources]
    return spark.range(1).select(F.inline(F.array(*loads)))


def loaded_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per table after a load of everything."""
    root = new_folder(spark)
    tables, sources = LayerTables(spark, f"{root}/layers"), _all_sources(spark, folder, root)
    tables.load(sources)
    return tables.row_counts([s.table for s in sources])


def numbered_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log read line by line from several files: numbers follow file and place."""
    path = _write(views.behaviour(spark, folder), f"{new_folder(spark)}/log", order="ingest_id")
    return read_csv(spark, path, schemas.BEHAVIOUR_FILE).select("ingest_id", "user_id", "goods_id", "behavior", "timestamp")


def malformed_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Records of a log in which every 50th amount is no number."""
    broken = views.behaviour(spark, folder).withColumn(
        "amount", F.when(F.col("ingest_id") % 50 == 0, F.lit("many")).otherwise(F.col("amount").cast("string"))
    )
    path = _write(broken, f"{new_folder(spark)}/log", order="ingest_id")
    return malformed_records(spark, path, schemas.BEHAVIOUR_FILE).agg(F.count(F.lit(1)).alias("records"))


def one_day_of_detail(spark: SparkSession, folder: str, day: str) -> DataFrame:
    """The detail layer written by day, and one day read: rows, days in the files read, and days in the table."""
    tables = LayerTables(spark, new_folder(spark))
    tables.write(warehouse.build_dwd(views.behaviour(spark, folder)), "dwd_user_behavior", "event_date")
    detail = tables.read("dwd_user_behavior")
    in_path = F.regexp_extract(F.col("_metadata.file_path"), "event_date=([^/]+)", 1)
    days = detail.select("event_date").distinct().agg(F.count(F.lit(1))).scalar()
    read = detail.filter(F.col("event_date") == F.lit(day).cast("date")).select("user_id", in_path.alias("day"))
    return read.agg(
        F.count(F.lit(1)).alias("rows_cnt"),
        F.count_distinct("user_id").alias("users"),
        F.min("day").alias("first_day_read"),
        F.max("day").alias("last_day_read"),
    ).withColumn("days_stored", days)


def report_file(spark: SparkSession, report: DataFrame) -> DataFrame:
    """Lines of a written report, and whether its file begins with the byte-order mark."""
    path = f"{new_folder(spark)}/report"
    write_report(report, path)
    content = F.decode(F.col("content"), "UTF-8")
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
        .select(F.startswith(content, F.lit(BOM)).alias("has_mark"), F.explode(F.split(content, "\n")).alias("line"))
        .filter("line <> ''")
        .withColumn("line", F.replace("line", F.lit(BOM), F.lit("")))
    )


def score_cache(spark: SparkSession, scored: DataFrame) -> DataFrame:
    """Scored reviews from the cache."""
    tables = LayerTables(spark, new_folder(spark))
    cache_scores(scored, tables)
    return tables.read("scored_reviews")


def gold_file(spark: SparkSession, sheet: DataFrame) -> DataFrame:
    """The labelling sheet written as CSV and read with its types forced."""
    return read_gold_csv(spark, _write(sheet, f"{new_folder(spark)}/gold"))
