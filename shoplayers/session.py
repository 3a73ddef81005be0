"""Session settings and durable intermediate results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "shoplayers", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; `conf` keys use `_` for `.`."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for durable intermediate results, one per application.

    The cluster names it in `spark.checkpoint.dir`. Where that is unset, as in tests, a folder in the
    warehouse takes its place, which driver and executors share as well.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(shared or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints")
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder once, so a lost executor cannot change its rows.

    For narrow tables: rows are kept in Spark's own form, and Spark deletes them with their last reader.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Keep `df` as Parquet in the checkpoint folder: compressed, and readers take the columns they need.

    For tables with texts. The folder belongs to the application; whoever owns it cleans it up.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate results that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
