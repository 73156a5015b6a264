"""Session defaults and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(app_name: str = "textloom", master: str | None = None, **conf: str) -> SparkSession:
    """The running session, or a new one with the settings the jobs rely on."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Only a local session without one gets a folder of its own, in its warehouse; a cluster has to name a
    folder that every executor can reach.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    spark.sparkContext.setCheckpointDir(f"{warehouse}/textloom-scratch")
    return spark.sparkContext.getCheckpointDir()


def job_dir(spark: SparkSession) -> str:
    """The part of the scratch folder that belongs to this application."""
    return f"{scratch_dir(spark).rstrip('/')}/textloom/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch folder."""
    return f"{job_dir(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's stored tables, once no frame built on them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(job_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the scratch folder and read it back.

    Used where a result feeds several jobs: it is computed once, survives lost executors and is
    read back column by column.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_path = path
    return table


def stored_small(df: DataFrame, label: str) -> DataFrame:
    """``stored`` for rows of a corpus: packed more tightly, and shuffle files of the writing job go when it ends."""
    spark = df.sparkSession
    kept = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return stored(df, label, "zstd")
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if kept is None else spark.conf.set(SHUFFLE_CLEANUP, kept)


def discard(table: DataFrame) -> None:
    """Delete a stored table that no frame still to be run reads; other frames are left alone."""
    if path := getattr(table, "_stored_path", None):
        spark = table.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of an input whose splits would leave half of the cores idle.

    All larger inputs are returned as they are, so no large text is shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df
