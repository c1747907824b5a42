"""Session construction and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SCRATCH_CONF = "spark.checkpoint.dir"


def build_session(app_name="terrasift", master=None, default_fs=None, shuffle_partitions=None,
                  checkpoint_dir=None, extra=None) -> SparkSession:
    """Session with the settings the operators rely on.

    Executor count, cores and memory belong to ``spark-submit``; only settings
    that change plans are made here. ``default_fs`` becomes
    ``spark.hadoop.fs.defaultFS`` so that paths can be given without a scheme.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # GBK catalogues are common; Spark 4 only accepts that charset with this flag.
        .config("spark.sql.legacy.javaCharsets", "true")
    )
    if master:
        builder = builder.master(master)
    if default_fs:
        builder = builder.config("spark.hadoop.fs.defaultFS", default_fs)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if checkpoint_dir:
        builder = builder.config(SCRATCH_CONF, checkpoint_dir)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder that the driver and all executors share: ``spark.checkpoint.dir``, or else one in the warehouse."""
    root = spark.conf.get(SCRATCH_CONF, None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/terrasift"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; :func:`clear_scratch` removes what is there."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete all staged tables, also those of other sessions that use the folder; True if there were any."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage_table(df, label: str):
    """Write ``df`` to the shared folder as Parquet and read it back.

    Cuts lineage like a checkpoint: what is read afterwards no longer depends
    on any executor, and every later pass sees the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)
