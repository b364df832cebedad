"""Session settings, the shared folder, and staging of small intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Dates must not shift with the driver's zone; bad values are handled by try_* functions.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str, **extra: str) -> SparkSession:
    """Session for a job. Master, memory and partition counts come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates are computed in UTC whatever session the caller hands in."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it in spark.checkpoint.dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    # One machine, no folder named: the setting cannot be changed in a running session, the context's folder can.
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stormglass-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; it is dropped when the driver ends."""
    folder = f"{shared_dir(spark)}/stormglass/{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    # Only an existing folder can be marked for deletion.
    file_system.mkdirs(hadoop_path)
    file_system.deleteOnExit(hadoop_path)
    return f"{folder}/{label}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a small derived table once and go on from the files.

    Cuts the lineage to the large scan behind it, survives the loss of executors, and gives
    Catalyst true sizes for its join choices.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
