"""Session settings and the shared scratch area."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator relies on (UTC hours above all)."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, **extra: str) -> SparkSession:
    """Session for tests and the bench; on a cluster the submitter brings its own."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("gridcast")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(cores))
               .config("spark.driver.memory", "16g"))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: the one the session names in spark.checkpoint.dir.

    Only a local-mode session without the setting gets a folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="gridcast-", dir=os.environ.get("TMPDIR", "/tmp"))
    context.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back.

    Cuts the lineage at a columnar table, so that later passes prune columns, know the
    table's size, and survive the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(spark: SparkSession, path: str) -> None:
    """Delete a folder of the scratch area."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Collect the driver's garbage. Shuffle files, cached blocks and broadcasts go only with the objects that stand for them
    in the driver, and a driver with little to do collects these late."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
