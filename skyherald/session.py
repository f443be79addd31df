"""Session settings that the jobs, the bench and the tests share."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

# What the engine relies on. Cluster sizing (executors, memory, shuffle partitions) stays with spark-submit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a join by (object, alert) takes rows as they lie where they are dealt by the object
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # a notice may repeat a parameter name; the last value wins
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # year/month/day stay strings with their leading zero
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a Python worker holds a batch and what it makes of it: texts of sky maps take kilobytes a row
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to a session that somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for written intermediates, below the cluster's `spark.checkpoint.dir`.

    What is written there is read lazily, so it stays until the folder is cleaned. A local master without that setting
    (tests) gets a temporary folder, removed when the process ends; a cluster without it is an error,
    because a machine-local folder would not be seen by the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        token = spark.sparkContext.applicationId
        stamp = spark.sparkContext._jvm.java.lang.System.nanoTime()
        return f"{root.rstrip('/')}/{purpose}-{token}-{stamp}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix=f"skyherald-{purpose}-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write below the shared folder and read back: cuts the lineage, survives a lost executor, is computed once."""
    path = shared_dir(df.sparkSession, purpose) + "/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
