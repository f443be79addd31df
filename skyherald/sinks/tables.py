"""Writers of the tables and topics."""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

PARTS = ("year", "month", "day")


def write_partitioned(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write below year / month / day. "overwrite" replaces only the days that are written, so that a rerun of a
    night does not duplicate it; "append" adds files."""
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write a micro-batch below year / month / day / batch, so that a repeated batch replaces itself and no other."""
    rows = df.withColumn("batch", F.lit(batch_id).cast("long"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS, "batch").parquet(path)


def existing_days(spark: SparkSession, path: str, days: Iterable[datetime.date]) -> list[str]:
    """The folders of these days that a partitioned table has: listing a table of years is left out."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out = []
    for d in sorted(days):
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/year={d:%Y}/month={d:%m}/day={d:%d}")
        if folder.getFileSystem(conf).exists(folder):
            out.append(folder.toString())
    return out


def stream_partitioned(
    df: DataFrame, path: str, checkpoint: str, interval: str | None = "30 seconds", name: str | None = None
) -> StreamingQuery:
    """Append a stream below year / month / day; without an interval, take what is there and stop."""
    writer = df.writeStream.outputMode("append").format("parquet").partitionBy(*PARTS)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def write_topics(records: DataFrame, path: str, batch_id: int | None = None) -> None:
    """(topic, key, value) rows as one folder per topic; a batch id makes a replayed batch replace itself."""
    if batch_id is None:
        records.write.mode("append").partitionBy("topic").parquet(path)
        return
    (
        records.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("topic", "batch").parquet(path)
    )


def write_kafka(records: DataFrame, servers: str, **options) -> None:
    """The same rows to a message broker. Needs Spark's Kafka package on the class path."""
    records.select("topic", "key", "value").write.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, **options}
    ).save()
