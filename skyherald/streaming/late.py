"""Rows that a streaming query's watermark refused, found again in the tables it read.

Spark drops a row that is older than the watermark before it reaches a join's state and only counts it. What is needed to
find it again is stored: the checkpoint's source logs say which files a source took in which step, and the progress table
(`ProgressLog`) says which steps a micro-batch took and at what watermark. A row is late when its event time lies before
the watermark of the micro-batch that read its file.

The watermark of a micro-batch is at least the one it drops rows by, so no refused row is missed; some that were still
accepted may be among the late ones, which is why what is made of them is compared with what is stored. Files that no kept
progress row covers (the end of a run that was killed) are compared with the highest watermark known, for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PROGRESS = "batchId long, eventTime struct<watermark: string>, sources array<struct<startOffset: string, endOffset: string>>"


def _same_form(path: Column) -> Column:
    """File paths as URIs of one form: `file:/a` and `file:///a` are the same file."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def file_watermarks(spark: SparkSession, checkpoint: str, progress: DataFrame, query: str) -> DataFrame:
    """(file, watermark) of every file that the query with this checkpoint and name has read."""
    p = progress.filter(F.col("query") == query).select(F.from_json("body", _PROGRESS).alias("p")).select("p.*")
    p = p.withColumn("watermark", F.to_timestamp("eventTime.watermark"))
    step = lambda offset: F.get_json_object(offset, "$.logOffset").cast("long")
    steps = p.select("watermark", F.posexplode("sources").alias("source", "at")).select(
        "watermark", F.col("source").cast("long").alias("source"),
        (F.coalesce(step(F.col("at.startOffset")), F.lit(-1)) + 1).alias("first"), step(F.col("at.endOffset")).alias("last"),
    )
    # an offset is a step of the source's own log; a micro-batch without new files takes none
    steps = steps.filter(F.col("last") >= F.col("first")).select(
        "source", F.explode(F.sequence("first", "last")).alias("step"), "watermark"
    )
    steps = steps.groupBy("source", "step").agg(F.max("watermark").alias("watermark"))
    log = spark.read.text(f"{checkpoint}/sources/*/*").filter(F.col("value").startswith("{"))
    entry = F.from_json("value", "path string, batchId long")
    source = F.regexp_extract(F.col("_metadata.file_path"), r"/sources/(\d+)/[^/]+$", 1).cast("long")
    files = log.select(source.alias("source"), entry.alias("e")).select(
        "source", F.col("e.batchId").alias("step"), _same_form(F.col("e.path")).alias("file")
    )
    highest = p.agg(F.max("watermark")).first()[0]
    known = files.join(steps, ["source", "step"], "left")
    # a log's compacted files repeat entries
    return known.groupBy("file").agg(F.max(F.coalesce("watermark", F.lit(highest))).alias("watermark"))


def late_rows(table: DataFrame, event_time: Column, watermarks: DataFrame) -> DataFrame:
    """The rows of a table's files, with all their columns, that came after the watermark had passed them.

    `table` reads the files a source of the stream read. Rows meet their file's watermark by its name: the list of
    files is small beside them and joined as its size allows.
    """
    rows = table.withColumns({"__file": _same_form(F.col("_metadata.file_path")), "__at": event_time})
    marks = watermarks.withColumnRenamed("file", "__file")
    late = rows.join(marks, "__file").filter(F.col("__at") < F.col("watermark"))
    return late.select(*table.columns)
