"""Numbering of notice updates on a stream: the notice table itself is the state."""

from __future__ import annotations

import datetime
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyherald.operators.notices import is_fresh, notice_status
from skyherald.sinks.tables import PARTS, existing_days, write_batch


def number_batch(
    rows: DataFrame, earlier: DataFrame | None, time_window: float = 7, key: str = "triggerId", ack: str = "ackTime",
    tie: Column | None = None,
) -> DataFrame:
    """Add `gcn_status` to the notices of a micro-batch; `earlier` has the notices of the batches before.

    Notices count in the order of arrival: batches one after another, a batch's rows by (ack, tie). Nothing is dropped for
    being late, and the number of a trigger's rows does not matter (`running`).
    """
    received = None
    if earlier is not None:
        received = (
            earlier.filter(is_fresh(time_window, ack)).join(rows.select(key).distinct(), key, "left_semi")
            .groupBy(key).agg(F.count(F.lit(1)).alias("received"))
        )
    return notice_status(rows, time_window, key, ack, tie, received)


def notices_before(rows: DataFrame, table: str, batch_id: int, time_window: float = 7) -> DataFrame | None:
    """Stored notices of earlier batches, from the days around those of `rows` only.

    A notice lies under its trigger's day, which later notices may shift by less than the window. The days of a batch
    are collected: at most one row per day.
    """
    reach = datetime.timedelta(days=math.ceil(time_window) + 1)
    days = set()
    for r in rows.select(*PARTS).distinct().collect():
        day = datetime.date(*(int(r[p]) for p in PARTS))
        days |= {day + datetime.timedelta(days=d) for d in range(-reach.days, reach.days + 1)}
    paths = existing_days(rows.sparkSession, table, days)
    if not paths:
        return None
    schema = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in ("triggerId", "ackTime", "triggerTimejd")])
    stored = rows.sparkSession.read.schema(schema.add("batch", "long")).option("basePath", table).parquet(*paths)
    return stored.filter(F.col("batch") < batch_id)


def numbered_sink(table: str, time_window: float = 7, tie: Column | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that numbers a stream of notices and writes it to a table by day and batch.

    A batch that is repeated after a failure sees the batches before it only and replaces its own rows.
    """

    def store(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            earlier = notices_before(rows, table, batch_id, time_window)
            write_batch(number_batch(rows, earlier, time_window, tie=tie), table, batch_id)
        finally:
            rows.unpersist()

    return store
