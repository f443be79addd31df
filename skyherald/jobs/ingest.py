"""spark-submit job: raw notice messages -> notice table, sky-map pixel table, dead letters (one streaming query)."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyherald.operators.notices import dead_letter, notice_row, parse_notices
from skyherald.operators.skymap import complete_skymap, credible_region, region_pixels, skymap_cells
from skyherald.session import build_session
from skyherald.sinks.tables import PARTS, write_batch
from skyherald.sources.tables import raw_notices_files, raw_notices_kafka
from skyherald.streaming.run import ProgressLog, bounded_run
from skyherald.streaming.status import notices_before, number_batch


def store_batch(root: str, time_window: float = 7, test: bool = False, map_nside: int = 4) -> Callable[[DataFrame, int], None]:
    """Parse one micro-batch of messages, once, and write its notices, its dead letters, and the pixels of its maps: all of
    them, and those of the credible regions for the streamed cross-match.

    Only ids and times go through the numbering; texts and maps join their numbers by row id. All tables have the
    batch as their last partition, so a batch repeated after a failure replaces itself.
    """

    def store(raw: DataFrame, batch_id: int) -> None:
        parsed = parse_notices(raw, test=test).withColumn("__id", F.monotonically_increasing_id()).persist()
        rows = notice_row(parsed, with_skymap=True, carry=("__id",))
        try:
            tie = F.xxhash64("ivorn", "observatory", "instrument", "event", "ra", "dec", "err_arcmin")
            narrow = rows.select("__id", "triggerId", "ackTime", "triggerTimejd", tie.alias("tie"), *PARTS)
            earlier = notices_before(narrow, f"{root}/notices", batch_id, time_window)
            numbers = number_batch(narrow, earlier, time_window, tie=F.col("tie")).select("__id", "gcn_status")
            numbered = rows.join(numbers, "__id").drop("__id").persist()
            try:
                write_batch(numbered.drop("skymap"), f"{root}/notices", batch_id)
                if not numbered.filter(F.col("skymap").isNotNull()).isEmpty():
                    pixels = map_pixels(numbered)
                    write_batch(pixels, f"{root}/skymaps", batch_id)
                    write_batch(map_regions(pixels, numbered, map_nside), f"{root}/regions", batch_id)
            finally:
                numbered.unpersist()
            day = {n: F.date_format("ackTime", p) for n, p in zip(PARTS, ("yyyy", "MM", "dd"), strict=True)}
            write_batch(dead_letter(parsed).withColumns(day), f"{root}/dead_letters", batch_id)
        finally:
            parsed.unpersist()

    return store


def map_pixels(notices: DataFrame) -> DataFrame:
    """Pixel rows of notices that carry their map, gaps filled and marked; `ackTime` tells versions of a trigger apart."""
    key = ("triggerId", "gcn_status", "ackTime", *PARTS)
    pixel = F.arrays_zip(F.col("skymap.uniq").alias("uniq"), F.col("skymap.probdensity").alias("probdensity"))
    pixels = (
        notices.filter(F.col("skymap").isNotNull()).select(*key, F.posexplode_outer(pixel).alias("row_idx", "p"))
        .select(*key, "row_idx", "p.uniq", "p.probdensity").filter(F.col("uniq").isNotNull())
    )
    return complete_skymap(pixels, key)


def map_regions(pixels: DataFrame, notices: DataFrame, nside: int) -> DataFrame:
    """The pixels of the credible regions, each with the times of its notice."""
    key = ("triggerId", "gcn_status", "ackTime")
    cells = skymap_cells(credible_region(pixels, key=key), nside, key=key)
    details = notices.select(*key, "observatory", "triggerTimejd", *PARTS)
    return region_pixels(pixels, cells, nside, key).join(details, list(key))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--kafka", help="bootstrap servers")
    p.add_argument("--files", help="folder of (topic, value, timestamp) files instead of Kafka")
    p.add_argument("--out", required=True)
    p.add_argument("--checkpoint", required=True, help="a new folder starts from the first message again")
    p.add_argument("--time-window", type=float, default=7)
    p.add_argument("--test", action="store_true", help="accept mock gravitational-wave events")
    p.add_argument("--exit-after", type=float)
    p.add_argument("--interval", default="30 seconds")
    a = p.parse_args(argv)
    spark = build_session("ingest-notices")
    spark.streams.addListener(ProgressLog(spark, f"{a.out}/progress"))
    raw = raw_notices_files(spark, a.files) if a.files else raw_notices_kafka(spark, a.kafka)
    query = (
        raw.writeStream.queryName("notices").foreachBatch(store_batch(a.out, a.time_window, a.test))
        .option("checkpointLocation", f"{a.checkpoint}/notices").trigger(processingTime=a.interval).start()
    )
    bounded_run(query, a.exit_after)


if __name__ == "__main__":
    main()
