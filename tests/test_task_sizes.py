"""What one task or one Python worker holds does not grow with the table."""

import base64

import numpy as np
from pyspark.sql import functions as F

from skyherald.plans.sizing import spread
from skyherald.sources import fits
from workload import derive as dv


def test_spread_bounds_the_rows_of_a_task(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).coalesce(1).write.parquet(path)
    dealt = spread(spark.read.parquet(path), rows_per_task=50)
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 1000 and max(r["count"] for r in sizes) <= 100
    # a few rows: a task for each core, as before
    assert spread(spark.read.parquet(path)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_batches_of_a_worker_are_bounded_in_bytes(spark):
    @F.pandas_udf("long")
    def held(texts):
        return texts.str.len() * 0 + int(texts.str.len().sum())

    texts = spark.range(4000, numPartitions=1).select(F.repeat(F.lit("x"), 12_000).alias("text"))
    assert texts.select(F.max(held("text"))).first()[0] <= 8 << 20


def test_map_texts_are_what_their_pixels_say(spark):
    maps = [[(4 + i, float(i) / 7) for i in range(n)] for n in (1, 3, 180, 181, 400, 3)]
    rows = spark.createDataFrame([(i, m) for i, m in enumerate(maps)], "i int, pixels array<struct<uniq:bigint,probdensity:double>>")
    texts = [r.t for r in rows.coalesce(1).orderBy("i").select(dv.fits_text("pixels").alias("t")).collect()]
    seen = {}
    for text, pixels in zip(texts, maps, strict=True):
        table = fits.read_table(base64.b64decode(text), ["UNIQ", "PROBDENSITY"], seen)
        assert np.array_equal(table["UNIQ"], [u for u, _ in pixels]) and np.array_equal(table["PROBDENSITY"], [d for _, d in pixels])
    # the first blocks are equal, the second ones tell the number of rows
    assert len(seen) == 1 + len({len(m) for m in maps})
