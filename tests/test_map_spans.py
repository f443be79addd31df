"""The time stretches of the map join, and derived rows that are made without arrays or decimals."""

import random

from pyspark.sql import functions as F

from skyherald.operators.regions import with_trigger_spans
from workload import derive as dv
from workload.queries import rnd


def test_a_pair_shares_one_stretch_and_few_others_do(spark):
    r = random.Random(5)
    triggers = [float(i) / 4 for i in range(0, 160)]
    taken = [r.uniform(0, 40) for _ in range(150)] + [t + 7.0 for t in triggers[:40]] + [t for t in triggers[:20]]
    alerts = spark.createDataFrame([(i, t - r.choice((0.0, 0.3, -2.0)), t) for i, t in enumerate(taken)], "a int, jdstarthist double, jd double")
    notices = spark.createDataFrame([(i, t) for i, t in enumerate(triggers)], "n int, triggerTimejd double")
    pair = (F.col("jdstarthist") > F.col("triggerTimejd")) & (F.col("jd") <= F.col("triggerTimejd") + 7.0)
    left, right, key = with_trigger_spans(alerts, notices, 7.0)
    met = left.join(right, key)
    want = {tuple(r) for r in alerts.crossJoin(notices).filter(pair).select("a", "n").collect()}
    found = [tuple(r) for r in met.filter(pair).select("a", "n").collect()]
    assert len(found) == len(set(found)) and set(found) == want
    # an alert meets the notices of 8.75 days and what rounding adds, not of 14
    assert met.count() < 1.5 * len(want)


def test_pixel_rows_are_those_of_the_arrays_and_made_without_them(spark, sf):
    rows = dv.skymap_pixels(spark, sf)
    arrays = dv.map_notices(spark, sf).select("triggerId", "gcn_status", F.posexplode("pixels").alias("row_idx", "p")).select(
        "triggerId", "gcn_status", "row_idx", "p.*"
    )
    assert rows.schema.simpleString() == arrays.schema.simpleString()
    assert rows.count() == arrays.count() and rows.exceptAll(arrays).isEmpty()
    assert "transform(" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_rounding_is_that_of_round(spark):
    given = [0.5, 0.15, 2.5e-7, 1.0000005, -1.0000005, -0.0000005, -1e-12, 1e14 + 0.5, 1e300, 123.4567891234, None]
    rows = spark.createDataFrame([(x,) for x in given + [float("nan"), float("inf"), float("-inf")]], "x double")
    rows = rows.unionByName(spark.range(20000).select(F.expr("(id - 10000) * 5e-7D + (id % 3) * 1e-8D").alias("x")))
    for digits in (4, 6, 9):
        assert rows.filter(~rnd("x", digits).eqNullSafe(F.round("x", digits))).isEmpty()
