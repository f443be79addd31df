"""Pairs of the night's cross-match: none from copies that could never be kept, and shuffled as little as their keys allow."""

import numpy as np
from pyspark.sql import functions as F

from skyherald.operators import match as mt
from skyherald.plans import crossmatch as plan
from workload import derive as dv
from workload.settings import MATCH


def test_copies_of_alerts_and_notices_make_no_pairs(spark, sf, monkeypatch):
    """The first of notices that agree in position, time and radius is kept whatever its copies are; one elsewhere is another."""
    met = []

    def dedup(rows, *a, **k):
        met.append(rows.count())
        return mt.dedup_matches(rows, *a, **k)

    monkeypatch.setattr(plan, "dedup_matches", dedup)
    alerts, notices, pixels = dv.alert_packets(spark, sf), dv.notice_table(spark, sf), dv.skymap_pixels(spark, sf)
    later = notices.withColumns({"ackTime": F.col("ackTime") + F.expr("interval 10 days"), "raw_event": F.concat("raw_event", F.lit(" later"))})
    shown = ["objectId", "candid", "triggerId", "p_assoc", "raw_event"]
    once = plan.crossmatch_night(alerts, notices, MATCH, pixels).select(*shown)
    twice = plan.crossmatch_night(alerts.unionByName(alerts), notices.unionByName(later), MATCH, pixels).select(*shown)
    assert met[0] == met[1] > 0
    assert sorted(once.collect()) == sorted(twice.collect())
    # a later version in another place makes pairs of its own, which count where the first has none
    moved = later.withColumns({"ra": F.pmod(F.col("ra") + 90.0, F.lit(360.0)), "dec": -F.col("dec")})
    both = plan.crossmatch_night(alerts, notices.unionByName(moved), MATCH).select(*shown)
    first = plan.crossmatch_night(alerts, notices, MATCH).select(*shown)
    assert met[2] > met[3] > 0 and both.filter(F.col("raw_event").endswith(" later")).count() > 0
    kept = {(r["objectId"], r["triggerId"]) for r in both.collect()}
    assert kept > {(r["objectId"], r["triggerId"]) for r in first.collect()}


def test_rows_of_bounded_keys_meet_in_one_shuffle(spark):
    rng = np.random.default_rng(3)
    rows = [(f"k{rng.integers(40)}", int(rng.integers(20)), int(rng.integers(3)), float(i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "objectId string, n long, candid long, v double")
    order = ("n", "candid", "v")
    dealt, met = (mt.dedup_matches(df, ("objectId",), order, hot=h) for h in (True, False))
    assert sorted(dealt.collect()) == sorted(met.collect()) and met.count() == 40
    shuffles = [d._jdf.queryExecution().sparkPlan().toString().count("Exchange") + d._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange ") for d in (dealt, met)]
    assert shuffles[1] < shuffles[0]
