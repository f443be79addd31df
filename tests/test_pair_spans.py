"""The time in the key of the cross-match: no pair is lost at a stretch's edge, and few notices out of time are met."""

from pyspark.sql import functions as F
from skyherald.operators import match as mt


def _notices(spark, times):
    rows = [(i, 10.0, 20.0, 60.0, float(t)) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "no long, gcn_ra double, gcn_dec double, region_arcmin double, triggerTimejd double")


def _alerts(spark, times):
    rows = [(i, 10.0, 20.1, float(t) - 0.1, float(t)) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "candid long, ztf_ra double, ztf_dec double, jdstarthist double, jd double")


def test_alert_meets_few_notices_out_of_its_time(spark, monkeypatch):
    sides, join = [], mt.skew_join
    monkeypatch.setattr(mt, "skew_join", lambda left, right, on, **kw: sides.append((left, right, on)) or join(left, right, on, **kw))
    pairs = mt.crossmatch(_alerts(spark, [20.0]), _notices(spark, range(30)))
    assert sorted(r.no for r in pairs.collect()) == [13, 14, 15, 16, 17, 18, 19]
    left, right, on = sides[0]
    met = left.select(*on).join(right.select(*on), on).count()
    # stretches of the whole delay gave 14
    assert 7 <= met <= 9


def test_pairs_at_the_edges_of_stretches(spark):
    triggers = [k * mt.MAX_DELAY / 8 for k in range(40)]
    taken = [t + d for t in triggers[::4] for d in (0.1, 0.2, mt.MAX_DELAY - 1e-6, mt.MAX_DELAY, mt.MAX_DELAY + 1e-6)]
    alerts, notices = _alerts(spark, taken), _notices(spark, triggers)
    got = {(r.candid, r.no) for r in mt.crossmatch(alerts, notices).collect()}
    plain = alerts.crossJoin(notices).filter(
        (F.col("jdstarthist") > F.col("triggerTimejd")) & (F.col("jd") <= F.col("triggerTimejd") + F.lit(mt.MAX_DELAY))
    )
    assert got == {(r.candid, r.no) for r in plain.collect()}
