"""Pairs of the night's cross-match lie by their object: they meet the others of their key and their alert in one place."""

import datetime

import pytest
from pyspark.sql import functions as F

from skyherald.operators import match as mt
from skyherald.plans import crossmatch as plan
from skyherald.plans.sizing import dealt_evenly, even_keys
from workload import derive as dv
from workload import queries as q
from workload.settings import MATCH


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Events of twenty days, every third a notice; some users have no name, and one is twice."""
    begin = datetime.datetime(2024, 1, 1)
    rows = [
        (i, begin + datetime.timedelta(hours=2 * i), None if i % 11 == 0 else i % 5, "error" if i % 3 == 1 else "view", 0.0, "{}")
        for i in range(240)
    ]
    path = tmp_path_factory.mktemp("small")
    events = spark.createDataFrame(rows + rows[:30], "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    events.write.parquet(str(path / "events.parquet"))
    return str(path)


def _night(spark, sf):
    found = plan.crossmatch_night(dv.alert_packets(spark, sf), dv.notice_table(spark, sf), MATCH, dv.skymap_pixels(spark, sf), with_raw=False)
    return found.select("objectId", "candid", "triggerId", "observatory", "p_assoc", "rb", "timestamp", "year", "month", "day")


def test_matches_meet_their_alerts_without_another_shuffle(spark, small, monkeypatch):
    found = _night(spark, small)
    planned = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(candid" not in planned and "hashpartitioning(__object" in planned
    rows = sorted(found.collect(), key=str)
    # an object's alerts are joined to that object, also to one without a name
    assert any(r.objectId is None for r in rows) and any(r.objectId is not None for r in rows)
    assert all((r.year, r.month, r.day) == tuple(r.timestamp.strftime("%Y %m %d").split()) for r in rows)
    # where an object has a large share of the alerts, keys are dealt, with the same rows
    monkeypatch.setattr(plan, "even_keys", lambda *a: False)
    assert rows == sorted(_night(spark, small).collect(), key=str)


def test_an_object_with_most_alerts_is_found():
    assert even_keys(1_000_000, 50, 200) and not even_keys(1_000_000, 300_000, 200)
    assert even_keys(0, 0, 8) and not even_keys(50_000_000, 2_000_000, 200)


def test_few_alerts_are_dealt_to_many_tasks(spark, small):
    narrow = plan.narrow_alerts(plan.prepare_alerts(dv.alert_packets(spark, small), MATCH))
    ranked = plan.ranked_alerts(narrow)
    assert ranked.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    assert ranked.count() == narrow.distinct().count()


def test_rows_of_a_key_meet_by_their_object(spark, small, monkeypatch):
    """No shuffle by the rest of the key, nor one for each column of the order."""
    found = q.dedup_matches(spark, small)
    planned = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(triggerId" not in planned and "hashpartitioning(objectId#" in planned
    assert "triggerId" not in "".join(line for line in planned.splitlines() if "hashpartitioning" in line)
    rows = sorted(found.collect(), key=str)
    plain = mt.crossmatch(dv.alerts(spark, small), mt.circle_notices(dv.notices(spark, small)))
    pairs = plain.select("objectId", "triggerId", "gcn_status", "jd", "candid", "separation").collect()
    first = {}
    for p in sorted(pairs, key=lambda p: (p.jd, p.candid)):
        first.setdefault((p.objectId, p.triggerId, p.gcn_status), p.candid)
    assert len(rows) == len(first) > 0 and {(r.objectId, r.triggerId, r.gcn_status): r.candid for r in rows} == first
    monkeypatch.setattr(q, "dealt_evenly", lambda df, key: (df, False))
    assert rows == sorted(q.dedup_matches(spark, small).collect(), key=str)


def test_alerts_of_one_object_are_left_as_they_are(spark):
    rows = spark.range(60_000)
    assert dealt_evenly(rows.withColumn("k", F.col("id") % 1000), "k")[1]
    assert not dealt_evenly(rows.withColumn("k", F.lit(None).cast("long")), "k")[1]
