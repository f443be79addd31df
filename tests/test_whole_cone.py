"""`cone_match` has every pair within the error radius and after the trigger, however late the alert was taken."""

import datetime
import math

from skyherald.functions.time import to_jd
from workload import queries as q
from workload import oracle as sq


def _sky(n: int, ra_step: int, dec_step: int) -> tuple[float, float]:
    return (n * ra_step % 36000) / 100.0, math.asin(2.0 * (n * dec_step % 100003) / 100003.0 - 1.0)


def _separation(a: tuple[float, float], b: tuple[float, float]) -> float:
    ra = math.radians(a[0] - b[0])
    x = math.sin((a[1] - b[1]) / 2) ** 2 + math.cos(a[1]) * math.cos(b[1]) * math.sin(ra / 2) ** 2
    return math.degrees(2 * math.asin(min(1.0, math.sqrt(x))))


def test_late_alerts_of_a_cone_are_pairs(spark, tmp_path):
    begin = datetime.datetime(2024, 1, 1)
    # an event every two hours, 50 days in all; every fourth is a notice
    rows = [(i, begin + datetime.timedelta(hours=2 * i), i % 7, "error" if i % 4 == 1 else "view", 0.0, "{}") for i in range(600)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    events.write.parquet(str(tmp_path / "events.parquet"))
    jd = {r[0]: r[1] for r in events.select("event_id", to_jd(events.ts)).collect()}
    want, late = set(), 0
    for n in (r[0] for r in rows if r[3] == "error"):
        for a in (r[0] for r in rows if r[3] != "error" and jd[r[0]] - (r[0] % 7) / 20.0 > jd[n]):
            if _separation(_sky(a, 7919, 104729), _sky(n, 6151, 15485)) <= 1 + n % 10:
                want.add((a, n))
                late += jd[a] > jd[n] + 7
    found = [tuple(r) for r in q.cone_match(spark, str(tmp_path)).select("candid", "trigger_no").collect()]
    assert late > 0 and len(found) == len(set(found)) and set(found) == want
    # the stated result has no such limit either; that of the other pair queries stays
    assert "7::double" not in q.SQL["cone_match"] and "7::double" in q.SQL["crossmatch_reference_cover"] and "7::double" in sq.PAIRS
