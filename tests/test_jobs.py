"""The three jobs, end to end over files; the streamed forms against the batch forms."""

import base64
import dataclasses
import gzip
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyherald.jobs import ingest
from skyherald.functions import sky
from skyherald.functions.time import from_jd
from skyherald.jobs.crossmatch import main as crossmatch_job, online_matches, online_sink, store_late
from skyherald.operators.grade import grade_flags, schema_differences, distribution_projection
from skyherald.operators import notices as nt
from skyherald.plans.crossmatch import crossmatch_night
from skyherald.schemas import DISTRIBUTION, GRADES, MATCH as MATCH_SCHEMA
from skyherald.sinks.tables import write_partitioned
from skyherald.sources.tables import require_notice
from skyherald.streaming.crossmatch import first_matches_sink, skymap_stream
from skyherald.streaming.late import file_watermarks
from skyherald.streaming.run import ProgressLog, bounded_run
from skyherald.streaming.status import numbered_sink
from skyherald.jobs.config import load
from workload import derive as dv
from workload.settings import CLASS_RULES, GRADES as RULES, MATCH


def test_ingest_job(spark, sf, tmp_path):
    dv.raw_notices(spark, sf).write.parquet(str(tmp_path / "raw"))
    raw = spark.readStream.schema("topic string, value string, timestamp timestamp").parquet(str(tmp_path / "raw"))
    query = (
        raw.writeStream.foreachBatch(ingest.store_batch(str(tmp_path))).trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "log")).start()
    )
    bounded_run(query, 120)
    stored = spark.read.parquet(str(tmp_path / "notices"))
    batch = nt.notice_row(nt.parse_notices(dv.raw_notices(spark, sf)))
    assert stored.count() == batch.count() > 0
    # every message has its own trigger here, so each is the first of its trigger
    assert stored.select("gcn_status").distinct().collect()[0][0] == "initial"
    maps = spark.read.parquet(str(tmp_path / "skymaps"))
    want = batch.filter("observatory = 'LVK' and event_type = 'alert'").count()
    assert maps.select("triggerId").distinct().count() == want > 0
    assert stored.filter(F.col("raw_event").contains("skymap")).count() == 0
    bad = nt.dead_letter(nt.parse_notices(dv.raw_notices(spark, sf)))
    assert spark.read.parquet(str(tmp_path / "dead_letters")).count() == bad.count()


def run_batches(spark, frames, sink, tmp_path):
    for f in frames:
        f.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True)
    bounded_run(query.start(), 120)


def test_numbering_over_batches_loses_nothing(spark, tmp_path):
    """Old beside new, a stale notice, more rows than an Arrow batch: numbers follow the order of arrival."""
    day = lambda d, h: f"2024-01-{d:02d} {h:02d}:00:00"
    jd = lambda d: 2460310.5 + d - 1
    frame = lambda rows: spark.createDataFrame(rows, "triggerId string, ack string, triggerTimejd double, n int").selectExpr(
        "triggerId", "timestamp(ack) as ackTime", "triggerTimejd", "n", "'2024' as year", "'01' as month", "'02' as day")
    batches = [
        [("a", day(2, 5), jd(2), 1), ("a", day(2, 3), jd(2), 0), ("b", day(2, 4), jd(2), 0)],
        [("a", day(2, 9), jd(2), 2), ("a", day(20, 9), jd(2), 90)],
        # three hours older than what came before, and a second stale one
        [("a", day(2, 6), jd(2), 3), ("a", day(21, 9), jd(2), 91), ("b", day(2, 6), jd(2), 1)],
        [("a", day(2, 10 + i), jd(2), 4 + i) for i in range(6)],
    ]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        run_batches(spark, [frame(b) for b in batches], numbered_sink(str(tmp_path / "out")), tmp_path)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(rows) == sum(map(len, batches))
    for r in rows:
        want = "initial" if r["n"] in (0, 90, 91) else f"update_{r['n'] - 1}"
        assert r["gcn_status"] == want, r


def test_first_match_per_key_over_days(spark, tmp_path):
    """A key seen on days 0, 2, 4 and 6 counts once, however the batches fall."""
    frame = lambda d: spark.sql(
        f"select 'o' objectId, 't' triggerId, 'initial' gcn_status, {d}.5D jd, {d}L candid, '2024' year, '01' month, '{d:02d}' day")
    run_batches(spark, [frame(d) for d in (1, 3, 5, 7)], first_matches_sink(str(tmp_path / "out"), 7), tmp_path)
    assert [r["candid"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [1]


def test_damaged_maps_are_dead_letters(spark, sf):
    raw = dv.raw_notices(spark, sf).filter("topic = 'igwn.gwalert'")
    good = nt.parse_notices(raw).filter("reason is null and event_type = 'alert'").select("value").limit(4).collect()
    values = []
    for i, r in enumerate(good):
        event = json.loads(r["value"])
        packed = base64.b64encode(gzip.compress(base64.b64decode(event["event"]["skymap"]))).decode()
        event["event"]["skymap"] = [packed, packed[: len(packed) // 2 // 4 * 4], "AAAA", "%%%"][i]
        values.append(("igwn.gwalert", json.dumps(event)))
    parsed = nt.parse_notices(spark.createDataFrame(values, "topic string, value string")).persist()
    assert [r["reason"] for r in nt.dead_letter(parsed).collect()] == ["unreadable sky map"] * 3
    (row,) = nt.notice_row(parsed).collect()
    assert row["ra"] is not None and "skymap" not in row["raw_event"] and json.loads(row["raw_event"])["event"]["time"]


def test_bounded_run_stops_and_require_notice_fails(spark, sf, tmp_path):
    dv.notices(spark, sf).write.parquet(str(tmp_path / "n"))
    stream = spark.readStream.schema(dv.notices(spark, sf).schema).parquet(str(tmp_path / "n"))
    query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "log")).start()
    bounded_run(query, 2)
    assert not query.isActive
    with pytest.raises(LookupError):
        require_notice(dv.notices(spark, sf), "20240115", "no such trigger", "initial")


def wide_alerts(spark, sf):
    return dv.alert_packets(spark, sf)


def test_batch_output_columns_and_rerun(spark, sf, tmp_path):
    matches = grade_flags(crossmatch_night(wide_alerts(spark, sf), dv.notice_table(spark, sf), MATCH, dv.skymap_pixels(spark, sf)), RULES)
    names = set(MATCH_SCHEMA.names) | set(GRADES)
    # the derived alerts carry a part of the science columns; nothing else may appear
    assert set(matches.columns) - {"event_ts"} <= names
    core = "objectId candid ztf_ra ztf_dec fid jdstarthist rb jd magpsf sigmapsf observatory instrument event triggerId gcn_ra gcn_dec gcn_loc_error gcn_status triggerTimeUTC ackTime raw_event p_assoc alert_class timestamp year month day"
    assert set(core.split()) <= set(matches.columns)
    for _ in range(2):
        write_partitioned(matches, str(tmp_path / "out"))
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.count() == matches.count() > 0
    gaps = [d for d in schema_differences(distribution_projection(matches), DISTRIBUTION) if d.startswith("unexpected")]
    assert set(gaps) <= {f"unexpected {g} boolean" for g in GRADES} | {"unexpected event_ts timestamp"}


def test_online_equals_batch_within_the_window(spark, sf, tmp_path):
    alerts, notices = wide_alerts(spark, sf), dv.notices(spark, sf).withColumn("event_type", F.lit("alert")).drop("trigger_no")
    alerts.write.parquet(str(tmp_path / "a"))
    notices.write.parquet(str(tmp_path / "n"))
    a = spark.readStream.schema(alerts.schema).parquet(str(tmp_path / "a"))
    n = spark.readStream.schema(notices.schema).parquet(str(tmp_path / "n"))
    online = online_matches(a, n, MATCH, "60 days")
    sink = online_sink(str(tmp_path / "o"), lambda s, days: s.read.parquet(str(tmp_path / "n")), MATCH, 60)
    query = online.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "log"))
    bounded_run(query.trigger(availableNow=True).start())
    key = ["objectId", "triggerId"]
    got = spark.read.parquet(str(tmp_path / "o")).select(*key)
    want = crossmatch_night(alerts, notices, dataclasses.replace(MATCH, max_delay=60.0), with_raw=False).select(*key)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and want.count() > 0


def test_late_rows_are_found_and_matched(spark, sf, tmp_path):
    """Notices and alerts that the watermark refused are in the side tables, and the table ends as the batch form's."""
    alerts, notices = wide_alerts(spark, sf), dv.notices(spark, sf).withColumn("event_type", F.lit("alert")).drop("trigger_no")
    for frame, name, old in ((alerts, "a", F.dayofmonth(from_jd(F.col("candidate.jd"))) == 7), (notices, "n", F.dayofmonth(from_jd(F.col("triggerTimejd"))) < 9)):
        new = F.xxhash64(F.to_json(F.struct(*[c for c in ("candid", "triggerId") if c in frame.columns]))) % 2 == 0
        for part in (~old & new, ~old & ~new, old):  # what is old comes last
            frame.filter(part).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    a, n = (spark.readStream.schema(f.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / x)) for f, x in ((alerts, "a"), (notices, "n")))
    stored_alerts, stored_notices = (spark.read.schema(f.schema).parquet(str(tmp_path / x)) for f, x in ((alerts, "a"), (notices, "n")))
    log = ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    sink = online_sink(str(tmp_path / "online"), lambda s, days: stored_notices, MATCH, 60)
    query = online_matches(a, n, MATCH, "60 days").writeStream.queryName("matches").foreachBatch(sink)
    bounded_run(query.option("checkpointLocation", str(tmp_path / "online_checkpoint")).trigger(availableNow=True).start())
    assert log.ended.wait(60)
    spark.streams.removeListener(log)
    dropped = spark.read.parquet(str(tmp_path / "progress")).agg(F.sum("dropped_late")).first()[0]
    key = ["objectId", "triggerId"]
    want = crossmatch_night(alerts, notices, dataclasses.replace(MATCH, max_delay=60.0), with_raw=False).select(*key)
    before = spark.read.parquet(str(tmp_path / "online")).select(*key)
    assert dropped > 0 and before.exceptAll(want).count() == 0 and want.exceptAll(before).count() > 0
    for _ in range(2):  # a rerun adds nothing
        store_late(spark, str(tmp_path), stored_alerts, stored_notices, MATCH, 60)
        got = spark.read.parquet(str(tmp_path / "online")).select(*key)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    late = spark.read.parquet(str(tmp_path / "late_notices"))
    refused = notices.filter(F.dayofmonth(from_jd(F.col("triggerTimejd"))) < 9)
    assert refused.count() > 0 and refused.exceptAll(late).count() == 0
    assert late.exceptAll(notices).count() == 0 and spark.read.parquet(str(tmp_path / "late_alerts")).count() > 0


def test_files_without_progress_meet_the_highest_watermark(spark, tmp_path):
    for source, step, files in ((0, "0", ["a"]), (0, "1", ["b"]), (1, "0", ["c"]), (1, "2.compact", ["c", "d"])):
        folder = tmp_path / "log" / "sources" / str(source)
        folder.mkdir(parents=True, exist_ok=True)
        at = {"a": 0, "b": 1, "c": 0, "d": 2}
        (folder / step).write_text("v1\n" + "\n".join(json.dumps({"path": f"file:///x/{f}", "timestamp": 1, "batchId": at[f]}) for f in files))
    step = lambda s, e: {"startOffset": None if s is None else {"logOffset": s}, "endOffset": {"logOffset": e}}
    rows = [
        (0, "1970-01-01T00:00:00.000Z", [step(None, 0), step(None, 0)]), (1, "2024-01-05T00:00:00.000Z", [step(0, 1), step(0, 0)]),
        (2, "2024-01-09T00:00:00.000Z", [step(1, 1), step(0, 0)]),
    ]
    bodies = [("q", json.dumps({"batchId": b, "eventTime": {"watermark": w}, "sources": s})) for b, w, s in rows]
    progress = spark.createDataFrame(bodies, "query string, body string")
    got = {r.file: str(r.w) for r in file_watermarks(spark, str(tmp_path / "log"), progress, "q").selectExpr("file", "date(watermark) w").collect()}
    assert got == {"file:/x/a": "1970-01-01", "file:/x/b": "2024-01-05", "file:/x/c": "1970-01-01", "file:/x/d": "2024-01-09"}


def test_streamed_maps_of_any_level(spark, tmp_path):
    """Pixels of levels 0 to 29 find the alerts that lie in them, and no other."""
    rng = np.random.default_rng(2)
    places = [(i, float(a), float(d)) for i, (a, d) in enumerate(zip(rng.uniform(0, 360, 60), rng.uniform(-89, 89, 60)))]
    alerts = spark.createDataFrame(places, "candid long, ztf_ra double, ztf_dec double").selectExpr(
        "*", "2.5D jdstarthist", "3D jd", "timestamp'2024-01-02' alert_ts")
    index = {r[0]: r[1] for r in alerts.select("candid", sky.ang2pix_nest(29, F.col("ztf_ra"), F.col("ztf_dec"))).collect()}
    rows, want = [], set()
    for n, level in enumerate((0, 1, 3, 4, 5, 13, 13, 29)):
        cell = index[7 * n] >> 2 * (29 - level)
        rows.append((f"S{n}", (4 << 2 * level) + cell, float(n)))
        want |= {(c, f"S{n}", float(n)) for c, i in index.items() if i >> 2 * (29 - level) == cell}
    regions = spark.createDataFrame(rows, "triggerId string, uniq long, density double").selectExpr(
        "*", "1D triggerTimejd", "timestamp'2024-01-01' trigger_ts")
    for frame, name in ((alerts, "a"), (regions, "r")):
        frame.write.parquet(str(tmp_path / name))
    streams = [spark.readStream.schema(f.schema).parquet(str(tmp_path / n)) for f, n in ((alerts, "a"), (regions, "r"))]
    pairs = skymap_stream(*streams).select("candid", "triggerId", "density")
    query = pairs.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "log"))
    bounded_run(query.trigger(availableNow=True).start())
    got = [tuple(r) for r in spark.read.parquet(str(tmp_path / "o")).collect()]
    assert len(got) == len(want) and set(got) == want and {t for _, t, _ in want} == {f"S{n}" for n in range(8)}


def test_online_job_does_not_leave_maps_out_silently(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"match": {"class_rules": CLASS_RULES}, "grades": {"extragalactic": []}}))
    with pytest.raises(SystemExit):
        crossmatch_job(["online", "--alerts", "a", "--notices", "n", "--out", "o", "--night", "20240115", "--config", str(tmp_path / "c.json")])


def test_config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"match": {"class_rules": CLASS_RULES, "tiers": [[4, None]]}, "grades": {"extragalactic": ["Galaxy"]}}))
    match, grades = load(str(path))
    assert match.tiers == ((4, None),) and match.class_rules == CLASS_RULES and grades.extragalactic == ("Galaxy",)
