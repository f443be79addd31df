"""Operators on small frames: parsing, maps, joins of every path, skew paths, gaps."""

import bisect

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyherald.functions import sky
from skyherald.operators import grade as gr
from skyherald.operators import match as mt
from skyherald.operators import notices as nt
from skyherald.operators import skymap as sm
from skyherald.operators.validate import Rule, between, validate
from skyherald.plans.sizing import running, skew_join
from workload import derive as dv

VOEVENT = """<?xml version = '1.0' encoding = 'UTF-8'?>
<voe:VOEvent ivorn="ivo://nasa.gsfc.gcn/{ivorn}" role="{role}" version="2.0" xmlns:voe="http://www.ivoa.net/xml/VOEvent/v2.0">
 <What><Param name="Packet_Type" value="{packet}" /><Param name="{param}" value="{trigger}" />
  <Group name="Trigger_ID"><Param name="{param}" value="wrong" /></Group></What>
 <WhereWhen><ObsDataLocation><ObservationLocation><AstroCoords><Time unit="s"><TimeInstant>
  <ISOTime>{time}</ISOTime></TimeInstant></Time><Position2D unit="deg"><Value2><C1>{ra}</C1><C2>{dec}</C2></Value2>
  <Error2Radius>{err}</Error2Radius></Position2D></AstroCoords></ObservationLocation></ObsDataLocation></WhereWhen>
</voe:VOEvent>"""

# ivorn, packet, trigger parameter, trigger, error in degrees -> observatory, instrument, event, stored radius
NOTICES = [
    ("Fermi#GBM_Fin_Pos2022-07-29T10:17:31.51_680782656_0-655", 115, "TrigID", "680782656", "11.3400", "Fermi", "GBM", "", 680.4),
    ("Fermi#LAT_Monitor_2022-08-06T12:00:00.00_1659883590-0-102", 125, "TrigID", "1659883590", "0.0000", "Fermi", "LAT", "", 0.0167),
    ("SWIFT#BAT_GRB_Pos_1118357-182", 61, "TrigID", "1118357", "0.0500", "SWIFT", "BAT", "", 3.0),
    ("SWIFT#XRT_Pos_1120270-655", 67, "TrigID", "1120270", "0.0016", "SWIFT", "XRT", "", 0.096),
    ("SWIFT#UVOT_Pos_1121751-809", 81, "TrigID", "1121751", "0.0001", "SWIFT", "UVOT", "", 0.006),
    ("INTEGRAL#Weak_Pos_009998-0-832", 56, "TrigID", "9998", "0.0656", "INTEGRAL", "Weak", "", 3.936),
    ("AMON#ICECUBE_GOLD_Event2022-12-23T07:43:00.52_24_137467_064735045_0", 173, "AMON_ID", "13746764735045", "0.6596", "ICECUBE", "", "GOLD", 39.576),
    ("AMON#ICECUBE_BRONZE_Event2022-08-08T07:59:57.26_25_1_1_0", 174, "AMON_ID", "1", "0", "ICECUBE", "", "BRONZE", 0.0167),
]


def message(ivorn, packet, param, trigger, err, role="observation"):
    return VOEVENT.format(ivorn=ivorn, packet=packet, param=param, trigger=trigger, err=err, role=role, time="2022-12-23T07:43:00.52", ra="350.5486", dec="34.7110")


def test_xml_notices(spark):
    topic = "gcn.classic.voevent.FERMI_GBM_GND_POS"
    rows = [(topic, message(*n[:5])) for n in NOTICES]
    rows += [
        (topic, message(*NOTICES[0][:5], role="test")), (topic, message(NOTICES[0][0], 999, *NOTICES[0][2:5])),
        (topic, message(*NOTICES[0][:5])[:150]), ("somewhere", "x"), (topic, message("Fermi#XYZ_1", 111, "TrigID", "1", "1")),
        (topic, message("Nobody#GBM_1", 111, "TrigID", "1", "1")), (topic, message("Fermi#GBM_1", 111, "Other", "1", "1")),
    ]
    parsed = nt.parse_notices(spark.createDataFrame(rows, "topic string, value string"))
    reasons = sorted(r["reason"] for r in parsed.filter("reason is not null").collect())
    assert reasons == sorted([
        nt.NOT_OBSERVATION, nt.NOT_LISTENED, "malformed message", "unknown topic", "unknown instrument",
        "unknown observatory", "no trigger id",
    ])
    assert nt.dead_letter(parsed).count() == 5
    got = {r["triggerId"]: r for r in nt.notice_row(parsed).collect()}
    for n in NOTICES:
        r = got[n[3]]
        assert (r["observatory"], r["instrument"], r["event"]) == n[5:8]
        assert round(r["err_arcmin"], 4) == n[8]
        assert (r["ra"], r["dec"], r["triggerTimejd"]) == (350.5486, 34.711, 2459936.8215337964)
        assert r["triggerTimeUTC"] == "2022-12-23 07:43:00.520" and (r["year"], r["month"], r["day"]) == ("2022", "12", "23")
    assert got["1"]["region_arcmin"] == 0.0


def test_json_notices(spark):
    rows = [("igwn.gwalert", t) for t in (
        '{"superevent_id": "S1", "alert_type": "RETRACTION", "event": null}', '{"superevent_id": "M1", "alert_type": "INITIAL"}',
        '{"other": 1}', '{"superevent_id": "S2", "alert_type": "INITIAL", "event": {"time": "2023-05-18T12:59:08.167Z", "instruments": ["H1", "L1"]}}',
    )]
    df = spark.createDataFrame(rows, "topic string, value string")
    parsed = nt.parse_notices(df)
    assert sorted(str(r["reason"]) for r in parsed.collect()) == ["None", "no sky map", nt.NOT_OBSERVATION, "unknown observatory"]
    kept = nt.notice_row(parsed).first()
    assert (kept["event_type"], kept["triggerId"], kept["region_arcmin"]) == ("retraction", "S1", None)
    assert nt.parse_notices(df, test=True).filter("json.superevent_id = 'M1'").first()["reason"] != nt.NOT_OBSERVATION


def test_drop_json_key(spark):
    texts = [
        '{"a": 1, "event": {"skymap": "QUJD+/=", "time": "t"}}', '{"event": {"time": "t", "skymap": "QUJD"}, "b": 2}',
        '{"event": {"skymap": null}}',
    ]
    df = spark.createDataFrame([("LVK", t) for t in texts] + [("Fermi", texts[0])], "observatory string, raw_event string")
    got = [r["raw_event"] for r in gr.drop_json_key(df).collect()]
    assert got == ['{"a": 1, "event": {"time": "t"}}', '{"event": {"time": "t"}, "b": 2}', '{"event": {}}', texts[0]]


def test_fits_round_trip_and_summary(spark, sf):
    m = dv.map_notices(spark, sf).limit(20).select("triggerId", "gcn_status", dv.fits_text("pixels").alias("skymap"), "pixels")
    m = m.persist()
    direct = m.select("triggerId", "gcn_status", F.posexplode("pixels").alias("row_idx", "p")).select("triggerId", "gcn_status", "row_idx", "p.*")
    decoded = sm.skymap_explode(m.select("triggerId", "gcn_status", "skymap"))
    assert decoded.exceptAll(direct).count() == 0 and direct.exceptAll(decoded).count() == 0
    table = sm.skymap_peak(direct).join(sm.credible_area(sm.credible_region(direct)), ["triggerId", "gcn_status"])
    table = {r["triggerId"]: r for r in table.collect()}
    for r in m.collect():
        uniq, density = (np.array([p[c] for p in r["pixels"]]) for c in ("uniq", "probdensity"))
        want = table[r["triggerId"]]
        assert sm.summarise(uniq, density) == pytest.approx((want["ra"], want["dec"], want["area_arcmin2"]))
    bad = spark.createDataFrame([("a", "initial", None), ("b", "initial", "xx")], "triggerId string, gcn_status string, skymap string")
    assert sm.skymap_explode(bad).count() == 0
    m.unpersist()


def test_partial_maps_answer_with_the_preceding_pixel(spark):
    rng = np.random.default_rng(3)
    rows, maps = [], {}
    for t in ("A", "B"):
        # level-2 pixels, some of them missing, the first ones too
        keep = sorted(rng.choice(np.arange(5, 190), 60, replace=False).tolist())
        maps[t] = [(p << 54, float(i + 1)) for i, p in enumerate(keep)]
        rows += [(t, "initial", i, 64 + p, float(i + 1)) for i, p in enumerate(keep)]
    pixels = spark.createDataFrame(rows, "triggerId string, gcn_status string, row_idx int, uniq long, probdensity double")
    whole = sm.complete_skymap(pixels)
    area = whole.groupBy("triggerId").agg(F.sum(sky.pixel_area_sr(sky.uniq_level(F.col("uniq")))).alias("a")).collect()
    assert all(r["a"] == pytest.approx(4 * np.pi) for r in area)
    pts = [(t, "initial", i, float(a), float(d)) for t in maps for i, (a, d) in enumerate(zip(rng.uniform(0, 360, 200), rng.uniform(-90, 90, 200)))]
    points = spark.createDataFrame(pts, "triggerId string, gcn_status string, i int, ra double, dec double")
    got = sm.skymap_density_at(points, whole).withColumn("x", sky.ang2pix_nest(29, F.col("ra"), F.col("dec"))).collect()
    assert len(got) == len(pts)
    for r in got:
        starts = [s for s, _ in maps[r["triggerId"]]]
        want = maps[r["triggerId"]][bisect.bisect_right(starts, r["x"]) - 1][1]
        assert r["density"] == pytest.approx(want * (np.pi / 180) ** 2)


def brute_force(spark, sf, factor=1.5, max_delay=None):
    a, n = dv.alerts(spark, sf).toPandas(), dv.notices(spark, sf).toPandas()

    def unit(ra, dec):
        p, t = np.radians(ra), np.radians(dec)
        return np.stack([np.cos(t) * np.cos(p), np.cos(t) * np.sin(p), np.sin(t)], 1)

    chord = np.linalg.norm(unit(a.ztf_ra, a.ztf_dec)[:, None] - unit(n.ra, n.dec)[None], axis=2)
    near = np.degrees(2 * np.arcsin(np.clip(chord / 2, 0, 1))) * 60 <= factor * n.err_arcmin.to_numpy()[None]
    if max_delay is not None:
        near &= a.jd.to_numpy()[:, None] <= n.triggerTimejd.to_numpy()[None] + max_delay
    i, j = np.nonzero(near & (a.jdstarthist.to_numpy()[:, None] > n.triggerTimejd.to_numpy()[None]))
    return set(zip(a.candid.to_numpy()[i].tolist(), n.trigger_no.to_numpy()[j].tolist()))


@pytest.mark.parametrize("kw", [
    {}, {"tiers": ((1, None),)}, {"tiers": ((16, 5.0), (4, None))}, {"broadcast_rows": 0}, {"max_delay": 7.0},
    {"max_delay": 0.5, "broadcast_rows": 0},
])
def test_cell_join_equals_brute_force(spark, sf, kw):
    kw = {"max_delay": None, **kw}
    pairs = mt.crossmatch(dv.alerts(spark, sf), mt.circle_notices(dv.notices(spark, sf)), **kw)
    got = [(r["candid"], r["trigger_no"]) for r in pairs.select("candid", "trigger_no").collect()]
    assert len(got) == len(set(got)) and set(got) == brute_force(spark, sf, max_delay=kw["max_delay"])


def test_skew_join_splits_hot_keys(spark):
    # a third of the rows share one key
    big = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("b"))
    small = spark.range(60_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    sizes = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in sizes}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    try:
        joined = skew_join(big.repartition(8), small, ["k"])
        rows = joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == 60_000 and all(r["v"] == 2 * r["k"] for r in rows)


@pytest.mark.parametrize("slices", [8, 2000])
def test_running_values_of_large_groups(spark, slices):
    # one group holds most rows, and most of these share one value of the order column
    df = spark.range(4000).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"),
        F.when(F.col("id") % 5 < 3, 1.0).otherwise((F.col("id") * 37 % 11).cast("double")).alias("o"),
        F.col("id").alias("t"), F.when(F.col("id") % 9 > 1, F.col("id") % 13).alias("m"),
    )
    for kind in ("sum", "last") if slices == 8 else ("sum",):
        small = running(df, ["g"], ["o", "t"], F.col("m"), "s", kind)
        sliced = running(df, ["g"], ["o", "t"], F.col("m"), "s", kind, rows_per_task=100, slices=slices)
        got, want = ({r["t"]: r["s"] for r in d.collect()} for d in (sliced, small))
        assert len(got) == 4000 and got == want


def test_densities_of_a_map_with_very_many_points(spark):
    rng = np.random.default_rng(5)
    keep = sorted(rng.choice(np.arange(3, 190), 90, replace=False).tolist())
    pixels = spark.createDataFrame([("A", "initial", i, 64 + p, float(i)) for i, p in enumerate(keep)], "triggerId string, gcn_status string, row_idx int, uniq long, probdensity double")
    places = zip(rng.uniform(0, 360, 900), rng.uniform(-90, 90, 900))
    rows = [("A", "initial", i, float(a), float(d)) for i, (a, d) in enumerate(places)] + [("B", "initial", -1, 1.0, 1.0)]
    points = spark.createDataFrame(rows, "triggerId string, gcn_status string, i int, ra double, dec double")
    whole, cut = (sm.skymap_density_at(points, pixels, rows_per_task=n) for n in (10_000, 100))
    assert whole.columns == [*points.columns, "density"]
    assert whole.count() == cut.count() == 900 and whole.exceptAll(cut).count() == 0


def test_first_match_by_every_column_of_the_order(spark):
    rng = np.random.default_rng(9)
    rows = [(f"k{rng.integers(12)}", None if rng.random() < 0.1 else float(rng.integers(3)), int(rng.integers(-2, 2)),
             None if rng.random() < 0.1 else int(rng.integers(3)), float(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "objectId string, jd double, candid long, n long, v double")
    order = ("jd", "candid", "n", "v")
    low = lambda x: (x is not None, x or 0)
    want = {k: min((r for r in rows if r[0] == k), key=lambda r: [low(x) for x in r[1:]]) for k in {r[0] for r in rows}}
    narrow = mt.dedup_matches(df, ("objectId",), order)
    assert {tuple(r) for r in narrow.collect()} == set(want.values())
    assert "SortAggregate" not in narrow._jdf.queryExecution().executedPlan().toString()
    texts = mt.dedup_matches(df.withColumn("t", F.col("objectId")), ("objectId",), order)
    assert {tuple(r)[:5] for r in texts.collect()} == set(want.values())


def test_validate(spark):
    df = spark.createDataFrame([(1, 5.0), (1, -999.0), (2, None), (3, 40.0)], "id int, x double")
    rules = [Rule("id", "unique"), *between("x", 0.0, 30.0)]
    got = {(r["column"], r["rule"]): (r["checked"], r["violations"]) for r in validate(df, rules, allow=(-999.0,)).collect()}
    assert got == {("id", "unique"): (4, 1), ("x", "not_null"): (4, 1), ("x", "min 0.0"): (4, 0), ("x", "max 30.0"): (4, 1)}


def test_late_notice_starts_again(spark):
    rows = [("T", d * 86400, 2451544.5 + 9131.0) for d in (0, 1, 2, 6.5, 7.5, 8)]
    base = 1735689600  # 2025-01-01 = JD 2460676.5
    df = spark.createDataFrame([(t, int(base + s), 2460676.5) for t, s, _ in rows], "triggerId string, s long, triggerTimejd double")
    df = df.select("triggerId", F.timestamp_seconds("s").alias("ackTime"), "triggerTimejd")
    got = [r["gcn_status"] for r in nt.notice_status(df).orderBy("ackTime").collect()]
    assert got == ["initial", "update_0", "update_1", "update_2", "initial", "initial"]
