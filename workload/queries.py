"""The registered queries: one per operator, over the whole derived tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyherald.functions import probability as pr
from skyherald.functions import sky
from skyherald.functions.time import from_jd, iso_utc, night_bounds, partition_cols, to_jd
from skyherald.operators import alerts as al
from skyherald.operators import contract as ct
from skyherald.operators import grade as gr
from skyherald.operators import match as mt
from skyherald.operators import notices as nt
from skyherald.operators import regions as rg
from skyherald.operators import skymap as sm
from skyherald.operators.validate import ALERT_RULES, NOTICE_RULES, validate
from skyherald.plans.sizing import computed_once, dealt_evenly
from skyherald.plans.crossmatch import crossmatch_night
from skyherald.schemas import LC_FEATURES
from skyherald.schemas import GRADES as GRADE_NAMES
from skyherald.session import shared_dir
from skyherald.sinks.tables import stream_partitioned, write_partitioned
from skyherald.sources.tables import (
    alerts_batch, alerts_stream, lookup_notice, matches_stream, notices_batch, notices_of_days, notices_stream, raw_notices_files,
)
from skyherald.jobs.crossmatch import online_matches, online_sink
from skyherald.streaming.crossmatch import crossmatch_stream, first_matches_sink, skymap_stream
from skyherald.streaming.run import ProgressLog, bounded_run
from skyherald.streaming.status import numbered_sink
from skyherald.streaming.topics import stream_topics as topics_query
from workload import derive as dv
from workload import oracle as sq
from workload.settings import CLASS_RULES, GRADES, MATCH

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
NSIDE = 4
MARGIN = sky.max_pixrad(4 * NSIDE)


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def rnd(c: Column | str, digits: int = 6) -> Column:
    """`round`, which goes through a decimal for every value: only where a plain sum could come out on the wrong side of a half,
    or with too few digits. A whole number divided by a power of ten is the double next to that decimal, as in `round`."""
    x = F.col(c) if isinstance(c, str) else c
    scaled = x * F.lit(float(10**digits))
    away = F.abs(scaled - F.floor(scaled) - 0.5) > 1e-3
    plain = F.floor(scaled + 0.5).cast("double") / F.lit(float(10**digits))
    return F.when((F.abs(scaled) < float(1 << 40)) & away, plain).otherwise(F.round(x, digits))


# --- cross-match ---------------------------------------------------------------------------------------------


def _pairs(spark, sf, **kw) -> DataFrame:
    return mt.crossmatch(dv.alerts(spark, sf), mt.circle_notices(dv.notices(spark, sf)), **kw)


@query(f"""select candid, trigger_no, observatory, round(sep, 6) as separation from {sq.PAIRS}
  where sep * 60 <= 1.5::double * err_arcmin""")
def crossmatch_cone(spark, sf):
    return _pairs(spark, sf).select("candid", "trigger_no", "observatory", rnd("separation").alias("separation"))


_COVER = sq.cover(sq.NOTICES, NSIDE, "n.err_arcmin / 60", 'trigger_no, "triggerId"', MARGIN)
_ALERT_CELLS = sq.with_ring(sq.with_point(sq.ALERTS, "ztf_ra", "ztf_dec"), NSIDE, "hpix")


@query(f"""select candid, trigger_no from (select a.candid, n.trigger_no, n.err_arcmin,
    {sq.sep_deg('a.ztf_ra', 'a.ztf_dec', 'n.ra', 'n.dec')} as sep
  from {_ALERT_CELLS} a join {_COVER} k using (hpix) join {sq.NOTICES} n using (trigger_no)
  where a.jdstarthist > n.trigger_jd and a.jd <= n.trigger_jd + 7::double) where sep * 60 <= 1.5::double * err_arcmin""")
def crossmatch_reference_cover(spark, sf):
    pairs = _pairs(spark, sf, cover_factor=1.0, tiers=rg.REFERENCE_TIER)
    return pairs.select("candid", "trigger_no")


@query(f"""select candid, trigger_no from (select a.candid, n.trigger_no, n.err_arcmin,
    {sq.sep_deg('a.ztf_ra', 'a.ztf_dec', 'n.ra', 'n.dec')} as sep
  from {_ALERT_CELLS} a join {_COVER} k using (hpix) join {sq.NOTICES} n using (trigger_no)
  where a.jdstarthist > n.trigger_jd) where sep * 60 <= err_arcmin""")
def cone_match(spark, sf):
    """The cell join, refined afterwards: what lies beyond the wide cone goes in the join and needs no separation. Every alert
    after the trigger counts, however late: the threshold is the separation alone."""
    pairs = _pairs(spark, sf, cover_factor=1.0, tiers=rg.REFERENCE_TIER, max_delay=None)
    return mt.cone_match(pairs, 1.0).select("candid", "trigger_no")


_RATE = "case observatory when 'Fermi' then 250 when 'SWIFT' then 100 when 'INTEGRAL' then 60 else -1 end"


def _p_sql(rate: str, days: str, radius: str) -> str:
    """Chance probability; a Taylor form of 1 - exp(-x) keeps the digits of small x."""
    x = f"({rate} * ({days} / 365.25::double))"
    near = f"({x} - {x} * {x} / 2 + {x} * {x} * {x} / 6)"
    least = f"(case when abs({x}) < 1e-4 then {near} else 1 - exp(-{x}) end)"
    return f"(1 - 31 * (pi() * {radius} * {radius}) / 141994 * {least})"


_DELAY = "(jd_first_real_det - trigger_jd)"
_P_ASSOC = f"""(case when observatory = 'ICECUBE' then (case when {_DELAY} >= 0 then 0.5::double else -1 end)
  else (case when {_DELAY} > 0 then {_p_sql(_RATE, _DELAY + ' / 365.25::double', 'err_arcmin / 60')} else -1 end) end)"""


@query(f"""select * from (select candid, trigger_no, round({_P_ASSOC}, 9) as p_assoc from {sq.PAIRS}
  where sep * 60 <= 1.5::double * err_arcmin) where p_assoc <> -1""")
def p_assoc(spark, sf):
    delay = F.col("jd_first_real_det") - F.col("triggerTimejd")
    pairs = _pairs(spark, sf).withColumn("p_assoc", mt.p_assoc(delay, F.col("separation")))
    return mt.keep_associated(pairs).select("candid", "trigger_no", rnd("p_assoc", 9).alias("p_assoc"))


@query(f"""select min("objectId") as "objectId", "triggerId", 'initial' as gcn_status,
    arg_min(candid, (jd, candid)) as candid, round(arg_min(sep, (jd, candid)), 6) as separation
  from {sq.PAIRS} where sep * 60 <= 1.5::double * err_arcmin group by "objectId", "triggerId" """)
def dedup_matches(spark, sf):
    # dealt by the object, rows of a key meet in one shuffle at most
    alerts, even = dealt_evenly(dv.alerts(spark, sf), "objectId")
    pairs = mt.crossmatch(alerts, mt.circle_notices(dv.notices(spark, sf)))
    pairs = pairs.select("objectId", "triggerId", "gcn_status", "jd", "candid", "separation")
    return mt.dedup_matches(pairs, by=("objectId",) if even else None).select(
        "objectId", "triggerId", "gcn_status", "candid", rnd("separation").alias("separation")
    )


@query(f"""select candid, "triggerId", '<notice ' || trigger_no || '/>' as raw_event from {sq.PAIRS}
  where sep * 60 <= 1.5::double * err_arcmin""")
def reattach_raw(spark, sf):
    pairs = _pairs(spark, sf).select("candid", "triggerId", "gcn_status")
    return mt.reattach_raw(pairs, dv.notices(spark, sf)).select("candid", "triggerId", "raw_event")


# --- scalars ---------------------------------------------------------------------------------------------------


@query(f"""select event_id, round({sq.sep_deg(sq.ra(7919), sq.dec(104729), sq.ra(6151), sq.dec(15485))}, 6) as separation
  from events""")
def angular_separation(spark, sf):
    sep = sky.angular_separation(dv._ra(7919), dv._dec(104729), dv._ra(6151), dv._dec(15485))
    return dv.events(spark, sf).select("event_id", rnd(sep).alias("separation"))


_EVENT_POINTS = sq.with_point(f"(select event_id, {sq.ra(7919)} as ra, {sq.dec(104729)} as dec from events)", "ra", "dec")


@query(f"""select event_id, hpix4, hpix32 from {sq.with_ring(sq.with_ring(_EVENT_POINTS, 4, 'hpix4'), 32, 'hpix32')}""")
def ang2pix_ring(spark, sf):
    ra, dec = dv._ra(7919), dv._dec(104729)
    return dv.events(spark, sf).select(
        "event_id", sky.ang2pix_ring(4, ra, dec).alias("hpix4"), sky.ang2pix_ring(32, ra, dec).alias("hpix32")
    )


@query(f"select event_id, round({sq.JD} * 1e5)::bigint as jd_e5 from events")
def to_julian_date(spark, sf):
    return dv.events(spark, sf).select("event_id", F.round(to_jd(F.col("ts")) * 1e5).cast("bigint").alias("jd_e5"))


@query(f"""select event_id, round(({sq.JD} - 2451545::double) * 86400000000::double)::bigint + 946728000000000
  as micros from events""")
def from_julian_date(spark, sf):
    back = from_jd(to_jd(F.col("ts")))
    return dv.events(spark, sf).select("event_id", F.unix_micros(back).alias("micros"))


for _old, _new in (("to_julian_date", "to_jd"), ("from_julian_date", "from_jd")):
    QUERIES[_new], SQL[_new] = QUERIES.pop(_old), SQL.pop(_old)


@query(f"""select candid, strftime(t, '%Y') as year, strftime(t, '%m') as month, strftime(t, '%d') as day from
  (select candid, make_timestamp(round((jd - 2451545::double) * 86400000000::double)::bigint + 946728000000000) as t
   from {sq.ALERTS})""")
def partition_columns(spark, sf):
    return partition_cols(dv.alerts(spark, sf)).select("candid", "year", "month", "day")


QUERIES["partition_cols"], SQL["partition_cols"] = QUERIES.pop("partition_columns"), SQL.pop("partition_columns")


@query(f"""select trigger_no, mode from {sq.NOTICES}, (values ('online', 0.2916666666666667::double, 0.7083333333333334::double),
    ('offline', 7.291666666666667::double, 0.75::double)) m(mode, before, after)
  where trigger_jd >= {sq.jd("timestamp '2024-01-15'")} - before and trigger_jd < {sq.jd("timestamp '2024-01-15'")} + after""")
def notices_of_night(spark, sf):
    n = dv.notices(spark, sf)
    windows = [night_bounds(n, dv.NIGHT, m).select("trigger_no", F.lit(m).alias("mode")) for m in ("online", "offline")]
    return windows[0].unionByName(windows[1])


QUERIES["night_bounds"], SQL["night_bounds"] = QUERIES.pop("notices_of_night"), SQL.pop("notices_of_night")

_RATE3 = "(case event_id % 3 when 0 then 250 when 1 then 100 else 60 end)::double"
_DAYS = "((event_id % 1000)::double / 10::double)"
_RADIUS = "((event_id % 401)::double / 10::double)"


def _rate3() -> Column:
    return F.when(dv._mod(3) == 0, 250.0).when(dv._mod(3) == 1, 100.0).otherwise(60.0)


@query(f"""select event_id, round(31 * (pi() * {_RADIUS} * {_RADIUS}), 4) as mean_transients,
  round(31 * (pi() * {_RADIUS} * {_RADIUS}) / 141994, 8) as p_location, round({_RATE3} * ({_DAYS} / 365.25::double), 8) as lambda,
  round(1 - exp(-({_RATE3} * ({_DAYS} / 365.25::double))), 9) as p_at_least_one,
  round({_p_sql(_RATE3, _DAYS, _RADIUS)}, 9) as p_serendipity from events""")
def p_serendipity(spark, sf):
    days, radius = dv._mod(1000).cast("double") / 10.0, dv._mod(401).cast("double") / 10.0
    return dv.events(spark, sf).select(
        "event_id", rnd(pr.mean_transients(radius), 4).alias("mean_transients"),
        rnd(pr.p_location(radius), 8).alias("p_location"), rnd(pr.poisson_lambda(days, _rate3()), 8).alias("lambda"),
        rnd(pr.p_at_least_one(days, _rate3()), 9).alias("p_at_least_one"),
        rnd(pr.p_serendipity(_rate3(), days, radius), 9).alias("p_serendipity"),
    )


_OWN_DELAY = "((event_id % 41)::double / 4::double - 5::double)"
_OWN_INSIDE = "((event_id % 97)::double <= 1.5::double * (event_id % 59)::double)"


@query(f"""select event_id, case when {_OWN_DELAY} >= 0 and {_OWN_INSIDE} then 0.5::double else -1::double end as assoc_neutrino,
  round(case when {_OWN_DELAY} > 0 and {_OWN_INSIDE} then
    {_p_sql(_RATE3, _OWN_DELAY + ' / 365.25::double', '((event_id % 59)::double / 60)')} else -1 end, 9) as assoc_grb from events""")
def assoc_neutrino(spark, sf):
    delay, err = dv._mod(41).cast("double") / 4.0 - 5.0, dv._mod(59).cast("double")
    inside = dv._mod(97).cast("double") <= 1.5 * err
    return dv.events(spark, sf).select(
        "event_id", pr.assoc_neutrino(delay, inside).alias("assoc_neutrino"),
        rnd(pr.assoc_grb(delay, inside, _rate3(), err), 9).alias("assoc_grb"),
    )


# --- regions -----------------------------------------------------------------------------------------------------


@query(f"select trigger_no, list_sort(list(hpix))::varchar as cells, count(*) as n from {_COVER} group by trigger_no")
def circle_cover(spark, sf):
    c = rg.circle_cover(dv.notices(spark, sf), NSIDE)
    cells = F.concat(F.lit("["), F.array_join(F.array_sort("hpix_circle"), ", "), F.lit("]"))
    return c.select("trigger_no", cells.alias("cells"), F.size("hpix_circle").cast("bigint").alias("n"))


@query(f"""select trigger_no, hpix, round(ra, 6) as gcn_ra, round(dec, 6) as gcn_dec
  from {_COVER} join {sq.NOTICES} using (trigger_no)""")
def explode_cells(spark, sf):
    e = rg.explode_cells(rg.circle_cover(dv.notices(spark, sf), NSIDE))
    return e.select("trigger_no", "hpix", rnd("gcn_ra").alias("gcn_ra"), rnd("gcn_dec").alias("gcn_dec"))


_MAP_CELLS = f"""(select distinct "triggerId", hpix from {sq.with_ring(sq.with_nest_centre(sq.REGION), NSIDE, 'hpix')})"""


@query(f"""select "triggerId", hpix from {_COVER} union all select "triggerId", hpix from {_MAP_CELLS}""")
def notice_cells(spark, sf):
    maps = sm.skymap_cells(sm.credible_region(dv.skymap_pixels(spark, sf)), NSIDE)
    return rg.notice_cells(dv.notices(spark, sf), maps, NSIDE).select("triggerId", "hpix")


# --- alerts ------------------------------------------------------------------------------------------------------


def _none(value: str, n: int) -> str:
    return f"(case when event_id % {n} = 0 then -999::double else {value} end)"


def _tenth(n: int, step: int, base: str = "0", scale: str = "10") -> str:
    return f"({base}::double + ((event_id * {step}) % {n})::double / {scale}::double)"


_SSDIST, _PSDIST, _GAIA = _none(_tenth(300, 7), 3), _none(_tenth(300, 11), 4), _none(_tenth(900, 13), 5)
_SG = _tenth(11, 3)
_NEAR = f"""({_SSDIST} > 5 or {_SSDIST} = -999) and ({_PSDIST} > 2 or {_PSDIST} = -999 or {_SG} < 0.5::double)
  and ({_GAIA} > 5 or {_GAIA} = -999)"""


@query(f"select event_id as candid from events where event_type <> 'error' and {_NEAR}")
def alert_quality_filter(spark, sf):
    return al.alert_quality_filter(dv.alert_packets(spark, sf)).select("candidate.candid")


@query(f"""select 'OBJECT' as kind, event_id as candid, round({sq.ra(7919)}, 6) as ztf_ra, round({sq.dec(104729)}, 6) as ztf_dec,
  'absent' as candid_column, 'absent' as stamps from events where event_type <> 'error'""")
def alert_prune(spark, sf):
    p = al.alert_position(al.alert_prune(dv.alert_packets(spark, sf)))

    def state(c: str) -> Column:
        return F.lit("present" if c in p.columns else "absent")

    return p.select(
        F.lit("OBJECT").alias("kind"), "candidate.candid", rnd("ztf_ra").alias("ztf_ra"), rnd("ztf_dec").alias("ztf_dec"),
        state("candid").alias("candid_column"), state("cutoutScience").alias("stamps"),
    )


_SIZE = "(2 + event_id % 9)"
_MAG, _LIM = _tenth(60, 17, "15"), _tenth(50, 23, "16")
_FID = "(1 + event_id % 2)::int"
_HISTORY = f"""(select event_id, k, case when k < {_SIZE} then (case when (event_id + k) % 4 = 0 then null
      else 15::double + ((event_id * 7 + k * 13) % 60)::double / 10::double end) else {_MAG} end as mag,
    case when k < {_SIZE} then 16::double + ((event_id * 7 + k * 13) * 3 % 50)::double / 10::double else {_LIM} end as lim,
    case when k < {_SIZE} then {sq.JD} - ({_SIZE} - k)::double / 4::double else {sq.JD} end as jd,
    case when k < {_SIZE} then (1 + (event_id + k * k) % 2)::int else {_FID} end as fid,
    {_FID} as cur_fid, {_MAG} as cur_mag, {sq.JD} as cur_jd, {sq.START} as start, {_SIZE} as last_k
  from (select *, unnest(range(0, {_SIZE} + 1)) as k from events where event_type <> 'error'))"""


@query(f"""select event_id as candid, count(*)::int as n, round(sum(lim), 6) as sum_lim, round(arg_max(lim, k), 6) as last_lim,
  count(mag)::int as detections, sum(fid)::bigint as sum_fid, round(min(jd), 6) as first_jd from {_HISTORY} group by event_id""")
def history_concat(spark, sf):
    h = al.history_concat(dv.alert_packets(spark, sf))
    zero = F.lit(0.0)
    return h.select(
        "candid", F.size("cmagpsf").alias("n"),
        rnd(F.aggregate("cdiffmaglim", zero, lambda a, x: a + x)).alias("sum_lim"),
        rnd(F.element_at("cdiffmaglim", -1)).alias("last_lim"),
        F.size(F.filter("cmagpsf", lambda x: ~F.isnan(x))).alias("detections"),
        F.aggregate("cfid", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("sum_fid"),
        rnd(F.array_min("cjd")).alias("first_jd"),
    )


_PREV = f"""(select event_id, max(cur_mag) as cur_mag, max(cur_jd) as cur_jd, max(start) as start,
    count(*) filter (where fid = cur_fid) as same, max(k) filter (where fid = cur_fid and k < last_k) as pk,
    arg_min(jd, k) filter (where mag is not null) as first_jd from {_HISTORY} group by event_id)"""
_RATES = f"""(select p.event_id, same, p.cur_mag, p.cur_jd, p.start, first_jd, h.mag as pmag, h.lim as plim, h.jd as pjd,
    p.cur_mag - coalesce(h.mag, h.lim) as delta from {_PREV} p left join {_HISTORY} h on h.event_id = p.event_id and h.k = p.pk)"""
_RATE_COLS = """round(case when same >= 2 then delta else cur_mag end, 6) as {0},
  case when same >= 2 then round(delta / (cur_jd - pjd), 6) end as {1},
  round(case when same >= 2 then first_jd else cur_jd end, 6) as {2},
  round(case when same >= 2 then first_jd - start else 0 end, 6) as {3},
  (same >= 2 and pmag is null) as {4}"""


@query(f"""select event_id as candid, {_RATE_COLS.format('abs_rate', 'norm_rate', 'first_variation_time', 'diff_start_hist', 'from_upper')}
  from {_RATES}""")
def mag_rate(spark, sf):
    r = al.with_mag_rate(al.history_concat(dv.alert_packets(spark, sf)))
    return r.select(
        "candid", rnd("c_rate.abs_rate").alias("abs_rate"),
        rnd(F.nanvl("c_rate.norm_rate", F.lit(None).cast("double"))).alias("norm_rate"),
        rnd("c_rate.first_variation_time").alias("first_variation_time"),
        rnd("c_rate.diff_start_hist").alias("diff_start_hist"), F.col("c_rate.from_upper").alias("from_upper"),
    )


@query(f"""select event_id as candid, {_RATE_COLS.format('delta_mag', 'rate', 'start_vartime', 'diff_vartime', 'from_upper')}
  from {_RATES}""")
def rate_columns(spark, sf):
    r = al.rate_columns(al.with_mag_rate(al.history_concat(dv.alert_packets(spark, sf))))
    return r.select(
        "candid", rnd("delta_mag").alias("delta_mag"), rnd(F.nanvl("rate", F.lit(None).cast("double"))).alias("rate"),
        rnd("start_vartime").alias("start_vartime"), rnd("diff_vartime").alias("diff_vartime"), "from_upper",
    )


_XMATCH = "case event_id % 3 when 0 then 'Unknown' when 1 then 'Galaxy' else 'Star' end"
_CLASS = f"""(case when event_id % 4 = 3 then 'Solar System' when event_id % 3 = 2 then 'Star'
  when {_tenth(11, 3)} > 0.8::double then 'Microlensing candidate'
  when {_tenth(11, 9)} > 0.5::double and {_tenth(11, 7)} > 0.5::double and (event_id * 3) % 40 < 20 then 'Early supernova'
  when {_tenth(11, 8)} > 0.5::double then 'Kilonova candidate'
  when event_id % 3 = 1 and {_tenth(11, 5)} < 0.5::double then 'Galaxy' else 'Unknown' end)"""


@query(f"select event_id as candid, {_CLASS} as alert_class from events where event_type <> 'error'")
def classify(spark, sf):
    return al.classify(dv.alert_packets(spark, sf), CLASS_RULES).select("candid", "alert_class")


# --- raw messages -> notices ---------------------------------------------------------------------------------------

# the derived messages: what is in them, and which are broken or not for us
_TOPIC = """(case when event_id % 29 = 0 then 'gcn.unknown' else 'gcn.classic.voevent.' ||
  (['FERMI_GBM_GND_POS','SWIFT_XRT_POSITION','INTEGRAL_WEAK','ICECUBE_ASTROTRACK_GOLD'])[(event_id % 4 + 1)::int] end)"""
_IVORN = f"""('ivo://nasa.gsfc.gcn/' || (['Fermi','SWIFT','INTEGRAL','AMON'])[(event_id % 4 + 1)::int] || '#' ||
  case when event_id % 4 = 3 then 'ICECUBE_' else '' end || {sq.INSTRUMENT8} || '_Pos_' || event_id)"""
_ERR = "(case when event_id % 11 = 0 then 0 else 1 + event_id % 10 end)::double"
_LISTENED = "(event_id % 19 <> 0)"
_REGION = f"""(case when event_id % 4 = 0 and (event_id // 4) % 2 = 0 then (case when {_ERR} = 0 then 1::double else {_ERR} * 60 end)
  when event_id % 4 = 0 then (case when {_ERR} = 0 then 1::double / 60 else {_ERR} end)
  when event_id % 4 = 1 then (case when {_ERR} = 0 then 1::double / 60 else {_ERR} * 60 end) else {_ERR} * 60 end)"""
# times of the messages carry hundredths of a second
_CENTI = "(epoch_us(ts) // 10000)"
_XML_OK = "event_type = 'error' and event_id % 29 <> 0 and event_id % 23 <> 0"
_XML_KEPT = f"{_XML_OK} and event_id % 17 <> 0 and {_LISTENED}"
_JSON_OK = "event_type = 'error' and event_id % 23 <> 0"
_JSON_KEPT = f"{_JSON_OK} and event_id % 17 <> 0"


@query(f"""select topic, format, count(*) as n from (select {_TOPIC} as topic, case when event_id % 29 = 0 then null else 'xml' end as format
    from events where event_type = 'error' union all select 'igwn.gwalert', 'json' from events where event_type = 'error')
  group by all""")
def route_format(spark, sf):
    return nt.route_format(dv.raw_notices(spark, sf)).groupBy("topic", "format").agg(F.count("*").alias("n"))


@query(f"""select {_IVORN} as ivorn, case when event_id % 17 = 0 then 'test' else 'observation' end as role,
  case when event_id % 19 = 0 then '999' else {sq.PACKET8}::varchar end as packet_type, '0x0' as other_param,
  round({sq.ra(6151)}, 6) as ra, round({sq.dec(15485)}, 6) as dec, {_ERR} as error_deg
  from events where {_XML_OK}""")
def parse_xml_notices(spark, sf):
    p = nt.parse_xml_notices(nt.route_format(dv.raw_xml(spark, sf)))
    p = computed_once(p, "xml").filter(F.col("xml._ivorn").isNotNull() & F.col("xml._corrupt").isNull())
    ra, dec, err = nt.extract_position()
    return p.select(
        F.substring_index("xml._ivorn", "!", 1).alias("ivorn"), F.col("xml._role").alias("role"),
        nt.top_param("Packet_Type").alias("packet_type"), nt.top_param("Trigger_ID").alias("other_param"),
        rnd(ra).alias("ra"), rnd(dec).alias("dec"), err.alias("error_deg"),
    )


_SID = "((case when event_id % 17 = 0 then 'M' else 'S' end) || event_id)"
_ALERT_TYPE = "(case when event_id % 13 = 0 then 'RETRACTION' else (['PRELIMINARY','INITIAL','UPDATE'])[(event_id % 3 + 1)::int] end)"
_DETECTORS = "case when event_id % 13 = 0 then null when event_id % 2 = 0 then 'H1_L1' else 'V1' end"


@query(f"""select {_SID} as superevent_id, {_ALERT_TYPE} as alert_type, {_DETECTORS} as instruments,
  case when event_id % 13 = 0 then null else event_id % 2 = 0 end as significant,
  case when event_id % 13 = 0 then null else (ceil((5760 + ceil(n * 16 / 2880.0) * 2880) / 3) * 4)::int end as map_length
  from events join (select event_id, count(*) as n from {sq.PIXELS} group by event_id) using (event_id) where {_JSON_OK}""")
def parse_json_notices(spark, sf):
    p = computed_once(nt.parse_json_notices(nt.route_format(dv.raw_json(spark, sf))), "json")
    return p.filter(F.col("json._corrupt").isNull()).select(
        "json.superevent_id", "json.alert_type", F.array_join("json.event.instruments", "_").alias("instruments"),
        "json.event.significant", F.length("json.event.skymap").alias("map_length"),
    )


def _parsed_xml(spark, sf) -> DataFrame:
    p = computed_once(nt.parse_json_notices(nt.parse_xml_notices(nt.route_format(dv.raw_notices(spark, sf)))), "xml", "json")
    p = p.filter(F.col("xml._ivorn").isNotNull() | F.col("json.superevent_id").isNotNull())
    return nt.detect_observatory(p)


@query(f"""select observatory, count(*) as n from (select {sq.OBS} as observatory from events where {_XML_OK}
    union all select 'LVK' from events where {_JSON_OK}) group by observatory""")
def detect_observatory(spark, sf):
    return _parsed_xml(spark, sf).groupBy("observatory").agg(F.count("*").alias("n"))


@query(f"""select observatory, observed, listened, count(*) as n from (
    select {sq.OBS} as observatory, event_id % 17 <> 0 as observed, {_LISTENED} as listened from events where {_XML_OK}
    union all select 'LVK', event_id % 17 <> 0, true from events where {_JSON_OK}) group by all""")
def is_listened_packet(spark, sf):
    p = _parsed_xml(spark, sf)
    listened = nt.is_listened(F.col("observatory"), nt.packet_type())
    p = p.select("observatory", nt.is_observation().alias("observed"), listened.alias("listened"))
    return p.groupBy("observatory", "observed", "listened").agg(F.count("*").alias("n"))


@query(f"""select observatory, instrument, event, count(*) as n from (select {sq.OBS} as observatory,
      case when event_id % 4 = 3 then '' else {sq.INSTRUMENT8} end as instrument,
      case when event_id % 4 = 3 then {sq.INSTRUMENT8} else '' end as event from events where {_XML_OK}
    union all select 'LVK', {_DETECTORS}, 'gw' from events where {_JSON_OK}) group by all""")
def extract_instrument(spark, sf):
    p = nt.extract_instrument(_parsed_xml(spark, sf))
    return p.groupBy("observatory", "instrument", "event").agg(F.count("*").alias("n"))


_UTC_XML = f"strftime(make_timestamp({_CENTI} * 10000), '%Y-%m-%d %H:%M:%S.') || lpad((({_CENTI} % 100) * 10)::varchar, 3, '0')"
_UTC_JSON = "strftime(ts, '%Y-%m-%d %H:%M:%S.') || lpad((epoch_us(ts) // 1000 % 1000)::varchar, 3, '0')"


@query(f"""select event_id::varchar as trigger_id, {_UTC_XML} as utc from events where {_XML_OK} union all
  select {_SID}, case when event_id % 13 = 0 then null else {_UTC_JSON} end from events where {_JSON_OK}""")
def extract_trigger_id(spark, sf):
    return _parsed_xml(spark, sf).select(
        nt.extract_trigger_id().alias("trigger_id"), iso_utc(nt.extract_trigger_time()).alias("utc")
    )


@query(f"""select event_id::varchar as "triggerId", round({_REGION}, 6) as region_arcmin,
  round(case when event_id % 4 = 3 and {_ERR} = 0 then 1::double / 60 else {_REGION} end, 6) as err_arcmin
  from events where {_XML_KEPT}""")
def error_radius(spark, sf):
    rows = nt.notice_row(nt.parse_notices(dv.raw_xml(spark, sf)))
    return rows.select("triggerId", rnd("region_arcmin").alias("region_arcmin"), rnd("err_arcmin").alias("err_arcmin"))


_DAY_COLS = "strftime(ts, '%Y') as year, strftime(ts, '%m') as month, strftime(ts, '%d') as day"
_PEAKS = f"""(select event_id, tt * 90 as ra, degrees(asin(z)) as dec from {sq.with_nest_centre(
  '(select * from (select *, row_number() over (partition by event_id order by probdensity desc, row_idx) as rk from '
  + sq.PIXELS + ') where rk = 1)')})"""
_AREAS = f"(select event_id, sum(area_sr) * pow(180 / pi() * 60, 2) as area from {sq.REGION} group by event_id)"
_NOTICE_ROWS = f"""(select {sq.OBS} as observatory, case when event_id % 4 = 3 then '' else {sq.INSTRUMENT8} end as instrument,
    case when event_id % 4 = 3 then {sq.INSTRUMENT8} else '' end as event, 'alert' as event_type, {_IVORN} as ivorn,
    event_id::varchar as "triggerId", round({sq.ra(6151)}, 6) as ra, round({sq.dec(15485)}, 6) as dec,
    round(case when event_id % 4 = 3 and {_ERR} = 0 then 1::double / 60 else {_REGION} end, 4) as err_arcmin,
    round({sq.jd(f'make_timestamp({_CENTI} * 10000)')}, 6) as "triggerTimejd", {_UTC_XML} as "triggerTimeUTC", {_DAY_COLS}
    from events where {_XML_KEPT}
  union all select 'LVK', {_DETECTORS}, 'gw', case when event_id % 13 = 0 then 'retraction' else 'alert' end, '', {_SID},
    case when event_id % 13 = 0 then null else round(p.ra, 6) end, case when event_id % 13 = 0 then null else round(p.dec, 6) end,
    case when event_id % 13 = 0 then null else round(a.area, 4) end,
    case when event_id % 13 = 0 then null else round({sq.jd('make_timestamp(epoch_us(ts) // 1000 * 1000)')}, 6) end,
    case when event_id % 13 = 0 then null else {_UTC_JSON} end, {_DAY_COLS}
    from events join {_PEAKS} p using (event_id) join {_AREAS} a using (event_id) where {_JSON_KEPT})"""


@query(f"select * from {_NOTICE_ROWS}")
def notice_row(spark, sf):
    rows = nt.notice_row(nt.parse_notices(dv.raw_notices(spark, sf)))
    return rows.select(
        "observatory", "instrument", "event", "event_type", "ivorn", "triggerId", rnd("ra").alias("ra"),
        rnd("dec").alias("dec"), rnd("err_arcmin", 4).alias("err_arcmin"),
        rnd("triggerTimejd", 6).alias("triggerTimejd"), "triggerTimeUTC", "year", "month", "day",
    )


@query(f"""select reason, topic, count(*) as n from (
    select case when event_id % 29 = 0 then 'unknown topic' else 'malformed message' end as reason, {_TOPIC} as topic
    from events where event_type = 'error' and (event_id % 29 = 0 or event_id % 23 = 0)
    union all select 'malformed message', 'igwn.gwalert' from events where event_type = 'error' and event_id % 23 = 0)
  group by all""")
def dead_letter(spark, sf):
    bad = nt.dead_letter(nt.parse_notices(dv.raw_notices(spark, sf)))
    return bad.groupBy("reason", "topic").agg(F.count("*").alias("n"))


_VERSION_BASE = "make_timestamp((1704067200 + (user_id % 20) * 86400) * 1000000)"
_VERSIONS = f"""(select event_id, user_id::varchar as "triggerId", {_DAY_COLS.replace('ts', _VERSION_BASE)},
    case when not fresh or rk = 1 then 'initial' else 'update_' || (rk - 2) end as gcn_status
  from (select *, row_number() over (partition by user_id, fresh order by ts, event_id) as rk from
    (select *, {sq.JD} - {sq.jd(_VERSION_BASE)} < 7 as fresh from events where event_type = 'error')))"""


def _versions(spark, sf) -> DataFrame:
    return nt.notice_status(dv.notice_versions(spark, sf), tie=F.col("event_id"))


@query(f"""select event_id, "triggerId", gcn_status from {_VERSIONS}""")
def notice_status(spark, sf):
    return _versions(spark, sf).select("event_id", "triggerId", "gcn_status")


@query(f"""select e.event_id as request, v.event_id as notice from (select event_id, user_id::varchar as "triggerId",
      {_DAY_COLS.replace('ts', _VERSION_BASE)}, case when event_id % 3 = 0 then 'initial' else 'update_' || (event_id % 3 - 1) end as gcn_status
    from events where event_type <> 'error') e join {_VERSIONS} v using (year, month, day, "triggerId", gcn_status)""")
def lookup_notices(spark, sf):
    base = F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("user_id"), F.lit(20)) * 86400)
    status = F.when(dv._mod(3) == 0, "initial").otherwise(F.concat(F.lit("update_"), (dv._mod(3) - 1).cast("string")))
    wanted = dv.events(spark, sf).filter(F.col("event_type") != "error").select(
        F.col("event_id").alias("request"), F.col("user_id").cast("string").alias("triggerId"),
        status.alias("gcn_status"),
        *[F.date_format(base, p).alias(n) for n, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))],
    )
    found = lookup_notice(_versions(spark, sf), wanted)
    return found.select("request", F.col("event_id").alias("notice"))


QUERIES["lookup_notice"], SQL["lookup_notice"] = QUERIES.pop("lookup_notices"), SQL.pop("lookup_notices")


@query(f"""select observatory, case when instrument = '' then event else instrument end as instrument_or_event, count(*) as notices,
  min(utc) as first_trigger, max(utc) as last_trigger from {sq.NOTICES}
  group by rollup(observatory, case when instrument = '' then event else instrument end)""")
def notice_inventory(spark, sf):
    return nt.notice_inventory(dv.notices(spark, sf))


def _rule_sql(column: str, rule: str, broken: str, src: str) -> str:
    return f"""select '{column}' as "column", '{rule}' as rule, count(*) as checked, count(*) filter (where {broken}) as violations from {src}"""


_NOTICE_CHECKS = [
    *[(c, "not_null", f'"{c}" is null') for c in ("observatory", "instrument", "event", "triggerId", "ra", "dec", "err_arcmin")],
    *[("ivorn", "not_null", "false"), ("raw_event", "not_null", "false"), ("triggerTimejd", "not_null", "trigger_jd is null")],
    ("triggerTimeUTC", "not_null", "utc is null"), ("ra", "min 0.0", "ra < 0"), ("ra", "max 360.0", "ra > 360"),
    ("dec", "min -90.0", "dec < -90"), ("dec", "max 90.0", "dec > 90"), ("err_arcmin", "min 0.0", "err_arcmin < 0"),
    ("triggerTimejd", "min 0.0", "trigger_jd < 0"),
]


@query(" union all ".join(_rule_sql(c, r, b, sq.NOTICES) for c, r, b in _NOTICE_CHECKS) + f"""
  union all select 'triggerId', 'unique', count(*), count(*) - count(distinct "triggerId") from {sq.NOTICES}""")
def validate_notices(spark, sf):
    return validate(dv.notices(spark, sf), NOTICE_RULES)


_PACKETS = f"""(select event_id, {_SSDIST} as "candidate.ssdistnr", {_PSDIST} as "candidate.distpsnr1", {_GAIA} as "candidate.neargaia",
  {sq.ra(7919)} as "candidate.ra", {sq.dec(104729)} as "candidate.dec", {sq.START} as "candidate.jdstarthist",
  (event_id * 3) % 40 as "candidate.ndethist", {_tenth(11, 1)} as "candidate.drb", {_tenth(11, 5)} as "candidate.classtar",
  {_MAG} as "candidate.magpsf", {_LIM} as "candidate.diffmaglim", {sq.JD} as "candidate.jd", {_FID} as "candidate.fid",
  'ZTF' || lpad((17 + event_id % 8)::varchar, 2, '0') || translate(lpad(user_id::varchar, 7, '0'), '0123456789', 'abcdefghij') as "objectId",
  event_id as candid, {_XMATCH} as cdsxmatch, event_id % 4 as roid, {_tenth(11, 2)} as rf_snia_vs_nonia, {_tenth(11, 7)} as snn_snia_vs_nonia,
  {_tenth(11, 9)} as snn_sn_vs_all, {_tenth(11, 3)} as mulens, {_tenth(11, 8)} as rf_kn_vs_nonkn from events where event_type <> 'error')"""


def _alert_check(rule) -> str:
    c = f'"{rule.column}"'
    bad = {
        "not_null": f"{c} is null", "min": f"{c} < {rule.value}", "max": f"{c} > {rule.value}", "above": f"{c} <= {rule.value}",
        "isin": f"{c} not in {rule.value}", "matches": f"not regexp_matches({c}, '{rule.value}')",
    }[rule.kind]
    return _rule_sql(rule.column, rule.name.replace("'", "''"), bad, _PACKETS)


@query(" union all ".join(_alert_check(r) for r in ALERT_RULES if r.kind != "unique") + f"""
  union all select 'candid', 'unique', count(*), count(*) - count(distinct candid) from {_PACKETS}""")
def validate_alerts(spark, sf):
    return validate(dv.alert_packets(spark, sf), ALERT_RULES)


# --- sky maps ------------------------------------------------------------------------------------------------------


@query(f"""select "triggerId", row_idx, uniq, level, ipix, round(area_sr, 9) as area_sr from {sq.PIXELS}""")
def uniq_decode(spark, sf):
    p = sm.uniq_decode(dv.skymap_pixels(spark, sf))
    return p.select("triggerId", "row_idx", "uniq", "level", "ipix", rnd("area_sr", 9).alias("area_sr"))


@query(f"""select "triggerId", row_idx, uniq, round(probdensity, 9) as probdensity from {sq.PIXELS}""")
def skymap_explode(spark, sf):
    """Decodes the base64 FITS text of every map notice."""
    maps = dv.map_notices(spark, sf).select("triggerId", "gcn_status", dv.fits_text("pixels").alias("skymap"))
    maps = computed_once(maps, "skymap")
    return sm.skymap_explode(maps).select("triggerId", "row_idx", "uniq", rnd("probdensity", 9).alias("probdensity"))


@query(f"""select "triggerId", row_idx, uniq, round(cumprob, 9) as cumprob from {sq.REGION}""")
def credible_region(spark, sf):
    r = sm.credible_region(dv.skymap_pixels(spark, sf))
    return r.select("triggerId", "row_idx", "uniq", rnd("cumprob", 9).alias("cumprob"))


@query(f"""select 'S' || event_id as "triggerId", round(area, 4) as area_arcmin2 from {_AREAS}""")
def credible_area(spark, sf):
    a = sm.credible_area(sm.credible_region(dv.skymap_pixels(spark, sf)))
    return a.select("triggerId", rnd("area_arcmin2", 4).alias("area_arcmin2"))


@query(f"""select 'S' || event_id as "triggerId", round(ra, 6) as ra, round(dec, 6) as dec from {_PEAKS}""")
def skymap_peak(spark, sf):
    p = sm.skymap_peak(dv.skymap_pixels(spark, sf))
    return p.select("triggerId", rnd("ra").alias("ra"), rnd("dec").alias("dec"))


@query(f"""select "triggerId", hpix from {_MAP_CELLS}""")
def skymap_cells(spark, sf):
    return sm.skymap_cells(sm.credible_region(dv.skymap_pixels(spark, sf)), NSIDE).select("triggerId", "hpix")


_POINTS = f"""(select event_id, 'S' || event_id as "triggerId", k, (((event_id * 6151 + k * 9973) % 36000)::double / 100::double) as ra,
  degrees(asin(2::double * (((event_id * 15485 + k * 31337) % 100003)::double / 100003::double) - 1::double)) as dec
  from (select *, unnest(range(0, 3)) as k from events where event_type = 'error'))"""


def _density_sql(points: str, keep: str) -> str:
    """Density of points at their map's pixel, found by the point's cell on each of the three levels."""
    nested = points
    for level in (1, 2, 3):
        nested = sq.with_nest(nested, level, f"n{level}")
    return f"""(select {keep}, p.probdensity * pow(pi() / 180, 2) as density from {nested} q join {sq.PIXELS} p
      on p."triggerId" = q."triggerId" and p.ipix = case p.level when 1 then q.n1 when 2 then q.n2 else q.n3 end)"""


@query(f"""select "triggerId", k, round(density, 9) as density from {_density_sql(sq.with_point(_POINTS, 'ra', 'dec'), 'q."triggerId", k')}""")
def skymap_density_at(spark, sf):
    d = sm.skymap_density_at(_map_points(spark, sf), dv.skymap_pixels(spark, sf))
    return d.select("triggerId", "k", rnd("density", 9).alias("density"))


def _map_points(spark, sf) -> DataFrame:
    """Three points per map notice."""
    k = F.col("k")
    return (
        dv.map_events(spark, sf).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(2))))
        .select(
            "triggerId", "gcn_status", k.cast("bigint").alias("k"),
            (F.pmod(F.col("event_id") * 6151 + k * 9973, F.lit(36000)).cast("double") / 100.0).alias("ra"),
            F.degrees(F.asin(
                2.0 * (F.pmod(F.col("event_id") * 15485 + k * 31337, F.lit(100003)).cast("double") / 100003.0) - 1.0
            )).alias("dec"),
        )
    )


_HOLED = f"(select * from {sq.PIXELS} where row_idx % 5 <> 0)"


def _holed_pixels(spark, sf) -> DataFrame:
    """Maps with a fifth of their pixels missing, completed as ingestion stores them."""
    return sm.complete_skymap(dv.skymap_pixels(spark, sf).filter(F.col("row_idx") % 5 != 0))


@query(f"""select "triggerId", row_idx, uniq, round(cumprob, 9) as cumprob from (select *, sum(area_sr * probdensity) over
  (partition by event_id order by probdensity desc, row_idx rows unbounded preceding) as cumprob from {_HOLED}) where cumprob < 0.6::double""")
def credible_region_gaps(spark, sf):
    """The region of a partial map is that of its own pixels, not of what fills its gaps."""
    region = sm.credible_region(_holed_pixels(spark, sf), 0.6)
    return region.select("triggerId", "row_idx", "uniq", rnd("cumprob", 9).alias("cumprob"))


@query(f"""select "triggerId", k, round(coalesce(arg_max(d, start) filter (where start <= n3), arg_max(d, start)), 9) as density from
  (select q."triggerId", q.k, q.n3, p.probdensity * pow(pi() / 180, 2) as d, p.ipix * (1::bigint << (2 * (3 - p.level))) as start
   from {sq.with_nest(sq.with_point(_POINTS, 'ra', 'dec'), 3, 'n3')} q join {_HOLED} p on p."triggerId" = q."triggerId")
  group by "triggerId", k""")
def skymap_density_gaps(spark, sf):
    """In a gap a point has the density of the pixel before it, before the first pixel that of the last."""
    d = sm.skymap_density_at(_map_points(spark, sf), _holed_pixels(spark, sf))
    return d.select("triggerId", "k", rnd("density", 9).alias("density"))


_GW_PAIRS = f"""(select a.*, k."triggerId" from {_ALERT_CELLS} a join {_MAP_CELLS} k using (hpix)
  join (select 'S' || event_id as "triggerId", {sq.JD} as trigger_jd from events where event_type = 'error') n using ("triggerId")
  where a.jdstarthist > n.trigger_jd and a.jd <= n.trigger_jd + 7::double)"""


@query(f"""select candid, "triggerId", round(density, 9) as p_assoc from {_density_sql(
    sq.with_point('(select * exclude (z, c, tt) from ' + _GW_PAIRS + ')', 'ztf_ra', 'ztf_dec'), 'q.candid, q."triggerId"')}""")
def assoc_gw(spark, sf):
    """Alerts in the cells of a map's 90 % region, valued by the map's density at the alert."""
    pixels = dv.skymap_pixels(spark, sf)
    cells = sm.skymap_cells(sm.credible_region(pixels), NSIDE)
    notices = dv.map_events(spark, sf).select("triggerId", "gcn_status", "observatory", "triggerTimejd")
    pairs = sm.skymap_match(dv.alerts(spark, sf), pixels, cells, notices, NSIDE, max_delay=mt.MAX_DELAY)
    value = mt.p_assoc(F.lit(0.0), F.lit(0.0), F.col("density"))
    pairs = pairs.withColumn("region_arcmin", F.lit(None).cast("double")).withColumn("p_assoc", value)
    return pairs.select("candid", "triggerId", rnd("p_assoc", 9).alias("p_assoc"))


# --- matches -> output ---------------------------------------------------------------------------------------------


def _night(spark, sf, **kw) -> DataFrame:
    return crossmatch_night(
        dv.alert_packets(spark, sf), dv.notice_table(spark, sf), MATCH, dv.skymap_pixels(spark, sf), **kw
    )


# the pairs of good alerts with both kinds of notices, valued, one per object and notice
_OBJECT = "'ZTF' || lpad((17 + event_id % 8)::varchar, 2, '0') || translate(lpad(user_id::varchar, 7, '0'), '0123456789', 'abcdefghij')"
_GOOD = f"""(select *, x.oid, ((event_id * 37) % 101)::double / 100::double as rb, {_CLASS} as alert_class,
  {_tenth(13, 5)} as mag_rate from {sq.ALERTS} a join
  (select *, {_OBJECT} as oid from events where event_type <> 'error' and {_NEAR}) x on x.event_id = a.candid)"""
_CIRCLE_MATCH = f"""(select candid, "triggerId", observatory, {_P_ASSOC} as p_assoc, err_arcmin from {sq.PAIRS}
  where sep * 60 <= 1.5::double * err_arcmin)"""
_GW_MATCH = _density_sql(
    sq.with_point("(select * exclude (z, c, tt) from " + _GW_PAIRS + ")", "ztf_ra", "ztf_dec"), 'q.candid, q."triggerId"'
)
_MATCHES = f"""(select * exclude (rk) from (select *, row_number() over (partition by oid, "triggerId" order by g.jd, g.candid) as rk from
  (select candid as cid, "triggerId", observatory, p_assoc, err_arcmin from {_CIRCLE_MATCH} where p_assoc <> -1
   union all select candid, "triggerId", 'LVK', density, null from {_GW_MATCH}) m join {_GOOD} g on g.candid = m.cid) where rk = 1)"""
_BRONZE = "(rb >= 0.7::double and alert_class in ('Early supernova', 'Kilonova candidate', 'Galaxy', 'Unknown'))"
_IS_GRB = "observatory in ('Fermi', 'SWIFT', 'INTEGRAL')"
_SILVER = f"({_BRONZE} and {_IS_GRB} and p_assoc >= 0.99::double)"
_GOLD = f"({_SILVER} and mag_rate > 0.3::double and rb >= 0.9::double and err_arcmin <= 400)"


@query(f"""select oid as "objectId", candid, "triggerId", observatory, round(p_assoc, 9) as p_assoc, round(ztf_ra, 6) as ztf_ra,
  err_arcmin as gcn_loc_error, rb, alert_class, case when observatory = 'LVK' then '{{"superevent_id": "' || "triggerId" || '"}}'
    else '<notice ' || "triggerId" || '/>' end as raw_event, strftime(ts, '%d') as day from {_MATCHES}""")
def offline_join(spark, sf):
    """The whole batch cross-match: filters, cells, association, de-duplication, classes, projection."""
    return _night(spark, sf).select(
        "objectId", "candid", "triggerId", "observatory", rnd("p_assoc", 9).alias("p_assoc"), rnd("ztf_ra").alias("ztf_ra"),
        "gcn_loc_error", "rb", "alert_class", "raw_event", "day",
    )


@query(SQL["offline_join"])
def offline_join_versions(spark, sf):
    """The same with every notice repeated as a later `initial` and every alert stored twice: one row per key all the same."""
    table = dv.notice_table(spark, sf)
    later = table.withColumns({"ackTime": F.col("ackTime") + F.expr("interval 10 days"), "raw_event": F.concat("raw_event", F.lit(" later"))})
    packets = dv.alert_packets(spark, sf)
    found = crossmatch_night(packets.unionByName(packets), table.unionByName(later), MATCH, dv.skymap_pixels(spark, sf))
    return found.select(
        "objectId", "candid", "triggerId", "observatory", rnd("p_assoc", 9).alias("p_assoc"), rnd("ztf_ra").alias("ztf_ra"),
        "gcn_loc_error", "rb", "alert_class", "raw_event", "day",
    )


@query(f"""select oid as "objectId", "triggerId", {_BRONZE} and {_IS_GRB} as is_grb_bronze, {_SILVER} as is_grb_silver,
  coalesce({_GOLD}, false) as is_grb_gold, {_BRONZE} and observatory = 'LVK' as is_gw_bronze from {_MATCHES}""")
def grade_flags(spark, sf):
    flagged = gr.grade_flags(_night(spark, sf, with_raw=False), GRADES)
    return flagged.select("objectId", "triggerId", *GRADE_NAMES)


@query(f"""select topic, oid as "objectId", "triggerId" from (
    select 'grb_bronze' as topic, * from {_MATCHES} where {_BRONZE} and {_IS_GRB} union all
    select 'grb_silver', * from {_MATCHES} where {_SILVER} union all
    select 'grb_gold', * from {_MATCHES} where {_GOLD} union all
    select 'gw_bronze', * from {_MATCHES} where {_BRONZE} and observatory = 'LVK')""")
def grade_split(spark, sf):
    return gr.grade_split(_night(spark, sf, with_raw=False), GRADES).select("topic", "objectId", "triggerId")


_PROJECTED = """event_id as candid, 1 + event_id % 2 as fid, ((event_id * 37) % 101)::double / 100::double as rb,
  ((event_id * 19) % 30)::double / 100::double as sigmapsf"""


@query(f"""select {_PROJECTED.replace('as fid', '::int as fid').replace('1 + event_id % 2', '(1 + event_id % 2)')}, round({sq.START}, 6) as jdstarthist,
  round({_MAG}, 6) as magpsf, 'err' as err_name, false as has_candidate from events where event_type <> 'error'""")
def match_projection(spark, sf):
    wide = al.history_concat(al.alert_position(dv.alert_packets(spark, sf))).withColumn("err_arcmin", F.lit("err"))
    p = gr.match_projection(wide)
    return p.select(
        "candid", "fid", rnd("rb").alias("rb"), rnd("sigmapsf").alias("sigmapsf"), rnd("jdstarthist").alias("jdstarthist"),
        rnd("magpsf").alias("magpsf"), F.col("gcn_loc_error").alias("err_name"),
        F.lit("candidate" in p.columns or "cmagpsf" in p.columns).alias("has_candidate"),
    )


def _records(spark, sf) -> DataFrame:
    """Every alert as a record to distribute."""
    wide = partition_cols(gr.match_projection(al.alert_position(dv.alert_packets(spark, sf)).withColumn("err_arcmin", F.lit(1.0))).drop("year", "month", "day"))
    return wide.withColumns({"triggerTimeUTC": F.col("timestamp"), "ackTime": F.col("timestamp")})


@query(f"""select event_id as candid, (1 + event_id % 2)::int as fid, (event_id % 6)::double as plx, (event_id % 9)::double as e_plx,
  round({_tenth(17, 5)}, 6) as amplitude, round({_tenth(19, 7)}, 6) as mean,
  'double' as plx_type, 'string' as utc_type, 'ackTime,day,month,t2,timestamp,year' as dropped from events where event_type <> 'error'""")
def distribution_projection(spark, sf):
    records = _records(spark, sf)
    d = gr.distribution_projection(records)
    types = dict(d.dtypes)
    gone = ",".join(sorted(set(records.columns) - set(d.columns)))
    return d.select(
        "candid", "fid", F.col("Plx").alias("plx"), F.col("e_Plx").alias("e_plx"),
        rnd("lc_features_g.amplitude").alias("amplitude"), rnd("lc_features_r.mean").alias("mean"),
        F.lit(types["Plx"]).alias("plx_type"), F.lit(types["triggerTimeUTC"]).alias("utc_type"), F.lit(gone).alias("dropped"),
    )


# the science columns that the derived alerts lack, as functions of the alert's number; every feature has its own gaps
_TEXTS = ("DR3Name", "gcvs", "vsx", "x3hsp", "x4lac", "observatory", "instrument", "event", "triggerId", "gcn_status", "raw_event", "alert_class")
_NUMBERS = ("anomaly_score", "sigma_rate", "lower_rate", "upper_rate", "delta_time", "jdstarthist_dt", "gcn_ra", "gcn_dec", "p_assoc")


def _complete_records(spark, sf) -> DataFrame:
    """Every alert as a record with all fields of the distribution contract."""
    d = _records(spark, sf).drop("event_ts", "cutoutScience", "schemavsn")

    def features(name: str) -> Column:
        given = {"amplitude", "mean"}
        return F.struct(*[
            F.col(f"{name}.{f}") if f in given
            else F.when(F.col("candid") % (i + 5) != 0, (F.col("candid") % (i + 7)).cast("double")).alias(f)
            for i, f in enumerate(LC_FEATURES.names)
        ])

    return d.withColumns({
        **{n: F.when(F.col("candid") % (i + 2) != 0, F.concat(F.lit(n), F.col("candid") % 3)) for i, n in enumerate(_TEXTS)},
        **{n: F.when(F.col("candid") % (i + 3) != 0, (F.col("candid") % 11).cast("double")) for i, n in enumerate(_NUMBERS)},
        "nalerthist": (F.col("candid") % 40).cast("int"), "from_upper": F.col("candid") % 2 == 0,
        **{n: features(n) for n in ("lc_features_g", "lc_features_r")},
    })


_GAPS = " + ".join(
    [f"(event_id % {i + 2} <> 0)::int" for i in range(len(_TEXTS))] + [f"(event_id % {i + 3} <> 0)::int" for i in range(len(_NUMBERS))]
    + [f"2 * (event_id % {i + 5} <> 0)::int" for i, f in enumerate(LC_FEATURES.names) if f not in ("amplitude", "mean")]
)
# what every derived record holds: 10 of the alert's position and photometry, radius and time, 14 science columns, and two
# features in either band
_OWN = 10 + 2 + 14


@query(f"""select (1 + event_id % 2)::int as fid, count(*) as records, {len(_TEXTS) + len(_NUMBERS) + _OWN + 2 * 26} as fields, 0 as missing, 0 as mistyped,
  0 as unexpected, sum({_OWN + 2 * 2} + {_GAPS})::bigint as filled from events where event_type <> 'error' group by 1""")
def distribution_schema(spark, sf):
    """The records against the contract, which is read from its text: fields of the contract, those that are missing, of a
    wrong type or not in the contract, at any depth, and per band how many values the records bring."""
    d = gr.distribution_projection(_complete_records(spark, sf))
    contract = ct.read_contract(ct.distribution_contract())
    kinds = [x.kind for x in ct.differences(d.schema, contract)]
    counted = [F.lit(kinds.count(k)).alias(k) for k in ("missing", "mistyped", "unexpected")]
    values = ct.resolved(d, contract).select("fid", ct.filled(contract).alias("filled"))
    return values.groupBy("fid").agg(
        F.count("*").alias("records"), F.lit(len(ct.leaves(contract))).alias("fields"), *counted, F.sum("filled").alias("filled"),
    )


# a reader's contract that is older than the records: wider numbers, a field with a default, a shorter feature record
_READER = """{"type": "record", "name": "reader", "fields": [
  {"name": "candid", "type": "double"}, {"name": "fid", "type": ["long", "null"]}, {"name": "survey", "type": "string", "default": "none"},
  {"name": "lc_features_g", "type": [{"type": "record", "name": "curve", "fields": [
    {"name": "mean", "type": ["double", "null"]}, {"name": "period", "type": "double", "default": -1.0}]}, "null"]},
  {"name": "lc_features_r", "type": ["curve", "null"]},
  {"name": "classes", "type": {"type": "array", "items": "string"}, "default": ["unset"]},
  {"name": "mangrove", "type": [{"type": "map", "values": ["string", "null"]}, "null"]}]}"""


@query(f"""select event_id::double as candid, (1 + event_id % 2)::bigint as fid, 'none' as survey, round({_tenth(19, 7)}, 6) as mean_g,
  round({_tenth(19, 7)}, 6) as mean_r, -1::double as period, 'unset' as classes, (event_id % 90)::varchar as lum_dist,
  'bigint double' as promoted from events where event_type <> 'error'""")
def contract_resolution(spark, sf):
    """Records as a reader with a contract of its own receives them, by Avro's resolution rules."""
    d = gr.distribution_projection(_complete_records(spark, sf))
    contract = ct.read_contract(_READER)
    r = ct.resolved(d, contract)
    promoted = [x for x in ct.differences(d.schema, contract) if x.path == "candid" and x.kind == "promoted"]
    return r.select(
        "candid", "fid", "survey", rnd("lc_features_g.mean").alias("mean_g"), rnd("lc_features_r.mean").alias("mean_r"),
        F.col("lc_features_g.period").alias("period"), F.array_join("classes", ",").alias("classes"),
        F.col("mangrove")["lum_dist"].alias("lum_dist"), F.lit(" ".join(f"{x.have} {x.want}" for x in promoted)).alias("promoted"),
    )


@query(f"""select event_id as candid, json as body from (select event_id, '{{"candid":' || event_id || ',"fid":' || (1 + event_id % 2) || ',"cdsxmatch":"'
  || {_XMATCH} || '"}}' as json from events where event_type <> 'error')""")
def topic_payload(spark, sf):
    rows = dv.alert_packets(spark, sf).select("candid", "candidate.fid", "cdsxmatch", F.lit("t").alias("topic"))
    return gr.payload(rows, key="candid").select(F.col("key").alias("candid"), F.col("value").alias("body"))


@query("""select event_id as candid, 'H' || event_id % 50 as hyperleda_name, null::varchar as twomass_name, (event_id % 90)::varchar as lum_dist,
  null::varchar as ang_dist from events where event_type <> 'error'""")
def map_to_struct(spark, sf):
    m = gr.map_to_struct(dv.alert_packets(spark, sf))
    return m.select(
        "candid", F.col("mangrove.HyperLEDA_name").alias("hyperleda_name"), F.col("mangrove.TwoMASS_name").alias("twomass_name"),
        F.col("mangrove.lum_dist").alias("lum_dist"), F.col("mangrove.ang_dist").alias("ang_dist"),
    )


@query(f"""select {_SID} as superevent_id, false as has_map, {_ALERT_TYPE} as alert_type, {_DETECTORS} as instruments
  from events where {_JSON_OK}""")
def drop_json_key(spark, sf):
    raw = dv.raw_json(spark, sf).select(F.lit("LVK").alias("observatory"), F.col("value").alias("raw_event"))
    cut = gr.drop_json_key(computed_once(raw, "raw_event")).select(F.col("raw_event").alias("value"), F.lit("json").alias("format"))
    p = computed_once(nt.parse_json_notices(cut), "json").filter(F.col("json._corrupt").isNull())
    return p.select(
        "json.superevent_id", F.col("value").contains("skymap").alias("has_map"), "json.alert_type",
        F.array_join("json.event.instruments", "_").alias("instruments"),
    )


# --- sources, sinks, streams: written to and read from a shared folder --------------------------------------------

_NIGHT_SQL = f"select event_id as candid, '2024' as year, '01' as month, '15' as day from events where event_type <> 'error' and strftime(ts, '%Y%m%d') = '{dv.NIGHT}'"


def _alert_files(spark, sf) -> tuple[DataFrame, str]:
    packets = dv.alert_packets(spark, sf)
    path = shared_dir(spark, "alerts")
    write_partitioned(packets, path)
    return packets, path


@query(_NIGHT_SQL)
def src_alerts_batch(spark, sf):
    """Writes the alert archive, then reads one night of it through its partition filter."""
    packets, path = _alert_files(spark, sf)
    return alerts_batch(spark, path, dv.NIGHT, packets.schema).select("candid", "year", "month", "day")


@query("select event_id as candid from events where event_type <> 'error'")
def src_alerts_stream(spark, sf):
    packets, path = _alert_files(spark, sf)
    stream = alerts_stream(spark, path, packets.schema).select("candid", "year", "month", "day")
    return _drain(spark, stream).select("candid")


@contextmanager
def _as_many_states_as_cores(spark):
    """Stateful operators keep a store per shuffle partition and batch; inputs of this size need no more than cores."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _drain(spark, stream: DataFrame) -> DataFrame:
    """Run a stream over what is there, into partitioned files, and read these back."""
    out, log = shared_dir(spark, "stream-out"), shared_dir(spark, "stream-log")
    with _as_many_states_as_cores(spark):
        bounded_run(stream_partitioned(stream, out, log, interval=None))
    return spark.read.schema(stream.schema).parquet(out)


_NOTICE_FILES_SQL = f"""select trigger_no as triggerid, observatory, round(ra, 6) as ra, strftime(ts, '%Y') as year, strftime(ts, '%m') as month,
  strftime(ts, '%d') as day from {sq.NOTICES}"""


def _notice_files(spark, sf) -> tuple[DataFrame, str]:
    rows = dv.notices(spark, sf)
    path = shared_dir(spark, "notices")
    write_partitioned(rows, path, "append")
    return rows, path


def _notice_view(df: DataFrame) -> DataFrame:
    return df.select(F.col("trigger_no").alias("triggerid"), "observatory", rnd("ra").alias("ra"), "year", "month", "day")


@query(_NOTICE_FILES_SQL)
def src_notices_batch(spark, sf):
    rows, path = _notice_files(spark, sf)
    return _notice_view(notices_batch(spark, path, rows.schema))


@query(_NOTICE_FILES_SQL)
def src_notices_stream(spark, sf):
    rows, path = _notice_files(spark, sf)
    return _notice_view(_drain(spark, notices_stream(spark, path, rows.schema)))


@query(f"""select oid as "objectId", "triggerId", observatory, '2024' as year, '01' as month, '15' as day from {_MATCHES}
  where strftime(ts, '%Y%m%d') = '{dv.NIGHT}'""")
def src_matches_stream(spark, sf):
    """Writes the matches, then streams those of one night."""
    matches, path = _night(spark, sf, with_raw=False), shared_dir(spark, "all-matches")
    write_partitioned(matches, path)
    stream = matches_stream(spark, path, dv.NIGHT, matches.schema)
    return _drain(spark, stream.select("objectId", "triggerId", "observatory", "year", "month", "day"))


def _raw_files(spark, sf) -> str:
    path = shared_dir(spark, "raw")
    dv.raw_notices(spark, sf).write.parquet(path)
    return path


@query(f"""select "triggerId", observatory, event_type, err_arcmin, "triggerTimeUTC" from {_NOTICE_ROWS}""")
def sink_notices(spark, sf):
    """Streamed ingestion: raw files -> parsed notices -> partitioned notice table."""
    rows = nt.notice_row(nt.parse_notices(raw_notices_files(spark, _raw_files(spark, sf))))
    return _drain(spark, rows).select(
        "triggerId", "observatory", "event_type", rnd("err_arcmin", 4).alias("err_arcmin"), "triggerTimeUTC"
    )


@query(f"""select topic, count(*) as n from (select {_TOPIC} as topic from events where event_type = 'error'
    union all select 'igwn.gwalert' from events where event_type = 'error') group by topic""")
def src_raw_notices(spark, sf):
    stream = raw_notices_files(spark, _raw_files(spark, sf))
    day = {n: F.date_format("timestamp", p) for n, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))}
    return _drain(spark, stream.withColumns(day)).groupBy("topic").agg(F.count("*").alias("n"))


@query(f"""select oid as "objectId", "triggerId", {_BRONZE} and {_IS_GRB} as is_grb_bronze, strftime(ts, '%d') as day
  from {_MATCHES}""")
def sink_matches_batch(spark, sf):
    """Writes the graded matches twice: the second run replaces the days of the first."""
    path = shared_dir(spark, "matches")
    graded = gr.grade_flags(_night(spark, sf, with_raw=False), GRADES)
    write_partitioned(graded, path)
    write_partitioned(graded, path)
    return spark.read.schema(graded.schema).parquet(path).select("objectId", "triggerId", "is_grb_bronze", "day")


def _in_turn(spark, rows: DataFrame, part: Column, parts: int, name: str) -> DataFrame:
    """A stream of rows in `parts` files, one per micro-batch, in the order of `part`."""
    path = shared_dir(spark, name)
    for k in range(parts):
        rows.filter(part == k).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _quarter(rows: DataFrame, at: str) -> Column:
    """Quarter 0 to 3 of the time that a table spans."""
    seconds = F.unix_seconds(F.col(at))
    lo, hi = rows.agg(F.min(seconds), F.max(seconds)).first()
    return F.least(F.floor((seconds - F.lit(lo)) * 4 / F.lit(max(1, hi - lo))), F.lit(3))


def _streamed_alerts(spark, sf) -> DataFrame:
    rows = dv.alerts(spark, sf).withColumn("alert_ts", from_jd(F.col("jd")))
    return _in_turn(spark, rows, _quarter(rows, "alert_ts"), 4, "narrow-alerts")


def _streamed_notices(spark, sf) -> DataFrame:
    rows = mt.circle_notices(dv.notices(spark, sf)).select(
        "trigger_no", "triggerId", "gcn_status", "observatory", "gcn_ra", "gcn_dec", "region_arcmin", "triggerTimejd",
        F.col("ackTime").alias("trigger_ts"),
    )
    return _in_turn(spark, rows, _quarter(rows, "trigger_ts"), 4, "narrow-notices")


def _run_batches(stream: DataFrame, sink, spark) -> None:
    """Run a foreachBatch function over all micro-batches of what is there."""
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", shared_dir(spark, "batch-log"))
    with _as_many_states_as_cores(spark):
        bounded_run(writer.trigger(availableNow=True).start())


@query(f"""select candid, trigger_no from {sq.PAIRS} where sep * 60 <= 1.5::double * err_arcmin and jd <= trigger_jd + 7""")
def stream_crossmatch(spark, sf):
    """Stream-stream join over what is there; pairs are within 7 days of the trigger."""
    pairs = crossmatch_stream(_streamed_alerts(spark, sf), _streamed_notices(spark, sf), tiers=rg.REFERENCE_TIER, salts=2)
    day = {n: F.date_format("alert_ts", p) for n, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))}
    return _drain(spark, pairs.select("candid", "trigger_no", "alert_ts").withColumns(day)).select("candid", "trigger_no")


def _streamed_regions(spark, sf) -> DataFrame:
    pixels = dv.skymap_pixels(spark, sf)
    cells = sm.skymap_cells(sm.credible_region(pixels), NSIDE)
    times = dv.map_events(spark, sf).select("triggerId", "gcn_status", "observatory", "triggerTimejd", F.col("ts").alias("ackTime"))
    rows = sm.region_pixels(pixels, cells, NSIDE).join(times, ["triggerId", "gcn_status"])
    rows = rows.withColumn("trigger_ts", F.col("ackTime"))
    return _in_turn(spark, rows, _quarter(rows, "trigger_ts"), 4, "regions")


@query(SQL["assoc_gw"])
def stream_assoc_gw(spark, sf):
    """Streamed alerts with streamed sky maps, over several micro-batches."""
    regions = _streamed_regions(spark, sf).drop("observatory", "ackTime")
    pairs = skymap_stream(_streamed_alerts(spark, sf), regions, salts=2)
    day = {n: F.date_format("alert_ts", p) for n, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))}
    found = _drain(spark, pairs.select("candid", "triggerId", "density", "alert_ts").withColumns(day))
    return found.select("candid", "triggerId", rnd("density", 9).alias("p_assoc"))


@query(f"""select oid as "objectId", candid, "triggerId", observatory, round(p_assoc, 9) as p_assoc, alert_class from {_MATCHES}""")
def online_join(spark, sf):
    """The streamed cross-match with both kinds of notices, over several micro-batches: the batch form's result."""
    packets = dv.alert_packets(spark, sf).withColumn("at", from_jd(F.col("candidate.jd")))
    alerts = _in_turn(spark, packets, _quarter(packets, "at"), 4, "packets").drop("at")
    table = dv.notice_table(spark, sf)
    notices = _in_turn(spark, table, _quarter(table, "ackTime"), 4, "both-notices")
    stored, out = shared_dir(spark, "notice-table"), shared_dir(spark, "online")
    table.write.partitionBy("year", "month", "day").parquet(stored)
    pairs = online_matches(alerts, notices, MATCH, "7 days", regions=_streamed_regions(spark, sf).drop("trigger_ts"))
    _run_batches(pairs, online_sink(out, lambda s, days: notices_of_days(s, stored, days, table.schema), MATCH, mt.MAX_DELAY), spark)
    found = spark.read.parquet(out)
    return found.select("objectId", "candid", "triggerId", "observatory", rnd("p_assoc", 9).alias("p_assoc"), "alert_class")


@query(f"""select distinct "objectId", "triggerId" from {sq.PAIRS} where sep * 60 <= 1.5::double * err_arcmin and jd <= trigger_jd + 7""")
def sink_matches_stream(spark, sf):
    """Stream-stream join in several micro-batches, first arrival per object and notice, into day partitions."""
    pairs = crossmatch_stream(_streamed_alerts(spark, sf), _streamed_notices(spark, sf), tiers=rg.REFERENCE_TIER, salts=2)
    rows = pairs.select("objectId", "triggerId", "gcn_status", "jd", "candid", F.col("alert_ts").alias("timestamp"))
    out = shared_dir(spark, "first-matches")
    _run_batches(partition_cols(rows), first_matches_sink(out, mt.MAX_DELAY), spark)
    return spark.read.parquet(out).select("objectId", "triggerId")


@query(f"""select event_id, "triggerId", gcn_status from {_VERSIONS}""".replace("order by ts, event_id", "order by day(ts) % 4, ts, event_id"))
def stream_notice_status(spark, sf):
    """Update numbers in order of arrival over several micro-batches, each with notices older than those before."""
    rows = dv.notice_versions(spark, sf).drop("raw_event")
    stream = _in_turn(spark, rows, F.dayofmonth("ackTime") % 4, 4, "versions")
    out = shared_dir(spark, "numbered")
    _run_batches(stream, numbered_sink(out, tie=F.col("event_id")), spark)
    return spark.read.parquet(out).select("event_id", "triggerId", "gcn_status")


@query(SQL["grade_split"])
def stream_topics(spark, sf):
    """Graded topics from a stream of matches, one folder per topic."""
    matches = _night(spark, sf, with_raw=False)
    path, out, log = (shared_dir(spark, n) for n in ("graded", "topics", "topics-log"))
    write_partitioned(matches, path)
    stream = spark.readStream.schema(matches.schema).parquet(path)
    bounded_run(topics_query(stream, GRADES, log, path=out, interval=None))
    sent = spark.read.parquet(out)
    return sent.select("topic", F.get_json_object("value", "$.objectId").alias("objectId"), F.get_json_object("value", "$.triggerId").alias("triggerId"))


@query("select count(*)::bigint as input_rows, true as all_batches from events where event_type <> 'error'")
def progress_log(spark, sf):
    """Metrics table of a streaming run: the rows its micro-batches read, and whether batches are numbered without gap."""
    packets, path = _alert_files(spark, sf)
    table = shared_dir(spark, "progress")
    listener = ProgressLog(spark, table)
    spark.streams.addListener(listener)
    try:
        _drain(spark, alerts_stream(spark, path, packets.schema).select("candid", "year", "month", "day"))
        listener.ended.wait(120)
    finally:
        spark.streams.removeListener(listener)
    log = spark.read.schema(ProgressLog.FIELDS).parquet(table)
    gapless = F.count_distinct("batch") == F.max("batch") + 1
    return log.agg(F.sum("input_rows").alias("input_rows"), gapless.alias("all_batches"))
