"""SQL texts (DuckDB) for the derived inputs of `derive.py` and for the HEALPix formulas, as subqueries."""

from __future__ import annotations


def jd(ts: str) -> str:
    return f"((epoch_us({ts}) - 946728000000000)::double / 86400000000::double + 2451545::double)"


def ra(step: int, eid: str = "event_id") -> str:
    return f"((({eid} * {step}) % 36000)::double / 100::double)"


def dec(step: int, eid: str = "event_id") -> str:
    return f"degrees(asin(2::double * ((({eid} * {step}) % 100003)::double / 100003::double) - 1::double))"


JD = jd("ts")
START = f"({JD} - (event_id % 7)::double / 20::double)"
ALERTS = f"""(select event_id as candid, 'OBJ' || user_id as "objectId", {ra(7919)} as ztf_ra,
  {dec(104729)} as ztf_dec, {JD} as jd, {START} as jdstarthist,
  {START} + (event_id % 5)::double / 50::double as jd_first_real_det
  from events where event_type <> 'error')"""

OBS = "case event_id % 4 when 0 then 'Fermi' when 1 then 'SWIFT' when 2 then 'INTEGRAL' else 'ICECUBE' end"


def pick2(values: str) -> str:
    """One of eight values by observatory and parity of event_id div 4; `values` is a list literal."""
    return f"({values})[(2 * (event_id % 4) + (event_id // 4) % 2 + 1)::int]"


INSTRUMENT8 = pick2("['GBM','LAT','XRT','BAT','Weak','Refined','BRONZE','GOLD']")
PACKET8 = pick2("[112,125,67,61,56,54,174,173]")
NOTICES = f"""(select event_id as trigger_no, event_id::varchar as "triggerId", {OBS} as observatory,
  case when event_id % 4 = 3 then '' else {INSTRUMENT8} end as instrument,
  case when event_id % 4 = 3 then {INSTRUMENT8} else '' end as event,
  {ra(6151)} as ra, {dec(15485)} as dec, 60::double * (1 + event_id % 10)::double as err_arcmin,
  {JD} as trigger_jd, ts, strftime(ts, '%Y-%m-%d %H:%M:%S.') || lpad((epoch_us(ts) // 1000 % 1000)::varchar, 3, '0') as utc
  from events where event_type = 'error')"""


def sep_deg(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    """Great-circle separation in degrees (haversine)."""
    return (
        f"degrees(2 * asin(least(1::double, sqrt(pow(sin(radians({dec2} - {dec1}) / 2), 2) + cos(radians({dec1}))"
        f" * cos(radians({dec2})) * pow(sin(radians({ra2} - {ra1}) / 2), 2)))))"
    )


PAIRS = f"""(select a.*, n.*, {sep_deg('a.ztf_ra', 'a.ztf_dec', 'n.ra', 'n.dec')} as sep
  from {ALERTS} a join {NOTICES} n on a.jdstarthist > n.trigger_jd
  and a.jd <= n.trigger_jd + 7::double)"""


# --- HEALPix ---------------------------------------------------------------------------------------------------


def with_point(src: str, ra_col: str, dec_col: str) -> str:
    """Add z, c (cosine of declination) and tt (right ascension in quarter turns)."""
    return (
        f"(select *, sin(radians({dec_col})) as z, cos(radians({dec_col})) as c,"
        f" fmod({ra_col} / 90::double, 4::double) as tt from {src})"
    )


def with_ring(src: str, n: int, out: str) -> str:
    """Add the RING cell at NSIDE n of rows with z, c, tt."""
    s1 = (
        f"(select *, {n} * (0.5::double + tt) as _a, 0.75::double * {n} * z as _b, tt - floor(tt) as _tp,"
        f" {n} * sqrt(3::double) * c / sqrt(1 + abs(z)) as _t from {src})"
    )
    s2 = (
        "(select *, floor(_a - _b)::bigint as _jp, floor(_a + _b)::bigint as _jm,"
        f" floor(_tp * _t)::bigint + floor((1 - _tp) * _t)::bigint + 1 as _pr from {s1})"
    )
    ring = f"({n} + 1 + _jp - _jm)"
    half = f"floor((_jp + _jm - {n} + 2 - ({ring} % 2)) / 2.0)::bigint"
    belt = f"{2 * n * (n - 1)} + ({ring} - 1) * {4 * n} + ((({half}) % {4 * n}) + {4 * n}) % {4 * n}"
    pip = "(floor(tt * _pr)::bigint % (4 * _pr))"
    cap = f"case when z > 0 then 2 * _pr * (_pr - 1) + {pip} else {12 * n * n} - 2 * _pr * (_pr + 1) + {pip} end"
    return (
        f"(select * exclude (_a, _b, _tp, _t, _jp, _jm, _pr), case when abs(z) <= 2::double / 3 then {belt}"
        f" else {cap} end as {out} from {s2})"
    )


def ring_centres(m: int) -> str:
    """All cells of NSIDE m: p, z, tt (and c)."""
    ncap, npix = 2 * m * (m - 1), 12 * m * m
    i_north = "floor((1 + sqrt(1 + 2 * p::double) ) / 2)::bigint"
    i_south = f"floor((1 + sqrt(2 * ({npix} - p)::double - 1)) / 2)::bigint"
    s = (
        f"(select p, case when p < {ncap} then {i_north} when p < {npix - ncap} then (p - {ncap}) // {4 * m} + {m}"
        f" else {i_south} end as i from range(0, {npix}) t(p))"
    )
    z = (
        f"case when p < {ncap} then 1 - (i * i)::double / {3 * m * m} when p < {npix - ncap} then"
        f" (2 * {m} - i)::double * 2 / {3 * m} else -1 + (i * i)::double / {3 * m * m} end"
    )
    tt = (
        f"case when p < {ncap} then (p + 1 - 2 * i * (i - 1) - 0.5::double) / i when p < {npix - ncap} then"
        f" ((p - {ncap}) % {4 * m} + 1 - 0.5::double * (1 + (i + {m}) % 2)) / {m}"
        f" else (4 * i + 1 - ({npix} - p - 2 * i * (i - 1)) - 0.5::double) / i end"
    )
    return f"(select p, z, tt, sqrt(1 - z * z) as c from (select p, {z} as z, {tt} as tt from {s}))"


def cover(notices: str, n: int, radius_deg: str, keep: str, margin_deg: float) -> str:
    """(keep, hpix): cells of NSIDE n that hold the centre of a cell of NSIDE 4n within radius + margin."""
    sub = with_ring(ring_centres(4 * n), n, "hpix")
    return (
        f"(select distinct {keep}, hpix from {notices} n join {sub} s on"
        f" {sep_deg('n.ra', 'n.dec', 's.tt * 90', 'degrees(asin(s.z))')} <= least(180::double, {radius_deg} + {margin_deg!r}))"
    )


# --- sky maps ----------------------------------------------------------------------------------------------------

PIXELS = """(select event_id, 'S' || event_id as "triggerId", (row_number() over (partition by event_id order by ip, ch) - 1)::int as row_idx,
  ((16::bigint << (2 * depth)) + ip * n + ch) as uniq, (1 + depth)::int as level, (ip * n + ch) as ipix,
  (case when hot then 4000 + (event_id * 7 + (ip * n + ch) * 13) % 101 else 1 + (event_id + (ip * n + ch) * 17) % 5 end)::double
    * 768::double / (4::double * pi() * 67056::double) as probdensity,
  4 * pi() / 12 / pow(4, 1 + depth) as area_sr
  from (select event_id, ip, hot, depth, (1::bigint << (2 * depth)) as n, unnest(range(0, 1::bigint << (2 * depth))) as ch from
    (select event_id, ip, ip = (event_id * 31) % 48 as hot,
       (case when ip = (event_id * 31) % 48 then 2 when (ip + event_id) % 3 = 0 then 1 else 0 end)::int as depth
     from events, range(0, 48) t(ip) where event_type = 'error')))"""

REGION = f"""(select * from (select *, sum(area_sr * probdensity) over (partition by event_id order by probdensity desc, row_idx
  rows unbounded preceding) as cumprob from {PIXELS}) where cumprob < 0.9::double)"""


def with_nest_centre(src: str) -> str:
    """Add z, tt, c of the centre of the NESTED cell (level <= 3, ipix)."""
    s1 = (
        "(select *, (1::bigint << level) as side, (ipix // (1::bigint << (2 * level)))::int as face,"
        " ipix % (1::bigint << (2 * level)) as inn from " + src + ")"
    )
    s2 = (
        "(select *, (inn & 1) + ((inn // 4) & 1) * 2 + ((inn // 16) & 1) * 4 as nx,"
        " ((inn // 2) & 1) + ((inn // 8) & 1) * 2 + ((inn // 32) & 1) * 4 as ny from " + s1 + ")"
    )
    # fixed values: ring and longitude offsets of the twelve base cells
    s3 = (
        "(select *, ([2,2,2,2,3,3,3,3,4,4,4,4])[face + 1] * side - nx - ny - 1 as jr,"
        " ([1,3,5,7,0,2,4,6,1,3,5,7])[face + 1] as jpl from " + s2 + ")"
    )
    s4 = (
        "(select *, case when jr < side then jr when jr > 3 * side then 4 * side - jr else side end as nr,"
        " case when jr < side or jr > 3 * side then 0 else (jr - side) % 2 end as sh from " + s3 + ")"
    )
    s5 = (
        "(select *, case when jr < side then 1 - (nr * nr)::double / (3 * side * side)"
        " when jr > 3 * side then (nr * nr)::double / (3 * side * side) - 1"
        " else ((2 * side - jr) * 2)::double / (3 * side) end as z,"
        " fmod(((jpl * nr + nx - ny + 1 + sh) // 2 - (sh + 1) * 0.5::double) / nr + 4, 4::double) as tt from " + s4 + ")"
    )
    return (
        "(select * exclude (side, face, inn, nx, ny, jr, jpl, nr, sh), sqrt(1 - z * z) as c from " + s5 + ")"
    )


def with_nest(src: str, level: int, out: str) -> str:
    """Add the NESTED cell at a level <= 3 of rows with z, c, tt."""
    n = 1 << level
    s1 = (
        f"(select *, {n} * (0.5::double + tt) as _a, 0.75::double * {n} * z as _b, least(floor(tt), 3) as _q,"
        f" {n} * sqrt(3::double) * c / sqrt(1 + abs(z)) as _t from {src})"
    )
    s2 = (
        f"(select *, abs(z) <= 2::double / 3 as _belt, floor(_a - _b)::bigint as _jp, floor(_a + _b)::bigint as _jm,"
        f" least({n - 1}, floor((tt - _q) * _t))::bigint as _cp, least({n - 1}, floor((1 - (tt - _q)) * _t))::bigint as _cm"
        f" from {s1})"
    )
    s3 = (
        "(select *, (case when _belt then (case when _jp // {n} = _jm // {n} then ((_jp // {n}) | 4) when _jp < _jm and"
        " _jp // {n} < _jm // {n} then _jp // {n} else _jm // {n} + 8 end)"
        " when z >= 0 then _q else _q + 8 end)::bigint as _f,"
        " case when _belt then _jm % {n} when z >= 0 then {n} - _cm - 1 else _cp end as _x,"
        " case when _belt then {n} - _jp % {n} - 1 when z >= 0 then {n} - _cp - 1 else _cm end as _y from "
    ).replace("{n}", str(n)) + s2 + ")"
    bits = " + ".join(
        f"((_x // {1 << k}) % 2) * {1 << (2 * k)} + ((_y // {1 << k}) % 2) * {1 << (2 * k + 1)}" for k in range(level)
    )
    return (
        f"(select * exclude (_a, _b, _q, _t, _belt, _jp, _jm, _cp, _cm, _f, _x, _y),"
        f" _f * {n * n} + {bits} as {out} from {s3})"
    )
