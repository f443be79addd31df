"""Alerts, notices, sky maps and raw messages derived from the `events` table, row by row.

The given tables hold no astronomy, so the engine's inputs are arithmetic on event columns: an `error` event is
a notice, any other event an alert. Nothing here groups or samples: every table grows with `events`.
`workload/oracle.py` states the same derivations as SQL.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyherald.functions.time import iso_utc, to_jd
from skyherald.plans.sizing import computed_once, spread
from skyherald.session import configure

NIGHT = "20240115"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spread(configure(spark).read.parquet(f"{sf_dir}/events.parquet"))
    return table.withColumn("ts", F.col("ts").cast("timestamp"))


def _ra(step: int) -> Column:
    return F.pmod(F.col("event_id") * step, F.lit(36000)).cast("double") / 100.0


def _dec(step: int) -> Column:
    share = F.pmod(F.col("event_id") * step, F.lit(100003)).cast("double") / 100003.0
    return F.degrees(F.asin(2.0 * share - 1.0))


def _mod(n: int, step: int = 1) -> Column:
    return F.pmod(F.col("event_id") * step, F.lit(n))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow alerts: what the cross-match itself needs."""
    jd = to_jd(F.col("ts"))
    start = jd - _mod(7).cast("double") / 20.0
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") != "error")
        .select(
            F.col("event_id").alias("candid"),
            F.concat(F.lit("OBJ"), F.col("user_id").cast("string")).alias("objectId"),
            _ra(7919).alias("ztf_ra"), _dec(104729).alias("ztf_dec"), jd.alias("jd"),
            start.alias("jdstarthist"), (start + _mod(5).cast("double") / 50.0).alias("jd_first_real_det"),
        )
    )


def alert_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full alerts: nested candidate, detection history, science columns, image stamps, partition columns."""
    jd = to_jd(F.col("ts"))
    start = jd - _mod(7).cast("double") / 20.0
    one = F.lit(1.0)

    def tenth(n: int, step: int, base: float = 0.0, scale: float = 10.0) -> Column:
        return base + _mod(n, step).cast("double") / scale

    def or_none(value: Column, n: int) -> Column:
        return F.when(_mod(n) == 0, F.lit(-999.0)).otherwise(value)

    candidate = F.struct(
        F.col("event_id").alias("candid"), (1 + _mod(2)).cast("int").alias("fid"),
        _ra(7919).alias("ra"), _dec(104729).alias("dec"), jd.alias("jd"), start.alias("jdstarthist"),
        or_none(tenth(300, 7), 3).alias("ssdistnr"), or_none(tenth(300, 11), 4).alias("distpsnr1"),
        tenth(11, 3).alias("sgscore1"), or_none(tenth(900, 13), 5).alias("neargaia"),
        tenth(11, 1).alias("drb"), tenth(101, 37, 0.0, 100.0).alias("rb"), tenth(11, 5).alias("classtar"),
        tenth(60, 17, 15.0).alias("magpsf"), tenth(30, 19, 0.0, 100.0).alias("sigmapsf"),
        tenth(50, 23, 16.0).alias("diffmaglim"), _mod(40, 3).alias("ndethist"),
    )
    size = 2 + _mod(9)

    def detection(k: Column) -> Column:
        seed = F.col("event_id") * 7 + k * 13
        missing = F.pmod(F.col("event_id") + k, F.lit(4)) == 0
        return F.struct(
            F.when(missing, F.lit(float("nan"))).otherwise(15.0 + F.pmod(seed, F.lit(60)).cast("double") / 10.0)
            .alias("magpsf"),
            (16.0 + F.pmod(seed * 3, F.lit(50)).cast("double") / 10.0).alias("diffmaglim"),
            (jd - (size - k).cast("double") / 4.0).alias("jd"),
            (1 + F.pmod(F.col("event_id") + k * k, F.lit(2))).cast("int").alias("fid"),
        )

    text = F.when(_mod(3) == 0, "Unknown").when(_mod(3) == 1, "Galaxy").otherwise("Star")
    features = F.struct(tenth(17, 5).alias("amplitude"), tenth(19, 7).alias("mean"))
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") != "error")
        .select(
            F.concat(
                F.lit("ZTF"), F.lpad((17 + _mod(8)).cast("string"), 2, "0"),
                F.translate(F.lpad(F.col("user_id").cast("string"), 7, "0"), "0123456789", "abcdefghij"),
            ).alias("objectId"),
            F.col("event_id").alias("candid"), candidate.alias("candidate"),
            F.transform(F.sequence(F.lit(0).cast("bigint"), size - 1), detection).alias("prv_candidates"),
            text.alias("cdsxmatch"), _mod(4).cast("int").alias("roid"), tenth(11, 3).alias("mulens"),
            tenth(11, 7).alias("snn_snia_vs_nonia"), tenth(11, 9).alias("snn_sn_vs_all"),
            tenth(11, 2).alias("rf_snia_vs_nonia"), tenth(11, 8).alias("rf_kn_vs_nonkn"),
            (start + _mod(5).cast("double") / 50.0).alias("jd_first_real_det"),
            tenth(13, 5).alias("mag_rate"), (one * _mod(6)).cast("float").alias("Plx"),
            (one * _mod(9)).cast("float").alias("e_Plx"), features.alias("lc_features_g"),
            features.alias("lc_features_r"),
            F.create_map(
                F.lit("HyperLEDA_name"), F.concat(F.lit("H"), _mod(50).cast("string")),
                F.lit("lum_dist"), _mod(90).cast("string"),
            ).alias("mangrove"),
            F.create_map(F.lit("M-dwarf"), tenth(11, 4)).alias("t2"),
            F.col("props").cast("binary").alias("cutoutScience"), F.lit("3.3").alias("schemavsn"),
            F.date_format("ts", "yyyy").alias("year"), F.date_format("ts", "MM").alias("month"),
            F.date_format("ts", "dd").alias("day"), F.col("ts").alias("event_ts"),
        )
    )


OBSERVATORY_OF = ("Fermi", "SWIFT", "INTEGRAL", "ICECUBE")
INSTRUMENT_OF = (("GBM", "LAT"), ("XRT", "BAT"), ("Weak", "Refined"), ("BRONZE", "GOLD"))
PACKET_OF = ((112, 125), (67, 61), (56, 54), (174, 173))
TOPIC_OF = ("FERMI_GBM_GND_POS", "SWIFT_XRT_POSITION", "INTEGRAL_WEAK", "ICECUBE_ASTROTRACK_GOLD")


def _pick(values: tuple, by: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), by.cast("int") + 1)


def _pick2(values: tuple) -> Column:
    """One of two values per observatory, by the parity of event_id div 4."""
    flat = tuple(v for pair in values for v in pair)
    return _pick(flat, 2 * _mod(4) + F.pmod(F.floor(F.col("event_id") / 4), F.lit(2)))


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed circle notices, one version per trigger."""
    err = 60.0 * (1 + _mod(10)).cast("double")
    neutrino = _mod(4) == 3
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") == "error")
        .select(
            F.col("event_id").alias("trigger_no"), F.col("event_id").cast("string").alias("triggerId"),
            F.lit("initial").alias("gcn_status"), _pick(OBSERVATORY_OF, _mod(4)).alias("observatory"),
            F.when(neutrino, "").otherwise(_pick2(INSTRUMENT_OF)).alias("instrument"),
            F.when(neutrino, _pick2(INSTRUMENT_OF)).otherwise("").alias("event"),
            F.concat(F.lit("ivo://derived/"), F.col("event_id").cast("string")).alias("ivorn"),
            _ra(6151).alias("ra"), _dec(15485).alias("dec"), err.alias("err_arcmin"), err.alias("region_arcmin"),
            F.col("ts").alias("ackTime"), to_jd(F.col("ts")).alias("triggerTimejd"),
            iso_utc(F.col("ts")).alias("triggerTimeUTC"),
            F.concat(F.lit("<notice "), F.col("event_id").cast("string"), F.lit("/>")).alias("raw_event"),
            F.date_format("ts", "yyyy").alias("year"), F.date_format("ts", "MM").alias("month"),
            F.date_format("ts", "dd").alias("day"),
        )
    )


def notice_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several versions per trigger: the trigger is the user, a version arrives with each error event."""
    base = F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("user_id"), F.lit(20)) * 86400)
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") == "error")
        .select(
            "event_id", F.col("user_id").cast("string").alias("triggerId"), F.col("ts").alias("ackTime"),
            to_jd(base).alias("triggerTimejd"),
            F.concat(F.lit("<notice "), F.col("event_id").cast("string"), F.lit("/>")).alias("raw_event"),
            F.date_format(base, "yyyy").alias("year"), F.date_format(base, "MM").alias("month"),
            F.date_format(base, "dd").alias("day"),
        )
    )


# --- sky maps ------------------------------------------------------------------------------------------------

WEIGHT_SUM = 67056.0


def _cell_pixels(ip: Column) -> tuple[Column, Column]:
    """(levels below level 1, number) of the pixels of a map's level-1 cell `ip`."""
    is_hot, split = ip == _mod(48, 31), F.pmod(ip + F.col("event_id"), F.lit(3)) == 0
    return tuple(F.when(is_hot, hot).when(split, four).otherwise(one) for hot, four, one in ((2, 1, 0), (16, 4, 1)))


def _pixel(ip: Column, depth: Column, ipix: Column) -> tuple[Column, Column]:
    """(uniq, probdensity) of a pixel `depth` levels below the level-1 cell `ip` it lies in."""
    eid = F.col("event_id")
    w = F.when(ip == _mod(48, 31), 4000 + F.pmod(eid * 7 + ipix * 13, F.lit(101))).otherwise(
        1 + F.pmod(eid + ipix * 17, F.lit(5))
    )
    uniq = F.call_function("shiftleft", F.lit(16).cast("bigint"), 2 * depth) + ipix
    return uniq.alias("uniq"), (w.cast("double") * 768.0 / (4.0 * F.pi() * WEIGHT_SUM)).alias("probdensity")


def _pixel_array() -> Column:
    """A map that covers the sky: a hot level-1 cell as 16 level-3 pixels, every third other cell as 4 of level 2."""

    def cells(ip: Column) -> Column:
        depth, n = _cell_pixels(ip)
        return F.transform(F.sequence(F.lit(0), n - 1), lambda c: F.struct(*_pixel(ip, depth, ip * n + c)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(47)), cells))


def map_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gravitational-wave notices without their pixels."""
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") == "error")
        .select(
            "event_id", "ts", F.concat(F.lit("S"), F.col("event_id").cast("string")).alias("triggerId"),
            F.lit("initial").alias("gcn_status"), F.lit("LVK").alias("observatory"), to_jd(F.col("ts")).alias("triggerTimejd"),
        )
    )


def map_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gravitational-wave notices with their pixels as an array."""
    return computed_once(map_events(spark, sf_dir).withColumn("pixels", _pixel_array()), "pixels")


def notice_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Circle and map notices in one table."""
    circles = notices(spark, sf_dir).withColumn("event_type", F.lit("alert")).drop("trigger_no")
    none = F.lit(None).cast("double")
    text = F.concat(F.lit('{"superevent_id": "'), "triggerId", F.lit('"}'))
    maps = map_events(spark, sf_dir).select(
        "triggerId", "gcn_status", "observatory", F.lit("H1_L1").alias("instrument"), F.lit("gw").alias("event"),
        F.lit("").alias("ivorn"), none.alias("ra"), none.alias("dec"), none.alias("err_arcmin"),
        none.alias("region_arcmin"), F.col("ts").alias("ackTime"), "triggerTimejd", iso_utc(F.col("ts")).alias("triggerTimeUTC"),
        text.alias("raw_event"), F.date_format("ts", "yyyy").alias("year"), F.date_format("ts", "MM").alias("month"),
        F.date_format("ts", "dd").alias("day"), F.lit("alert").alias("event_type"),
    )
    return circles.unionByName(maps)


def skymap_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of `_pixel_array`, made one by one: no map is built as an array, which is many times slower."""
    ip = F.col("__ip")
    split = F.pmod(-F.col("event_id"), F.lit(3))  # the first cell that is split in four, and every third after it
    hot = _mod(48, 31)
    # pixels of the cells before: one each, three more where split, and what the hot one has beyond that
    hot_more = 15 - F.when(F.pmod(hot - split, F.lit(3)) == 0, 3).otherwise(0)
    before = ip + 3 * F.floor((ip - split + 2) / 3) + F.when(hot < ip, hot_more).otherwise(0)
    depth, n = _cell_pixels(ip)
    cells = map_events(spark, sf_dir).select("event_id", "triggerId", "gcn_status", F.explode(F.sequence(F.lit(0), F.lit(47))).alias("__ip"))
    cells = cells.withColumns({"__depth": depth, "__n": n, "__before": before.cast("int")})
    rows = cells.withColumn("__c", F.explode_outer(F.sequence(F.lit(0), F.col("__n") - 1)))
    pixel = _pixel(ip, F.col("__depth"), ip * F.col("__n") + F.col("__c"))
    return rows.select("triggerId", "gcn_status", (F.col("__before") + F.col("__c")).alias("row_idx"), *pixel)


def fits_headers(rows: int) -> bytes:
    """The headers of a minimal FITS file with one binary table (UNIQ, PROBDENSITY)."""

    def cards(*lines: str) -> bytes:
        text = "".join(line.ljust(80) for line in (*lines, "END"))
        return text.ljust(-(-len(text) // 2880) * 2880).encode("ascii")

    def card(key: str, value) -> str:
        shown = f"'{value}'" if isinstance(value, str) and value not in "TF" else value
        return f"{key:<8}= {shown:>20}"

    return cards(card("SIMPLE", "T"), card("BITPIX", 8), card("NAXIS", 0), card("EXTEND", "T")) + cards(
        card("XTENSION", "BINTABLE"), card("BITPIX", 8), card("NAXIS", 2), card("NAXIS1", 16),
        card("NAXIS2", rows), card("PCOUNT", 0), card("GCOUNT", 1), card("TFIELDS", 2),
        card("TTYPE1", "UNIQ"), card("TFORM1", "K"), card("TTYPE2", "PROBDENSITY"), card("TFORM2", "D"),
    )


def fits_bytes(uniq: np.ndarray, density: np.ndarray, headers: bytes | None = None) -> bytes:
    """A minimal FITS file with one binary table (UNIQ, PROBDENSITY); `headers` are those of so many rows, made before."""
    rows = np.empty(len(uniq), np.dtype([("u", ">i8"), ("d", ">f8")]))
    rows["u"], rows["d"] = uniq, density
    body = rows.tobytes()
    return (headers or fits_headers(len(uniq))) + body.ljust(-(-len(body) // 2880) * 2880, b"\0")


@F.arrow_udf(T.StringType())
def fits_text(maps: Iterator[pa.Array]) -> Iterator[pa.Array]:
    headers: dict[int, bytes] = {}
    for batch in maps:
        pixels, ends = batch.values, batch.offsets.to_numpy()
        uniq, density = (pixels.field(n).to_numpy(zero_copy_only=False) for n in ("uniq", "probdensity"))
        headers |= {n: fits_headers(n) for n in set(np.diff(ends).tolist()) - headers.keys()}
        spans = zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
        texts = [base64.b64encode(fits_bytes(uniq[a:b], density[a:b], headers[b - a])) for a, b in spans]
        yield pa.array(texts, pa.binary()).cast(pa.string())


# --- raw messages --------------------------------------------------------------------------------------------


def raw_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(topic, value, timestamp): VOEvents, some not for us, some broken, some on a topic nobody knows."""
    eid = F.col("event_id").cast("string")
    obs, instrument = _mod(4), _pick2(INSTRUMENT_OF)
    path = _pick(("Fermi", "SWIFT", "INTEGRAL", "AMON"), obs)
    fragment = F.concat(F.when(obs == 3, "ICECUBE_").otherwise(""), instrument, F.lit("_Pos_"), eid)
    packet = F.when(_mod(19) == 0, F.lit(999)).otherwise(_pick2(PACKET_OF)).cast("string")
    error = F.when(_mod(11) == 0, F.lit(0)).otherwise(1 + _mod(10)).cast("string")

    def param(name: Column | str, value: Column) -> list[Column]:
        name = F.lit(name) if isinstance(name, str) else name
        return [F.lit('<Param name="'), name, F.lit('" value="'), value, F.lit('" />')]

    text = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<voe:VOEvent ivorn="ivo://nasa.gsfc.gcn/'), path, F.lit("#"),
        fragment, F.lit('" role="'), F.when(_mod(17) == 0, "test").otherwise("observation"),
        F.lit('" version="2.0" xmlns:voe="http://www.ivoa.net/xml/VOEvent/v2.0">\n<What>'),
        *param("Packet_Type", packet), *param(F.when(obs == 3, "AMON_ID").otherwise("TrigID"), eid),
        *param("Trigger_ID", F.lit("0x0")),
        F.lit('<Group name="Trigger_ID">'), *param("TrigID", F.lit("in-a-group")), F.lit("</Group></What>\n"),
        F.lit("<WhereWhen><ObsDataLocation><ObservationLocation><AstroCoords><Time><TimeInstant><ISOTime>"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SS"),
        F.lit("</ISOTime></TimeInstant></Time><Position2D unit=\"deg\"><Value2><C1>"), _ra(6151).cast("string"),
        F.lit("</C1><C2>"), _dec(15485).cast("string"), F.lit("</C2></Value2><Error2Radius>"), error,
        F.lit("</Error2Radius></Position2D></AstroCoords></ObservationLocation></ObsDataLocation></WhereWhen>\n"),
        F.lit("</voe:VOEvent>"),
    )
    value = F.when(_mod(23) == 0, F.substring(text, 1, 200)).otherwise(text)
    topic = F.when(_mod(29) == 0, "gcn.unknown").otherwise(F.concat(F.lit("gcn.classic.voevent."), _pick(TOPIC_OF, obs)))
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") == "error")
        .select(topic.alias("topic"), value.alias("value"), F.col("ts").alias("timestamp"))
    )


def raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(topic, value, timestamp): gravitational-wave alerts with their map as base64 FITS text."""
    m = map_notices(spark, sf_dir)
    kind = _pick(("PRELIMINARY", "INITIAL", "UPDATE"), _mod(3))
    body = F.struct(
        F.concat(F.when(_mod(17) == 0, "M").otherwise("S"), F.col("event_id").cast("string")).alias("superevent_id"),
        F.when(_mod(13) == 0, "RETRACTION").otherwise(kind).alias("alert_type"),
        F.when(
            _mod(13) != 0,
            F.struct(
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("time"),
                F.when(_mod(2) == 0, F.array(F.lit("H1"), F.lit("L1"))).otherwise(F.array(F.lit("V1")))
                .alias("instruments"),
                (_mod(2) == 0).alias("significant"), fits_text("pixels").alias("skymap"),
            ),
        ).alias("event"),
    )
    text = F.to_json(body)
    value = F.when(_mod(23) == 0, F.substring(text, 1, 40)).otherwise(text)
    return m.select(F.lit("igwn.gwalert").alias("topic"), value.alias("value"), F.col("ts").alias("timestamp"))


def raw_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_xml(spark, sf_dir).unionByName(raw_json(spark, sf_dir))
