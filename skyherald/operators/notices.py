"""Raw (topic, value) messages -> notice rows.

Every message is parsed once into typed columns. All steps are projections and filters, so the same functions
run on a table and on a stream; only the numbering of updates (`notice_status`) has two forms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyherald.functions.time import iso_utc, to_jd
from skyherald.observatories import (
    OBSERVATORIES, error_radius, is_listened, per_observatory, stored_radius, topic_table,
)
from skyherald.operators.grade import drop_json_key
from skyherald.operators.skymap import decode_skymap
from skyherald.plans.sizing import computed_once, running

VOEVENT = """
_ivorn string, _role string,
What struct<Param: array<struct<_name: string, _value: string>>>,
WhereWhen struct<ObsDataLocation: struct<ObservationLocation: struct<AstroCoords: struct<
  Time: struct<TimeInstant: struct<ISOTime: string>>,
  Position2D: struct<Value2: struct<C1: string, C2: string>, Error2Radius: string>>>>>,
_corrupt string
"""
GW_ALERT = """
superevent_id string, alert_type string,
event struct<time: string, instruments: array<string>, significant: boolean, skymap: string>,
_corrupt string
"""
_PARSE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}

# why a message does not become a notice: the first two are not errors, just not for us
NOT_OBSERVATION = "not an observation"
NOT_LISTENED = "packet type not listened to"
GATES = (NOT_OBSERVATION, NOT_LISTENED)


def route_format(raw: DataFrame, observatories=OBSERVATORIES) -> DataFrame:
    """Add the message format of the topic, null for an unknown topic."""
    topics = F.broadcast(topic_table(raw.sparkSession, observatories))
    return raw.join(topics, "topic", "left")


def parse_xml_notices(routed: DataFrame) -> DataFrame:
    """Add `xml`, the VOEvent as a struct; malformed text ends in `xml._corrupt`."""
    text = F.when(F.col("format") == "xml", F.col("value"))
    return routed.withColumn("xml", F.from_xml(text, VOEVENT, _PARSE))


def parse_json_notices(routed: DataFrame) -> DataFrame:
    """Add `json`, the gravitational-wave alert as a struct."""
    text = F.when(F.col("format") == "json", F.col("value"))
    return routed.withColumn("json", F.from_json(text, GW_ALERT, _PARSE))


def top_param(name: Column | str) -> Column:
    """Value of a top-level parameter (those inside groups do not count); the last one if it is repeated."""
    name = F.lit(name) if isinstance(name, str) else name
    return F.try_element_at(F.filter("xml.What.Param", lambda p: p["_name"] == name), F.lit(-1))["_value"]


def _fragment() -> Column:
    return F.split_part(F.col("xml._ivorn"), F.lit("#"), F.lit(2))


def detect_observatory(parsed: DataFrame, observatories=OBSERVATORIES) -> DataFrame:
    """Add `observatory`: for XML from the ivorn's path, for JSON by the presence of `superevent_id`."""
    base = F.lower(F.element_at(F.split(F.split_part(F.col("xml._ivorn"), F.lit("#"), F.lit(1)), "/"), -1))
    detector = F.when(base == "amon", F.lower(F.split_part(_fragment(), F.lit("_"), F.lit(1)))).otherwise(base)
    found = F.when(F.col("format") == "xml", detector).when(F.col("json.superevent_id").isNotNull(), "lvk")
    return parsed.withColumn("observatory", per_observatory(found, lambda o: o.name, observatories, by="key"))


def is_observation(test: bool = False) -> Column:
    """XML: role. JSON: the id starts with S, in test mode also with M; `significant` is not required."""
    first = F.substring("json.superevent_id", 1, 1)
    json = first.isin("S", "M") if test else first == "S"
    return F.when(F.col("format") == "xml", F.col("xml._role") == "observation").otherwise(json)


def packet_type() -> Column:
    number = top_param("Packet_Type").try_cast("int").cast("string")
    return F.when(F.col("format") == "xml", number).otherwise(F.col("json.alert_type"))


def extract_instrument(df: DataFrame, observatories=OBSERVATORIES) -> DataFrame:
    """Add `instrument` and `event`, from a token of the ivorn or the list of detectors."""
    obs = F.col("observatory")
    token = F.split_part(
        _fragment(), F.lit("_"), per_observatory(obs, lambda o: o.instrument_token + 1, observatories, default=1)
    )
    as_event = per_observatory(obs, lambda o: o.token_is_event, observatories, default=False)
    is_json = F.col("format") == "json"
    return df.withColumns(
        {
            "instrument": F.when(is_json, F.array_join("json.event.instruments", "_"))
            .when(as_event, F.lit("")).otherwise(token),
            "event": F.when(is_json, F.lit("gw")).when(as_event, token).otherwise(F.lit("")),
        }
    )


def extract_trigger_id(observatories=OBSERVATORIES) -> Column:
    name = per_observatory(F.col("observatory"), lambda o: o.trigger_param, observatories)
    return F.when(F.col("format") == "json", F.col("json.superevent_id")).otherwise(top_param(name))


def extract_trigger_time() -> Column:
    coords = "xml.WhereWhen.ObsDataLocation.ObservationLocation.AstroCoords"
    text = F.when(F.col("format") == "json", F.col("json.event.time")).otherwise(
        F.trim(F.col(f"{coords}.Time.TimeInstant.ISOTime"))
    )
    return F.try_to_timestamp(text)


def extract_position() -> tuple[Column, Column, Column]:
    """Right ascension, declination and error radius of a VOEvent, in degrees."""
    p = "xml.WhereWhen.ObsDataLocation.ObservationLocation.AstroCoords.Position2D"
    return tuple(
        F.trim(F.col(f"{p}.{f}")).try_cast("double") for f in ("Value2.C1", "Value2.C2", "Error2Radius")
    )


def parse_notices(raw: DataFrame, test: bool = False, observatories=OBSERVATORIES) -> DataFrame:
    """One row per message with all notice columns and `reason`: null for a notice, else why it is none."""
    ack = F.col("timestamp") if "timestamp" in raw.columns else F.current_timestamp()
    df = raw.withColumn("ackTime", ack).select("topic", "value", "ackTime")
    df = parse_json_notices(parse_xml_notices(route_format(df, observatories)))
    df = detect_observatory(computed_once(df, "xml", "json"), observatories)
    df = extract_instrument(df.withColumn("packet_type", packet_type()), observatories)
    ra, dec, error_deg = extract_position()
    df = df.withColumns(
        {
            "triggerId": extract_trigger_id(observatories),
            "trigger_time": extract_trigger_time(),
            "ra": ra, "dec": dec, "error_deg": error_deg,
            "event_type": F.when(F.col("packet_type") == "RETRACTION", F.lit("retraction")).otherwise(F.lit("alert")),
            "skymap": F.col("json.event.skymap"),
        }
    )
    df = df.withColumn(
        "region_arcmin", error_radius(F.col("observatory"), F.col("instrument"), F.col("error_deg"), observatories)
    )
    malformed = (
        F.col("value").isNull() | F.col("xml._corrupt").isNotNull() | F.col("json._corrupt").isNotNull()
        | ((F.col("format") == "xml") & F.col("xml._ivorn").isNull())
    )
    listened = is_listened(F.col("observatory"), F.col("packet_type"), observatories)
    alert = F.col("event_type") == "alert"
    circle = alert & (F.col("format") == "xml")
    reason = (
        F.when(F.col("format").isNull(), "unknown topic")
        .when(malformed, "malformed message")
        .when(F.col("observatory").isNull(), "unknown observatory")
        .when(~F.coalesce(is_observation(test), F.lit(False)), NOT_OBSERVATION)
        .when(~F.coalesce(listened, F.lit(False)), NOT_LISTENED)
        .when(F.col("triggerId").isNull(), "no trigger id")
        .when(alert & F.col("trigger_time").isNull(), "no trigger time")
        .when(circle & (F.col("ra").isNull() | F.col("dec").isNull() | F.col("error_deg").isNull()), "no position")
        .when(circle & F.col("region_arcmin").isNull(), "unknown instrument")
        .when(alert & (F.col("format") == "json") & F.col("skymap").isNull(), "no sky map")
    )
    df = computed_once(df.withColumn("reason", reason), "reason")
    # only maps of messages that are notices so far are decoded; one that cannot be read is a dead letter too
    text = F.when(F.col("reason").isNull() & (F.col("format") == "json"), F.col("skymap"))
    df = df.withColumn("map", decode_skymap(text))
    unreadable = text.isNotNull() & alert & F.col("map.uniq").isNull()
    df = df.withColumn("reason", F.when(unreadable, "unreadable sky map").otherwise(F.col("reason")))
    return computed_once(df, "reason", "map")


def dead_letter(parsed: DataFrame) -> DataFrame:
    """Messages that failed, with the reason; messages the gates dropped are not failures."""
    bad = F.col("reason").isNotNull() & ~F.col("reason").isin(*GATES)
    return parsed.filter(bad).select("topic", "value", "ackTime", "reason")


def notice_row(
    parsed: DataFrame, observatories=OBSERVATORIES, with_skymap: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """The accepted messages as rows of the notice table (all columns but `gcn_status`).

    A sky map gives the position (its densest pixel) and the "radius" (its 90 % area in square arcmin). Its text is cut
    out of `raw_event`, as the pixels have a table of their own (`with_skymap` hands them on).
    """
    obs = F.col("observatory")
    kept = parsed.filter(F.col("reason").isNull())
    is_map = per_observatory(obs, lambda o: o.region == "skymap", observatories, default=False)
    day = F.coalesce("trigger_time", "ackTime")
    out = kept.select(
        *carry, "observatory", "instrument", "event", "event_type",
        F.when(F.col("format") == "json", F.lit("")).otherwise(F.col("xml._ivorn")).alias("ivorn"),
        "triggerId",
        F.when(is_map, F.col("map.ra")).otherwise(F.col("ra")).alias("ra"),
        F.when(is_map, F.col("map.dec")).otherwise(F.col("dec")).alias("dec"),
        F.when(is_map, F.col("map.area_arcmin2"))
        .otherwise(stored_radius(obs, F.col("region_arcmin"), observatories)).alias("err_arcmin"),
        "region_arcmin", "ackTime",
        to_jd(F.col("trigger_time")).alias("triggerTimejd"),
        iso_utc(F.col("trigger_time")).alias("triggerTimeUTC"),
        F.col("value").alias("raw_event"),
        *[F.date_format(day, p).alias(n) for n, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))],
        *([F.struct("map.uniq", "map.probdensity").alias("skymap"), F.col("map.uniq").isNotNull().alias("__has_map")] if with_skymap else []),
    )
    if with_skymap:
        out = out.withColumn("skymap", F.when(F.col("__has_map"), F.col("skymap"))).drop("__has_map")
    return drop_json_key(out)


def status_text(rank: Column) -> Column:
    """1st notice of a trigger `initial`, 2nd `update_0`, 3rd `update_1`, ..."""
    return F.when(rank <= 1, "initial").otherwise(F.concat(F.lit("update_"), (rank - 2).cast("string")))


def is_fresh(time_window: float, ack: str = "ackTime") -> Column:
    """Whether a notice arrives while its trigger is remembered."""
    return F.coalesce(to_jd(F.col(ack)) - F.col("triggerTimejd") < time_window, F.lit(True))


def notice_status(
    notices: DataFrame, time_window: float = 7, key: str = "triggerId", ack: str = "ackTime",
    tie: Column | None = None, received: DataFrame | None = None,
) -> DataFrame:
    """Add `gcn_status`, the update number in order of arrival.

    A trigger is remembered for `time_window` days after its trigger time; a notice that arrives later finds
    no predecessor and is `initial`. Works for a trigger of any number of notices (see `running`).
    `received` has per trigger the number of fresh notices before these, for a table that comes in parts.
    """
    tie = F.xxhash64(*[c for c in notices.columns if c != "raw_event"]) if tie is None else tie
    fresh = is_fresh(time_window, ack)
    marked = notices.withColumns(
        {"__order": F.unix_micros(ack), "__tie": tie, "__fresh": fresh.cast("bigint")}
    )
    ranked = running(marked, [key], ["__order", "__tie"], F.col("__fresh"), "__rank")
    before = F.lit(0)
    if received is not None:
        ranked, before = ranked.join(received.select(key, F.col("received").alias("__before")), key, "left"), F.coalesce("__before", F.lit(0))
    status = F.when(F.col("__fresh") == 1, status_text(F.col("__rank") + before)).otherwise(F.lit("initial"))
    return ranked.withColumn("gcn_status", status).select(*notices.columns, "gcn_status")


def notice_inventory(notices: DataFrame) -> DataFrame:
    """Counts and first / last trigger time: in all, per observatory, and per instrument or event."""
    what = F.when(F.col("instrument") == "", F.col("event")).otherwise(F.col("instrument"))
    return (
        notices.withColumn("instrument_or_event", what)
        .rollup("observatory", "instrument_or_event")
        .agg(
            F.count(F.lit(1)).alias("notices"),
            F.min("triggerTimeUTC").alias("first_trigger"),
            F.max("triggerTimeUTC").alias("last_trigger"),
        )
    )
