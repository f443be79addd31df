"""The observatories, as data: what they send, how their error radius reads, how their regions are matched.

A new observatory is a new row of `OBSERVATORIES` (or of the list a caller passes instead).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Observatory:
    name: str
    message_format: str  # "xml" or "json"
    packet_types: tuple[str, ...]
    topics: tuple[str, ...]
    rate: float  # detections per year, -1 when none is known
    trigger_param: str  # top-level parameter with the trigger id (XML)
    # instrument -> (radius in arcmin for a zero error, factor applied to a non-zero error in degrees)
    error_rules: dict[str, tuple[float, float]] = field(default_factory=dict)
    stored_zero: float | None = None  # radius stored in the table for a zero radius, when it differs
    instrument_token: int = 0  # token of the ivorn fragment that names the instrument (or event)
    token_is_event: bool = False
    region: str = "circle"  # "circle" or "skymap"
    assoc: str = "grb"  # "grb", "neutrino" or "gw"

    @property
    def key(self) -> str:
        return self.name.lower()


# fixed values: names, packet types, topics, rates and error rules of the observatories
OBSERVATORIES = (
    Observatory(
        name="Fermi",
        message_format="xml",
        packet_types=("111", "112", "115", "120", "121", "127", "123", "125"),
        topics=(
            "gcn.classic.voevent.FERMI_GBM_ALERT", "gcn.classic.voevent.FERMI_GBM_FIN_POS",
            "gcn.classic.voevent.FERMI_GBM_FLT_POS", "gcn.classic.voevent.FERMI_GBM_GND_POS",
            "gcn.classic.voevent.FERMI_GBM_LC", "gcn.classic.voevent.FERMI_GBM_POS_TEST",
            "gcn.classic.voevent.FERMI_GBM_SUBTHRESH", "gcn.classic.voevent.FERMI_GBM_TRANS",
            "gcn.classic.voevent.FERMI_LAT_GND", "gcn.classic.voevent.FERMI_LAT_MONITOR",
            "gcn.classic.voevent.FERMI_LAT_OFFLINE", "gcn.classic.voevent.FERMI_LAT_POS_DIAG",
            "gcn.classic.voevent.FERMI_LAT_POS_INI", "gcn.classic.voevent.FERMI_LAT_POS_TEST",
            "gcn.classic.voevent.FERMI_LAT_POS_UPD", "gcn.classic.voevent.FERMI_LAT_TRANS",
            "gcn.classic.voevent.FERMI_POINTDIR", "gcn.classic.voevent.FERMI_SC_SLEW",
        ),
        rate=250.0,
        trigger_param="TrigID",
        # LAT stores degrees in the arcmin column; kept, since results are compared with it
        error_rules={"GBM": (1.0, 60.0), "LAT": (1 / 60, 1.0)},
    ),
    Observatory(
        name="SWIFT",
        message_format="xml",
        packet_types=("61", "63", "65", "67", "81", "84", "97"),
        topics=(
            "gcn.classic.voevent.SWIFT_ACTUAL_POINTDIR", "gcn.classic.voevent.SWIFT_BAT_ALARM_LONG",
            "gcn.classic.voevent.SWIFT_BAT_ALARM_SHORT", "gcn.classic.voevent.SWIFT_BAT_GRB_ALERT",
            "gcn.classic.voevent.SWIFT_BAT_GRB_LC", "gcn.classic.voevent.SWIFT_BAT_GRB_LC_PROC",
            "gcn.classic.voevent.SWIFT_BAT_GRB_POS_ACK", "gcn.classic.voevent.SWIFT_BAT_GRB_POS_NACK",
            "gcn.classic.voevent.SWIFT_BAT_GRB_POS_TEST", "gcn.classic.voevent.SWIFT_BAT_KNOWN_SRC",
            "gcn.classic.voevent.SWIFT_BAT_MONITOR", "gcn.classic.voevent.SWIFT_BAT_QL_POS",
            "gcn.classic.voevent.SWIFT_BAT_SCALEDMAP", "gcn.classic.voevent.SWIFT_BAT_SLEW_POS",
            "gcn.classic.voevent.SWIFT_BAT_SUB_THRESHOLD", "gcn.classic.voevent.SWIFT_BAT_SUBSUB",
            "gcn.classic.voevent.SWIFT_BAT_TRANS", "gcn.classic.voevent.SWIFT_FOM_OBS",
            "gcn.classic.voevent.SWIFT_FOM_PPT_ARG_ERR", "gcn.classic.voevent.SWIFT_FOM_SAFE_POINT",
            "gcn.classic.voevent.SWIFT_FOM_SLEW_ABORT", "gcn.classic.voevent.SWIFT_POINTDIR",
            "gcn.classic.voevent.SWIFT_SC_SLEW", "gcn.classic.voevent.SWIFT_TOO_FOM",
            "gcn.classic.voevent.SWIFT_TOO_SC_SLEW", "gcn.classic.voevent.SWIFT_UVOT_DBURST",
            "gcn.classic.voevent.SWIFT_UVOT_DBURST_PROC", "gcn.classic.voevent.SWIFT_UVOT_EMERGENCY",
            "gcn.classic.voevent.SWIFT_UVOT_FCHART", "gcn.classic.voevent.SWIFT_UVOT_FCHART_PROC",
            "gcn.classic.voevent.SWIFT_UVOT_POS", "gcn.classic.voevent.SWIFT_UVOT_POS_NACK",
            "gcn.classic.voevent.SWIFT_XRT_CENTROID", "gcn.classic.voevent.SWIFT_XRT_EMERGENCY",
            "gcn.classic.voevent.SWIFT_XRT_IMAGE", "gcn.classic.voevent.SWIFT_XRT_IMAGE_PROC",
            "gcn.classic.voevent.SWIFT_XRT_LC", "gcn.classic.voevent.SWIFT_XRT_POSITION",
            "gcn.classic.voevent.SWIFT_XRT_SPECTRUM", "gcn.classic.voevent.SWIFT_XRT_SPECTRUM_PROC",
            "gcn.classic.voevent.SWIFT_XRT_SPER", "gcn.classic.voevent.SWIFT_XRT_SPER_PROC",
            "gcn.classic.voevent.SWIFT_XRT_THRESHPIX", "gcn.classic.voevent.SWIFT_XRT_THRESHPIX_PROC",
        ),
        rate=100.0,
        trigger_param="TrigID",
        error_rules={i: (1 / 60, 60.0) for i in ("XRT", "UVOT", "BAT", "FOM")},
    ),
    Observatory(
        name="INTEGRAL",
        message_format="xml",
        packet_types=("53", "54", "56"),
        topics=(
            "gcn.classic.voevent.INTEGRAL_OFFLINE", "gcn.classic.voevent.INTEGRAL_POINTDIR",
            "gcn.classic.voevent.INTEGRAL_REFINED", "gcn.classic.voevent.INTEGRAL_SPIACS",
            "gcn.classic.voevent.INTEGRAL_WAKEUP", "gcn.classic.voevent.INTEGRAL_WEAK",
        ),
        rate=60.0,
        trigger_param="TrigID",
        error_rules={i: (0.0, 60.0) for i in ("Weak", "Wakeup", "Refined")},
    ),
    Observatory(
        name="ICECUBE",
        message_format="xml",
        packet_types=("157", "173", "174", "176"),
        topics=(
            "gcn.classic.voevent.ICECUBE_ASTROTRACK_BRONZE", "gcn.classic.voevent.ICECUBE_ASTROTRACK_GOLD",
            "gcn.classic.voevent.ICECUBE_CASCADE",
        ),
        rate=-1.0,
        trigger_param="AMON_ID",
        error_rules={"": (0.0, 60.0)},
        stored_zero=1 / 60,
        instrument_token=1,
        token_is_event=True,
        assoc="neutrino",
    ),
    Observatory(
        name="LVK",
        message_format="json",
        packet_types=("PRELIMINARY", "INITIAL", "UPDATE", "RETRACTION"),
        topics=("igwn.gwalert",),
        rate=-1.0,
        trigger_param="superevent_id",
        region="skymap",
        assoc="gw",
    ),
)


def topic_table(spark: SparkSession, observatories=OBSERVATORIES) -> DataFrame:
    """(topic, format): one row per topic that is listened to; a fixed, small dimension."""
    rows = [(t, o.message_format) for o in observatories for t in o.topics]
    return spark.createDataFrame(rows, "topic string, format string")


def per_observatory(observatory: Column, value, observatories=OBSERVATORIES, default=None, by: str = "name") -> Column:
    """`value(o)` of the observatory a row belongs to; `value` gives a Column, a literal or None (= `default`).

    Rows carry the observatory's name; `by="key"` compares with its lower-case form instead.
    """
    cases = [(o, value(o)) for o in observatories]
    cases = [(o, v) for o, v in cases if v is not None]
    if not cases:
        return F.lit(default)

    def lit(v):
        return v if isinstance(v, Column) else F.lit(v)

    (o, v), *tail = cases
    first = F.when(observatory == getattr(o, by), lit(v))
    chain = reduce(lambda c, ov: c.when(observatory == getattr(ov[0], by), lit(ov[1])), tail, first)
    return chain.otherwise(F.lit(default))


def of_assoc(observatory: Column, kind: str, observatories=OBSERVATORIES) -> Column:
    """Whether a row's observatory is associated in the given way ("grb", "neutrino" or "gw")."""
    return observatory.isin(*[o.name for o in observatories if o.assoc == kind])


def rate_of(observatory: Column, observatories=OBSERVATORIES) -> Column:
    """Detections per year, null where none is known."""
    return per_observatory(observatory, lambda o: o.rate if o.rate > 0 else None, observatories)


def is_listened(observatory: Column, packet_type: Column, observatories=OBSERVATORIES) -> Column:
    return per_observatory(observatory, lambda o: packet_type.isin(*o.packet_types), observatories, default=False)


def error_radius(
    observatory: Column, instrument: Column, error_deg: Column, observatories=OBSERVATORIES
) -> Column:
    """Radius in arcmin that cells and association use; null for an unknown instrument."""

    def rule(o: Observatory):
        if not o.error_rules:
            return None
        items = list(o.error_rules.items())

        def radius(zero, factor):
            return F.when(error_deg == 0, F.lit(zero)).otherwise(error_deg * factor)

        chain = F.when(instrument == items[0][0], radius(*items[0][1]))
        for name, (zero, factor) in items[1:]:
            chain = chain.when(instrument == name, radius(zero, factor))
        return chain

    return per_observatory(observatory, rule, observatories)


def stored_radius(observatory: Column, region_arcmin: Column, observatories=OBSERVATORIES) -> Column:
    """The radius of the notice table, which replaces a zero for some observatories."""
    zero = per_observatory(observatory, lambda o: o.stored_zero, observatories)
    return F.when((region_arcmin == 0) & zero.isNotNull(), zero).otherwise(region_arcmin)
