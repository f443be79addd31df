"""The cross-match of a night as one plan: prepared alerts x prepared notices -> matches."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyherald.functions.time import partition_cols
from skyherald.observatories import OBSERVATORIES, Observatory
from skyherald.operators import skymap as sm
from skyherald.operators.alerts import alert_position, alert_prune, alert_quality_filter, classify, history_concat
from skyherald.operators.grade import WORKING, match_projection
from skyherald.operators.match import (
    CONE_FACTOR, MAX_DELAY, circle_notices, crossmatch, dedup_matches, keep_associated, p_assoc,
)
from skyherald.operators.regions import TIERS, Tier
from skyherald.plans.sizing import BROADCAST_BYTES, ROWS_PER_TASK, even_keys, skew_join, total
from skyherald.sinks.tables import PARTS


@dataclass(frozen=True)
class MatchSettings:
    """`cover_factor=1.5` finds every associated pair; `cover_factor=1.0` with `tiers=((4, None),)` only those
    that share a cell of the bare error circle on the NSIDE 4 grid."""

    class_rules: list[tuple[str, str]]
    cover_factor: float = CONE_FACTOR
    tiers: tuple[Tier, ...] = TIERS
    map_nside: int = 4
    max_delay: float = MAX_DELAY
    year_conversion: str = "double"
    ast_dist: float = 5
    ps_dist: float = 2
    ps_score: float = 0.5
    gaia_dist: float = 5
    histories: bool = False
    observatories: tuple[Observatory, ...] = field(default=OBSERVATORIES)


# what a match takes from its notice, besides the raw text
NOTICE_COLUMNS = (
    "observatory", "instrument", "event", "triggerId", "gcn_status", "gcn_ra", "gcn_dec", "err_arcmin",
    "region_arcmin", "ackTime", "triggerTimejd", "triggerTimeUTC",
)


# what a pair takes from its notice
PAIR_COLUMNS = (
    "__notice", "__first_notice", "__notice_rank", "observatory", "triggerId", "gcn_status", "region_arcmin", "ackTime", "triggerTimejd",
)
# what pairs and their values depend on
VALUED_BY = ("triggerId", "gcn_status", "observatory", "region_arcmin", "triggerTimejd")
KEYED = (
    "observatory", "instrument", "event", "triggerId", "gcn_status", "ra", "dec", "err_arcmin", "ackTime",
    "triggerTimejd", "raw_event",
)
# notices are broadcast to their matches while their texts and about so many bytes a row stay below BROADCAST_BYTES
ROW_BYTES = 300


# what a pair takes from its alert; the other alert columns join the survivors
ALERT_COLUMNS = ("__object", "candid", "ztf_ra", "ztf_dec", "jdstarthist", "jd", "jd_first_real_det")


def prepare_alerts(alerts: DataFrame, s: MatchSettings) -> DataFrame:
    """Filtered, pruned alerts with their position."""
    kept = alert_quality_filter(alerts, s.ast_dist, s.ps_dist, s.ps_score, s.gaia_dist)
    return alert_position(alert_prune(kept))


def narrow_alerts(prepared: DataFrame) -> DataFrame:
    """What pairs need of the alerts; an object is a number here, also one without a name."""
    lifted = prepared.withColumns({c: F.col(f"candidate.{c}") for c in ("candid", "jdstarthist", "jd")})
    return lifted.withColumn("__object", F.xxhash64("objectId")).select(*ALERT_COLUMNS)


def _wide_alerts(prepared: DataFrame, s: MatchSettings) -> DataFrame:
    """What a match shows of its alert, classified, one row per object and `candid`: the rows of an alert that is stored twice
    are equal.

    Counting the rows of an id needs them sorted by it, and nothing is aggregated.
    """
    wide = prepared.withColumns({"candid": F.col("candidate.candid"), "__object": F.xxhash64("objectId")})
    order = Window.partitionBy("__object", "candid").orderBy("candid")
    copy = F.count(F.lit(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    one = wide.repartition("__object").withColumn("__copy", copy).filter(F.col("__copy") == 1).drop("__copy")
    # of the alert alone, so not once for every match
    return partition_cols(match_projection(classify(history_concat(one) if s.histories else one, s.class_rules)))


def ranked_alerts(narrow: DataFrame) -> DataFrame:
    """Different narrow alerts, each with its rank among those of its object: the order in which matches are kept.

    A number of partitions is given, since adaptive execution would put the few bytes into as few tasks, which then make all
    the pairs.
    """
    order = Window.partitionBy("__object").orderBy("jd", "candid")
    dealt = narrow.repartition(int(narrow.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__object")
    return dealt.distinct().withColumn("__alert_rank", F.row_number().over(order).cast("long"))


def ranked_notices(notices: DataFrame) -> DataFrame:
    """Notices with their rank among those of their trigger and status, and the id of the first of these."""
    order = Window.partitionBy("triggerId", "gcn_status").orderBy("ackTime", "__notice")
    return notices.withColumns({"__notice_rank": F.row_number().over(order).cast("long"), "__first_notice": F.first("__notice").over(order)})


def first_of_equals(notices: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Of notices that agree in `columns`, which make the same pairs with the same values, the first: no other is ever kept."""
    order = Window.partitionBy(*columns).orderBy("ackTime", "__notice")
    return notices.withColumn("__equal", F.row_number().over(order)).filter(F.col("__equal") == 1).drop("__equal")


def map_pairs(alerts: DataFrame, notices: DataFrame, pixels: DataFrame, s: MatchSettings) -> DataFrame:
    """Pairs with sky-map notices, each with the map's density at the alert.

    A pixel table that tells versions apart by `ackTime` is joined on it as well. Maps without `is_filler` may have gaps,
    which are filled first.
    """
    key = (*sm.KEY, "ackTime") if "ackTime" in pixels.columns else sm.KEY
    if "is_filler" not in pixels.columns:
        pixels = sm.complete_skymap(pixels, key)
    cells = sm.skymap_cells(sm.credible_region(pixels, key=key), s.map_nside, key=key)
    pairs = sm.skymap_match(alerts, pixels, cells, notices, s.map_nside, key=key, max_delay=s.max_delay)
    return pairs.withColumn("separation", F.lit(None).cast("double"))


def crossmatch_night(
    alerts: DataFrame, notices: DataFrame, settings: MatchSettings, pixels: DataFrame | None = None,
    with_raw: bool = True,
) -> DataFrame:
    """Matches of a set of alerts with a set of notices (one row per object, trigger and notice version).

    `pixels` is the child table of the notices' sky maps. Pairs are refined and valued before they are
    de-duplicated, so that an object is kept when any of its alerts is associated.

    A pair carries an id of its very notice, since several versions that arrive after their trigger's window are all
    `initial`; the survivors' columns are joined on that id. Of an alert that is stored twice one row is joined.

    Pairs can outnumber alerts and notices by far, so what can be done on either side is done before they are made: alerts
    stored twice and notices that could never be kept make none, and both sides are ranked, so that a pair's place in the
    order is one number. A pair is shuffled once, by its object, to meet the others of its key and, if kept, its alert; where one object has a
    large share of the alerts, a second time.
    """
    s = settings
    prepared = prepare_alerts(alerts, s)
    narrow = ranked_alerts(narrow_alerts(prepared))
    # equal in all that a match shows: the same notice
    notices = notices.withColumn("__notice", F.xxhash64(*[f"`{c}`" for c in KEYED if c in notices.columns]))
    ranked = ranked_notices(notices)
    circles = circle_notices(ranked, s.observatories).select(*PAIR_COLUMNS, "gcn_ra", "gcn_dec")
    circles = first_of_equals(circles, (*VALUED_BY, "gcn_ra", "gcn_dec"))
    pairs = crossmatch(narrow, circles, s.cover_factor, s.tiers, max_delay=s.max_delay)
    pairs = pairs.drop("gcn_ra", "gcn_dec").withColumn("density", F.lit(None).cast("double"))
    if pixels is not None:
        maps = first_of_equals(ranked.select(*PAIR_COLUMNS), (*VALUED_BY, *(["ackTime"] if "ackTime" in pixels.columns else [])))
        pairs = pairs.unionByName(map_pairs(narrow, maps, pixels, s), allowMissingColumns=True)
    delay = F.col("jd_first_real_det") - F.col("triggerTimejd")
    value = p_assoc(delay, F.col("separation"), F.col("density"), s.year_conversion, s.observatories)
    valued = keep_associated(pairs.withColumn("p_assoc", value))
    # few columns go through the de-duplication; all others join its survivors by key
    place = F.shiftleft("__alert_rank", 32) + F.col("__notice_rank")
    few = valued.select("__object", "__first_notice", place.alias("__place"), "candid", "p_assoc", "__notice")
    alerts_of, n = narrow.agg(F.max("__alert_rank"), F.count(F.lit(1))).first()
    alerts_of, versions_of = alerts_of or 0, ranked.agg(F.max("__notice_rank")).first()[0] or 0
    hot = alerts_of * versions_of > ROWS_PER_TASK
    # by the object alone, pairs lie where their alerts are joined as well
    even = even_keys(n, alerts_of, int(prepared.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    matches = dedup_matches(few, ("__object", "__first_notice"), ("__place",), hot=hot, by=("__object",) if even else None)
    # the alerts are the smaller side: hashed, so that the matches need no sort
    wide = _wide_alerts(prepared, s)
    added = [c for c in ("timestamp", *PARTS) if c not in prepared.columns]
    matches = matches.drop("__place", "__first_notice").join(wide.hint("shuffle_hash"), ["__object", "candid"])
    shown_first = ["candid", "objectId", "p_assoc", "__notice"]
    others = [c for c in wide.columns if c not in ("__object", *shown_first, *added)]
    matches = matches.select(*shown_first, *others, *added)
    details = notices.withColumnsRenamed({"ra": "gcn_ra", "dec": "gcn_dec"})
    shown = [*NOTICE_COLUMNS, *(["raw_event"] if with_raw else [])]
    # names of their own until joined: the pairs come from the same columns, and the optimiser must not mix the two up
    details = details.select("__notice", *[F.col(c).alias(f"__of_{c}") for c in shown]).dropDuplicates(["__notice"])
    size = total(notices, F.octet_length("raw_event").cast("bigint") + ROW_BYTES) if with_raw else total(notices, F.lit(ROW_BYTES))
    rows = 0 if size <= BROADCAST_BYTES else None
    matches = skew_join(matches, details, ["__notice"], small_rows=rows).drop("__notice")
    shown = {f"__of_{c}": c for c in shown if c not in WORKING}
    matches = matches.withColumnsRenamed({**shown, "__of_err_arcmin": "gcn_loc_error"})
    return matches.select(*[c for c in matches.columns if c not in added and not c.startswith("__of_")], *added)
