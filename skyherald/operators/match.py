"""Alerts x notices: candidate pairs by cell and time, exact refinement, association, de-duplication."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyherald.functions import probability, sky
from skyherald.observatories import OBSERVATORIES, of_assoc, per_observatory, rate_of
from skyherald.operators.regions import TIERS, Tier, used_tiers, with_alert_keys, with_notice_keys, with_trigger_spans
from skyherald.plans.sizing import BROADCAST_BYTES, BROADCAST_ROWS, computed_once, skew_join, total

# an association accepts separations up to this multiple of the error radius
CONE_FACTOR = 1.5
# days after the trigger in which alerts are paired with it
MAX_DELAY = 7.0
NOT_ASSOCIATED = -1.0

_ALERT_VECTOR = ("__ax", "__ay", "__az")
_NOTICE_VECTOR = ("__nx", "__ny", "__nz")


def _with_vector(df: DataFrame, ra: str, dec: str, names: tuple[str, ...]) -> DataFrame:
    return df.withColumns(dict(zip(names, sky.unit_vector(F.col(ra), F.col(dec)))))


def circle_notices(notices: DataFrame, observatories=OBSERVATORIES) -> DataFrame:
    """Notices with an error circle (no sky maps, no retractions); the position becomes gcn_ra, gcn_dec."""
    is_circle = per_observatory(F.col("observatory"), lambda o: o.region == "circle", observatories, default=False)
    return (
        notices.filter(is_circle & F.col("region_arcmin").isNotNull())
        .withColumnsRenamed({"ra": "gcn_ra", "dec": "gcn_dec"})
    )


def map_notices(notices: DataFrame, observatories=OBSERVATORIES) -> DataFrame:
    """Notices whose region is a sky map; retractions have none."""
    is_map = per_observatory(F.col("observatory"), lambda o: o.region == "skymap", observatories, default=False)
    return notices.filter(is_map & (F.col("event_type") == "alert"))


def crossmatch(
    alerts: DataFrame,
    notices: DataFrame,
    cover_factor: float = CONE_FACTOR,
    tiers: tuple[Tier, ...] = TIERS,
    cone_factor: float | None = CONE_FACTOR,
    broadcast_rows: int = BROADCAST_ROWS,
    max_delay: float | None = MAX_DELAY,
) -> DataFrame:
    """Pairs of an alert and a circle notice in the same sky cell, the alert starting after the trigger and taken at most
    `max_delay` days after it. The time is part of the join's key, so pairs grow with the alerts, not with their square.

    `alerts` has candid, ztf_ra, ztf_dec, jdstarthist, jd; `notices` has gcn_ra, gcn_dec, region_arcmin,
    triggerTimejd; all other columns travel along. The exact cone test (`cone_factor` radii) is part of the
    join condition, on unit vectors computed once per row. `cover_factor=1.5` gives every pair of the cone,
    whatever the grid; `cover_factor=1.0` with one NSIDE gives the pairs that share a cell of the bare circle.

    The notice side is broadcast while a bound of its number of cells and of their bytes, from one aggregate over the
    notices, stays small: then the alerts are not shuffled. Otherwise both sides are shuffled by cell and hot cells are
    split by adaptive execution.
    """
    # a cover as wide as the cone is refined exactly, so a coarser and cheaper one gives the same pairs
    complete = cone_factor is not None and cone_factor <= cover_factor
    oversampling = 2 if complete else 4
    tiers, cells, width = used_tiers(notices, cover_factor, tiers, oversampling)
    left = with_alert_keys(_with_vector(alerts, "ztf_ra", "ztf_dec", _ALERT_VECTOR), tiers)
    right = with_notice_keys(_with_vector(notices, "gcn_ra", "gcn_dec", _NOTICE_VECTOR), cover_factor, tiers, oversampling)
    cond = F.col("jdstarthist") > F.col("triggerTimejd")
    if cone_factor is not None:
        right = right.withColumn("__reach", sky.chord2_of(F.col("region_arcmin") / 60.0 * cone_factor))
        cond = cond & (_pair_chord2() <= F.col("__reach"))
    # a notice lies in one short stretch of time, so that an alert meets few notices out of its time
    left, right, key = with_trigger_spans(left, right, max_delay)
    if max_delay is not None:
        cond = cond & _in_time(max_delay)
    # vectors, reach and cell come on top of a notice's own width
    if cells * (width + 80) > BROADCAST_BYTES:
        cells = None
    pairs = skew_join(
        left, right, ["cell", *key], small_rows=cells, condition=cond, broadcast_rows=broadcast_rows
    )
    pairs = pairs.withColumn("separation", sky.separation_of(_pair_chord2())).drop(
        "cell", *key, "__reach", *_ALERT_VECTOR, *_NOTICE_VECTOR
    )
    # a later filter on the association must not become part of the join condition, tested for every candidate
    return computed_once(pairs, "separation")


def _in_time(max_delay: float) -> Column:
    return F.col("jd") <= F.col("triggerTimejd") + F.lit(max_delay)


def _pair_chord2() -> Column:
    return sky.chord2([F.col(c) for c in _ALERT_VECTOR], [F.col(c) for c in _NOTICE_VECTOR])


def cone_match(pairs: DataFrame, factor: float = CONE_FACTOR) -> DataFrame:
    """Keep pairs whose exact separation is within `factor` error radii."""
    return pairs.filter(F.col("separation") * 60.0 <= factor * F.col("region_arcmin"))


def p_assoc(
    delay_days: Column,
    separation: Column,
    density: Column | None = None,
    year_conversion: str = "double",
    observatories=OBSERVATORIES,
) -> Column:
    """Association value by observatory: chance probability (gamma rays), 0.5 (neutrinos), density (maps)."""
    inside = separation * 60.0 <= F.col("region_arcmin") * CONE_FACTOR
    rate = rate_of(F.col("observatory"), observatories)
    grb = probability.assoc_grb(delay_days, inside, rate, F.col("region_arcmin"), year_conversion)
    value = F.when(of_assoc(F.col("observatory"), "grb", observatories), grb).when(
        of_assoc(F.col("observatory"), "neutrino", observatories), probability.assoc_neutrino(delay_days, inside)
    )
    return value if density is None else value.otherwise(density)


def keep_associated(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("p_assoc") != NOT_ASSOCIATED)


# the least value of the types whose aggregation buffers are changed in place, so that a hash aggregate can hold them
_LEAST = {
    "double": float("-inf"), "float": float("-inf"), "long": -(1 << 63), "integer": -(1 << 31), "short": -(1 << 15),
    "byte": -(1 << 7), "boolean": False, "timestamp": datetime.datetime(1, 1, 1), "date": datetime.date(1, 1, 1),
}


def dedup_matches(
    matches: DataFrame, key=("objectId", "triggerId", "gcn_status"), order=("jd", "candid"), hot: bool = True,
    by: tuple[str, ...] | None = None,
) -> DataFrame:
    """One row per key, the first in `order` (null first).

    Aggregates, not a window: a hot key's rows are dealt by the first column of `order` and reduced there before they meet.
    Where all columns but the key are of fixed width these are hash aggregates, one for each column of `order`, from the
    last to the first; texts and nested columns need one that sorts. Rows are shuffled twice for that; where no key has more
    than a task can read (`hot=False`) all rows of a key meet at once. `by` names columns of the key that all rows are dealt by, for what
    is joined by these afterwards.
    """
    rest = [c for c in matches.columns if c not in key]
    if any(matches.schema[c].dataType.typeName() not in _LEAST for c in rest):
        return (
            matches.groupBy(*key)
            .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
            .select(*key, "__row.*")
        )
    ranks = [f"__rank{i}" for i in range(len(order))]
    least = [F.lit(_LEAST[matches.schema[c].dataType.typeName()]).cast(matches.schema[c].dataType) for c in order]
    rows = matches.select(*key, *rest, *[F.coalesce(c, x).alias(r) for c, x, r in zip(order, least, ranks, strict=True)])
    rows = rows.repartition(*(by or ((*key, ranks[0]) if hot else key)))
    for i in reversed(range(len(order))):
        first = [F.min_by(c, ranks[i]).alias(c) for c in rest]
        rows = rows.groupBy(*key, *ranks[:i]).agg(*first)
    return rows.select(*key, *rest)


def reattach_raw(
    matches: DataFrame, notices: DataFrame, max_broadcast_bytes: int = 64 << 20, key=("triggerId", "gcn_status")
) -> DataFrame:
    """Bring each match the raw text of its own notice version. `key` names one notice: (triggerId, gcn_status) does not
    where versions arrive after their trigger's window, which are all `initial`."""
    raw = notices.select(*key, "raw_event")
    size = total(raw, F.octet_length("raw_event").cast("bigint") + 100)
    rows = 0 if size <= max_broadcast_bytes else None
    return skew_join(matches, raw, list(key), small_rows=rows)
