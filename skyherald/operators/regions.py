"""Sky cells and time spans of notices and alerts: the buckets that turn the join into an equi join.

A cell key is 4*NSIDE^2 + RING cell, unique over all NSIDE, so that small and large regions can use
different grids in the same join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyherald.functions import sky
from skyherald.plans.sizing import row_bytes

# (NSIDE, radius in degrees up to which this grid is used), finest first; None = no limit
Tier = tuple[int, float | None]
REFERENCE_TIER: tuple[Tier, ...] = ((4, None),)
TIERS: tuple[Tier, ...] = ((64, 1.0), (8, None))


def tier_of(radius_deg: Column, tiers: tuple[Tier, ...]) -> list[tuple[int, Column]]:
    """(NSIDE, condition) per tier; the conditions are disjoint and cover every radius."""
    out, below = [], F.lit(True)
    for nside, limit in tiers:
        mine = F.lit(True) if limit is None else radius_deg <= limit
        out.append((nside, below & mine))
        below = below & ~mine
    return out


def cover_cells(
    ra: Column, dec: Column, radius_deg: Column, tiers: tuple[Tier, ...] = TIERS, oversampling: int = 4
) -> Column:
    """Array of the cell keys a circle may overlap, on the grid of its tier."""
    chain = None
    for nside, mine in tier_of(radius_deg, tiers):
        keys = sky.disc_cells(nside, ra, dec, radius_deg, oversampling, first_key=4 * nside * nside)
        chain = F.when(mine, keys) if chain is None else chain.when(mine, keys)
    return chain


def circle_cover(notices: DataFrame, nside: int, cover_factor: float = 1.0) -> DataFrame:
    """Add `hpix_circle`, the RING cells that may overlap the notice's error circle."""
    radius = F.col("region_arcmin") / 60.0 * cover_factor
    return notices.withColumn("hpix_circle", sky.disc_cells(nside, F.col("ra"), F.col("dec"), radius))


def explode_cells(notices: DataFrame) -> DataFrame:
    """One row per (notice, cell); the position becomes gcn_ra, gcn_dec."""
    return notices.withColumn("hpix", F.explode_outer("hpix_circle")).withColumnsRenamed({"ra": "gcn_ra", "dec": "gcn_dec"})


def notice_cells(circles: DataFrame, map_cells: DataFrame, nside: int, cover_factor: float = 1.0) -> DataFrame:
    """(triggerId, gcn_status, hpix) of circle and sky-map notices alike."""
    covered = circle_cover(circles, nside, cover_factor)
    return covered.select("triggerId", "gcn_status", F.explode_outer("hpix_circle").alias("hpix")).unionByName(
        map_cells.select("triggerId", "gcn_status", "hpix")
    )


def with_notice_keys(
    notices: DataFrame, cover_factor: float, tiers: tuple[Tier, ...] = TIERS, oversampling: int = 4
) -> DataFrame:
    """One row per (circle notice, cell key)."""
    radius = F.col("region_arcmin") / 60.0 * cover_factor
    # outer, since a cover is never empty and the optimiser would test that by building it a second time
    return notices.withColumn("cell", F.explode_outer(cover_cells(F.col("gcn_ra"), F.col("gcn_dec"), radius, tiers, oversampling)))


def with_alert_keys(alerts: DataFrame, tiers: tuple[Tier, ...] = TIERS) -> DataFrame:
    """One row per (alert, grid); a single grid needs no explode."""
    grids = [n for n, _ in tiers]
    keyed = sky.with_ring_cells(alerts, "ztf_ra", "ztf_dec", grids, "__cell")
    keys = [sky.known(F.col(f"__cell{n}") + 4 * n * n, -1) for n in grids]
    cell = keys[0] if len(keys) == 1 else F.explode_outer(F.array(*keys))
    return keyed.withColumn("cell", cell).drop(*[f"__cell{n}" for n in grids])


def used_tiers(
    notices: DataFrame, cover_factor: float, tiers: tuple[Tier, ...] = TIERS, oversampling: int = 4
) -> tuple[tuple[Tier, ...], int, int]:
    """(tiers that some notice uses, bound of the number of notice cells, bytes of the widest notice), from one aggregate
    over the notices."""
    radius = F.col("region_arcmin") / 60.0 * cover_factor
    bounds = [
        F.sum(F.when(mine, sky.disc_cell_bound(nside, radius, oversampling))).alias(f"t{i}")
        for i, (nside, mine) in enumerate(tier_of(radius, tiers))
    ]
    *found, width = notices.agg(*bounds, F.max(row_bytes(notices)).alias("width")).first()
    used = tuple(t for t, n in zip(tiers, found, strict=True) if n)
    return used or tiers[-1:], sum(n or 0 for n in found), width or 0


def with_trigger_spans(
    alerts: DataFrame, notices: DataFrame, max_delay: float | None, parts: int = 4
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Number the stretches of a `parts`-th of `max_delay` days: a notice lies in one, and an alert is listed in those that its
    triggers can lie in. A pair meets once, and an alert meets few notices out of its time."""
    if max_delay is None:
        return alerts, notices, []
    width = F.lit(max_delay / parts)
    # a little longer than the delay, so that rounding leaves no trigger out; an alert that starts after it was taken may be
    # before its trigger
    first = F.floor((F.col("jd") - F.lit(max_delay + 1e-3)) / width)
    latest = F.greatest("jd", F.least(F.col("jdstarthist"), F.col("jd") + F.lit(max_delay)))
    spans = F.explode_outer(F.sequence(first, F.floor((latest + 1e-3) / width)))
    return alerts.withColumn("__span", spans), notices.withColumn("__span", F.floor(F.col("triggerTimejd") / width)), ["__span"]
