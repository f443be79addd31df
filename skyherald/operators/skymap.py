"""Multi-order sky maps: one child row per (notice version, pixel), and what is computed from these rows.

Tables here have key columns (by default triggerId, gcn_status), `row_idx`, `uniq` and `probdensity` (per sr).
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyherald.functions import sky
from skyherald.operators.regions import with_trigger_spans
from skyherald.plans.sizing import ROWS_PER_TASK, running, skew_join
from skyherald.session import written
from skyherald.sources import fits

KEY = ("triggerId", "gcn_status")

_DECODED = T.StructType([
    T.StructField("uniq", T.ArrayType(T.LongType())), T.StructField("probdensity", T.ArrayType(T.DoubleType())),
    T.StructField("ra", T.DoubleType()), T.StructField("dec", T.DoubleType()), T.StructField("area_arcmin2", T.DoubleType()),
])


def _levels(uniq: np.ndarray) -> np.ndarray:
    """Level of each UNIQ number, by comparing with the first number of each level."""
    return np.searchsorted(4 << (2 * np.arange(sky.MAX_LEVEL + 1, dtype=np.int64)), uniq, side="right") - 1


def _centre(uniq: int) -> tuple[float, float]:
    """(ra, dec) of a UNIQ cell's centre."""
    level = (uniq.bit_length() - 1) // 2 - 1
    face, inner = divmod(uniq - (4 << 2 * level), 1 << 2 * level)
    side = 1 << level
    x = sum((inner >> 2 * b & 1) << b for b in range(level))
    y = sum((inner >> (2 * b + 1) & 1) << b for b in range(level))
    ring = sky.BASE_RING[face] * side - x - y - 1
    polar = min(ring, 4 * side - ring)
    if polar < side:
        length, shift, cap = polar, 0, polar * float(polar) / (3 * side * side)
        z = 1 - cap if ring < side else cap - 1
    else:
        length, shift, z = side, (ring - side) % 2, (2 * side - ring) * 2 / (3 * side)
    column = (sky.BASE_LONGITUDE[face] * length + x - y + 1 + shift) >> 1
    quarter_turns = ((column - (shift + 1) * 0.5) / length) % 4.0
    return quarter_turns * 90.0, math.degrees(math.asin(z))


def summarise(uniq: np.ndarray, density: np.ndarray, prob: float = 0.9) -> tuple[float, float, float]:
    """(ra, dec, area in square arcmin) of a map: its densest pixel, the first on ties, and its credible area."""
    order = np.argsort(-density, kind="stable")
    area = 4 * math.pi / 12 / np.exp2(2.0 * _levels(uniq[order]))
    inside = np.cumsum(area * density[order]) < prob
    return *_centre(int(uniq[order[0]])), float(np.cumsum(area * inside)[-1] * (180 / math.pi * 60) ** 2)


@F.pandas_udf(_DECODED)
def decode_skymap(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """base64 FITS text -> struct of arrays, peak and credible area; null for a missing, damaged or empty map."""

    seen: dict = {}

    def decode(text):
        if text is None:
            return None, None, None, None, None
        try:
            data = base64.b64decode(text)
            if data[:2] == b"\x1f\x8b":
                data = zlib.decompress(data, wbits=31)
            t = fits.read_table(data, ["UNIQ", "PROBDENSITY"], seen)
            uniq, density = t["UNIQ"].astype("int64"), t["PROBDENSITY"].astype("float64")
            if not len(uniq) or uniq.min() < 4 or not np.isfinite(density).all():
                raise ValueError("not a sky map")
        except (ValueError, KeyError, TypeError, IndexError, EOFError, zlib.error):
            return None, None, None, None, None
        return uniq, density, *summarise(uniq, density)

    for batch in texts:
        yield pd.DataFrame([decode(t) for t in batch], columns=_DECODED.names)


def skymap_explode(notices: DataFrame, skymap: str = "skymap", key=KEY) -> DataFrame:
    """Notices with a base64 sky map -> pixel rows, each map decoded once."""
    maps = notices.select(*key, decode_skymap(skymap).alias("m"))
    zipped = F.arrays_zip(F.col("m.uniq").alias("uniq"), F.col("m.probdensity").alias("probdensity"))
    # outer: the inner form would add a filter on the array, which decodes every map a second time
    return (
        maps.select(*key, F.posexplode_outer(zipped).alias("row_idx", "p"))
        .select(*key, "row_idx", F.col("p.uniq").alias("uniq"), F.col("p.probdensity").alias("probdensity"))
        .filter(F.col("row_idx").isNotNull())
    )


def uniq_decode(pixels: DataFrame) -> DataFrame:
    """Add level, ipix (NESTED) and the pixel area in sr."""
    return pixels.withColumn("level", sky.uniq_level(F.col("uniq"))).withColumns(
        {"ipix": F.col("uniq") - 4 * sky.power4(F.col("level")), "area_sr": sky.pixel_area_sr(F.col("level"))}
    )


def own_pixels(pixels: DataFrame) -> DataFrame:
    """The pixels that maps came with, without what `complete_skymap` filled in."""
    return pixels.filter(~F.col("is_filler")).drop("is_filler") if "is_filler" in pixels.columns else pixels


def credible_region(pixels: DataFrame, prob: float = 0.9, key=KEY) -> DataFrame:
    """Pixels, densest first, before the one that makes the cumulative probability reach `prob`. Fillers don't count."""
    ranked = uniq_decode(own_pixels(pixels)).withColumn("__neg", -F.col("probdensity"))
    share = F.col("area_sr") * F.col("probdensity")
    return (
        running(ranked, list(key), ["__neg", "row_idx"], share, "cumprob")
        .filter(F.col("cumprob") < prob)
        .drop("__neg")
    )


def credible_area(region: DataFrame, key=KEY) -> DataFrame:
    """Area of a credible region in square arcmin."""
    return region.groupBy(*key).agg(sky.sr_to_arcmin2(F.sum("area_sr")).alias("area_arcmin2"))


def skymap_peak(pixels: DataFrame, key=KEY) -> DataFrame:
    """Centre of each map's densest pixel, the first row on ties."""
    best = own_pixels(pixels).groupBy(*key).agg(
        F.min(F.struct((-F.col("probdensity")).alias("neg"), "row_idx", "uniq")).alias("best")
    )
    uniq = F.col("best.uniq")
    return best.select(*key, sky.nest_ra_dec(sky.uniq_level(uniq), sky.uniq_ipix(uniq)).alias("pos")).select(
        *key, F.col("pos.ra").alias("ra"), F.col("pos.dec").alias("dec")
    )


def skymap_cells(region: DataFrame, nside: int, key=KEY, fill: bool = False) -> DataFrame:
    """Distinct RING cells at `nside` of a region's pixel centres.

    A pixel coarser than the grid gives only its centre's cell, unless `fill` asks for all it covers.
    """
    p = uniq_decode(region).select(*key, "level", "ipix")
    if fill:
        grid = F.lit(nside.bit_length() - 1)
        steps = F.greatest(grid - F.col("level"), F.lit(0))
        below = sky.power4(steps)
        p = p.select(
            *key, (F.col("level") + steps).alias("level"),
            F.explode_outer(F.sequence(F.col("ipix") * below, (F.col("ipix") + 1) * below - 1)).alias("ipix"),
        )
    return p.select(*key, sky.nest_to_ring(nside, F.col("level"), F.col("ipix")).alias("hpix")).distinct()


def complete_skymap(pixels: DataFrame, key=KEY) -> DataFrame:
    """Fill the gaps of partial maps: a gap takes the density of the pixel before it, in level-29 order, and
    the part before the first pixel that of the last one.

    That is what a search for "the last pixel starting at or before a position" returns, so afterwards a join on the
    pixels' ranges finds the same density. A window group is one map, which arrived
    as one message. `is_filler` marks what was filled in: it has no probability of its own.
    """
    order = Window.partitionBy(*key).orderBy("start")
    everywhere = Window.partitionBy(*key)
    p = (
        uniq_decode(pixels)
        .withColumn("start", sky.first_index(F.col("uniq")))
        .withColumn("end", F.col("start") + sky.power4(F.lit(sky.MAX_LEVEL) - F.col("level")))
        .withColumn("next", F.coalesce(F.lead("start").over(order), F.lit(WHOLE)))
        .withColumn("__first", F.min("start").over(everywhere))
    )
    last = F.col("next") == WHOLE
    gaps = p.select(
        *key, "row_idx", "probdensity",
        F.inline(
            F.array_compact(
                F.array(
                    F.when(F.col("end") < F.col("next"), F.struct(F.col("end").alias("a"), F.col("next").alias("b"))),
                    F.when(last & (F.col("__first") > 0), F.struct(F.lit(0).alias("a"), F.col("__first").alias("b"))),
                )
            )
        ),
    )
    filled = gaps.select(
        *key, "row_idx", F.explode(_range_uniqs(F.col("a"), F.col("b"))).alias("uniq"), "probdensity",
        F.lit(True).alias("is_filler"),
    )
    own = pixels.select(*key, "row_idx", "uniq", "probdensity", F.lit(False).alias("is_filler"))
    return own.unionByName(filled)


def _range_uniqs(a: Column, b: Column) -> Column:
    """The fewest UNIQ cells that tile the level-29 range [a, b)."""

    def exact(level: Column) -> Column:
        shift = (2 * (F.lit(sky.MAX_LEVEL) - level)).cast("int")
        one = sky.power4(F.lit(sky.MAX_LEVEL) - level)
        return F.struct(
            F.call_function("shiftright", a + one - 1, shift).alias("lo"),
            F.call_function("shiftright", b, shift).alias("hi"),
        )

    def cells(level: Column) -> Column:
        def pick(s: Column) -> Column:
            here, up = s["here"], s["up"]
            covered = (level > 0) & (up["lo"] < up["hi"])
            left = _span(here["lo"], F.when(covered, 4 * up["lo"]).otherwise(here["hi"]))
            right = F.when(covered, _span(4 * up["hi"], here["hi"])).otherwise(F.array().cast("array<bigint>"))
            return F.transform(F.concat(left, right), lambda i: i + 4 * sky.power4(level))

        return sky.let(pick, here=exact(level), up=exact(F.greatest(level - 1, F.lit(0))))

    # cells of coarser levels are longer than the range, and a cut at finer levels than both ends are on adds none
    size, ends = b - a, a.bitwiseOR(b)
    coarsest = F.greatest(F.lit(sky.MAX_LEVEL) - F.floor((F.length(F.bin(size)) - 1) / 2), F.lit(0)).cast("int")
    zeros = F.bit_count(ends.bitwiseAND(-ends) - 1)
    finest = F.greatest(F.lit(sky.MAX_LEVEL) - F.floor(zeros / 2), F.lit(0)).cast("int")
    return F.flatten(F.transform(F.sequence(coarsest, F.greatest(coarsest, finest)), cells))


def _span(lo: Column, hi: Column) -> Column:
    """[lo, hi) as an array."""
    return F.when(lo < hi, F.sequence(lo, hi - 1)).otherwise(F.array().cast("array<bigint>"))


WHOLE = 12 * (1 << (2 * sky.MAX_LEVEL))
# the interval join's buckets are cells of this level on a stream; in batch the level is chosen from the pixels
BUCKET_LEVEL = 3


def skymap_density_at(
    points: DataFrame, pixels: DataFrame, key=KEY, ra: str = "ra", dec: str = "dec", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Add `density` (per square degree) of each point in the map of its own notice: that of the last pixel that starts at
    or before the point, in level-29 order, and of the map's last pixel before its first one. Maps may have gaps.

    An as-of join as one merge: points and pixel starts are put into one order per map, and the last density is carried
    along. No point or pixel is repeated; a map with very many points is cut into slices (`running`). Points of a notice
    without a map are left out.
    """
    point = F.struct(*[F.col(f"`{c}`") for c in points.columns if c not in key]).alias("__point")
    indexed = sky.with_nest_index(points.select(*key, point, F.col(f"`{ra}`").alias("__ra"), F.col(f"`{dec}`").alias("__dec")), "__ra", "__dec", "__at")
    asked = indexed.select(
        *key, "__at", F.monotonically_increasing_id().alias("__tie"), "__point", F.lit(None).cast("double").alias("probdensity")
    )
    starts = pixels.select(*key, sky.first_index(F.col("uniq")).alias("__at"), "probdensity")
    merged = asked.unionByName(starts.withColumn("__tie", F.lit(-1).cast("long")), allowMissingColumns=True)
    found = running(merged, list(key), ["__at", "__tie"], F.col("probdensity"), "__density", "last", rows_per_task)
    found = found.filter(F.col("__point").isNotNull() & F.col("__density").isNotNull())
    inner = [F.col("__point").getField(c).alias(c) for c in points.columns if c not in key]
    return found.select(*key, *inner, sky.per_sr_to_per_deg2(F.col("__density")).alias("density")).select(*points.columns, "density")


def with_index_range(pixels: DataFrame) -> DataFrame:
    """The level-29 cells of a pixel, [start, end)."""
    size = sky.power4(F.lit(sky.MAX_LEVEL) - sky.uniq_level(F.col("uniq")))
    return pixels.withColumn("start", sky.first_index(F.col("uniq"))).withColumn("end", F.col("start") + size)


def in_buckets(ranges: DataFrame, level: int) -> DataFrame:
    """One row per range [start, end) and bucket it meets: the cells of a level, whatever the range's own is."""
    shift = 2 * (sky.MAX_LEVEL - level)
    return ranges.withColumn("bucket", F.explode_outer(F.sequence(F.shiftright("start", shift), F.shiftright(F.col("end") - 1, shift))))


def bucket_of(index: str, level: int) -> Column:
    """The bucket of a level-29 index; a point has one."""
    return sky.known(F.shiftright(index, 2 * (sky.MAX_LEVEL - level)), -1)


def bucket_level(pixels: DataFrame, grid: int) -> tuple[int, int]:
    """(level of the buckets, rows that the pixels make in them), from one count per pixel level.

    Buckets are as fine as they can be while listing the coarser pixels in all of theirs doubles the rows at most.
    """
    rows = pixels.groupBy(sky.uniq_level(F.col("uniq")).alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {}
    for r in rows:  # at most 30
        counts[max(r["level"], grid)] = counts.get(max(r["level"], grid), 0) + r["n"] * 4 ** max(grid - r["level"], 0)
    listed = lambda at: sum(n * 4 ** max(at - level, 0) for level, n in counts.items())
    level = max(v for v in range(grid, sky.MAX_LEVEL + 1) if v == grid or listed(v) <= 2 * listed(grid))
    return level, listed(level)


def skymap_match(
    alerts: DataFrame, pixels: DataFrame, cells: DataFrame, notices: DataFrame, nside: int, key=KEY,
    max_delay: float | None = None,
) -> DataFrame:
    """Pairs of alerts and map notices that share a cell of the credible region, with the map's density.

    One interval join does both: every map pixel is brought to the grid level or finer, kept where its cell is in
    the region, and listed in the buckets it meets; an alert is in one bucket, whatever levels the maps have, and inside one
    pixel of a map at most. `notices` carries the columns a pair needs; pairs before the trigger are dropped.

    The regions' pixels are written once: their levels fix the buckets, so that the many coarse pixels outside of the regions
    do not make these wider, and their number is known before the join.
    """
    region = written(region_pixels(pixels, cells, nside, key), "region")
    level, rows = bucket_level(region, nside.bit_length() - 1)
    side = in_buckets(with_index_range(region).drop("uniq").join(notices, list(key)), level)
    placed = sky.with_nest_index(alerts, "ztf_ra", "ztf_dec", "__at").withColumn("bucket", bucket_of("__at", level))
    after = F.col("jdstarthist") > F.col("triggerTimejd")
    placed, side, span = with_trigger_spans(placed, side, max_delay)
    if max_delay is not None:
        after = after & (F.col("jd") <= F.col("triggerTimejd") + F.lit(max_delay))
    inside = (F.col("__at") >= F.col("start")) & (F.col("__at") < F.col("end"))
    pairs = skew_join(placed, side, ["bucket", *span], small_rows=rows, condition=inside & after)
    return pairs.drop("bucket", "__at", "start", "end", *span)


def region_pixels(pixels: DataFrame, cells: DataFrame, nside: int, key=KEY) -> DataFrame:
    """(key, uniq, density per square degree): a complete map's pixels inside the region's cells, at the grid or finer."""
    grid = nside.bit_length() - 1
    fine = uniq_decode(pixels).select(
        *key, "probdensity", F.greatest("level", F.lit(grid)).alias("level"),
        F.explode_outer(
            sky.let(
                lambda s: F.sequence(s["ipix"] * s["k"], (s["ipix"] + 1) * s["k"] - 1),
                ipix=F.col("ipix"), k=sky.power4(F.greatest(F.lit(grid) - F.col("level"), F.lit(0))),
            )
        ).alias("ipix"),
    )
    above = (2 * (F.col("level") - grid)).cast("int")
    fine = fine.select(
        *key, "probdensity", (4 * sky.power4(F.col("level")) + F.col("ipix")).alias("uniq"),
        F.call_function("shiftright", F.col("ipix"), above).alias("grid_ipix"),
    )
    # NESTED numbers of the grid's RING cells: a fixed table of 12 NSIDE^2 rows
    names = pixels.sparkSession.range(12 * nside * nside).select(
        F.col("id").alias("grid_ipix"), sky.nest_to_ring(nside, F.lit(grid), F.col("id")).alias("hpix")
    )
    nested = cells.join(F.broadcast(names), "hpix").drop("hpix")
    inside = fine.join(nested, [*key, "grid_ipix"], "left_semi")
    return inside.select(*key, "uniq", sky.per_sr_to_per_deg2(F.col("probdensity")).alias("density"))
