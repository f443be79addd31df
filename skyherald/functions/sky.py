"""Sky geometry as Column expressions: separations and HEALPix (Gorski et al. 2005), no Python per row.

RING functions take NSIDE as a Python int, so it is folded into the expression. NESTED functions take the
level as a Column, because the pixels of a multi-order map differ in level. Angles are degrees.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LEVEL = 29  # finest level whose UNIQ number fits a bigint
HALF_PI = math.pi / 2

# fixed values: ring and longitude offsets of the twelve base cells
BASE_RING = [2, 2, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4]
BASE_LONGITUDE = [1, 3, 5, 7, 0, 2, 4, 6, 1, 3, 5, 7]

EVEN_BITS = 0x5555555555555555


def let(body, **values: Column) -> Column:
    """`body(names)` with every value computed once per row.

    A Column is a tree: an intermediate value used k times is repeated k times in the plan, and nesting
    multiplies that. Binding it to a lambda variable keeps the tree linear.
    """
    bound = F.array(F.struct(*[v.alias(k) for k, v in values.items()]))
    return F.element_at(F.transform(bound, body), 1)


def known(value: Column, missing: float | int) -> Column:
    """A value that is never null.

    A join on a computed key adds "is not null" filters, rewritten onto the inputs of the computation with every
    intermediate value repeated. A key that cannot be null spares them; `missing` is a value that joins nothing.
    """
    return F.coalesce(value, F.lit(missing))


def unit_vector(ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    """Direction of a position; NaN, which is near nothing, for a missing one."""
    phi, theta = F.radians(ra), F.radians(dec)
    parts = F.cos(theta) * F.cos(phi), F.cos(theta) * F.sin(phi), F.sin(theta)
    return tuple(known(p, float("nan")) for p in parts)


def chord2(u: tuple, v: tuple) -> Column:
    """Squared distance of two unit vectors: as exact as haversine for small angles, without trigonometry."""
    dx, dy, dz = (a - b for a, b in zip(u, v))
    return dx * dx + dy * dy + dz * dz


def chord2_of(radius_deg: Column) -> Column:
    """Squared chord of an angle (angles above 180 degrees cover everything)."""
    half = F.sin(F.radians(F.least(radius_deg, F.lit(180.0))) / 2)
    return F.lit(4.0) * half * half


def separation_of(chord_squared: Column) -> Column:
    return F.degrees(2 * F.asin(F.least(F.lit(1.0), F.sqrt(chord_squared) / 2)))


def angular_separation(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle separation in degrees (haversine)."""
    s_dec = F.sin(F.radians(dec2 - dec1) / 2)
    s_ra = F.sin(F.radians(ra2 - ra1) / 2)
    h = s_dec * s_dec + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * s_ra * s_ra
    return F.degrees(2 * F.asin(F.least(F.lit(1.0), F.sqrt(h))))


def is_nside(nside: int) -> int:
    if nside < 1 or nside & (nside - 1):
        raise ValueError(f"NSIDE is a power of two, not {nside}")
    return nside


def max_pixrad(nside: int) -> float:
    """Largest centre-to-corner distance of a cell, in degrees."""
    za, pa = 2.0 / 3.0, math.pi / (4 * nside)
    zb = 1 - (1 - 1 / nside) ** 2 / 3
    ra, rb = math.sqrt(1 - za * za), math.sqrt(1 - zb * zb)
    va, vb = (ra * math.cos(pa), ra * math.sin(pa), za), (rb, 0.0, zb)
    return math.degrees(2 * math.asin(math.dist(va, vb) / 2))


# --- RING ----------------------------------------------------------------------------------------------------


def _ring_cell(nside: int, z: Column, cos_dec: Column, tt: Column) -> Column:
    """Cell of a point given by z, cos(dec) and tt = right ascension in quarter turns, 0 <= tt < 4."""
    n, npix = nside, 12 * nside * nside
    za = F.abs(z)
    a, b = n * (0.5 + tt), 0.75 * n * z
    jp, jm = F.floor(a - b), F.floor(a + b)
    ring = n + 1 + jp - jm
    ip = F.pmod(F.shiftright(jp + jm - n + 2 - ring.bitwiseAND(F.lit(1)), 1), F.lit(4 * n))
    belt = 2 * n * (n - 1) + (ring - 1) * (4 * n) + ip

    tp = tt - F.floor(tt)
    t = n * math.sqrt(3.0) * cos_dec / F.sqrt(1 + za)
    pole_ring = F.floor(tp * t) + F.floor((1 - tp) * t) + 1
    pole_ip = F.pmod(F.floor(tt * pole_ring), 4 * pole_ring)
    north = 2 * pole_ring * (pole_ring - 1) + pole_ip
    south = npix - 2 * pole_ring * (pole_ring + 1) + pole_ip
    cap = F.when(z > 0, north).otherwise(south)
    return F.when(za <= 2.0 / 3.0, belt).otherwise(cap).cast("bigint")


def ang2pix_ring(nside: int, ra: Column, dec: Column) -> Column:
    """(ra, dec) -> RING cell."""
    theta = F.radians(dec)
    return _ring_cell(is_nside(nside), F.sin(theta), F.cos(theta), F.pmod(ra / 90.0, F.lit(4.0)))


def with_ring_cells(df: DataFrame, ra: str, dec: str, nsides: list[int], prefix: str) -> DataFrame:
    """Add `<prefix><NSIDE>`, the RING cell on each grid, in steps that name every intermediate value.

    Same result as `ang2pix_ring`. As steps, the generated code computes each value once, shares the trigonometry
    among the grids, and stays small enough that the JVM compiles the join loop it becomes part of.
    """
    c, names = F.col, ("__z", "__tt", "__t", "__tp")
    theta = F.radians(c(dec))
    df = df.withColumns({"__z": F.sin(theta), "__tt": F.pmod(c(ra) / 90.0, F.lit(4.0))})
    df = df.withColumns(
        {"__t": math.sqrt(3.0) * F.cos(theta) / F.sqrt(1 + F.abs("__z")), "__tp": c("__tt") - F.floor("__tt")}
    )
    belt = F.abs("__z") <= 2.0 / 3.0
    lines = {}
    for n in map(is_nside, nsides):
        a, b, t = n * (0.5 + c("__tt")), 0.75 * n * c("__z"), n * c("__t")
        lines[f"__jp{n}"] = F.floor(F.when(belt, a - b).otherwise(c("__tp") * t))
        lines[f"__jm{n}"] = F.floor(F.when(belt, a + b).otherwise((1 - c("__tp")) * t))
    df = df.withColumns(lines)
    rings = {f"__r{n}": F.when(belt, n + 1 + c(f"__jp{n}") - c(f"__jm{n}")).otherwise(c(f"__jp{n}") + c(f"__jm{n}") + 1) for n in nsides}
    df = df.withColumns(rings)
    cells = {}
    for n in nsides:
        ring, turn = c(f"__r{n}"), c(f"__jp{n}") + c(f"__jm{n}") - n + 2
        ip = F.pmod(F.shiftright(turn - ring.bitwiseAND(F.lit(1)), 1), F.lit(4 * n))
        cap = F.pmod(F.floor(c("__tt") * ring), 4 * ring)
        cells[f"{prefix}{n}"] = (
            F.when(belt, 2 * n * (n - 1) + (ring - 1) * (4 * n) + ip)
            .when(c("__z") > 0, 2 * ring * (ring - 1) + cap)
            .otherwise(12 * n * n - 2 * ring * (ring + 1) + cap)
        )
    return df.withColumns(cells).drop(*names, *lines, *rings)


def _ring_above(nside: int, z: Column) -> Column:
    """Number of the last ring whose centres lie at or above z (0 above the first)."""
    n = nside
    return (
        F.when(F.abs(z) <= 2.0 / 3.0, F.floor(n * (2 - 1.5 * z)))
        .when(z > 0, F.floor(n * F.sqrt(3 * (1 - z))))
        .otherwise(4 * n - F.floor(n * F.sqrt(3 * (1 + z))) - 1)
        .cast("int")
    )


def _ring_shape(nside: int, ring: Column) -> tuple[Column, Column, Column]:
    """z of the centres, number of cells, and the half-cell shift of a ring."""
    n = nside
    i = F.least(ring, 4 * n - ring)
    polar = i < n
    z_polar = 1 - i * i / F.lit(3.0 * n * n)
    z = F.when(polar, F.when(ring < n, z_polar).otherwise(-z_polar)).otherwise((2 * n - ring) / F.lit(1.5 * n))
    length = F.when(polar, 4 * i).otherwise(F.lit(4 * n))
    shift = F.when(polar | (F.pmod(ring - n, F.lit(2)) == 0), F.lit(0.5)).otherwise(F.lit(0.0))
    return z, length, shift


def disc_cells(
    nside: int, ra: Column, dec: Column, radius_deg: Column, oversampling: int = 4, first_key: int = 0
) -> Column:
    """Array of the distinct RING cells whose area may overlap a circle (an inclusive disc query).

    Walks the rings of a grid `oversampling` times finer that the circle reaches, takes each ring's run of
    cells with their centre within radius + the fine grid's cell radius, and maps these to `nside`. The work
    is proportional to the circle; one notice never meets the cells of the rest of the sky. `first_key` is
    added to every cell.
    """
    fine = is_nside(nside) * oversampling
    reach = F.least(radius_deg + max_pixrad(fine), F.lit(180.0))

    def rings(d: Column) -> Column:
        first = F.greatest(_ring_above(fine, d["top"]), F.lit(1))
        last = F.least(_ring_above(fine, d["bottom"]) + 1, F.lit(4 * fine - 1))
        runs = F.transform(F.sequence(first, last), lambda ring: run(d, ring))
        cells = F.transform(F.filter(runs, lambda r: r["lo"] <= r["hi"]), run_cells)
        return F.array_distinct(F.flatten(cells))

    def run(d: Column, ring: Column) -> Column:
        z, length, shift = _ring_shape(fine, ring)
        return let(lambda s: width(d, s), z=z, length=length, shift=shift, c=F.sqrt(1 - z * z))

    def width(d: Column, s: Column) -> Column:
        # cosine of the half width of the circle on this ring; a circle around a pole holds whole rings
        over = d["cos_reach"] - s["z"] * d["z"]
        cut = F.when(d["c"] * s["c"] < 1e-12, F.signum(over) * 2).otherwise(over / (d["c"] * s["c"]))
        half = F.acos(F.least(F.greatest(cut, F.lit(-1.0)), F.lit(1.0)))
        per_cell = s["length"] / (2 * math.pi)
        return let(
            lambda h: cell_run(d, s, h), none=cut >= 1, whole=cut <= -1,
            mid=d["phi"] * per_cell - s["shift"], half=half * per_cell,
        )

    def cell_run(d: Column, s: Column, h: Column) -> Column:
        lo = F.when(h["whole"], F.lit(0)).otherwise(F.ceil(h["mid"] - h["half"]))
        hi = F.when(h["none"], lo - 1).when(h["whole"], s["length"] - 1).otherwise(F.floor(h["mid"] + h["half"]))
        # all cells of a ring share what depends on z
        return F.struct(
            lo.cast("bigint").alias("lo"), hi.cast("bigint").alias("hi"),
            s["shift"].alias("shift"), (4.0 / s["length"]).alias("step"),
            (F.abs(s["z"]) <= 2.0 / 3.0).alias("belt"), (s["z"] > 0).alias("north"),
            (0.75 * nside * s["z"]).alias("b"),
            (nside * math.sqrt(3.0) * s["c"] / F.sqrt(1 + F.abs(s["z"]))).alias("t"),
        )

    def run_cells(r: Column) -> Column:
        return F.transform(
            F.sequence(r["lo"], r["hi"]),
            lambda k: let(lambda q: cell(r, q), tt=F.pmod((k + r["shift"]) * r["step"], F.lit(4.0))),
        )

    def cell(r: Column, q: Column) -> Column:
        a, tp = nside * (0.5 + q["tt"]), q["tt"] - F.floor(q["tt"])
        belt = let(_belt_cell, jp=F.floor(a - r["b"]), jm=F.floor(a + r["b"]))
        cap = let(
            lambda s: _cap_cell(s, r["north"]), tt=q["tt"],
            ring=F.floor(tp * r["t"]) + F.floor((1 - tp) * r["t"]) + 1,
        )
        return F.when(r["belt"], belt).otherwise(cap)

    def _belt_cell(s: Column) -> Column:
        ring = nside + 1 + s["jp"] - s["jm"]
        ip = F.pmod(F.shiftright(s["jp"] + s["jm"] - nside + 2 - ring.bitwiseAND(F.lit(1)), 1), F.lit(4 * nside))
        return (ring - 1) * (4 * nside) + ip + (first_key + 2 * nside * (nside - 1))

    def _cap_cell(s: Column, north: Column) -> Column:
        ip = F.pmod(F.floor(s["tt"] * s["ring"]), 4 * s["ring"])
        far = first_key + 12 * nside * nside
        return ip + F.when(north, 2 * s["ring"] * (s["ring"] - 1) + first_key).otherwise(
            far - 2 * s["ring"] * (s["ring"] + 1)
        )

    theta = F.radians(dec)
    return let(
        rings, z=F.sin(theta), c=F.cos(theta), phi=F.radians(F.pmod(ra, F.lit(360.0))),
        cos_reach=F.cos(F.radians(reach)),
        top=F.sin(F.radians(F.least(dec + reach, F.lit(90.0)))),
        bottom=F.sin(F.radians(F.greatest(dec - reach, F.lit(-90.0)))),
    )


def disc_cell_bound(nside: int, radius_deg: Column, oversampling: int = 4) -> Column:
    """Upper bound of the length of `disc_cells`: the equal-area cells that fit the widened circle."""
    reach = radius_deg + max_pixrad(nside * oversampling) + 2 * max_pixrad(nside)
    share = (1 - F.cos(F.radians(F.least(reach, F.lit(180.0))))) / 2
    return F.ceil(share * (12 * nside * nside)).cast("bigint")


# --- NESTED and UNIQ -------------------------------------------------------------------------------------------


def _spread_bits(x: Column) -> Column:
    """Insert a zero before every bit: the binary digits of x read as base-4 digits."""
    return F.conv(F.bin(x), 4, 10).cast("bigint")


def _gather_bits(x: Column) -> Column:
    """The even bits of x, pushed together: the inverse of `_spread_bits`."""
    even = x.bitwiseAND(F.lit(EVEN_BITS)).cast("string")
    return F.conv(F.conv(even, 10, 4), 2, 10).cast("bigint")


def power4(level: Column) -> Column:
    return _shift_left(F.lit(1).cast("bigint"), 2 * level)


def _shift_left(x: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", x, bits.cast("int"))


def _shift_right(x: Column, bits: Column) -> Column:
    return F.call_function("shiftright", x, bits.cast("int"))


def ang2pix_nest(level: int, ra: Column, dec: Column) -> Column:
    """(ra, dec) -> NESTED cell at a fixed level."""
    n, mask = 1 << level, F.lit((1 << level) - 1)

    def corner_lines(p: Column) -> Column:
        a, b = n * (0.5 + p["tt"]), 0.75 * n * p["z"]
        quarter = F.least(F.floor(p["tt"]), F.lit(3).cast("bigint"))
        tp, t = p["tt"] - quarter, n * math.sqrt(3.0) * p["c"] / F.sqrt(1 + F.abs(p["z"]))
        belt = F.abs(p["z"]) <= 2.0 / 3.0
        return let(
            face_xy,
            jp=F.when(belt, F.floor(a - b)).otherwise(F.least(F.floor(tp * t), mask)),
            jm=F.when(belt, F.floor(a + b)).otherwise(F.least(F.floor((1 - tp) * t), mask)),
            quarter=quarter, belt=belt, north=p["z"] >= 0,
        )

    def face_xy(j: Column) -> Column:
        fp, fm = F.shiftright(j["jp"], level), F.shiftright(j["jm"], level)
        belt_face = F.when(fp == fm, fp.bitwiseOR(F.lit(4))).when(fp < fm, fp).otherwise(fm + 8)
        face = F.when(j["belt"], belt_face).when(j["north"], j["quarter"]).otherwise(j["quarter"] + 8)
        x = F.when(j["belt"], j["jm"].bitwiseAND(mask)).when(j["north"], n - j["jm"] - 1).otherwise(j["jp"])
        y = F.when(j["belt"], n - j["jp"].bitwiseAND(mask) - 1).when(j["north"], n - j["jp"] - 1).otherwise(j["jm"])
        return F.shiftleft(face.cast("bigint"), 2 * level) + _spread_bits(x) + F.shiftleft(_spread_bits(y), 1)

    theta = F.radians(dec)
    return let(corner_lines, z=F.sin(theta), c=F.cos(theta), tt=F.pmod(ra / 90.0, F.lit(4.0)))


def with_nest_index(df: DataFrame, ra: str, dec: str, name: str) -> DataFrame:
    """Add the NESTED cell at `MAX_LEVEL`, in steps that name every intermediate value.

    Same result as `ang2pix_nest`. As steps on columns, with masks and shifts, it stays inside the generated code.
    """
    c, level, n = F.col, MAX_LEVEL, 1 << MAX_LEVEL
    mask = F.lit(n - 1)
    theta = F.radians(c(dec))
    df = df.withColumns({"__z": F.sin(theta), "__c": F.cos(theta), "__tt": F.pmod(c(ra) / 90.0, F.lit(4.0))})
    df = df.withColumns({
        "__belt": F.abs("__z") <= 2.0 / 3.0, "__quarter": F.least(F.floor("__tt"), F.lit(3).cast("bigint")),
        "__t": n * math.sqrt(3.0) * c("__c") / F.sqrt(1 + F.abs("__z")), "__a": n * (0.5 + c("__tt")), "__b": 0.75 * n * c("__z"),
    })
    df = df.withColumn("__tp", c("__tt") - c("__quarter"))
    df = df.withColumns({
        "__jp": F.when(c("__belt"), F.floor(c("__a") - c("__b"))).otherwise(F.least(F.floor(c("__tp") * c("__t")), mask)),
        "__jm": F.when(c("__belt"), F.floor(c("__a") + c("__b"))).otherwise(F.least(F.floor((1 - c("__tp")) * c("__t")), mask)),
    })
    df = df.withColumns({"__fp": F.shiftright("__jp", level), "__fm": F.shiftright("__jm", level)})
    belt_face = (
        F.when(c("__fp") == c("__fm"), c("__fp").bitwiseOR(F.lit(4))).when(c("__fp") < c("__fm"), c("__fp")).otherwise(c("__fm") + 8)
    )
    north = c("__z") >= 0
    df = df.withColumns({
        "__face": F.when(c("__belt"), belt_face).when(north, c("__quarter")).otherwise(c("__quarter") + 8).cast("bigint"),
        "__x": F.when(c("__belt"), c("__jm").bitwiseAND(mask)).when(north, n - c("__jm") - 1).otherwise(c("__jp")).cast("bigint"),
        "__y": F.when(c("__belt"), n - c("__jp").bitwiseAND(mask) - 1).when(north, n - c("__jp") - 1).otherwise(c("__jm")).cast("bigint"),
    })
    for shift, kept in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, EVEN_BITS)):
        df = df.withColumns({v: c(v).bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(kept)) for v in ("__x", "__y")})
    index = F.shiftleft("__face", 2 * level) + c("__x") + F.shiftleft("__y", 1)
    working = ("z", "c", "tt", "belt", "quarter", "t", "a", "b", "tp", "jp", "jm", "fp", "fm", "face", "x", "y")
    return df.withColumn(name, index).drop(*[f"__{w}" for w in working])


def uniq_level(uniq: Column) -> Column:
    """Level of a UNIQ number, from its count of binary digits (no logarithm, so no rounding)."""
    return (F.floor((F.length(F.bin(uniq)) - 1) / 2) - 1).cast("int")


def uniq_ipix(uniq: Column) -> Column:
    return uniq - 4 * power4(uniq_level(uniq))


def uniq_at(level: Column, index: Column) -> Column:
    """UNIQ of the cell at `level` that holds the level-29 cell `index`."""
    return 4 * power4(level) + _shift_right(index, 2 * (F.lit(MAX_LEVEL) - level))


def first_index(uniq: Column) -> Column:
    """First level-29 cell inside a UNIQ cell."""
    return _shift_left(uniq_ipix(uniq), 2 * (F.lit(MAX_LEVEL) - uniq_level(uniq)))


def pixel_area_sr(level: Column) -> Column:
    return F.lit(4 * math.pi / 12) / power4(level).cast("double")


def sr_to_arcmin2(area_sr: Column) -> Column:
    return area_sr * F.lit((180 / math.pi * 60) ** 2)


def per_sr_to_per_deg2(density: Column) -> Column:
    return density * F.lit((math.pi / 180) ** 2)


def _nest_center(level: Column, ipix: Column, then) -> Column:
    """Apply `then` to struct(z, tt) of the centre of a NESTED cell; tt is the longitude in quarter turns."""

    def place(s: Column) -> Column:
        rings = F.element_at(F.array(*[F.lit(v) for v in BASE_RING]), s["face"])
        lons = F.element_at(F.array(*[F.lit(v) for v in BASE_LONGITUDE]), s["face"])
        return let(
            along_ring, ring=rings * s["side"] - s["x"] - s["y"] - 1, side=s["side"], lon=lons, skew=s["x"] - s["y"]
        )

    def along_ring(s: Column) -> Column:
        north, south = s["ring"] < s["side"], s["ring"] > 3 * s["side"]
        length = F.when(north, s["ring"]).when(south, 4 * s["side"] - s["ring"]).otherwise(s["side"])
        shift = F.when(north | south, F.lit(0).cast("bigint")).otherwise(F.pmod(s["ring"] - s["side"], F.lit(2)))
        return let(
            z_and_tt, ring=s["ring"], side=s["side"].cast("double"), lon=s["lon"], skew=s["skew"],
            north=north, south=south, length=length, shift=shift,
        )

    def z_and_tt(s: Column) -> Column:
        cap = s["length"] * s["length"].cast("double") / (3 * s["side"] * s["side"])
        z = (
            F.when(s["north"], 1 - cap).when(s["south"], cap - 1)
            .otherwise((2 * s["side"] - s["ring"]) * 2 / (3 * s["side"]))
        )
        # the sum below is even; cells of a ring are counted from 1
        column = F.shiftright(s["lon"] * s["length"] + s["skew"] + 1 + s["shift"], 1)
        tt = F.pmod((column - (s["shift"] + 1) * 0.5) / s["length"], F.lit(4.0))
        return let(then, z=z, tt=tt)

    inner = ipix.bitwiseAND(power4(level) - 1)
    return let(
        place, side=_shift_left(F.lit(1).cast("bigint"), level), face=_shift_right(ipix, 2 * level).cast("int") + 1,
        x=_gather_bits(inner), y=_gather_bits(F.shiftright(inner, 1)),
    )


def nest_ra_dec(level: Column, ipix: Column) -> Column:
    """struct(ra, dec) of the centre of a NESTED cell."""
    return _nest_center(
        level, ipix,
        lambda s: F.struct((s["tt"] * 90.0).alias("ra"), F.degrees(F.asin(s["z"])).alias("dec")),
    )


def nest_to_ring(nside: int, level: Column, ipix: Column) -> Column:
    """RING cell at `nside` that holds the centre of a NESTED cell of any level."""
    is_nside(nside)
    return _nest_center(
        level, ipix, lambda s: _ring_cell(nside, s["z"], F.sqrt(1 - s["z"] * s["z"]), s["tt"])
    )
