"""The cells that fill a gap of a map, against plain greedy tiling."""

import random

from pyspark.sql import functions as F

from skyherald.operators import skymap as sm


def tiled(a, b):
    """The fewest cells of [a, b): at each place the largest that is aligned and fits."""
    out = []
    while a < b:
        up = 0
        while up < 29 and a % 4 ** (up + 1) == 0 and a + 4 ** (up + 1) <= b:
            up += 1
        out.append(4 * 4 ** (29 - up) + a // 4**up)
        a += 4**up
    return sorted(out)


def test_ranges_of_all_levels(spark):
    rng, ranges = random.Random(3), [(0, 1), (0, sm.WHOLE), (1, sm.WHOLE), (0, sm.WHOLE - 1), (3, 5), (4**29, 2 * 4**29)]
    for _ in range(300):
        unit = 4 ** rng.randrange(30)
        a, b = sorted(rng.sample(range(sm.WHOLE // unit + 1), 2))
        ranges.append((a * unit, b * unit))
    ranges += [(x, x + rng.randrange(1, 100)) for x in (rng.randrange(sm.WHOLE - 100) for _ in range(100))]
    rows = spark.createDataFrame(ranges, "a long, b long").select("a", "b", sm._range_uniqs(F.col("a"), F.col("b")).alias("cells"))
    for r in rows.collect():
        assert sorted(r.cells) == tiled(r.a, r.b), (r.a, r.b)
