"""Connected components by alternating large and small stars, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyherald.llm.common import stored

# beyond so many edges a node's may be too many for a task: minima are written before the join, so that a join of plain
# exchanges lets adaptive execution split a node. Below, all edges fit one task.
SPLIT_ROWS = 1_000_000


def _with_least(edges: DataFrame, split: bool) -> DataFrame:
    """Edges (u, v) with m, the least v of each u: a pre-aggregated minimum joined back."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(stored(least, "least") if split else least, "u")


def _large_star(edges: DataFrame, split: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    starred = _with_least(both, split).withColumn("m", F.least("m", "u"))
    return starred.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, split: bool) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _with_least(down, split)
    others = starred.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(starred.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (u, v; longs without nulls) but the roots: root is the least node reached.

    Each round's edges are written to the shared folder. The rounds end when stars remain, after about log(nodes).
    """
    now = stored(edges.filter("u <> v").select("u", "v").distinct(), "links")
    state = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state or not seen[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(seen)
        split = seen[0] > SPLIT_ROWS
        now = stored(_small_star(_large_star(now, split), split), "links")
