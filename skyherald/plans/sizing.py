"""Decisions that need a size: broadcast or shuffle, ordered slices of hot groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyherald.session import written

# a side is broadcast only when its row count, and its rows times their width, are proven to stay below these
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 256 << 20
# an ordered group with more rows than this is not given to a single task
ROWS_PER_TASK = 2_000_000
# source rows that a task is given where each becomes a packet or a whole sky map
SPREAD_ROWS = 50_000


def spread(df: DataFrame, rows_per_task: int = SPREAD_ROWS) -> DataFrame:
    """Round-robin a table of small files or compact rows, so that every core has a task and no task more than about
    `rows_per_task` rows, however many the table has; a table whose files give as many tasks stays as it is.

    The rows are counted from the files' footers.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_per_task))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def computed_once(df: DataFrame, *columns: str) -> DataFrame:
    """Pass columns through a one-element explode, which later filters are not pushed below.

    A filter on a computed value is otherwise rewritten onto the inputs of the computation: after a parse, it would
    parse every message again, once per use of the parse in the condition.
    """
    rest = [c for c in df.columns if c not in columns]
    once = df.select(*rest, F.explode(F.array(F.struct(*columns))).alias("__once"))
    return once.select(*rest, "__once.*")


def row_bytes(df: DataFrame) -> Column:
    """A row's size: texts as long as they are, every other column as a few numbers."""
    widths = [
        F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) + 16 if f.dataType.typeName() in ("string", "binary") else F.lit(32)
        for f in df.schema
    ]
    return sum(widths, F.lit(16)).cast("bigint")


def total(df: DataFrame, rows: Column) -> int:
    """Sum of a per-row bound over a table: one aggregate, one number to the driver."""
    return df.agg(F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("n")).first()["n"]


def even_keys(rows: int, most: int, parts: int) -> bool:
    """Whether no key has so many of the rows, `most`, that what is made of them would keep a task busy while the others are done."""
    return most * parts <= max(rows, ROWS_PER_TASK // 100)


def dealt_evenly(df: DataFrame, key: str) -> tuple[DataFrame, bool]:
    """Rows dealt by a key, and True, unless a key has too large a share of them: then as they are, and False. One aggregate; the
    number of partitions is given, so that adaptive execution does not put few bytes into few tasks."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    even = even_keys(counts[0] or 0, counts[1] or 0, parts)
    return (df.repartition(parts, key) if even else df), even


def skew_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    small_rows: int | None = None,
    condition: Column | None = None,
    how: str = "inner",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Equi join of a big table with a smaller one that survives a key holding a large share of `big`.

    `small_rows` is a proven bound of the smaller side: below `broadcast_rows` it is broadcast and `big` is
    not shuffled at all. Beyond it both sides are shuffled by plain exchanges, of which adaptive execution cuts the
    partitions that turn out to be skewed (`spark.sql.adaptive.skewJoin`, see `SETTINGS`): a hot key's rows of `big` go to
    several tasks, and only its rows of `small` are repeated. Nothing is counted beforehand, so `big` is computed once.
    """
    on_condition, renamed = condition, small
    if condition is not None:
        for k in on:
            renamed = renamed.withColumnRenamed(k, f"__{k}")
            on_condition = on_condition & (F.col(k) == F.col(f"__{k}"))
    if small_rows is not None and small_rows <= broadcast_rows:
        renamed = F.broadcast(renamed)
    if condition is None:
        return big.join(renamed, on, how)
    return big.join(renamed, on_condition, how).drop(*[f"__{k}" for k in on])


def running(
    df: DataFrame, group: list[str], order: list[str], value: Column, name: str, kind: str = "sum",
    rows_per_task: int = ROWS_PER_TASK, slices: int | None = None,
) -> DataFrame:
    """`value` accumulated over each group in the order of `order`, current row included, for groups of any size: its
    sum, or (`kind="last"`) its last value that is not null; in a circle, so that rows before the first value get the
    group's last one.

    A window hands a whole group to one task, which is right for groups of up to `rows_per_task` rows. A first,
    pre-aggregated count finds the larger ones; only these go through `_scanned`. The columns of `order` have no nulls and
    are unique in a group.
    """
    df = df.withColumn("__m", value)
    large = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows_per_task)
    # at most rows / rows_per_task groups
    rows = large.agg(F.sum("n")).first()[0]
    if rows is None:
        return _accumulated(df, group, order, name, kind).drop("__m")
    # so many that a slice is about half of what a task holds
    slices = max(8, -(-2 * rows // rows_per_task)) if slices is None else slices
    large = F.broadcast(large.select(*group))
    small = _accumulated(df.join(large, group, "left_anti"), group, order, name, kind).drop("__m")
    return small.unionByName(_scanned(df.join(large, group, "left_semi"), group, order, name, kind, slices))


def _accumulated(df: DataFrame, group: list[str], order: list[str], name: str, kind: str, circle: bool = True) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    if kind == "sum":
        return df.withColumn(name, F.sum("__m").over(so_far))
    last = F.last("__m", ignorenulls=True)
    found = last.over(so_far)
    whole = last.over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.withColumn(name, F.coalesce(found, whole) if circle else found)


def _scanned(df: DataFrame, group: list[str], order: list[str], name: str, kind: str, slices: int) -> DataFrame:
    """`running` as a prefix scan: one range partitioning by group and order cuts large groups into slices, a slice's total
    is carried to those after it, and only a slice is accumulated in one task.

    The dealt rows are written, because a range partitioning computed twice may cut at other places.
    """
    dealt = written(df.repartitionByRange(slices, *group, *order).withColumn("__slice", F.spark_partition_id()), "slices")
    keys = [*group, "__slice"]
    # a row per group and slice
    w = Window.partitionBy(*group).orderBy("__slice")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    if kind == "sum":
        offsets = dealt.groupBy(*keys).agg(F.sum("__m").alias("__t"))
        carry = F.sum("__t").over(before)
    else:
        last = F.max(F.when(F.col("__m").isNotNull(), F.struct(*order, "__m"))).alias("__t")
        offsets = dealt.groupBy(*keys).agg(last).withColumn("__t", F.col("__t.__m"))
        last = F.last("__t", ignorenulls=True)
        carry = F.coalesce(last.over(before), last.over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    offsets = offsets.select(*keys, carry.alias("__before"))
    inside = _accumulated(dealt, keys, order, name, kind, circle=False).join(offsets, keys)
    both = F.col("__before") + F.col(name) if kind == "sum" else F.col(name)
    return inside.withColumn(name, F.coalesce(both, name, "__before")).drop("__slice", "__m", "__before")
