"""What the text operators share: written intermediates, rows carried whole, native word arrays."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyherald.session import shared_dir

# the six characters between words, and a run of them
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write below the cluster's shared folder and read back: cuts the lineage, survives a lost executor."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path + "/rows")
    return df.sparkSession.read.schema(df.schema).parquet(path + "/rows")


@contextmanager
def batches_of(spark: SparkSession, size: str) -> Iterator[None]:
    """Actions inside give Python workers Arrow batches of at most so many bytes: what a task holds is bounded."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def words(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text as an array; a null text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def let(value: Column, body) -> Column:
    """Evaluate `value` once per row and hand it to `body`, inside one expression (so also inside a CASE branch)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def carried(df: DataFrame, *inputs: str) -> DataFrame:
    """The whole row as one struct `row`, beside the columns an operator works on under names of its own.

    Whatever other columns a table has, they cannot clash with the operator's.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    return df.select(row, *[F.col(f"`{c}`").alias(f"in_{c}") for c in inputs])


def released(df: DataFrame, columns: Sequence[str], results: dict[str, Column]) -> DataFrame:
    """Columns of the carried row followed by results; a result replaces an input column of its name."""
    lower = {name.lower() for name in results}
    kept = [F.col("row").getField(c).alias(c) for c in columns if c.lower() not in lower]
    return df.select(*kept, *[value.alias(name) for name, value in results.items()])


def running_total(sizes: Column, block: int = 256) -> Column:
    """For each element of an array the sum of the elements before it, inside one expression.

    Sums of blocks first, so that long arrays don't take quadratic time.
    """
    add = lambda a, x: a + x
    zero = F.lit(0).cast("long")

    def by_blocks(totals: Column) -> Column:
        before = F.transform(totals, lambda _, b: F.aggregate(F.slice(totals, F.lit(1), b), zero, add))
        return let(before, lambda starts: F.transform(sizes, lambda _, i: F.get(starts, (i / block).cast("int")) + F.aggregate(
            F.slice(sizes, (i / block).cast("int") * block + 1, i % block), zero, add
        )))

    blocks = F.transform(
        F.sequence(F.lit(0), ((F.size(sizes) - 1) / block).cast("int")),
        lambda b: F.aggregate(F.slice(sizes, b * block + 1, F.lit(block)), zero, add),
    )
    return F.when(F.size(sizes) == 0, F.array().cast("array<bigint>")).otherwise(let(blocks, by_blocks))


def regex_spans(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as array<struct<start, end, found>>: code points, end exclusive.

    The text between matches gives the places; it is only cut up where there is a match. `found` is the group's text.
    """
    kind = "array<struct<start: bigint, end: bigint, found: string>>"

    def placed(whole: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p).cast("long"))
        sizes = lambda g: F.transform(whole, lambda m, i: F.get(g, i) + F.length(m))
        named = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole

        def built(g: Column) -> Column:
            return let(sizes(g), lambda s: let(running_total(s), lambda before: let(named, lambda found: F.transform(
                whole, lambda m, i: F.struct(
                    (F.get(before, i) + F.get(g, i)).alias("start"),
                    (F.get(before, i) + F.get(g, i) + F.length(m)).alias("end"), F.get(found, i).alias("found"),
                )
            ))))

        return F.when(F.size(whole) == 0, F.array().cast(kind)).otherwise(let(gaps, built))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
