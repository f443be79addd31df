"""Packing into batches of a token budget, with optimal length buckets.

Sequences (documents, or pieces of at most `max_len` tokens of longer ones) are padded to the bound of their bucket. A
dynamic program over the histogram of all sequence lengths, at most `max_len` rows however many documents there are,
finds the bounds of at most `buckets` buckets that make the padding least. Inside a bucket, batches hold
`token_budget // bound` sequences (one at least).

Sequences are numbered inside a bucket without a task that sees a whole bucket: they are dealt to slices of about
`rows_per_slice`, numbered in their slice, and offset by the pre-aggregated sizes of the slices before.

Defined results: a null or blank text has no token and gets one row without bucket and batch; equal rows are sequences
each; an empty table gives an empty result; other columns are kept, a result column replaces one of its name.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyherald.llm.common import carried, released, stored, words

MAX_LEN, BUCKETS, TOKEN_BUDGET = 4096, 8, 65_536
ROWS_PER_SLICE = 20_000


def optimal_bounds(histogram: dict[int, int], buckets: int) -> tuple[list[int], int]:
    """(bucket bounds, padding) with the least padding for {length: count} and at most `buckets` buckets.

    least[j] is the least padding of the j shortest lengths in the buckets allowed so far; the last bucket ends at
    length j and pads all lengths after some i up to it. Of equal choices the fewest lengths come before the last bucket.
    """
    lengths = np.array(sorted(histogram), dtype=np.int64)
    m = len(lengths)
    if not m:
        return [], 0
    counts = np.array([histogram[int(x)] for x in lengths], dtype=np.int64)
    rows = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)])
    least = np.full(m + 1, np.iinfo(np.int64).max // 4)
    least[0] = 0
    choices = []
    for _ in range(min(buckets, m)):
        # a bucket may stay empty, so that fewer buckets are among the choices
        now, choice = least.copy(), np.full(m + 1, -1)
        for j in range(1, m + 1):
            costs = least[:j] + lengths[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            i = int(np.argmin(costs))
            if costs[i] < now[j]:
                now[j], choice[j] = costs[i], i
        least = now
        choices.append(choice)
    bounds, j = [], m
    for choice in reversed(choices):
        if j and choice[j] >= 0:
            bounds.append(int(lengths[j - 1]))
            j = int(choice[j])
    return bounds[::-1], int(least[m])


def _sequences(docs: DataFrame, text: str, carry: Sequence[str], length: Column | None, max_len: int) -> DataFrame:
    rows = carried(docs, text)
    held = F.struct(*[F.col("row").getField(c).alias(c) for c in carry]).alias("row")
    n = F.size(words(F.col(f"in_{text}"))) if length is None else F.coalesce(length, F.lit(0))
    counted = rows.select(held, n.cast("long").alias("n"))
    last = F.greatest(F.floor((F.col("n") - 1) / max_len), F.lit(0)).cast("int")
    pieces = counted.select("row", "n", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    size = F.least(F.lit(max_len).cast("long"), F.col("n") - F.col("piece").cast("long") * max_len)
    return pieces.select("row", "piece", size.alias("n_tokens"))


def packed(
    docs: DataFrame, text: str = "text", length: Column | None = None, max_len: int = MAX_LEN, buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET, rows_per_slice: int = ROWS_PER_SLICE, carry: Sequence[str] | None = None,
) -> DataFrame:
    """One row per sequence: `piece` of its document, `n_tokens`, `bucket_len`, `batch_no` in the bucket and `slot`.

    Tokens are the words `[^\\x20\\x09-\\x0D]+`; `length` may be another count, over the columns `row` and `in_<text>`.
    """
    carry = list(docs.columns if carry is None else carry)
    sequences = stored(_sequences(docs, text, carry, length, max_len), "sequences")
    # at most max_len rows
    histogram = {r["n_tokens"]: r["count"] for r in sequences.filter("n_tokens > 0").groupBy("n_tokens").count().collect()}
    bounds, _ = optimal_bounds(histogram, buckets)
    per_bucket = dict.fromkeys(bounds, 0)
    for n, c in histogram.items():
        per_bucket[next(b for b in bounds if n <= b)] += c
    bucket, slices = F.lit(None).cast("long"), F.lit(1)
    for b in reversed(bounds):
        here = F.col("n_tokens") <= b
        bucket = F.when(here, F.lit(b).cast("long")).otherwise(bucket)
        slices = F.when(here, F.lit(-(-per_bucket[b] // rows_per_slice))).otherwise(slices)
    # ids of rows of a written table are the same in every attempt
    numbered = sequences.withColumn("at", F.monotonically_increasing_id())
    dealt = numbered.filter("n_tokens > 0").select(
        "row", "piece", "n_tokens", "at", bucket.alias("bucket_len"),
        F.pmod(F.xxhash64("at"), slices).cast("long").alias("slice"),
    )
    order = Window.partitionBy("bucket_len").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("bucket_len", "slice").agg(F.count(F.lit(1)).alias("c"))
    before = sizes.select("bucket_len", "slice", F.coalesce(F.sum("c").over(order), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket_len", "slice").orderBy("at")
    place = dealt.withColumn("n", F.row_number().over(inside) - 1).join(before, ["bucket_len", "slice"])
    number, capacity = F.col("before") + F.col("n"), F.greatest(F.floor(F.lit(token_budget) / F.col("bucket_len")), F.lit(1))
    placed = place.select(
        "row", "piece", "n_tokens", "bucket_len", F.floor(number / capacity).alias("batch_no"),
        (number % capacity).alias("slot"),
    )
    none = F.lit(None).cast("long")
    empty = sequences.filter("n_tokens <= 0").select(
        "row", "piece", F.lit(0).cast("long").alias("n_tokens"), none.alias("bucket_len"), none.alias("batch_no"), none.alias("slot"),
    )
    both = placed.unionByName(empty)
    return released(both, carry, {c: F.col(c) for c in both.columns[1:]})
