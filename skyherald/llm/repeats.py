"""Substring de-duplication by prefix-partitioned suffix trees over words.

Every word position with `min_words` words left starts a suffix. A node of the suffix tree at depth `min_words` or
more with two leaves is a repeat, so only suffixes that can lie under such a node need a tree:

1. Each suffix is filed under a prefix: the least of the `PREFIX`-word sequences in its first `min_words` words, which
   lies at the same place in every equal suffix. Neighbouring suffixes filed under the same sequence form one *run*,
   and one row (`suffix_runs`), about fifteen suffixes in length.
2. Prefixes that occur once are leaves high up in the tree and are dropped after a pre-aggregated count.
3. Runs of equal words are leaves with a weight: two or more make all their suffixes repeats, with no tree. Only where
   different runs share a prefix are the words of one run of each kind fetched.
4. Prefix groups are packed into bins of bounded size, and each bin's suffix tree is built in one task (`subtree`): the
   suffixes are ranked by prefix doubling, and a class that agrees to depth `min_words` is a deep internal node.
   A prefix with too many different runs for a bin is lengthened to `min_words` words, suffix by suffix; such a prefix
   is itself the deep node, and a pre-aggregated count decides.
5. Repeated suffixes come back as spans of word positions per document; overlapping ones are maximal repeats.

Windows are compared as 64-bit word hashes. Defined results: a null or blank text has no words, equal rows repeat one
another (also with equal ids), an empty table gives an empty result, and other columns are carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyherald.llm.common import carried, released, stored
from skyherald.llm.tokens import mixed, powers, text_slices, window_hashes

PREFIX = 8
# words that one task's suffix tree may hold; runs of a prefix beyond a quarter of it get longer prefixes
BIN_WORDS = 1_000_000
_RUN_BASE = 0xA24BAED4963EE407

RUNS = pa.schema([("prefix", pa.int64()), ("body", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("place", pa.int64())])
BODIES = pa.schema([
    ("prefix", pa.int64()), ("copies", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int64()),
    ("codes", pa.binary()),
])
SPANS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int64()), ("n", pa.int64())])


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """Place of the leftmost minimum of each run of `size` values."""
    best, width = np.arange(len(values)), 1
    while width < size:
        step = min(width, size - width)
        left, right = best[:-step], best[step:]
        best = np.where(values[left] <= values[right], left, right)
        width += step
    return best


def _runs_of(h: np.ndarray, first: np.ndarray, min_words: int, prefix: int):
    """(row, prefix hash, body hash, start in row, suffixes) for each run of a slice of rows."""
    n = len(h) - min_words + 1
    if n <= 0:
        return None
    grams = window_hashes(h, prefix)
    at = _least(grams, min_words - prefix + 1)[:n]
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = row[:n] == row[min_words - 1 :]
    start = np.flatnonzero(whole)
    if not len(start):
        return None
    at, row = at[start], row[start]
    head = np.ones(len(start), dtype=bool)
    head[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    heads = np.flatnonzero(head)
    count = np.diff(np.append(heads, len(start)))
    s, at, row = start[heads], at[heads], row[heads]
    length = count + min_words - 1
    up, down = powers(_RUN_BASE, len(h)), powers(pow(_RUN_BASE, -1, 1 << 64), len(h))
    total = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * up, out=total[1:])
    body = (total[s + length] - total[s]) * down[s]
    shape = ((at - s) * 4096 + length).astype(np.uint64)
    body = mixed(body + shape * np.uint64(0x9FB21C651E98DF25))
    return row, grams[at].view(np.int64), body.view(np.int64), s - first[row], count


def suffix_runs(keyed: DataFrame, min_words: int) -> DataFrame:
    """One row per run of suffixes that share a prefix. `place` is start * 4096 + number of suffixes."""
    if not 1 <= min_words <= 4000:
        raise ValueError("min_words from 1 to 4000")
    prefix = min(PREFIX, min_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
            for lo, _, w in text_slices(batch.column("text")):
                found = _runs_of(w.hashes(), w.first, min_words, prefix)
                if found is None:
                    continue
                row, gram, body, start, count = found
                row = row + lo
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (gram, body, k1[row], k2[row], start * 4096 + count)], schema=RUNS
                )

    return keyed.select("k1", "k2", "text").mapInArrow(run, "prefix long, body long, k1 long, k2 long, place long")


def _bodies(asked: DataFrame, min_words: int) -> DataFrame:
    """Word codes of the asked runs: rows of (k1, k2, text, runs array<struct<prefix, copies, start, n>>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
            wanted = batch.column("runs")
            for lo, hi, w in text_slices(batch.column("text")):
                h = w.hashes()
                part = wanted.slice(lo, hi - lo)
                count = part.value_lengths().to_numpy(zero_copy_only=False)
                flat = part.flatten()
                gram, copies, start, n = (flat.field(f).to_numpy() for f in ("prefix", "copies", "start", "n"))
                row = np.repeat(np.arange(hi - lo), count)
                begin = w.first[row] + start
                codes = [h[b : b + k].tobytes() for b, k in zip(begin.tolist(), (n + min_words - 1).tolist(), strict=True)]
                row = row + lo
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram), pa.array(copies), pa.array(k1[row]), pa.array(k2[row]), pa.array(start),
                     pa.array(codes, pa.binary())], schema=BODIES,
                )

    return asked.mapInArrow(run, "prefix long, copies long, k1 long, k2 long, start long, codes binary")


def deep_leaves(codes: np.ndarray, run_of: np.ndarray, first: np.ndarray, weight: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes below an internal node of depth `depth` or more of the suffix tree of all runs.

    `codes` holds the runs one after another, run r at first[r]:first[r + 1]. Suffixes are ranked by their first
    1, 2, 4 .. words (prefix doubling); the classes at `depth` are the nodes just there, and one that has leaves of a
    total weight of two or more is, or lies above, a branching. Returns a mask over the places of `codes`.
    """
    last = first[run_of + 1]
    place = np.arange(len(codes))
    _, rank = np.unique(codes, return_inverse=True)
    rank, width = rank.astype(np.uint64), 1
    full = place + depth <= last
    while width < depth:
        step = min(width, depth - width)
        # a suffix that ends before its next part is alone: it gets a rank of its own
        ahead = place + step
        inside = ahead + width <= last
        pair = rank * np.uint64(1 << 32) + rank[np.minimum(ahead, len(codes) - 1)]
        _, merged = np.unique(pair, return_inverse=True)
        merged = merged.astype(np.uint64)
        outside = np.flatnonzero(~inside)
        merged[outside] = np.uint64(len(codes)) + outside.astype(np.uint64)
        rank, width = merged, width + step
    leaves = np.flatnonzero(full)
    _, node = np.unique(rank[leaves], return_inverse=True)
    deep = np.bincount(node, weights=weight[run_of[leaves]])[node] >= 2
    mask = np.zeros(len(codes), dtype=bool)
    mask[leaves[deep]] = True
    return mask


def _subtrees(bodies: DataFrame, min_words: int) -> DataFrame:
    """Spans of repeated suffixes, from one suffix tree per bin of prefixes."""

    def tree(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        data = table.column("codes").to_pylist()
        size = np.array([len(x) // 8 for x in data])
        first = np.concatenate([[0], np.cumsum(size)])
        codes = np.frombuffer(b"".join(data), dtype=np.uint64)
        run_of = np.repeat(np.arange(len(data)), size)
        copies, start, k1, k2 = (table.column(c).to_numpy() for c in ("copies", "start", "k1", "k2"))
        at = np.flatnonzero(deep_leaves(codes, run_of, first, copies, min_words) & (copies[run_of] == 1))
        head = np.ones(len(at), dtype=bool)
        head[1:] = (np.diff(at) != 1) | (run_of[at[1:]] != run_of[at[:-1]])
        heads = np.flatnonzero(head)
        n, r = np.diff(np.append(heads, len(at))), run_of[at[heads]]
        return pa.Table.from_arrays(
            [pa.array(k1[r]), pa.array(k2[r]), pa.array(start[r] + at[heads] - first[r]), pa.array(n)], schema=SPANS
        )

    return bodies.groupBy("bin").applyInArrow(tree, "k1 long, k2 long, start long, n long")


def _long_prefixes(bodies: DataFrame, min_words: int) -> DataFrame:
    """Spans of repeated suffixes of prefixes lengthened to `min_words`: one row per suffix, counted by its prefix."""

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("codes").to_pylist()
            out = [np.empty(0, np.int64)] * 5
            parts = []
            copies, k1, k2, start = (batch.column(c).to_numpy() for c in ("copies", "k1", "k2", "start"))
            for i, x in enumerate(data):
                h = window_hashes(np.frombuffer(x, dtype=np.uint64), min_words).view(np.int64)
                parts.append((h, np.full(len(h), i), start[i] + np.arange(len(h))))
            if parts:
                h, i, s = (np.concatenate(x) for x in zip(*parts, strict=True))
                out = [h, copies[i], k1[i], k2[i], s]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["node", "copies", "k1", "k2", "start"])

    rows = bodies.select("copies", "k1", "k2", "start", "codes").mapInArrow(
        suffixes, "node long, copies long, k1 long, k2 long, start long"
    )
    deep = stored(rows.groupBy("node").agg(F.sum("copies").alias("leaves")).filter("leaves >= 2").select("node"), "deep-nodes")
    return rows.filter("copies = 1").join(deep, "node", "left_semi").select("k1", "k2", "start", F.lit(1).cast("long").alias("n"))


def repeat_spans(keyed: DataFrame, min_words: int, bin_words: int = BIN_WORDS) -> DataFrame:
    """Spans (k1, k2, start, n): the n suffixes from word `start` on each repeat somewhere else."""
    runs = stored(suffix_runs(keyed, min_words), "suffix-runs")
    # counts are written before they are joined: a join of two plain exchanges lets adaptive execution split a prefix
    # that a large share of all runs has, one with an aggregate in the same stage does not
    shared = stored(runs.groupBy("prefix").agg(F.count(F.lit(1)).alias("c")).filter("c >= 2").select("prefix"), "shared-prefixes")
    runs = stored(runs.join(shared, "prefix", "left_semi"), "shared-runs")
    one = F.min(F.struct("k1", "k2", "place")).alias("one")
    kinds = stored(runs.groupBy("prefix", "body").agg(F.count(F.lit(1)).alias("copies"), one), "run-kinds")
    start, n = F.shiftright("place", 12), F.col("place") % 4096
    whole = (
        runs.join(kinds.filter("copies >= 2").select("prefix", "body"), ["prefix", "body"], "left_semi")
        .select("k1", "k2", start.alias("start"), n.alias("n"))
    )
    per_prefix = stored(kinds.groupBy("prefix").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds >= 2"), "mixed-prefixes")
    mixed_kinds = kinds.join(per_prefix, "prefix")
    asked = (
        mixed_kinds.select("prefix", "copies", "kinds", "one.*")
        .groupBy("k1", "k2")
        .agg(F.collect_list(F.struct("prefix", "copies", start.alias("start"), n.alias("n"))).alias("runs"))
    )
    # rows that are equal in id and text have equal words: one of them is read
    texts = keyed.select("k1", "k2", "text")
    bodies = stored(_bodies(texts.join(asked, ["k1", "k2"]), min_words), "run-words")
    run_words = F.length("codes") / 8
    sized = bodies.groupBy("prefix").agg(F.sum(run_words).alias("size"))
    # at most words / (bin_words / 4) prefixes
    hot = stored(sized.filter(F.col("size") > bin_words / 4).select("prefix"), "hot-prefixes")
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    bins = max(1, -(-4 * int(total) // bin_words))
    usual = bodies.join(hot, "prefix", "left_anti").withColumn("bin", F.pmod(F.xxhash64("prefix"), F.lit(bins)))
    found = [whole, _subtrees(usual, min_words), _long_prefixes(bodies.join(hot, "prefix", "left_semi"), min_words)]
    return found[0].unionByName(found[1]).unionByName(found[2])


def _keys(row_id: Column, text: Column) -> list[Column]:
    """128 bits for a row's id and text."""
    return [F.xxhash64(row_id, text).alias("k1"), F.xxhash64(F.lit(7), text, row_id).alias("k2")]


def _cut(min_words: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, spans = batch.column("row"), batch.column("spans").to_pylist()
            texts = batch.column("text").cast(pa.binary())
            n_words, n_removed, sha, cuts, kept_text = [], [], [], [], []
            for text, found in zip(texts, spans, strict=True):
                words = (text.as_py() or b"").split()
                merged: list[list[int]] = []
                for begin, end in sorted((s["start"], s["start"] + s["n"] + min_words - 1) for s in found or ()):
                    if merged and begin <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([begin, end])
                n_words.append(len(words))
                for begin, end in reversed(merged):
                    del words[begin:end]
                kept = b" ".join(words)
                n_removed.append(n_words[-1] - len(words))
                sha.append(hashlib.sha256(kept).hexdigest())
                cuts.append([{"start": b, "end": e} for b, e in merged])
                if with_text:
                    kept_text.append(kept.decode())
            arrays = [rows, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha),
                      pa.array(cuts, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
            names = ["row", "n_words", "n_removed", "kept_sha256", "repeats"]
            if with_text:
                arrays.append(pa.array(kept_text, pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = 35, with_text: bool = True,
    carry: list[str] | None = None, bin_words: int = BIN_WORDS,
) -> DataFrame:
    """Documents with `n_words`, `n_removed`, `kept_sha256`, `repeats` (word spans, end exclusive) and `kept_text`.

    A word goes if it lies in a window of `min_words` words that also starts anywhere else; kept words are joined by
    one space.
    """
    carry = list(docs.columns if carry is None else carry)
    rows = carried(docs, id_col, text)
    held = F.struct(*[F.col("row").getField(c).alias(c) for c in carry]).alias("row")
    keyed = rows.select(held, F.col(f"in_{text}").alias("text"), *_keys(F.col(f"in_{id_col}"), F.col(f"in_{text}")))
    spans = repeat_spans(keyed, min_words, bin_words)
    spans = spans.distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    joined = keyed.join(spans, ["k1", "k2"], "left").select("row", "text", "spans")
    kind = f"row {joined.schema['row'].dataType.simpleString()}, n_words long, n_removed long, kept_sha256 string, " \
        "repeats array<struct<start: long, end: long>>" + ", kept_text string" * with_text
    cut = joined.mapInArrow(_cut(min_words, with_text), kind)
    return released(cut, carry, {c: F.col(c) for c in cut.columns[1:]})
