"""How far the sources of a language diverge in their words, by count-level bitmaps.

A term's weight in a group depends on nothing but its count there, so a pair of groups is described by how many terms have
each pair of counts. Term ids are cut into words of 64; a bitmap row is (group, count, word) with the bits of the terms
that have this count in the group. For two groups' rows of one word, AND and popcount give the joint cells, which are
multiplied by the value f of the two weights; terms that lack in one group or both follow by complement.

Words are independent of each other, so the work is spread over slices of words and tiles of TILE sources, and only sums per
pair of sources leave a task. All numbers are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyherald.llm.common import stored
from skyherald.llm.tokens import as_bytes, slices

# sources in a tile (bounds a task's matrices) and words of 64 terms in a slice
TILE, SLICE_WORDS = 32, 16
# texts counted together before their counts go to Spark
COUNT_BYTES = 8 << 20
SCALE = 1_000_000_000
# bytes of term characters: letters and everything beyond ASCII; capitals become small
_SOLID = np.zeros(256, dtype=bool)
_SOLID[0x41:0x5B] = _SOLID[0x61:0x7B] = _SOLID[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(row, term) of all term occurrences of the rows that `offsets` cuts `data` into."""
    data, off = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    if not len(data):
        return np.zeros(0, np.int64), pa.array([], pa.large_string())
    solid = _SOLID[data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    filled = off[:-1] < off[1:]
    heads, tails = off[:-1][filled], off[1:][filled] - 1
    begins[heads], ends[tails] = solid[heads], solid[tails]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    bounds = np.concatenate([[0], np.cumsum(end - start)])
    packed = _LOWER[data[solid]]
    terms = pa.Array.from_buffers(
        pa.large_string(), len(start), [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(packed.tobytes())]
    )
    return np.searchsorted(off, start, side="right") - 1, terms


def _codes(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _counted(texts: pa.Array, group: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """(group, term, occurrences, rows with the term) per run of texts."""
    data, offsets = as_bytes(texts)
    for lo, hi in slices(offsets, COUNT_BYTES):
        row, terms = terms_of(data, offsets[lo : hi + 1])
        if not len(row):
            continue
        code, names = _codes(terms)
        width = len(names)
        # a row's terms first, then a group's: (row, term) with occurrences, (group, term) with rows
        pair, n = np.unique(row * width + code, return_counts=True)
        key, at = np.unique(group[lo:hi][pair // width] * width + pair % width, return_inverse=True)
        yield (
            key // width, names.take(pa.array(key % width)),
            np.bincount(at, weights=n, minlength=len(key)).astype(np.int64), np.bincount(at, minlength=len(key)),
        )


def _occurrences(docs: DataFrame) -> DataFrame:
    """Rows (lang, source, text) as partial counts (lang, source, term, n, docs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, langs = _codes(batch.column("lang"))
            source, sources = _codes(batch.column("source"))
            for group, terms, n, rows in _counted(batch.column("text"), lang * max(len(sources), 1) + source):
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(group // len(sources))), sources.take(pa.array(group % len(sources))),
                     terms.cast(pa.string()), pa.array(n), pa.array(rows.astype(np.int64))],
                    names=["lang", "source", "term", "n", "docs"],
                )

    return docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def weight(count: str, total: str = "total", kinds: str = "kinds") -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kinds)) of columns or SQL terms, exact beyond 64 bits."""
    top = f"{SCALE}BD * cast({count} + 2 as decimal(20,0))"
    return F.expr(f"1L + (({top}) div cast({total} + 2 * {kinds} as decimal(20,0)))")


def divergence(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)) of two columns."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _tile_sums(tiles: tuple[int, int], level: dict[str, np.ndarray], bits: dict[str, np.ndarray]) -> np.ndarray:
    """Sums of n * f over the terms of a slice, for each source of the one tile (rows) and the other (columns).

    `level` has a row per source (tile, no, weight at count 0, terms of the slice), `bits` one per bitmap (word, level row,
    weight, bitmap), ordered by word and level row.
    """
    side = [np.flatnonzero(level["tile"] == t) for t in tiles]
    place = np.full(len(level["tile"]), -1)
    f = lambda p, q: (p - q) ** 2 // (p + q)
    zero_a, zero_b = (level["p0"][x] for x in side)
    # as if every source lacked every term; then the terms that are there
    out = f(zero_a[:, None], zero_b[None, :]) * level["terms"][side[0]][:, None]
    starts = np.flatnonzero(np.diff(bits["word"], prepend=-1))
    for lo, hi in zip(starts, [*starts[1:], len(bits["word"])], strict=True):
        owner, p, x = bits["level"][lo:hi], bits["p"][lo:hi], bits["bits"][lo:hi]
        ones = np.bitwise_count(x).astype(np.int64)
        place[:] = -1
        place[side[1]] = np.arange(len(side[1]))
        mine = np.flatnonzero(place[owner] >= 0)
        col, pb, xb, mb = place[owner[mine]], p[mine], x[mine], ones[mine]
        heads = np.flatnonzero(np.diff(col, prepend=-1))
        for r, a in enumerate(side[0]):
            at = np.flatnonzero(owner == a)
            pa_, xa, ma = p[at], x[at], ones[at]
            # terms of the one source alone: by complement of its joint cells
            miss = f(pa_[:, None], zero_b[None, :])
            both = np.bitwise_count(xa[:, None] & xb[None, :]).astype(np.int64)
            none = f(zero_a[r], zero_b)
            there = np.add.reduceat(both, heads, axis=1) if len(heads) else np.zeros((len(at), 0), np.int64)
            lone = np.repeat(ma[:, None], len(zero_b), axis=1)
            lone[:, col[heads]] -= there
            out[r] += (lone * miss).sum(axis=0)
            union = np.full(len(zero_b), ma.sum())
            if len(heads):
                other = mb - both.sum(axis=0)
                cells = (both * f(pa_[:, None], pb[None, :])).sum(axis=0) + other * f(zero_a[r], pb)
                out[r, col[heads]] += np.add.reduceat(cells, heads)
                union[col[heads]] += np.add.reduceat(other, heads)
            out[r] -= union * none
    return out


def _pair_sums(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Per pair of sources of a tile pair the sum over a slice; rows without bits are the sources themselves."""
    tiles = (key[1].as_py(), key[2].as_py())
    numbers = {c: table.column(c).to_numpy() for c in ("tile", "no", "p", "word", "bits", "terms")}
    order = np.lexsort((numbers["no"], numbers["tile"]))
    at = order[numbers["word"][order] < 0]
    level = {"tile": numbers["tile"][at], "p0": numbers["p"][at], "terms": numbers["terms"][at]}
    names = {(t, n): i for i, (t, n) in enumerate(zip(level["tile"].tolist(), numbers["no"][at].tolist(), strict=True))}
    rows = np.flatnonzero(numbers["word"] >= 0)
    owner = np.array([names[x] for x in zip(numbers["tile"][rows].tolist(), numbers["no"][rows].tolist(), strict=True)], np.int64)
    order = np.lexsort((owner, numbers["word"][rows]))
    rows, owner = rows[order], owner[order]
    bits = {"word": numbers["word"][rows], "level": owner, "p": numbers["p"][rows], "bits": numbers["bits"][rows].view(np.uint64)}
    sums = _tile_sums(tiles, level, bits)
    sources = table.column("source").take(pa.array(at)).combine_chunks()
    a, b = (np.flatnonzero(level["tile"] == t) for t in tiles)
    i, j = np.repeat(np.arange(len(a)), len(b)), np.tile(np.arange(len(b)), len(a))
    keep = (a[i] < b[j]) if tiles[0] == tiles[1] else np.ones(len(i), bool)
    i, j = i[keep], j[keep]
    return pa.table({
        "lang": pa.array([key[0].as_py()] * len(i), pa.string()), "a": sources.take(pa.array(a[i])),
        "b": sources.take(pa.array(b[j])), "value": pa.array(sums[i, j]),
    })


def _bitmaps(kept: DataFrame) -> DataFrame:
    """(lang, word, source, n, bits): the terms of a word of 64 that have the count n in the source."""
    each = kept.select("lang", "id", F.explode("groups").alias("g")).select("lang", "id", "g.source", "g.n")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("id") % 64).cast("int"))
    return each.groupBy("lang", F.floor(F.col("id") / 64).alias("word"), "source", "n").agg(F.bit_or(bit).alias("bits"))


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) for pairs of sources a, b of a language with kept terms, a pair once."""
    word = F.floor(F.col("id") / 64)
    spans = kept.groupBy("lang", F.floor(word / SLICE_WORDS).alias("slice")).agg(F.count(F.lit(1)).alias("terms"))
    own = groups.filter("kinds > 0").select("lang", "source", "tile", "tiles", "no", "total", "kinds")
    level = own.join(spans, "lang").select(
        "lang", "source", "tile", "tiles", "no", "slice", weight("0L").alias("p"), F.lit(-1).cast("long").alias("word"),
        F.lit(0).cast("long").alias("bits"), "terms",
    )
    maps = _bitmaps(kept).join(own, ["lang", "source"]).select(
        "lang", "source", "tile", "tiles", "no", F.floor(F.col("word") / SLICE_WORDS).alias("slice"),
        weight("n").alias("p"), "word", "bits", F.lit(0).cast("long").alias("terms"),
    )
    # a tile meets those of a larger or equal number as first, the smaller as second
    met = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(
        F.least(t, F.col("tile")).alias("first"), F.greatest(t, F.col("tile")).alias("second")))
    dealt = maps.unionByName(level).withColumn("met", F.explode(met)).select(
        "lang", F.col("met.first").alias("first"), F.col("met.second").alias("second"), "slice", "tile", "no", "p", "word",
        "bits", "terms", F.when(F.col("word") < 0, F.col("source")).alias("source"),
    )
    sums = dealt.groupBy("lang", "first", "second", "slice").applyInArrow(
        _pair_sums, "lang string, a string, b string, value long"
    )
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def kept_terms(docs: DataFrame, least_docs: int) -> DataFrame:
    """(id, lang, term, total, groups<source, n>): the terms in at least `least_docs` documents of the language.

    An id is of one term; terms of a language have nearly consecutive ids.
    """
    counts = _occurrences(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = counts.groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("groups")
    )
    kept = terms.filter(F.col("docs") >= least_docs).sortWithinPartitions("lang")
    return stored(kept.select(F.monotonically_increasing_id().alias("id"), "lang", "term", "total", "groups"), "kept-terms")


def source_divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = 10, top: int = 10
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): how far each source of a language is from the others and from the whole.

    Terms are runs of letters and of characters beyond ASCII, A-Z in lower case. Null text, lang and source are ''. The
    terms in at least `least_docs` documents of a language count there; a group (or language) with N of their occurrences and
    V such terms gives a term with `count` the weight 1 + floor(10^9 (count + 2) / (N + 2 V)). Two weights differ by
    f = floor((p - q)^2 / (p + q)).

    Part `pair`: each other source of the language, with the sum of f over all terms (0 without terms), all ranks. Part
    `term`: terms of the group that weigh more there than in the language, the `top` largest f. Ranks start at 1, equal
    values by item. A table's other columns play no part; an empty table gives no rows; repeated rows count again.
    """
    given = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    read = docs.select(given(lang).alias("lang"), given(source).alias("source"), given(text).alias("text"))
    kept = kept_terms(read, least_docs)
    sums = kept.select("lang", F.explode("groups").alias("g")).groupBy("lang", F.col("g.source").alias("source")).agg(F.sum("g.n").alias("total"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("total").alias("lang_total"))
    found = read.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("docs"))
    sizes = found.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    groups = (
        found.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").join(sizes, "lang")
        .select(
            "lang", "source", F.coalesce("total", F.lit(0)).cast("long").alias("total"),
            F.coalesce("kinds", F.lit(0)).cast("long").alias("kinds"), "lang_total",
            F.ceil(F.col("sources") / TILE).cast("long").alias("tiles"), F.xxhash64("source").alias("no"),
        ).withColumn("tile", F.pmod("no", F.col("tiles")))
    )
    groups = stored(groups.withColumn("no", F.row_number().over(Window.partitionBy("lang", "tile").orderBy("source")).cast("long")), "groups")

    valued = _pairs(kept, groups)
    both = valued.unionByName(valued.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    bare = groups.filter("kinds = 0").select("lang", "source")
    silent = bare.withColumnRenamed("source", "a").join(bare.withColumnRenamed("source", "b"), "lang").filter("a <> b")
    pairs = both.unionByName(silent.withColumn("value", F.lit(0).cast("long")))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")

    each = kept.select("lang", "term", F.col("total").alias("in_lang"), F.explode("groups").alias("g"))
    each = each.select("lang", "term", "in_lang", "g.source", "g.n").join(
        groups.select("lang", "source", "total", "kinds", "lang_total"), ["lang", "source"])
    weighed = each.select("lang", "source", F.col("term").alias("item"), weight("n").alias("p"), weight("in_lang", "lang_total").alias("q"))
    terms = weighed.filter("p > q").select("lang", "source", F.lit("term").alias("part"), "item", divergence("p", "q").alias("value"))
    ranked = terms.withColumn("rank", place).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", place).unionByName(ranked)
