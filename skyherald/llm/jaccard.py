"""Near copies by the exact Jaccard similarity of their shingle sets.

Candidates come from SimHash fingerprints and, as a pair at 0.8 differs in too many bits for a grid of fingerprints, from
MinHash bands. A set's fingerprint has a bit where over half of its shingles' hashes have it; fingerprints are tied by
`simhash.fingerprint_classes` (two-bit segment popcounts, grid range join, exact distance of NEAR_BITS, star contraction),
and each set is compared with that of most copies among those its fingerprint is tied to. Bands are BANDS values, each of
ROWS minima over the shingles' hashes; texts that agree in one are a candidate pair. A pair of similarity s agrees in none
with probability (1 - s^ROWS)^BANDS, 5e-8 at 0.8 and less beyond. Whatever proposed it, a candidate links only if the two
whole sets of 64-bit shingle hashes have a Jaccard similarity of `least` or more.

Only distinct sets are joined, so copies are never paired. In each of ROUNDS rounds every band that holds several groups
elects a hub, and each set is compared with one hub, that with which it shares most bands, so that few comparisons tie a
dense group together. Of the texts in bands that still hold several groups and more than CROWD members, the shingles that
no other of them has are counted: such a text's own shingles bound its similarity to the others exactly, and the text with
the smallest share of them is the band's hub in a last round. Then only candidates across the groups so far are compared: a
pair is listed in the first band it shares, only if its own shingles leave room for `least`, and only if a bit of each minimum
differs in at most FAR_BITS of them. A pair of similarity 0.8 differs in more with probability 2e-9. Last, a map of MAP_BITS
bits marks each set's shingles by their hashes: a bit that only one of two sets has stands for a shingle, at least, that the
other lacks, which bounds the shared ones exactly, before any set travels. An empty table gives an empty table; columns of any name, clashing ones too, are carried in one struct.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyherald.llm.common import batches_of, stored
from skyherald.llm.components import components
from skyherald.llm.simhash import fingerprint_classes
from skyherald.llm.tokens import Words, mixed, text_slices, window_hashes

BANDS, ROWS = 32, 4
ROUNDS, FAR_BITS = 2, 36
# own shingles are counted for bands of more members; in smaller ones there are few pairs (nothing is left out either way)
CROWD = 32
# fingerprints of so many different bits are tied
NEAR_BITS = 3
# bits of the map that bounds what two sets share; a longer one costs bytes in each band row, a shorter one collisions
MAP_BITS = 2048
# bytes of text worked on at once, and in an Arrow batch
SLICE, BATCH = 1 << 19, "4m"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# fixed values: the permutations' multipliers (odd) and masks
_RANDOM = mixed(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_TIMES = (_RANDOM[::2] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_MASK = (_RANDOM[1::2] >> np.uint64(32)).astype(np.uint32)


def shingles_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each distinct shingle of a slice's rows, by row and hash.

    A-Z are lower-cased. A text with fewer words is one shingle, one without any has none.
    """
    lower = Words(_LOWER[words.data], words.start, words.end, words.first)
    n = np.diff(words.first)
    count = np.maximum(n - size + 1, 0)
    owner = np.repeat(np.arange(len(n)), count)
    at = np.repeat(words.first[:-1] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    h = window_hashes(lower.hashes(), size)[at] if len(at) else np.zeros(0, np.uint64)
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        own = [xxhash.xxh64_intdigest(b" ".join(lower.row_bytes(r)), 42) for r in short.tolist()]
        owner, h = np.concatenate([owner, short]), np.concatenate([h, np.array(own, dtype=np.uint64)])
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return owner[fresh], h[fresh]


def sketches_of(words: Words, size: int) -> tuple[np.ndarray, ...]:
    """Per row the number of its shingles, two longs that name their set, the BANDS band values, a bit of each minimum, and
    the fingerprint."""
    rows = len(words.first) - 1
    owner, h = shingles_of(words, size)
    n = np.bincount(owner, minlength=rows)
    key, bands = np.zeros((rows, 2), np.uint64), np.zeros((rows, BANDS), np.uint64)
    bits, fp = np.zeros((rows, BANDS * ROWS // 64), np.uint64), np.zeros(rows, np.uint64)
    if not len(h):
        return n, key, bands, bits, fp
    filled = np.flatnonzero(n)
    heads = (np.cumsum(n) - n)[filled]
    key[filled, 0], key[filled, 1] = np.add.reduceat(mixed(h), heads), np.add.reduceat(mixed(~h), heads)
    upper = (h >> np.uint64(32)).astype(np.uint32)
    for band in range(BANDS):
        value = np.full(len(filled), band + 1, dtype=np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            least = np.minimum.reduceat((upper ^ _MASK[k]) * _TIMES[k], heads)
            value = mixed(value + least)
            bits[filled, k // 64] |= (least & np.uint32(1)).astype(np.uint64) << np.uint64(k % 64)
        bands[filled, band] = value
    fp[filled] = _fingerprints(h, heads, n[filled])
    return n, key, bands, bits, fp


def _fingerprints(h: np.ndarray, heads: np.ndarray, n: np.ndarray) -> np.ndarray:
    """SimHash fingerprint of each run of hashes: a bit is set where over half of the hashes have it."""
    out = np.zeros(len(heads), np.uint64)
    for bit in range(64):
        ones = np.add.reduceat((h >> np.uint64(bit)) & np.uint64(1), heads)
        out |= (2 * ones > n.astype(np.uint64)).astype(np.uint64) << np.uint64(bit)
    return out


def _sketched(rows: DataFrame, text: int, size: int) -> DataFrame:
    """Rows (row) as (row, n, k0, k1, bits0, bits1, fp0, bands); a text without words has no bands.

    The text is the field of that number in `row`: it goes to the Python worker once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            longs = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))
            for lo, hi, w in text_slices(batch.column("row").flatten()[text], SLICE):
                n, key, bands, bits, fp = sketches_of(w, size)
                ends = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row")[lo:hi], pa.array(n.astype(np.int64)), longs(key[:, 0]), longs(key[:, 1]), longs(bits[:, 0]),
                     longs(bits[:, 1]), longs(fp), pa.ListArray.from_arrays(pa.array(ends), longs(bands[n > 0].ravel()))],
                    names=["row", "n", "k0", "k1", "bits0", "bits1", "fp0", "bands"],
                )

    kind = f"row {rows.schema['row'].dataType.simpleString()}, n long, k0 long, k1 long, bits0 long, bits1 long, fp0 long, bands array<long>"
    return rows.select("row").mapInArrow(run, kind)


def _sets(rows: DataFrame, size: int) -> DataFrame:
    """Rows (node, text) as (node, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, w in text_slices(batch.column("text"), SLICE):
                owner, h = shingles_of(w, size)
                ends = np.searchsorted(owner, np.arange(hi - lo + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("node")[lo:hi], lists], names=["node", "shingles"])

    return rows.select("node", "text").mapInArrow(run, "node long, shingles array<long>")


def _maps(sets: DataFrame) -> DataFrame:
    """Sets (node, shingles) as (node, map): MAP_BITS bits as longs, set where a shingle's hash falls."""
    longs = MAP_BITS // 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("shingles")
            ends, h = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            owner = np.repeat(np.arange(len(lists)), np.diff(ends))
            at = (h[ends[0] : ends[-1]] % np.uint64(MAP_BITS)).astype(np.int64)
            marks = np.zeros((len(lists), MAP_BITS), np.uint8)
            marks[owner, at] = 1
            maps = np.packbits(marks, axis=1, bitorder="little").view(np.int64).ravel()
            starts = pa.array(np.arange(len(lists) + 1, dtype=np.int32) * longs)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.ListArray.from_arrays(starts, pa.array(maps))], names=["node", "map"])

    return sets.select("node", "shingles").mapInArrow(run, "node long, map array<long>")


def _lacking(a: str, b: str) -> Column:
    """Of the set with map `a` so many shingles, at least, are not in that with map `b`."""
    only = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
    return F.aggregate(only, F.lit(0), lambda so_far, x: so_far + x)


def _linked(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v, ...) whose sets have a Jaccard similarity of `least` or more."""
    side = lambda p: sets.select(F.col("node").alias(p), F.col("shingles").alias(p + "_set"))
    both = F.size(F.array_intersect("u_set", "v_set"))
    united = F.size("u_set") + F.size("v_set") - both
    return pairs.join(side("v"), "v").join(side("u"), "u").filter(both / united >= least).select(*pairs.columns)


def _sizes_fit(a: str, b: str, least: float):
    """Sets of similarity `least` differ no more in size; a millionth for rounding."""
    return F.least(a, b) >= F.greatest(a, b) * (least - 1e-6)


def _merged(roots: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """(node, root) after links between roots (u, v)."""
    tops = stored(components(links).select(F.col("node").alias("root"), F.col("root").alias("top")), "merged-roots")
    return stored(roots.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root")), name)


def _hub_pairs(rooted: DataFrame, rank: Column, least: float) -> DataFrame:
    """(u, v, a_root, b_root): each set with one hub of another group, that with which it shares most bands.

    The hub of a band is its member of the highest rank.
    """
    elected = rooted.groupBy("band").agg(
        F.min("root").alias("a"), F.max("root").alias("b"), F.max(F.struct(rank.alias("rank"), "node", "n", "root")).alias("hub")
    ).filter("a <> b")
    hubs = stored(elected.select("band", *[F.col(f"hub.{c}").alias(f"hub_{c}") for c in ("node", "n", "root")]), "hubs")
    met = rooted.join(hubs, "band").filter((F.col("root") != F.col("hub_root")) & _sizes_fit("n", "hub_n", least))
    met = met.groupBy("node", "root", "hub_node", "hub_root").agg(F.count(F.lit(1)).alias("bands"))
    best = met.groupBy("node", "root").agg(F.max(F.struct("bands", "hub_node", "hub_root")).alias("best"))
    return best.select(
        F.col("node").alias("u"), F.col("best.hub_node").alias("v"), F.col("root").alias("a_root"), F.col("best.hub_root").alias("b_root")
    )


def _among_groups(rows: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """Rows (band, place, node, n) with root and members of the bands that hold several groups."""
    rooted = stored(rows.join(roots, "node").select("band", "place", "node", "n", "root"), "rooted-bands")
    members = F.count(F.lit(1)).alias("members")
    several = rooted.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b"), members).filter("a <> b")
    return stored(rooted.join(stored(several.select("band", "members"), "mixed-bands"), "band"), name)


def _own_shingles(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, own) for the given nodes: how many shingles of each no other of them has."""
    each = sets.join(nodes, "node", "left_semi").select("node", F.explode("shingles").alias("shingle"))
    alone = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node")).filter("c = 1")
    own = alone.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    return stored(nodes.join(own, "node", "left").select("node", F.coalesce("own", F.lit(0)).alias("own")), "own-shingles")


def _fingerprint_pairs(classes: DataFrame, least: float) -> DataFrame:
    """(u, v, a_root, b_root): each set with that of most copies among those whose fingerprints are tied to its own."""
    worded = classes.filter("n > 0")
    fps = stored(worded.groupBy("fp0").agg(F.sum("copies").alias("copies")), "fingerprints")
    tied = stored(fingerprint_classes(fps, NEAR_BITS, ["fp0"]), "fingerprint-classes").withColumnRenamed("node", "fp0")
    placed = stored(worded.select("node", "n", "copies", "fp0").join(tied, "fp0").drop("fp0"), "fingerprinted")
    tops = placed.groupBy("root").agg(F.max(F.struct("copies", "node", "n")).alias("top"), F.count(F.lit(1)).alias("sets"))
    tops = tops.filter("sets > 1").select("root", F.col("top.node").alias("v"), F.col("top.n").alias("v_n"))
    met = placed.join(tops, "root").filter((F.col("node") != F.col("v")) & _sizes_fit("n", "v_n", least))
    return met.select(F.col("node").alias("u"), "v", F.col("node").alias("a_root"), F.col("v").alias("b_root"))


def _pairs_across(among: DataFrame, own: DataFrame, maps: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """(u, v, a_root, b_root): candidates of different groups, each in the first band the two share."""
    # half of each band value tells which bands two sets share
    marks = classes.select("node", "bits0", "bits1", F.transform("bands", lambda b: F.shiftright(b, 32).cast("int")).alias("marks"))
    known = stored(marks.join(maps, "node").join(own, "node", "left"), "across-nodes")
    across = stored(among.drop("members").join(known, "node"), "across-bands")
    side = lambda p: across.select("band", *[F.col(c).alias(f"{p}_{c}") for c in across.columns if c != "band"])
    apart = sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in ("bits0", "bits1")), F.lit(0))
    first = F.array_position(F.zip_with("a_marks", "b_marks", lambda x, y: x == y), True) == F.col("a_place") + 1
    # m shared shingles give a similarity of m / (a + b - m); own ones are known to be missing if both sets were counted
    most = F.least(F.col("a_n") - F.col("a_own"), F.col("b_n") - F.col("b_own"))
    room = F.coalesce(most * (1 + least) >= (F.col("a_n") + F.col("b_n")) * least - 1e-6, F.lit(True))
    most = F.least(F.col("a_n") - _lacking("a_map", "b_map"), F.col("b_n") - _lacking("b_map", "a_map"))
    enough = most * (1 + least) >= (F.col("a_n") + F.col("b_n")) * least - 1e-6
    on = (F.col("a_root") < F.col("b_root")) & _sizes_fit("a_n", "b_n", least) & room & (apart <= FAR_BITS) & first & enough
    met = side("a").join(side("b").withColumnRenamed("band", "b_band"), (F.col("band") == F.col("b_band")) & on)
    return met.select(F.col("a_node").alias("u"), F.col("b_node").alias("v"), "a_root", "b_root")


def _roots(classes: DataFrame, marked: DataFrame, text: str, size: int, least: float) -> DataFrame:
    """(node, root) of the classes that share a band or have a near fingerprint with others; root names the component."""
    banded = classes.select("node", "n", "copies", F.posexplode("bands").alias("place", "band"))
    crowded = stored(banded.groupBy("band").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("band"), "crowded-bands")
    shared = stored(banded.join(crowded, "band"), "shared-bands")
    near = stored(_fingerprint_pairs(classes, least), "near-fingerprints")
    met = shared.select("node").unionByName(near.select(F.col("u").alias("node"))).unionByName(near.select(F.col("v").alias("node")))
    roots = stored(met.distinct().withColumn("root", F.col("node")), "roots")
    texts = marked.select("at", F.col("row").getField(text).alias("text"))
    named = classes.select("node", F.col("first.at").alias("at")).join(roots.select("node"), "node")
    with batches_of(marked.sparkSession, BATCH):
        sets = stored(_sets(texts.join(named, "at"), size), "shingle-sets")

    def tied(roots: DataFrame, found: DataFrame) -> DataFrame:
        links = _linked(stored(found, "pairs"), sets, least).select(F.col("a_root").alias("u"), F.col("b_root").alias("v"))
        return _merged(roots, links, "roots")

    roots = tied(roots, near)
    for turn in range(ROUNDS):
        rank = F.col("copies") if turn == 0 else F.xxhash64(F.lit(turn), "node")
        roots = tied(roots, _hub_pairs(shared.join(roots, "node"), rank, least))
    among = _among_groups(shared, roots, "among-groups")
    crowd = stored(among.filter(F.col("members") > CROWD), "crowd")
    own = _own_shingles(crowd.select("node").distinct(), sets)
    roots = tied(roots, _hub_pairs(crowd.join(own, "node"), -F.col("own") / F.col("n"), least))
    among = _among_groups(among.drop("root", "members"), roots, "still-among-groups")
    with batches_of(marked.sparkSession, BATCH):
        maps = stored(_maps(sets.join(among.select("node").distinct(), "node", "left_semi")), "shingle-maps")
    return tied(roots, _pairs_across(among, own, maps, classes, least))


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 5, least: float = 0.8
) -> DataFrame:
    """One document, that with the smallest id, of each component linked by Jaccard similarities of `least` or more.

    Texts of equal sets, also those without words (or null), are copies. A null id is never the smallest; of rows of equal
    id one stays.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    marked = _sketched(docs.select(row), docs.columns.index(text), shingle)
    with batches_of(docs.sparkSession, BATCH):
        marked = stored(marked.select("*", F.monotonically_increasing_id().alias("at")), "sketches")
    ident = F.col("row").getField(id_col)
    first = F.min(F.struct(ident.isNull().alias("no_id"), ident.alias("id"), "at")).alias("first")
    classes = marked.groupBy("k0", "k1").agg(
        first, F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"),
        *[F.first(c).alias(c) for c in ("bits0", "bits1", "fp0", "bands")],
    )
    classes = stored(classes.select("*", F.monotonically_increasing_id().alias("node")), "classes")
    roots = _roots(classes, marked, text, shingle, least)
    tied = stored(classes.select("node", "first").join(roots, "node"), "tied")
    tops = stored(tied.groupBy("root").agg(F.min("first").alias("top")), "tops")
    lost = tied.join(tops, "root").filter(F.col("first.at") != F.col("top.at")).select("node")
    gone = stored(lost, "lost").withColumn("gone", F.lit(True))
    copied = classes.filter("copies > 1").select("k0", "k1", "node", F.col("first.at").alias("keep"))
    # copies but the first of their class, and the first of each class that is tied to one of a smaller id
    extra = marked.select("k0", "k1", "at").join(copied, ["k0", "k1"]).filter("at <> keep").select("at")
    firsts = classes.select("node", F.col("first.at").alias("at")).join(gone, "node").select("at")
    return marked.join(stored(extra.unionByName(firsts), "dropped"), "at", "left_anti").select("row.*")
