"""SimHash near-duplicates by segment popcounts.

A text's fingerprint has a bit set where over half of its shingles' XXH64 values have it. Fingerprints within
`distance` bits link. They are embedded by the popcounts of their 32 two-bit segments: the Manhattan distance of two
embeddings is a lower bound of the fingerprints' distance. The embedding is cut into blocks of segments, enough of them
that some block of a linked pair is at most 1 apart; a block's values are a cell of a grid, and a range join pairs each
cell with itself and the neighbours 1 away. Candidates meet the lower bound over all segments, then the exact distance.

Only distinct fingerprints are joined, so copies are never paired. Before the pairwise join, each fingerprint is linked to
the near ones of its cells' few hubs; the join then only keeps links across the groups so far, as links of their roots, which leaves the components as they would be with all links, without all pairs of a dense group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyherald.llm.common import carried, released, stored
from skyherald.llm.components import components
from skyherald.llm.tokens import mixed, text_slices

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOW_BITS = 0x5555555555555555
HUBS = 8


def _joined(words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Lower-cased words one space apart, with the words' new places."""
    length = words.end - words.start
    start = np.cumsum(length + 1) - (length + 1)
    take = np.repeat(words.start - start, length + 1) + np.arange(int((length + 1).sum()))
    out = _LOWER[words.data[np.minimum(take, len(words.data) - 1)]]
    out[start + length] = 0x20
    return out.tobytes(), start, start + length


def fingerprints_of(words, shingle: int, longs: int = 1) -> np.ndarray:
    """Fingerprint of each row of a slice: `longs` values of 64 bits.

    The first has the bits of the shingles' XXH64 values, a second those of the values mixed once more.
    """
    n = np.diff(words.first)
    count = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    if not count.sum():
        return np.zeros((len(n), longs), dtype=np.uint64)
    text, start, end = _joined(words)
    first = np.repeat(words.first[:-1] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    last = first + np.repeat(np.minimum(n, shingle), count) - 1
    view, digest = memoryview(text), xxhash.xxh64_intdigest
    h = np.fromiter(
        (digest(view[a:b], 42) for a, b in zip(start[first].tolist(), end[last].tolist())), np.uint64, len(first)
    )
    out = np.zeros((len(n), longs), dtype=np.uint64)
    filled = np.flatnonzero(count)
    # blocks of shingles, so that the bit matrix stays small for a long text
    owner, block = np.repeat(np.arange(len(filled)), count[filled]), 1 << 16
    for k in range(longs):
        ones = np.zeros((len(filled), 64), dtype=np.int64)
        for lo in range(0, len(h), block):
            part = np.unpackbits(h[lo : lo + block].view(np.uint8), bitorder="little").reshape(-1, 64)
            rows = owner[lo : lo + block]
            heads = np.flatnonzero(np.diff(rows, prepend=-1))
            ones[rows[heads]] += np.add.reduceat(part, heads, axis=0, dtype=np.int64)
        most = 2 * ones > count[filled][:, None]
        out[filled, k] = np.packbits(most, axis=1, bitorder="little").view(np.uint64)[:, 0]
        h = mixed(h)
    return out


def fingerprinted(rows: DataFrame, shingle: int, longs: int = 1) -> DataFrame:
    """Carried rows (row, text) with the fingerprint as longs fp0..; a null or blank text has fingerprint zero."""
    names = [f"fp{k}" for k in range(longs)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [fingerprints_of(w, shingle, longs) for _, _, w in text_slices(batch.column("text"))]
            fp = np.concatenate(parts) if parts else np.zeros((0, longs), np.uint64)
            values = [pa.array(np.ascontiguousarray(fp[:, k]).view(np.int64)) for k in range(longs)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *values], names=["row", *names])

    kind = f"row {rows.schema['row'].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names)
    return rows.select("row", "text").mapInArrow(run, kind)


def embedding(fp: Column) -> Column:
    """Popcounts of the 32 two-bit segments, each in unary (00, 01, 11): Manhattan distance is a count of bits."""
    low = F.lit(_LOW_BITS)
    some = fp.bitwiseOR(F.shiftrightunsigned(fp, 1)).bitwiseAND(low)
    both = fp.bitwiseAND(F.shiftrightunsigned(fp, 1)).bitwiseAND(low)
    return some.bitwiseOR(F.shiftleft(both, 1))


def _blocks(distance: int, longs: int) -> list[tuple[int, int, int]]:
    """(long, first bit, bits) of the blocks: so many that one of a linked pair's is at most 1 apart, two per long at least."""
    each = max(2, -(-(distance // 2 + 1) // longs))
    cuts = [2 * (32 * i // min(each, 32)) for i in range(min(each, 32) + 1)]
    return [(k, a, b - a) for k in range(longs) for a, b in zip(cuts, cuts[1:], strict=False)]


def _neighbours(own: Column, bits: int) -> Column:
    """The cells 1 away: 0 <-> 1 flips a segment's low bit, allowed while its high bit is 0; 1 <-> 2 flips the high
    bit, allowed while the low bit is 1."""

    def moved(b: Column) -> Column:
        low = b % 2 == 0
        partner = F.call_function("getbit", own, F.when(low, b + 1).otherwise(b - 1)).cast("int")
        flipped = own.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))
        return F.when(partner == b % 2, flipped)

    return F.filter(F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), moved), lambda x: x.isNotNull())


def _cells(fps: DataFrame, distance: int, names: Sequence[str], around: bool) -> DataFrame:
    """One row per fingerprint, block and cell: the own cell, with `around` also the cells 1 away. A cell's number has
    its block's in the upper bits."""
    cells = []
    for block, (k, bit, bits) in enumerate(_blocks(distance, len(names))):
        e = embedding(F.col(names[k]))
        own = F.shiftrightunsigned(e, bit).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
        near = F.concat(F.array(own), _neighbours(own, bits)) if around else F.array(own)
        cells.append(_numbered(near, block))
    return fps.select("*", F.explode(F.flatten(F.array(*cells))).alias("cell"))


def _numbered(cells: Column, block: int) -> Column:
    return F.transform(cells, lambda c: c + F.lit(block << 40).cast("long"))


def _apart(a: str, b: str, names: Sequence[str], embedded: bool = False) -> Column:
    """Bits in which two fingerprints differ, or the Manhattan distance of their embeddings."""
    view = embedding if embedded else (lambda c: c)
    return sum((F.bit_count(view(F.col(a + n)).bitwiseXOR(view(F.col(b + n)))) for n in names), F.lit(0))


def _node(names: Sequence[str], prefix: str = "") -> Column:
    """A long that names a fingerprint: itself, or a hash of its longs."""
    return F.col(prefix + names[0]) if len(names) == 1 else F.xxhash64(*[prefix + n for n in names])


def _root_links(rooted: DataFrame, distance: int, sure: int, names: Sequence[str]) -> DataFrame:
    """Links between fingerprints of different groups so far, as distinct links of their roots: (u, v)."""
    side = lambda p, around: _cells(
        rooted.select(*[F.col(n).alias(p + n) for n in names], F.col("root").alias(p + "root")), sure,
        [p + n for n in names], around,
    ).withColumnRenamed("cell", p + "cell")
    bound = _apart("a_", "b_", names, embedded=True) <= distance
    exact = _apart("a_", "b_", names) <= distance
    on = (F.col("a_cell") == F.col("b_cell")) & (F.col("a_root") < F.col("b_root")) & bound & exact
    found = side("a_", True).join(side("b_", False), on)
    return found.select(F.col("a_root").alias("u"), F.col("b_root").alias("v")).distinct()


def _hub_links(fps: DataFrame, distance: int, sure: int, names: Sequence[str]) -> DataFrame:
    """Links (u, v) of fingerprints to the near ones among their cells' hubs.

    A cell has up to HUBS hubs: its fingerprints are dealt to so many classes, and the one with most copies of each class
    is a hub. In a dense group nearly every member is near some hub of its cells, so that few links tie the group together.
    """
    cells = _cells(fps, sure, names, around=False).withColumn("class", F.pmod(F.xxhash64(F.lit(11), *names), F.lit(HUBS)))
    hubs = stored(
        cells.groupBy("cell", "class").agg(F.max(F.struct("copies", *names)).alias("hub"))
        .select(F.col("cell").alias("h_cell"), *[F.col(f"hub.{n}").alias(f"h_{n}") for n in names]),
        "hubs",
    )
    plain = cells.select("cell", *[F.col(n).alias(f"f_{n}") for n in names])
    other = F.lit(False)
    for n in names:
        other = other | (F.col(f"f_{n}") != F.col(f"h_{n}"))
    near = plain.join(hubs, (F.col("cell") == F.col("h_cell")) & other & (_apart("f_", "h_", names) <= distance))
    return near.select(_node(names, "f_").alias("u"), _node(names, "h_").alias("v")).distinct()


def fingerprint_classes(fps: DataFrame, distance: int, names: Sequence[str], sure: int | None = None) -> DataFrame:
    """(node, root) for the distinct fingerprints; root names the component."""
    sure = distance if sure is None else sure
    first = components(_hub_links(fps, distance, sure, names))
    rooted = fps.withColumn("node", _node(names)).join(first, "node", "left")
    rooted = stored(rooted.select("node", *names, F.coalesce("root", "node").alias("root")), "rooted")
    merged = components(_root_links(rooted, distance, sure, names)).select(F.col("node").alias("root"), F.col("root").alias("top"))
    return rooted.select("node", "root").join(stored(merged, "merged-roots"), "root", "left").select(
        "node", F.coalesce("top", "root").alias("root")
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3,
    longs: int = 1, sure: int | None = None, carry: Sequence[str] | None = None,
) -> DataFrame:
    """Documents with `fingerprint` (hexadecimal), `component_id`, the smallest id reachable over links, and `stays`, true
    for one row of each component: one with that id.

    All links of up to `sure` bits (by default `distance`) are found. Beyond it, up to `distance`, a link is found if some
    block of its pair happens to be at most 1 apart: a smaller `sure` means fewer, larger blocks and far fewer candidates.

    A-Z are lower-cased, words are `[^\\x20\\x09-\\x0D]+`, shingles count as often as they occur; a text with fewer
    words is one shingle, one with none (also null) has fingerprint zero. Rows of equal id are each kept; ids that are
    null are never the smallest, and a component of null ids only has a null component_id.
    """
    carry = list(docs.columns if carry is None else carry)
    rows = carried(docs, id_col, text)
    held = F.struct(F.col(f"in_{id_col}").alias("id"), F.struct(*[F.col("row").getField(c).alias(c) for c in carry]).alias("doc"))
    names = [f"fp{k}" for k in range(longs)]
    marked = fingerprinted(rows.select(held.alias("row"), F.col(f"in_{text}").alias("text")), shingle, longs)
    at = F.monotonically_increasing_id().alias("at")
    marked = stored(marked.select(F.col("row.id").alias("id"), F.col("row.doc").alias("row"), at, *names), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "at"))
    least = stored(marked.groupBy(*names).agg(first.alias("least"), F.count(F.lit(1)).alias("copies")), "distinct")
    classes = stored(fingerprint_classes(least.select("copies", *names), distance, names, sure), "classes")
    rooted = least.withColumn("node", _node(names)).join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = stored(rooted, "roots")
    by_root = stored(rooted.groupBy("root").agg(F.min("least").alias("first")), "least-ids")
    per_fp = stored(rooted.join(by_root, "root").select(*names, "first"), "component-ids")
    joined = marked.join(per_fp, names).select("row", *names, "first", (F.col("at") == F.col("first.at")).alias("stays"))
    shown = F.concat(*[F.lower(F.lpad(F.hex(n), 16, "0")) for n in names])
    return released(joined, carry, {"fingerprint": shown, "component_id": F.col("first.id"), "stays": F.col("stays")})


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One document of each component (`stays`), with its own columns only."""
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    inner = docs.select(F.col(f"`{id_col}`").alias("id"), held, F.col("`text`").alias("text"))
    found = near_duplicates(inner, "id", "text", carry=["doc"], **options)
    return found.filter("stays").select("doc.*")
