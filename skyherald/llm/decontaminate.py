"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are normalised (lower case, runs of other than letters and digits are one space). An item of m
characters may be matched with k = floor(error_rate * m) edits anywhere in a document. Cut into k + 1 pieces, at
least one piece of a matched item is free of edits, so an exact multi-pattern search (Aho-Corasick) for all pieces finds
every place worth a look; the stretch around it is verified with Myers' bit-parallel edit distance. Items too short for an edit
(k = 0) are only found as whole words, so that "yes" is not found in "eyes".

Items are searched in blocks of at most `block_chars` characters: a block, not the benchmark, is what a task holds and
what the driver sends. Every document is scanned in full against every block. One block is one pass over the documents,
which are not shuffled. With more, each block is a job of its own that writes only what it finds, under the SHA-256 of the
text; a text's finds of all blocks, once however many copies it has, then join the documents by it.

Defined results: null and empty texts match nothing, items that are null or without a letter or digit are never matched;
equal rows and equal items each count; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from skyherald.llm.common import carried, released, stored

ERROR_RATE = 0.08
BLOCK_CHARS = 4_000_000
_OTHER = re.compile(r"[\W_]+")


def normal(text: str | None) -> str:
    return _OTHER.sub(" ", (text or "").lower()).strip()


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece) of budget + 1 pieces of nearly equal length."""
    count = budget + 1
    cuts = [len(item) * i // count for i in range(count + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def peq(pattern: str) -> dict[str, int]:
    """For each character the bit set of its places in the pattern."""
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def myers(eq: dict[str, int], m: int, text: str, anchored: bool = False) -> tuple[int, int]:
    """(least distance, end) of the pattern over all substrings of text, or over its prefixes if anchored.

    Bit i of the vertical delta vectors says whether the distance grows or falls from pattern prefix i to i + 1; a
    column of the edit matrix is one step on integers of m bits. The first end of the least distance is returned.
    """
    ones, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = ones, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        e = eq.get(c, 0)
        diagonal = (((e & up) + up) ^ up) | e | down
        rise = (down | ~(diagonal | up)) & ones
        fall = up & diagonal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise = (rise << 1 | anchored) & ones
        fall = (fall << 1) & ones
        up = (fall | ~(diagonal | rise)) & ones
        down = rise & diagonal
        if score < best:
            best, end = score, j
    return best, end


def whole_words(text: str, start: int, end: int) -> bool:
    """Whether a stretch of a normalised text begins and ends with a word."""
    return (start == 0 or text[start - 1] == " ") and (end == len(text) or text[end] == " ")


class Block:
    """Pieces of a block of items in one automaton."""

    def __init__(self, items: Sequence[tuple[object, str]], error_rate: float):
        self.items = []
        at: dict[str, list[tuple[int, int]]] = {}
        for key, raw in items:
            text = normal(raw)
            if not text:
                continue
            budget = int(error_rate * len(text))
            self.items.append((key, text, budget, peq(text)))
            for offset, piece in pieces(text, budget):
                at.setdefault(piece, []).append((len(self.items) - 1, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in at.items():
            self.automaton.add_word(piece, (len(piece), places))
        if at:
            self.automaton.make_automaton()

    def search(self, text: str) -> list[tuple[object, int, int, int]]:
        """(item, distance, start, end) in the normalised text: per item the closest match, the first of several."""
        found: dict[int, tuple[int, int]] = {}
        tried = set()
        if not self.items:
            return []
        for last, (size, places) in self.automaton.iter(text):
            for i, offset in places:
                begin = last + 1 - size - offset
                if (i, begin) in tried:
                    continue
                tried.add((i, begin))
                key, item, budget, eq = self.items[i]
                if not budget and not whole_words(text, begin, begin + len(item)):
                    continue
                low = max(0, begin - budget)
                distance, end = myers(eq, len(item), text[low : begin + len(item) + budget])
                if distance <= budget and (distance, low + end) < found.get(i, (budget + 1, 0)):
                    found[i] = (distance, low + end)
        out = []
        for i, (distance, end) in sorted(found.items()):
            key, item, budget, _ = self.items[i]
            stretch = text[max(0, end - len(item) - budget) : end][::-1]
            _, length = myers(peq(item[::-1]), len(item), stretch, anchored=True)
            out.append((key, distance, end - length, end))
        return out


def _kind(key_type: pa.DataType) -> pa.DataType:
    return pa.list_(pa.struct([("item_id", key_type), ("distance", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))


def _matches(block: Block, text: str | None) -> list[dict]:
    return [dict(zip(("item_id", "distance", "start", "end"), h, strict=True)) for h in block.search(normal(text))]


def _scan(items: list[tuple[object, str]], error_rate: float, key_type: pa.DataType):
    """The rows with their matches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(items, error_rate)
        for batch in batches:
            out = [_matches(block, text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, _kind(key_type))], names=["row", "matches"])

    return run


def _finds(items: list[tuple[object, str]], error_rate: float, key_type: pa.DataType):
    """Of the texts with a match the digest and the matches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(items, error_rate)
        for batch in batches:
            digests, out = [], []
            for value in batch.column("text"):
                text = value.as_py()
                hits = _matches(block, text)
                if hits:
                    digests.append(hashlib.sha256(text.encode()).hexdigest())
                    out.append(hits)
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.string()), pa.array(out, _kind(key_type))], names=["digest", "found"])

    return run


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS, carry: Sequence[str] | None = None,
) -> DataFrame:
    """Documents with `contaminated` and `matches`: item_id, distance, start and end in the normalised text."""
    carry = list(docs.columns if carry is None else carry)
    items = benchmark.select(F.col(f"`{item_id}`").alias("id"), F.col(f"`{item_text}`").alias("t")).filter("t is not null")
    id_kind = items.schema["id"].dataType
    total = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-2 * int(total) // block_chars))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("id", "t"), F.lit(blocks)))
    rows = carried(docs, text)
    held = F.struct(*[F.col("row").getField(c).alias(c) for c in carry]).alias("row")
    match_kind = f"array<struct<item_id: {id_kind.simpleString()}, distance: int, start: long, end: long>>"
    found = rows.select(held, F.col(f"in_{text}").alias("text"))

    def items_of(b: int) -> list[tuple[object, str]]:
        # about half a block's characters; the list is of that size, whatever the benchmark's
        return sorted(((r["id"], r["t"]) for r in dealt.filter(F.col("block") == b).collect()), key=str)

    if blocks == 1:
        row_kind = f"row {found.schema['row'].dataType.simpleString()}, matches {match_kind}"
        found = found.mapInArrow(_scan(items_of(0), error_rate, to_arrow_type(id_kind)), row_kind)
    else:
        dealt, parts = stored(dealt, "benchmark-blocks"), []
        for b in range(blocks):
            scan = _finds(items_of(b), error_rate, to_arrow_type(id_kind))
            hits = found.select("text").mapInArrow(scan, f"digest string, found {match_kind}")
            parts.append(stored(hits.withColumn("block", F.lit(b)), "benchmark-finds"))
        # copies of a text find the same: one row per text and block, at most `blocks` rows per text
        once = reduce(DataFrame.union, parts).dropDuplicates(["digest", "block"])
        of_text = once.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("block", "found"))).alias("blocks"))
        of_text = of_text.select("digest", F.flatten(F.transform("blocks", lambda x: x["found"])).alias("found"))
        joined = found.withColumn("digest", F.sha2("text", 256)).drop("text").join(of_text, "digest", "left")
        found = joined.select("row", F.coalesce("found", F.array().cast(match_kind)).alias("matches"))
    return released(found, carry, {"contaminated": F.size("matches") > 0, "matches": F.col("matches")})


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents in which no item is found, with their own columns only."""
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{text}`").alias("text"))
    return find_contamination(inner, benchmark, carry=["doc"], **options).filter("not contaminated").select("doc.*")
