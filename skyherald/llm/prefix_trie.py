"""Trie of the prefixes of conversations, from padded matrices of turn ids over range shards.

A turn's id is 127 bits of the SHA-256 of its role and text. Conversations are dealt by range of (their ids, conv_id), so that
a shard is a run of the sorted order. A shard's task sorts blocks of COLUMNS turns as padded matrices (`numpy.lexsort`);
the changes from row to row, OR-accumulated over the columns, give how many turns a row shares with the one before, and so
where nodes start. With the last row of the shard before and the first of the next one these lengths hold over the whole
order, so every number of a node is a sum over its rows, which `reduceat` takes at each depth:

* a row begins the nodes deeper than what it shares with the row before;
* a row ends a childless node if the next row does not go on from it;
* the sum of (members - 1) * bytes over a subtree is the bytes of all rows from the node's turn on, less the bytes of the
  nodes begun there.

Only nodes that go on in a neighbour shard are put together afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyherald.llm.common import stored

# columns of a matrix; rows (turns) a shard is planned for
COLUMNS, SHARD_ROWS, SHARD_TURNS = 32, 50_000, 1_000_000
# nodes of a shard: `node` names one that goes on in a neighbour shard, `parent` its parent if that does
NODE = (
    "node binary, depth long, parent binary, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, ends string, shard long"
)
NUMBERS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
RESULT = ("conv_id", "depth", "parent_conv_id", *NUMBERS, "ends_sha256")


# --- conversations as rows of turn ids -----------------------------------------------------------------------


def _half(digest: Column, first: int) -> Column:
    """16 hexadecimal digits as a long."""
    return F.conv(F.substring(digest, first, 16), 16, -10).cast("long")


def ordered(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turns<a, b, size>): each conversation's turns in order, as ids and bytes of their texts."""
    part = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    # the role's length keeps (role, text) apart from any other split of the same characters
    digest = F.sha2(F.concat(F.length(part(role)).cast("string"), F.lit(":"), part(role), part(text)), 256)
    named = turns.filter(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        digest.alias("digest"), F.octet_length(part(text)).cast("long").alias("size"),
    )
    in_order = F.array_sort(F.collect_list(F.struct("turn", "digest", "size")))
    bare = F.transform(in_order, lambda t: F.struct(
        _half(t["digest"], 1).bitwiseAND(F.lit((1 << 63) - 1)).alias("a"), _half(t["digest"], 17).alias("b"), t["size"].alias("size")
    ))
    return named.groupBy("conv_id").agg(bare.alias("turns"))


def rebuilt(convs: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of c - c % family; h = crc32(c) % most."""
    convs = convs.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int"))
    heads = convs.select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, most - 1).alias("head"))
    own = convs.withColumn("head_id", F.col("conv_id") - F.col("conv_id") % family)
    empty = F.array().cast("array<struct<a: bigint, b: bigint, size: bigint>>")
    rest = F.when(F.size("turns") > F.col("h"), F.slice("turns", F.col("h") + 1, F.size("turns"))).otherwise(empty)
    first = F.when(F.col("h") > 0, F.slice(F.coalesce("head", empty), F.lit(1), F.col("h"))).otherwise(empty)
    return own.join(heads, "head_id", "left").select("conv_id", F.concat(first, rest).alias("turns"))


def sharded(convs: DataFrame) -> DataFrame:
    """Conversations (conv_id, turns) with the number of their shard, and each shard's neighbours: rows of conv_id null with
    `side` -1 (last row of the shard before) or 1 (first row of the next)."""
    path = F.transform("turns", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b")))
    held = stored(convs.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes")), "conversations")
    n, turns = held.agg(F.count(F.lit(1)), F.sum(F.size("path"))).first()
    shards = max(int(held.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // SHARD_ROWS, (turns or 0) // SHARD_TURNS)
    dealt = held.repartitionByRange(int(shards), "path", "conv_id").withColumn("shard", F.spark_partition_id().cast("long"))
    rows = stored(dealt, "shards")
    ends = rows.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    order = Window.orderBy("shard")  # a row per shard
    near = ends.select("shard", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))
    near = near.select("shard", F.explode(F.array(
        F.struct(F.lit(-1).alias("side"), F.col("before").alias("path")), F.struct(F.lit(1).alias("side"), F.col("after").alias("path"))
    )).alias("n")).select("shard", "n.side", "n.path").filter("path is not null")
    none = F.lit(None)
    return rows.withColumn("side", F.lit(0)).unionByName(
        near.select(none.cast("long").alias("conv_id"), "path", none.cast("array<long>").alias("sizes"), "shard", "side"))


# --- a shard -------------------------------------------------------------------------------------------------


class Paths:
    """Rows of turn ids: row i has values a[first[i]:first[i + 1]], and b likewise."""

    def __init__(self, a: np.ndarray, b: np.ndarray, first: np.ndarray):
        self.a, self.b, self.first, self.size = a, b, first, np.diff(first)

    def padded(self, rows: np.ndarray, off: int) -> np.ndarray:
        """Turns off .. off + COLUMNS of the rows, two columns per turn; -1 (less than any `a`) beyond a row's end."""
        column = off + np.arange(COLUMNS)
        there = column[None, :] < self.size[rows][:, None]
        at = np.where(there, self.first[:-1][rows][:, None] + column[None, :], 0)
        out = np.empty((len(rows), 2 * COLUMNS), np.int64)
        out[:, ::2], out[:, 1::2] = np.where(there, self.a[at], -1), np.where(there, self.b[at], -1)
        return out

    def order(self, ties: np.ndarray) -> np.ndarray:
        """Rows in lexicographic order, equal ones by `ties`."""
        rank, off = np.zeros(len(self.size), np.int64), 0
        while len(rows := np.flatnonzero(self.size > off)):
            matrix = self.padded(rows, off)
            by = np.lexsort((*matrix.T[::-1], rank[rows]))
            fresh = np.ones(len(rows), bool)
            fresh[1:] = (np.diff(matrix[by], axis=0) != 0).any(axis=1) | (np.diff(rank[rows][by]) != 0)
            deeper = np.zeros(len(rank), np.int64)  # rows that have ended stay before those that go on
            deeper[rows[by]] = np.cumsum(fresh)
            by = np.lexsort((deeper, rank))
            fresh = np.zeros(len(rank), bool)
            fresh[1:] = (np.diff(rank[by]) != 0) | (np.diff(deeper[by]) != 0)
            rank[by] = np.cumsum(fresh)
            off += COLUMNS
        return np.lexsort((ties, rank))

    def shared(self, rows: np.ndarray) -> np.ndarray:
        """How many turns each of `rows` but the first shares with the row before it in `rows`."""
        out, off = np.zeros(max(len(rows) - 1, 0), np.int64), 0
        least = np.minimum(self.size[rows][1:], self.size[rows][:-1])
        while len(at := np.flatnonzero((out == off) & (least > off))):
            changed = self.padded(rows[at], off) != self.padded(rows[at + 1], off)
            apart = np.logical_or.accumulate(changed[:, ::2] | changed[:, 1::2], axis=1)
            out[at] += np.minimum((~apart).sum(axis=1), least[at] - off)
            off += COLUMNS
        return out

    def keys(self, row: int) -> list[bytes]:
        """A name for each prefix of a row, from the empty one on."""
        out = [b""]
        for k in range(self.first[row], self.first[row + 1]):
            turn = self.a[k].tobytes() + self.b[k].tobytes()
            out.append(hashlib.blake2b(out[-1] + turn, digest_size=16).digest())
        return out


def shard_nodes(ids: np.ndarray, paths: Paths, side: np.ndarray, sizes: np.ndarray, shard: int) -> Iterator[dict[str, list]]:
    """Columns of the shard's nodes, a depth at a time. `sizes` go with the paths' values."""
    before, after = (np.flatnonzero(side == s) for s in (-1, 1))
    order = paths.order(ids)
    rows = order[side[order] == 0]  # the neighbours stand at the ends, whatever ties there are
    shares = paths.shared(np.concatenate([before, rows, after]))
    no = np.array([-1], np.int64)
    shares = np.concatenate([no[: 1 - len(before)], shares, no[: 1 - len(after)]])
    back, ahead = shares[:-1], shares[1:]
    length, conv = paths.size[rows], ids[rows]
    leaf = (ahead < length).astype(np.int64)
    # bytes from each turn on to the row's end, with one more place at the end
    total = np.concatenate([[0], np.cumsum(sizes)])
    head, tail = paths.first[:-1][rows], paths.first[1:][rows]
    left = lambda r, d: total[tail[r]] - total[head[r] + np.minimum(d, length[r] + 1) - 1]
    first_keys, last_keys = paths.keys(rows[0]), paths.keys(rows[-1])
    node_of, least_of, open_of = None, None, None
    for depth in range(int(length.max(initial=0)) + 1):
        at = np.flatnonzero(length >= depth)
        starts = np.flatnonzero((back[at] < depth) | (at == 0))
        stops = np.concatenate([starts[1:], [len(at)]]) - 1
        add = lambda x: np.add.reduceat(x, starts)  # noqa: E731,B023
        least = np.minimum.reduceat(conv[at], starts)
        goes_on = ((at[starts] == 0) & (back[0] >= depth)) | ((at[stops] == len(rows) - 1) & (ahead[-1] >= depth))
        members = add(np.ones(len(at), np.int64))
        # a row's part in the subtree: its bytes from here on, less those of the nodes it begins
        from_here = max(depth, 1)
        saved = left(at, np.full(len(at), from_here)) - left(at, np.maximum(from_here, back[at] + 1))
        ended = length[at] == depth
        ends = [""] * len(starts)
        group = np.cumsum(np.bincount(starts, minlength=len(at))) - 1
        closing = np.flatnonzero(ended)
        for g in np.unique(group[closing]).tolist():
            lo, hi = np.searchsorted(group[closing], [g, g + 1])
            ends[g] = ",".join(map(str, sorted(conv[at[closing[lo:hi]]].tolist())))
        names = [None] * len(starts)
        for g in np.flatnonzero(goes_on).tolist():
            names[g] = (first_keys if at[starts[g]] == 0 else last_keys)[depth]
        if depth:
            up = node_of[at[starts]]
            above = list(zip(up.tolist(), open_of[up].tolist(), strict=True))
            # an open parent holds the shard's first or last row
            parents = [(first_keys if u == node_of[0] else last_keys)[depth - 1] if is_open else None for u, is_open in above]
            parent_conv = [None if is_open else int(least_of[u]) for u, is_open in above]
        else:
            parents, parent_conv = [None] * len(starts), [None] * len(starts)
        yield {
            "node": names, "depth": [depth] * len(starts), "parent": parents, "conv_id": least, "parent_conv_id": parent_conv,
            "n_convs": members, "n_children": add(((back[at] <= depth) & (length[at] > depth)).astype(np.int64)),
            "n_leaves": add(leaf[at]), "saved_tokens": add(saved),
            "ends_sha256": [None if n is not None else hashlib.sha256(e.encode()).hexdigest() for n, e in zip(names, ends, strict=True)],
            "ends": [e if n is not None else None for n, e in zip(names, ends, strict=True)], "shard": [shard] * len(starts),
        }
        node_of = np.full(len(rows), -1)
        node_of[at] = group
        least_of, open_of = least, goes_on


def _nodes(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    path, sizes = (table.column(c).combine_chunks() for c in ("path", "sizes"))
    first = np.concatenate([[0], np.cumsum(path.value_lengths().to_numpy())])
    values = path.flatten()
    a, b = (values.field(c).to_numpy() for c in ("a", "b"))
    side, ids = table.column("side").to_numpy(), table.column("conv_id").fill_null(0).to_numpy()
    given = np.zeros(len(a), np.int64)  # the neighbours come without sizes
    given[np.repeat(side == 0, np.diff(first))] = sizes.flatten().to_numpy()
    schema = pa.schema([
        (name, {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}[kind])
        for name, kind in (c.split() for c in NODE.split(", "))
    ])
    found = [pa.table(n, schema=schema) for n in shard_nodes(ids, Paths(a, b, first), side, given, key[0].as_py())]
    return pa.concat_tables(found)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, ends), those of a node in a run in shard order, as (node, ends_sha256)."""
    at, digest = None, None

    def closed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])

    for batch in batches:
        for node, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if node == at:
                digest.update(b"," + ends.encode())
                continue
            if digest is not None:
                yield closed()
            at, digest = node, hashlib.sha256(ends.encode())
    if digest is not None:
        yield closed()


def _put_together(found: DataFrame) -> DataFrame:
    """Nodes of all shards, those that go on from one to the next as one row each."""
    open_ = found.filter("node is not null")
    ends = open_.filter("ends <> ''").select("node", "shard", "ends").repartition("node").sortWithinPartitions("node", "shard")
    digests = ends.select("node", "ends").mapInArrow(_digests, "node binary, ends_sha256 string")
    whole = open_.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"),
        *[F.sum(c).alias(c) for c in NUMBERS],
    )
    none = hashlib.sha256().hexdigest()
    whole = stored(whole.join(digests, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none))), "open-nodes")
    parents = whole.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    below = found.filter("node is null and parent is not null").drop("parent_conv_id", "node", "shard", "ends")
    below = below.unionByName(whole.filter("parent is not null").drop("node")).join(parents, "parent")
    apart = found.filter("node is null and parent is null").unionByName(whole.filter("parent is null"), allowMissingColumns=True)
    return below.select(*RESULT).unionByName(apart.select(*RESULT))


def prefix_trie(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", rebuild: bool = True
) -> DataFrame:
    """A row per distinct sequence of first turns (role, text): the trie of all conversations.

    `conv_id` is the smallest of its members and, with `depth`, names the node; `parent_conv_id` is the parent's (null for
    the root); `n_convs` members, `n_children`, `n_leaves` in the subtree, `saved_tokens`, the bytes that storing each node of
    the subtree once saves, and the SHA-256 of the members that end at the node, by number, comma-joined.

    With `rebuild`, the first turns of a conversation are replaced by those of its family first (`rebuilt`).

    Turns are ordered by `turn` (null first), then by the digest of role and text; repeated rows are turns of their own.
    Null role and text are ''. Rows without conv_id are left out. Other columns play no part; an empty table has no nodes.
    """
    convs = ordered(turns, conv_id, turn, role, text)
    rows = sharded(rebuilt(convs) if rebuild else convs)
    return _put_together(stored(rows.groupBy("shard").applyInArrow(_nodes, NODE), "nodes"))
