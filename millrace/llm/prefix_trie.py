"""Prefix trie of conversations: sorted sequences, their LCPs, and range minima over them.

A turn is the 128-bit digest of its role and text, a conversation the digests of
its turns. Sorted, all conversations that share their first ``d`` turns lie next
to each other: a trie node is an interval of the sorted order in which adjacent
conversations share at least ``d`` turns. ``lcp[i]`` is what conversation ``i``
shares with the one before it. Every candidate prefix (``i``, ``d``) searches the ends of
its interval to the left and to the right, each by a binary search over a sparse
table of range minima of ``lcp``; no search depends on another one, and all of a
block run as array operations.

What a node tells is a sum over its interval: members, leaves, children, and

    saved(node) = sum of bytes(lcp[i] first turns of i) - (members - 1) * bytes(d - 1 first turns)

over its conversations but the first, which is the sum of ``(members - 1) * bytes``
over its subtree. So the sorted order is cut into blocks of a bounded number of
turns. Nodes inside a block are final there. A node that crosses a block's edge
is at most as deep as the two conversations at the edge share, so a block has few
of them; their parts are added up by Spark, and the blocks are read once more to name the
parents of their own nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import one
from millrace.session import stage

BLOCK_TURNS = 1 << 18
_WIDTH = 16  # bytes of a turn's digest
_NOTHING = hashlib.sha256(b"").hexdigest()

NODES = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
PARTS = (
    "block int, place int, depth bigint, key binary, parent_key binary, conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, shared bigint, above bigint, ends string"
)
_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in (c.split() for c in ddl.split(", "))])


# ---------------------------------------------------------------- conversations as sequences


def sequences(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as (turn, digest, bytes).

    NULL turns come first; equal ones are ordered by digest, so repeated rows are
    repeated turns. A NULL role or text is empty. Turns of a NULL conversation belong
    to none and are left out. Texts are read once and go no further than this.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    turns = conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), digest.alias("digest"), F.octet_length(text).alias("bytes")).alias("t"),
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def regrafted(own: DataFrame, group: int = 5, most: int = 8) -> DataFrame:
    """Conversations with the first ``h`` turns of their group's first one in place of their own.

    The group of ``c`` begins at ``c - c % group``; ``h`` is the crc32 of ``c`` as text modulo
    ``most + 1``. A group without its first conversation gives no turns.
    """
    heads = own.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("head_id"), F.slice("turns", 1, most).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    joined = own.withColumn("h", h).join(heads, F.col("conv_id") - F.col("conv_id") % group == F.col("head_id"), "left")
    taken = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return joined.select("conv_id", F.concat(taken, rest).alias("turns"))


# ---------------------------------------------------------------- one block


def adjacent_lcps(digests: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Turns that each sequence but the first shares with the one before it."""
    lengths = np.diff(offsets)
    m = np.minimum(lengths[:-1], lengths[1:])
    out = m.copy()
    some = np.flatnonzero(m)
    if len(some):
        sizes = m[some]
        starts = np.cumsum(sizes) - sizes
        k = np.arange(sizes.sum()) - np.repeat(starts, sizes)
        same = (digests[np.repeat(offsets[some], sizes) + k] == digests[np.repeat(offsets[some + 1], sizes) + k]).all(axis=1)
        out[some] = np.minimum.reduceat(np.where(same, np.repeat(sizes, sizes), k), starts)
    return out


class RangeMinimum:
    """Sparse table: minima of all spans of 2**k values."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Minimum of values ``a .. b`` inclusive, from two spans that may overlap."""
        k = np.frexp((b - a + 1).astype(np.float64))[1] - 1
        out = np.empty(len(a), self.levels[0].dtype)
        for level in np.unique(k):
            at = k == level
            out[at] = np.minimum(self.levels[level][a[at]], self.levels[level][b[at] - (1 << int(level)) + 1])
        return out

    def reach_right(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """For each place, the last one reached over values >= ``least`` (value ``i`` joins ``i - 1`` and ``i``)."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            inside = at + 1 < len(level)
            ok = inside & (level[np.where(inside, at + 1, 0)] >= least)
            at[ok] += 1 << k
        return at

    def reach_left(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first place reached, as ``reach_right``."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            start = at - (1 << k) + 1
            ok = (start >= 1) & (self.levels[k][np.maximum(start, 0)] >= least)
            at[ok] -= 1 << k
        return at


class Block:
    """All nodes that have members among consecutive sorted conversations.

    ``before`` and ``after`` are the sequences next to the block, None at an end.
    A node is (``place``, ``depth``): its first member here. ``left`` and ``right`` mark
    nodes that go on beyond the block.
    """

    def __init__(self, rows: list[tuple[bytes, int, list[int]]], before: bytes | None, after: bytes | None):
        rows = sorted(rows, key=lambda r: r[:2])
        self.seqs = [r[0] for r in rows]
        ids = np.array([r[1] for r in rows], np.int64)
        n = len(rows)
        lengths = np.array([len(s) // _WIDTH for s in self.seqs], np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        digests = np.frombuffer(b"".join(self.seqs), np.uint64).reshape(-1, 2)
        lcp = np.empty(n, np.int64)
        lcp[0] = -1 if before is None else _lcp(before, self.seqs[0])
        lcp[1:] = adjacent_lcps(digests, offsets)
        last = -1 if after is None else _lcp(self.seqs[-1], after)
        following = np.append(lcp[1:], last)

        # Candidates: prefixes a conversation doesn't share with the one before it, and
        # those that the block's first one shares with the block before.
        low = lcp + 1
        low[0] = 0
        each = lengths - low + 1
        first = np.cumsum(each) - each
        self.place = np.repeat(np.arange(n), each)
        self.depth = np.arange(each.sum()) - np.repeat(first, each) + np.repeat(low, each)
        joins = RangeMinimum(lcp)
        left = joins.reach_left(self.place, self.depth)
        right = joins.reach_right(self.place, self.depth)

        def node(place, depth):
            return first[place] + depth - low[place]

        # A prefix's parent is one turn shorter: of the same conversation, or, where that one is
        # shared, at the left end of the shared prefix's interval.
        up = np.maximum(self.depth - 1, 0)
        self.parent = node(joins.reach_left(self.place, up), up)
        self.root = self.depth == 0

        counted = np.cumsum(np.concatenate([[0], following < lengths]))  # ends of maximal sequences
        cum = np.concatenate([[0], np.cumsum(np.array([b for r in rows for b in r[2]], np.int64))])
        shared = np.where(lcp > 0, cum[offsets[:-1] + np.maximum(lcp, 0)] - cum[offsets[:-1]], 0)
        shared = np.cumsum(np.concatenate([[0], shared]))
        self.left = (self.place == 0) & (self.depth <= lcp[0])
        self.right = (right == n - 1) & (self.depth <= last)
        self.n_convs = right - left + 1
        self.n_leaves = counted[right + 1] - counted[left]
        self.shared = shared[right + 1] - np.where(self.left, shared[left], shared[left + 1])
        self.above = cum[offsets[self.place] + up] - cum[offsets[self.place]]
        self.conv_id = RangeMinimum(ids).least(left, right)
        # A child is counted where it begins.
        begun = ~self.left & ~self.root
        self.n_children = np.bincount(self.parent[begun], minlength=len(self.place))

        same = np.zeros(n, bool)
        same[1:] = (lcp[1:] == lengths[1:]) & (lengths[1:] == lengths[:-1])
        runs = np.flatnonzero(~same)
        self.ends = {}
        for a, b in zip(runs, [*runs[1:], n]):
            self.ends[int(node(a, lengths[a]))] = ",".join(map(str, ids[a:b].tolist()))

    def key(self, k: int, shorter: int = 0) -> bytes:
        """Digest of a node's prefix."""
        return hashlib.md5(self.seqs[self.place[k]][: _WIDTH * (int(self.depth[k]) - shorter)]).digest()

    def parts(self, block: int) -> pa.Table:
        """What the block knows of nodes that go on beyond it."""
        at = np.flatnonzero(self.left | self.right)
        columns = {
            "block": np.full(len(at), block, np.int32), "place": self.place[at].astype(np.int32), "depth": self.depth[at],
            "key": [self.key(k) for k in at], "parent_key": [None if self.root[k] else self.key(k, 1) for k in at],
            "conv_id": self.conv_id[at], "n_convs": self.n_convs[at], "n_children": self.n_children[at],
            "n_leaves": self.n_leaves[at], "shared": self.shared[at], "above": self.above[at],
            "ends": [self.ends.get(int(k)) for k in at],
        }
        return pa.table(columns, schema=_schema(PARTS))

    def nodes(self, crossing: dict[tuple[int, int], int]) -> pa.Table:
        """The nodes inside the block; ``crossing`` names the others by (place, depth)."""
        names, out = self.conv_id.copy(), self.left | self.right
        for k in np.flatnonzero(out):
            names[k] = crossing[int(self.place[k]), int(self.depth[k])]
        at = np.flatnonzero(~out)
        ends = [hashlib.sha256(self.ends[k].encode()).hexdigest() if k in self.ends else _NOTHING for k in at.tolist()]
        columns = {
            "conv_id": self.conv_id[at], "depth": self.depth[at],
            "parent_conv_id": pa.array(names[self.parent[at]], mask=self.root[at]), "n_convs": self.n_convs[at],
            "n_children": self.n_children[at], "n_leaves": self.n_leaves[at],
            "saved_tokens": self.shared[at] - (self.n_convs[at] - 1) * self.above[at], "ends_sha256": ends,
        }
        return pa.table(columns, schema=_schema(NODES))


def _lcp(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b)) // _WIDTH
    return next((k for k in range(n) if a[_WIDTH * k : _WIDTH * (k + 1)] != b[_WIDTH * k : _WIDTH * (k + 1)]), n)


def _block(table: pa.Table, edges: pa.Table) -> Block:
    rows = zip(*(table.column(c).to_pylist() for c in ("seq", "conv_id", "weights")))
    return Block(list(rows), edges.column("before")[0].as_py(), edges.column("after")[0].as_py())


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ends_sha256) of parts sorted by key and block; a part is hashed and forgotten."""
    key = digest = None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])

    for batch in batches:
        for k, ends in zip(one(batch.column("key")).to_pylist(), one(batch.column("ends")).to_pylist()):
            if k != key:
                if key is not None:
                    yield done()
                key, digest = k, hashlib.sha256(ends.encode())
            else:
                digest.update(b"," + ends.encode())
    if key is not None:
        yield done()


# ---------------------------------------------------------------- all blocks


def prefix_trie(convs: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Nodes of the trie over (conv_id, turns): columns ``NODES``, one row per distinct prefix.

    ``turns`` are structs with ``digest`` (32 hex digits) and ``bytes``, as ``sequences`` gives them.
    A conversation without turns is a member of the root only. Without conversations
    there is no node. A conversation's digests are one row (a few tens of bytes a turn);
    ids of equal conversations are hashed as a stream of block-sized parts.
    """
    rows = stage(
        convs.select(
            "conv_id",
            F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("seq"),
            F.transform("turns", lambda t: t["bytes"]).alias("weights"),
        ),
        "sequences",
    )
    turns = rows.agg(F.sum(F.size("weights") + 1)).first()[0] or 0
    # Equal sequences are cut by id, so a hot conversation spreads over blocks.
    ranged = rows.repartitionByRange(int(turns) // block_turns + 1, "seq", "conv_id")
    placed = stage(ranged.withColumn("block", F.spark_partition_id()), "sorted")

    # One row per block, some hundred thousand times fewer than there are turns.
    sides = Window.orderBy("block")
    edges = placed.groupBy("block").agg(F.min("seq").alias("low"), F.max("seq").alias("high"))
    edges = stage(edges.select("block", F.lag("high").over(sides).alias("before"), F.lead("low").over(sides).alias("after")), "edges")

    def parts(table: pa.Table, edges: pa.Table) -> pa.Table:
        return _block(table, edges).parts(edges.column("block")[0].as_py())

    def nodes(table: pa.Table, edges: pa.Table) -> pa.Table:
        crossing = edges.column("crossing")[0].as_py() or ()
        return _block(table, edges).nodes({(c["place"], c["depth"]): c["conv_id"] for c in crossing})

    crossing = stage(placed.groupBy("block").cogroup(edges.groupBy("block")).applyInArrow(parts, PARTS), "parts")
    added: list[Column] = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "shared")]
    merged = stage(
        crossing.groupBy("key", "parent_key", "depth", "above").agg(F.min("conv_id").alias("conv_id"), *added), "crossing"
    )
    ends = crossing.filter("ends IS NOT NULL").select("key", "block", "ends")
    hashed = ends.repartition("key").sortWithinPartitions("key", "block").drop("block").mapInArrow(_hash_ends, "key binary, ends_sha256 string")
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    across = merged.join(parents, "parent_key", "left").join(hashed, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("shared") - (F.col("n_convs") - 1) * F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"),
    )

    named = crossing.select("block", "place", "depth", "key").join(merged.select("key", "conv_id"), "key")
    named = named.groupBy("block").agg(F.collect_list(F.struct("place", "depth", "conv_id")).alias("crossing"))
    known = edges.join(named, "block", "left")
    inside = placed.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(nodes, NODES)
    return inside.unionByName(across)
