"""Best-fit-decreasing packing of token sequences into windows.

Documents are encoded once; a document longer than a window is first cut into
full windows, which are sequences of their own. What is left of each document
is packed best-fit decreasing: pieces by falling length, each into the open
window with the least room that still holds it. A segment tree over the
possible rooms (one leaf per number of free tokens) finds that window in
logarithmic time, with one entry per room instead of a search over windows.

Only lengths are packed. Pieces are dealt into shards of a bounded number of
tokens by hash, so shards are packed independently and every shard leaves at most a
few windows unfilled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import release, texts
from millrace.llm.tokens import crc, encoded
from millrace.session import stage

SHARD_TOKENS = 1 << 20

_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
_PIECE_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in _PIECES.split(", ")])
_PLACED_ARROW = pa.schema([*_PIECE_ARROW, ("sequence_id", pa.int64()), ("offset", pa.int64())])


class OpenWindows:
    """Open windows by room, over a segment tree that knows which rooms are taken."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()  # leaves 0 .. capacity
        self.tree = [0] * (2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.tree[node] += by
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The window of least room >= need, no longer open, and its room."""
        node = need + self.size
        if not self.tree[node]:
            # Up to the first subtree to the right that has a window, then down its left edge.
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.tree[2 * node] else 2 * node + 1
        room = node - self.size
        window = self.windows[room].pop()
        self._change(room, -1)
        return window, room


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Window and offset of every piece, pieces given by falling length."""
    open_windows, windows, offsets, n = OpenWindows(capacity), [], [], 0
    for length in lengths:
        found = open_windows.take(length)
        if found is None:
            found, n = (n, capacity), n + 1
        window, room = found
        windows.append(window)
        offsets.append(capacity - room)
        if room > length:
            open_windows.add(room - length, window)
    return windows, offsets


def pieces(docs: DataFrame, vocabulary: str, window: int, keep_ids: bool) -> DataFrame:
    """Encoded documents cut into full windows and a rest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded(vocabulary, batch.column("text"))):
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start : 4 * (start + window)]
                    rows.append((doc_id, start, len(part) // 4, crc(part), total, part))
            columns = list(zip(*rows)) if rows else [()] * 6
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
            names = list(_PIECE_ARROW.names)
            if keep_ids:
                arrays.append(pa.array([np.frombuffer(x, np.uint32).astype(np.int32) for x in columns[5]], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.mapInArrow(cut, _PIECES + (", ids array<int>" if keep_ids else ""))


def pack(
    docs: DataFrame,
    vocabulary: str,
    window: int = 4096,
    shard_tokens: int = SHARD_TOKENS,
    keep_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]) per piece.

    Every token of every document, with its end id, lies in one piece. A NULL or
    empty text is its end id alone; repeated rows are packed each. Sequence ids
    are unique and not gapless. ``sequences`` turns pieces with ids into windows.
    """
    cut = stage(pieces(texts(docs, id_col, text_col), vocabulary, window, keep_ids), "pieces")
    tokens = cut.agg(F.sum("length")).first()[0] or 0
    shards = int(tokens) // shard_tokens + 1

    def place(table: pa.Table) -> pa.Table:
        release()
        shard = table.column("shard")[0].as_py()
        length = table.column("length").to_numpy()
        order = np.lexsort((table.column("ids_crc32").to_numpy(), table.column("start").to_numpy(), -length))
        windows, offsets = best_fit_decreasing(length[order].tolist(), window)
        table = table.take(pa.array(order)).drop_columns(["shard"])
        ids = np.array(windows, np.int64) + (np.int64(shard) << np.int64(32))
        return table.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets, pa.int64()))

    schema = _PIECES + (", ids array<int>" if keep_ids else "") + ", sequence_id bigint, offset bigint"
    shard = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shards)).cast("int")
    placed = cut.withColumn("shard", shard).groupBy("shard").applyInArrow(place, schema)
    return placed.select(*_PLACED_ARROW.names, *(["ids"] if keep_ids else []))


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, starts): the windows of ``pack(keep_ids=True)``, unpadded."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("starts")
    )
