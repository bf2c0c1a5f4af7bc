"""Documents packed into blocks of a bounded number of text bytes, one compressed row each.

A block is what one task holds at a time. Its rows follow each other in the table;
a text longer than a block is a block of its own. Blocks are as many as the text needs,
whatever the number of partitions. They are written once: every later pass reads
the same blocks, also after a lost executor, and a pass that must bring something to a
block moves one compressed row, not its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import one, release, utf8
from millrace.session import stage

BLOCK_BYTES = 4 << 20
_PACKED = "block bigint, n_bytes bigint, packed binary"
_IN_TASK = 1 << 32  # blocks of one task at most
_ROW_BYTES = 64  # that a row counts beside its text, so that empty texts fill blocks too


def pack_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, text_col: str = "text") -> DataFrame:
    """(block, n_bytes, packed) of all rows with all their columns; ``text_col`` has no NULL."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        number = TaskContext.get().partitionId() * _IN_TASK
        parts, size = [], 0

        def done() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                for part in parts:
                    writer.write_batch(part)
            columns = [pa.array([number], pa.int64()), pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["block", "n_bytes", "packed"])

        for batch in batches:
            _, ends = utf8(batch.column(batch.schema.get_field_index(text_col)))
            ends = ends + _ROW_BYTES * np.arange(len(ends))
            a = 0
            while a < batch.num_rows:
                # As many rows as still fit, at least one into an empty block.
                b = int(np.searchsorted(ends, ends[a] + block_bytes - size, "right")) - 1
                if b > a or not parts:
                    b = max(b, a + 1)
                    # Copied, so that no more of the batch is kept than this.
                    parts.append(batch.take(pa.array(np.arange(a, b))))
                    size += int(ends[b] - ends[a])
                    a = b
                if a < batch.num_rows or size >= block_bytes:
                    yield done()
                    parts, size, number = [], 0, number + 1
        if parts:
            yield done()

    return stage(docs.mapInArrow(pack, _PACKED), "blocks")


def text_bytes(blocks: DataFrame) -> int:
    return int(blocks.agg(F.sum("n_bytes")).first()[0] or 0)


def unpacked(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, pa.Table]]:
    """(block, its rows) of every packed row."""
    for block, packed in zip(one(table.column("block")).to_pylist(), one(table.column("packed"))):
        yield block, pa.ipc.open_stream(packed.as_buffer()).read_all()
