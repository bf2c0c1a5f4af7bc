"""Helpers the training-data operators share: columns, folds, Arrow text buffers, hashes.

Conventions of every operator of this package:

* It reads the id and text columns it is told to and nothing else, so further
  columns, also of clashing names, never matter.
* A NULL text is an empty text. Rows are judged one by one: repeated rows give
  repeated results. A NULL id is a row without a name; operators that group by
  id say what happens to it.
* An empty table gives an empty result of the same schema.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import configure, shared_dir_or

# The white space of the contracts, ``[\x20\x09-\x0D]``.
WS_CLASS = r"[\x20\x09-\x0D]"
WS_CHARS = " \t\n\x0b\x0c\r"


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of a table; NULL texts become empty."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``. A NULL id counts as the empty text: fold 0."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- Arrow text buffers


def one(column) -> pa.Array:
    """A table or batch column as one array."""
    if isinstance(column, pa.ChunkedArray):
        if column.num_chunks == 1:
            return column.chunk(0)
        if column.num_chunks == 0:
            return pa.array([], column.type)
        return pa.concat_arrays(column.chunks)
    return column


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text or binary column without NULLs."""
    array = one(column)
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offsets, kind)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


def raw(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


# ---------------------------------------------------------------- word hashes

_CHUNK = 1 << 20  # bytes of text hashed at once; bounds the temporary arrays
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_BYTE = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the whole word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (A-Z lower-cased) of every text, and each text's first word.

    Words are maximal runs without white space. All texts of a batch are hashed
    with array operations, about a megabyte at a time.
    """
    n = len(offsets) - 1
    hashes, counts = [], []
    d0 = 0
    while d0 < n:
        d1 = max(d0 + 1, int(np.searchsorted(offsets, offsets[d0] + _CHUNK, "right")) - 1)
        lo = offsets[d0]
        b = _LOWER[data[lo : offsets[d1]]]
        bounds = offsets[d0 : d1 + 1] - lo
        if not len(b):
            counts.append(np.zeros(d1 - d0, np.int64))
            d0 = d1
            continue
        word = _IS_WORD[b]
        start = word.copy()
        start[1:] &= ~word[:-1]
        firsts = bounds[:-1][bounds[:-1] < len(b)]
        start[firsts] = word[firsts]
        at = np.flatnonzero(word)
        begins = np.flatnonzero(start)
        counts.append(np.diff(np.searchsorted(begins, bounds)))
        if len(begins):
            first = np.flatnonzero(start[at])
            lengths = np.diff(np.append(first, len(at)))
            k = np.arange(len(at)) - np.repeat(first, lengths)
            value = _BYTE[b[at]] * _powers(int(lengths.max()))[k]
            hashes.append(mix(np.add.reduceat(value, first) + lengths.astype(np.uint64)))
        d0 = d1
    words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    ends = np.cumsum(np.concatenate([[0], *counts])) if counts else np.zeros(1, np.int64)
    return words, ends.astype(np.int64)


def chain(*parts: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of equally long hash arrays."""
    out = np.full(len(parts[0]), len(parts), np.uint64)
    for part in parts:
        out = mix(out * _STEP + part)
    return out


# ---------------------------------------------------------------- Python workers

# Of the rows that Spark hands to Python at once. 10,000 documents, Spark's default, were 35 MB in each of the
# buffers of a task, in the JVM and in Python.
BATCH_BYTES = 4 << 20
KEPT: dict[str, object] = {}  # what the tasks of a step leave in their worker for its next ones


def release() -> None:
    """Forgets what an earlier step left in this worker, for tasks of steps that leave nothing.

    Workers outlive a step: without this they hold the caches of one through all later ones.
    """
    KEPT.clear()
    pa.default_memory_pool().release_unused()


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings, and a place for staged frames where the session names none.

    Python workers of one machine find this package where the driver did; a
    cluster gets it as Spark packages are given, with ``--py-files``.
    """
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    shared_dir_or(spark, "/tmp/checkpoints")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark
