"""Importance resampling towards a target: hashed word features, array scores, radix-sorted draws.

Words are hashed into a fixed number of buckets. A bucket's gain is the logarithm
of its share in the target over its share in the corpus, in whole thousandths; the gains are
one array, and a text's weight is the sum of the array at its words' buckets.
Gumbel noise from a hash of the id makes the largest scores a draw without replacement.

The draw is a distributed least-significant-digit radix sort. Rows have a position;
positions are cut into chunks of a fixed number of rows. A pass takes the next digit of the
composite key (score falling, then id) from the low end:

* every chunk counts its digits,
* the counts, in order of digit and then of chunk, are summed up to what lies before each
  (digit, chunk): first over the digits, a table of one row a digit, then within each
  digit over the chunks,
* a chunk's rows, in order of position, take the next free places of their digit
  there. That is a stable counting sort, and the place is the row's new position.

After the pass over the highest digit the position is the rank. A chunk is
bounded whatever the keys, so equal scores, equal ids and hot digits make no
larger task; positions are written with the rows, so a task run again finds
the same places.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import one, texts
from millrace.session import stage

CHUNK_ROWS = 1 << 18
DIGIT_BITS = 12
CACHE_WORDS = 1_000_000  # words whose bucket a worker keeps; beyond that the cache starts anew

# What separates words; A-Z are lower-cased, all bytes from 0x80 on belong to words.
_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_TABLE = bytes(0x20 if b in _SEPARATORS else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))


class _Buckets(dict):
    """word -> bucket, filled as words are met."""

    def __init__(self, buckets: int, size: int):
        super().__init__()
        self.buckets, self.n = buckets, size

    def __missing__(self, word: bytes) -> int:
        found = zlib.crc32(word) % self.buckets
        if len(word) < 100:
            self[word] = found
        return found

    def of(self, text: str) -> tuple[int, np.ndarray]:
        """Words of a text, and the buckets of all its runs of 1 to ``n`` words, repeats included."""
        words = text.encode().translate(_TABLE).split()
        if len(self) > CACHE_WORDS:
            self.clear()
        runs = [words, *([b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] for k in range(2, self.n + 1))]
        return len(words), np.fromiter((b for run in runs for b in map(self.__getitem__, run)), np.int64)


def bucket_counts(docs: DataFrame, buckets: int, size: int) -> np.ndarray:
    """How many features of the whole table fall into each bucket: at most ``buckets`` rows to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = _Buckets(buckets, size), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in one(batch.column("text")).to_pylist():
                total += np.bincount(own.of(text)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    counted = docs.select("text").mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counted.collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of (target share / source share), one added to each bucket."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    ratio = [(t + 1) * (s_all + n) / ((s + 1) * (t_all + n)) for s, t in zip(source.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, size: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Buckets(len(gain), size)
        for batch in batches:
            found = [own.of(t) for t in one(batch.column("text")).to_pylist()]
            columns = [(n, len(f), int(gain[f].sum())) for n, f in found]
            arrays = [pa.array(c, pa.int64()) for c in (zip(*columns) if columns else [()] * 3)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "n_words", "n_features", "weight"])

    return docs.mapInArrow(score, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


# ---------------------------------------------------------------- radix sort


def digit_passes(high_bits: int, low_bits: int, width: int = DIGIT_BITS) -> list[tuple[str, int, int]]:
    """(word of the key, shift, bits) of every pass, lowest digit first, digits of nearly equal width."""
    out = []
    for word, bits in (("low", low_bits), ("high", high_bits)):
        n = -(-bits // width)
        cuts = [bits * k // n for k in range(n + 1)] if n else [0]
        out += [(word, a, b - a) for a, b in zip(cuts[:-1], cuts[1:])]
    return out


def counting_pass(rows: DataFrame, word: str, shift: int, bits: int, chunk_rows: int) -> DataFrame:
    """``rows`` (position, high, low, ..) with the positions of a stable sort by one digit."""
    digit = F.shiftrightunsigned(F.col(word), shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias("digit")
    chunk = F.floor(F.col("position") / chunk_rows).cast("bigint").alias("chunk")
    counts = stage(rows.select(chunk, digit).groupBy("chunk", "digit").agg(F.count(F.lit(1)).alias("n")), "counts")

    digits = counts.groupBy("digit").agg(F.sum("n").alias("n"))  # at most 2 ** bits rows
    below = digits.select("digit", (F.sum("n").over(Window.orderBy("digit")) - F.col("n")).alias("below"))
    earlier = F.sum("n").over(Window.partitionBy("digit").orderBy("chunk")) - F.col("n")
    places = counts.withColumn("earlier", earlier).join(below, "digit")
    offsets = places.groupBy("chunk").agg(
        F.collect_list(F.struct("digit", (F.col("below") + F.col("earlier")).alias("place"))).alias("offsets")
    )  # per chunk at most one entry a row and a digit

    def move(table: pa.Table, offsets: pa.Table) -> pa.Table:
        if not table.num_rows:  # never so: a chunk's offsets come from its rows
            return table.drop_columns(["chunk"])
        table = table.take(pa.array(np.argsort(table.column("position").to_numpy())))
        own = (table.column(word).to_numpy().view(np.uint64) >> np.uint64(shift)).astype(np.int64) & ((1 << bits) - 1)
        free = np.zeros(1 << bits, np.int64)
        for x in offsets.column("offsets")[0].as_py():
            free[x["digit"]] = x["place"]
        order = np.argsort(own, kind="stable")
        sizes = np.bincount(own, minlength=1 << bits)
        within = np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        position = np.empty(len(own), np.int64)
        position[order] = free[own[order]] + within
        at = table.schema.get_field_index("position")
        return table.set_column(at, "position", pa.array(position)).drop_columns(["chunk"])

    moved = rows.withColumn("chunk", chunk).groupBy("chunk").cogroup(offsets.groupBy("chunk")).applyInArrow(move, rows.schema)
    return stage(moved, "pass")


def radix_ranks(scored: DataFrame, chunk_rows: int = CHUNK_ROWS, width: int = DIGIT_BITS) -> DataFrame:
    """``scored(doc_id, score, ..)`` with ``rank`` 1, 2, 3, .. by falling score, then rising id.

    NULL ids come last among equal scores; repeated rows keep the order they were written in.
    """
    rows = stage(scored.withColumn("line", F.monotonically_increasing_id()), "scored")
    top, low, high, bottom, n = rows.agg(F.max("score"), F.min("doc_id"), F.max("doc_id"), F.min("score"), F.count(F.lit(1))).first()
    if not n:
        return rows.drop("line").withColumn("rank", F.lit(None).cast("bigint"))
    # The key as two unsigned words: distance from the best score, with a last bit for a NULL
    # id, and distance from the least id, or the id with its sign bit turned if that doesn't fit.
    span = high - low if low is not None else 0
    near = span < 1 << 62
    own = F.col("doc_id") - F.lit(low).cast("bigint") if near else F.col("doc_id").bitwiseXOR(F.lit(-(1 << 63)))
    key = rows.withColumns({
        "high": (F.lit(top) - F.col("score")) * 2 + F.col("doc_id").isNull().cast("bigint"),
        "low": F.coalesce(own, F.lit(0).cast("bigint")),
    })
    # Lines number the rows of each written part; with all parts before, that is the first position.
    sizes = rows.groupBy(F.shiftright("line", 33).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row per part
    placed = key.withColumn("part", F.shiftright("line", 33)).join(before, "part")
    position = F.col("before") + F.col("line").bitwiseAND(F.lit((1 << 33) - 1))
    sorted_rows = stage(placed.withColumn("position", position).drop("part", "before", "line"), "placed")
    bits = (2 * (top - bottom) + 1).bit_length(), span.bit_length() if near else 64
    for word, shift, bits in digit_passes(*bits, width):
        sorted_rows = counting_pass(sorted_rows, word, shift, bits, chunk_rows)
    return sorted_rows.drop("high", "low").withColumnRenamed("position", "rank").withColumn("rank", F.col("rank") + 1)


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    size: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    min_words: int = 20,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row.

    ``rank`` is NULL for rows that aren't drawn. A NULL or empty text has no words and
    a weight of 0; a NULL id is drawn by the hash of its seed alone and comes after other ids
    of its score; repeated rows have one score and a rank each. An empty target or
    corpus counts no features.
    """
    base = texts(docs, id_col, text_col)
    wanted = target.select(F.coalesce(F.col(target_text_col).cast("string"), F.lit("")).alias("text"))
    gain = gains(bucket_counts(base, buckets, size), bucket_counts(wanted, buckets, size))
    text_id = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text_id, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")
    scored = stage(weighted(base, gain, size).withColumn("score", F.col("weight") + noise), "weighted")
    eligible = scored.filter(F.col("n_words") >= min_words)
    ranked = radix_ranks(eligible.select("doc_id", "n_features", "weight", "score"), chunk_rows)
    n = eligible.count()
    drawn = F.when(F.col("rank") <= percent * n // 100, F.col("rank")).alias("rank")
    rest = scored.filter(F.col("n_words") < min_words).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("bigint").alias("rank"))
    return ranked.select("doc_id", "n_features", "weight", "score", drawn).unionByName(rest)
