"""Exact deduplication with an index of live digests behind cuckoo filters.

The digest of a text is the SHA-256 of the text with A-Z lower-cased. The index
holds every live digest once, in shards by digest. A shard is a cuckoo filter and
the stored keys behind its slots: a digest's 16-bit fingerprint lies in one of two
buckets of four slots, and each slot has its own key beside it. A lookup that
finds no fingerprint is a new digest, without looking at any key; a hit is verified against
the keys of exactly those slots, so a false hit is never taken for a copy. An insertion moves
fingerprints between their two buckets to make room. When that takes too many
moves, the filter has overflowed: it is built anew with twice the buckets from the
stored keys. A deletion verifies in the same way and frees the slot.

Texts are read once. Equal texts are counted per digest and salt before they
are moved, and each answer goes back to its own salt, so a group that holds a third of all rows is
neither one task's work on the way to the index nor on the way back. What the index gets of it
is one row a salt.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import partitions
from millrace.session import new_folder, stage

SHARD_ROWS = 1 << 18  # rows that a shard's task handles at once
SLOTS = 4
MOVES = 200  # of fingerprints for one insertion, before the filter counts as full
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Entry = tuple[int | None, int, int]  # id and line of the row that stays, rows of the digest


class CuckooIndex:
    """Cuckoo filter over 32-byte digests, with the stored key of every slot."""

    def __init__(self, buckets: int = 64):
        self.buckets = 1 << max(buckets - 1, 1).bit_length()
        self.marks = [0] * (self.buckets * SLOTS)  # fingerprints, 0 for a free slot
        self.keys: list[bytes | None] = [None] * (self.buckets * SLOTS)
        self.entries: dict[int, Entry] = {}  # by slot
        self.size = self.resizes = self.verified = 0
        self._turn = 0

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "little") or 1
        first = int.from_bytes(digest[2:10], "little") & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 & (self.buckets - 1))

    def slot(self, digest: bytes) -> int | None:
        """The slot of a live digest. Only slots of its fingerprint are compared by key."""
        mark, a, b = self._places(digest)
        for bucket in (a, b) if a != b else (a,):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.marks[slot] == mark:
                    self.verified += 1
                    if self.keys[slot] == digest:
                        return slot
        return None

    def get(self, digest: bytes) -> Entry | None:
        slot = self.slot(digest)
        return None if slot is None else self.entries[slot]

    def put(self, digest: bytes, entry: Entry) -> None:
        """Change a live digest's entry, or insert the digest."""
        slot = self.slot(digest)
        if slot is not None:
            self.entries[slot] = entry
        else:
            self._insert(digest, entry)
            self.size += 1

    def delete(self, digest: bytes) -> bool:
        slot = self.slot(digest)
        if slot is None:
            return False
        self.marks[slot], self.keys[slot] = 0, None
        del self.entries[slot]
        self.size -= 1
        return True

    def items(self) -> Iterable[tuple[bytes, Entry]]:
        return ((self.keys[slot], entry) for slot, entry in self.entries.items())

    def _insert(self, digest: bytes, entry: Entry) -> None:
        mark, a, b = self._places(digest)
        for bucket in (a, b):
            if self._fill(bucket, mark, digest, entry):
                return
        bucket = a
        for _ in range(MOVES):
            # Whose fingerprint goes on to its other bucket changes from move to move.
            self._turn += 1
            slot = bucket * SLOTS + self._turn % SLOTS
            mark, self.marks[slot] = self.marks[slot], mark
            digest, self.keys[slot] = self.keys[slot], digest
            entry, self.entries[slot] = self.entries[slot], entry
            bucket = self._other(bucket, mark)
            if self._fill(bucket, mark, digest, entry):
                return
        self._resize(digest, entry)

    def _fill(self, bucket: int, mark: int, digest: bytes, entry: Entry) -> bool:
        for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if not self.marks[slot]:
                self.marks[slot], self.keys[slot], self.entries[slot] = mark, digest, entry
                return True
        return False

    def _resize(self, digest: bytes, entry: Entry) -> None:
        """Twice the buckets, filled from the stored keys and the one without a place."""
        stored = [*self.items(), (digest, entry)]
        self.buckets *= 2
        self.resizes += 1
        self.marks, self.keys = [0] * (self.buckets * SLOTS), [None] * (self.buckets * SLOTS)
        self.entries = {}
        for key, known in stored:
            self._insert(key, known)


def combined(a: Entry | None, b: Entry) -> Entry:
    """The row of the larger id stays (no id is the smallest); of equal ids that of the larger line."""
    if a is None:
        return b
    last = max((a[0] is not None, a[0] or 0, a[1]), (b[0] is not None, b[0] or 0, b[1]))
    return (last[1] if last[0] else None, last[2], a[2] + b[2])


# ---------------------------------------------------------------- tables

_KEYS = pa.schema([("shard", pa.int32()), ("digest", pa.binary()), ("keep_id", pa.int64()), ("keep_line", pa.int64()), ("group_size", pa.int64())])
KEYS = "shard int, digest binary, keep_id bigint, keep_line bigint, group_size bigint"
_ANSWERS = pa.schema([("digest", pa.binary()), ("salt", pa.int32()), *list(_KEYS)[2:]])
ANSWERS = "digest binary, salt int, keep_id bigint, keep_line bigint, group_size bigint"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line, digest, salt) of every row, written once; ``line`` tells repeated rows apart."""
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), _UPPER, _LOWER)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"))
    salts = partitions(docs.sparkSession)
    rows = rows.withColumn("line", F.monotonically_increasing_id())
    return stage(rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "line"), F.lit(salts)).cast("int")), "digests")


def _counted(rows: DataFrame) -> DataFrame:
    """One row per digest and salt: its last row and how many there are."""
    last = F.max(F.struct("doc_id", "line")).alias("last")
    return rows.groupBy("digest", "salt").agg(last, F.count(F.lit(1)).alias("n")).select("digest", "salt", "last.*", "n")


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")


def _insert_all(counted: pa.Table, index: CuckooIndex) -> list[bytes]:
    """Puts all rows into the index and returns their digests, in row order."""
    found = counted.column("digest").to_pylist()
    for digest, *entry in zip(found, *(counted.column(c).to_pylist() for c in ("doc_id", "line", "n"))):
        index.put(digest, combined(index.get(digest), tuple(entry)))
    return found


def _entries(schema: pa.Schema, first: dict, entries: list[Entry]) -> pa.Table:
    columns = list(zip(*entries)) if entries else [(), (), ()]
    return pa.table({**first, **dict(zip(("keep_id", "keep_line", "group_size"), columns))}, schema=schema)


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_rows: int = SHARD_ROWS, buckets: int = 64
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row.

    Of rows with equal texts (A-Z lower-cased; NULL is empty) the one with the largest id stays.
    A NULL id is smaller than any other; of repeated rows of the id that stays, one does.
    """
    rows = digests(docs, id_col, text_col)
    counted = stage(_counted(rows), "counted")
    shards = counted.count() // shard_rows + 1

    def answer(table: pa.Table) -> pa.Table:
        index = CuckooIndex(buckets)
        found = _insert_all(table, index)
        return _entries(_ANSWERS, {"digest": found, "salt": table.column("salt")}, [index.get(d) for d in found])

    answers = counted.groupBy(_shard(shards).alias("shard")).applyInArrow(answer, ANSWERS)
    return rows.join(answers, ["digest", "salt"]).select(
        "doc_id", "keep_id", "group_size", (F.col("line") == F.col("keep_line")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


class DedupIndex:
    """A stored index: the live digests, and the rows they stand for.

    Every change writes new tables below the shared folder and returns a new index;
    the one before stays as it was, so a lost job can be repeated from it. Shards are filtered,
    inserted into and deleted from by the cuckoo filter that their stored keys fill.
    """

    def __init__(self, rows: DataFrame, keys: DataFrame, shards: int):
        self.rows, self.keys, self.shards = rows, keys, shards

    @classmethod
    def empty(cls, spark: SparkSession, shards: int = 1) -> DedupIndex:
        rows = spark.createDataFrame([], "doc_id bigint, line bigint, digest binary")
        return cls(rows, spark.createDataFrame([], KEYS), shards)

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DedupIndex:
        """The index with the rows of ``docs``; of equal texts, old and new, the largest id stays."""
        new = digests(docs, id_col, text_col)
        # Lines go on after those the index has, so they stay unique.
        top = self.rows.agg(F.max("line")).first()[0]
        new = new.withColumn("line", F.col("line") + F.lit(0 if top is None else top + 1))

        def change(index: CuckooIndex, table: pa.Table) -> None:
            _insert_all(table, index)

        rows = stage(self.rows.unionByName(new.select(*self.rows.columns)), "rows")
        return DedupIndex(rows, self._changed(_counted(new), change), self.shards)

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> DedupIndex:
        """The index without the rows of the given ids. A digest whose last row goes is deleted;
        if only the row that stayed goes, the largest id of the others takes its place."""
        gone = ids.select(F.col(id_col).cast("bigint").alias("doc_id")).distinct()
        rows = stage(self.rows.join(gone, "doc_id", "left_anti").select(*self.rows.columns), "rows")
        hit = self.rows.join(gone, "doc_id", "left_semi").select("digest").distinct()
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("line"), F.lit(partitions(rows.sparkSession))).cast("int"))
        left = _counted(salted.join(hit, "digest", "left_semi"))
        none = left.select("digest").distinct()
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("salt", "int"), ("doc_id", "bigint"), ("line", "bigint"), ("n", "bigint"))]
        change = hit.select("digest", *nothing).unionByName(left.join(none, "digest", "left_semi"))

        def apply(index: CuckooIndex, table: pa.Table) -> None:
            asked = table.filter(pc.is_null(table.column("n"))).column("digest").to_pylist()
            for digest in asked:
                index.delete(digest)
            _insert_all(table.filter(pc.is_valid(table.column("n"))), index)

        return DedupIndex(rows, self._changed(change, apply), self.shards)

    def _changed(self, changes: DataFrame, change: Callable[[CuckooIndex, pa.Table], None]) -> DataFrame:
        def apply(stored: pa.Table, table: pa.Table) -> pa.Table:
            index = CuckooIndex(max(len(stored) // 3, 64))
            entries = zip(*(stored.column(c).to_pylist() for c in ("keep_id", "keep_line", "group_size")))
            for digest, entry in zip(stored.column("digest").to_pylist(), entries):
                index.put(digest, entry)
            change(index, table)
            live = list(index.items())
            shard = (stored if len(stored) else table).column("shard")[0].as_py()
            first = {"shard": np.full(len(live), shard, np.int32), "digest": [d for d, _ in live]}
            return _entries(_KEYS, first, [e for _, e in live])

        asked = changes.withColumn("shard", _shard(self.shards))
        return stage(self.keys.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(apply, KEYS), "keys")

    def resharded(self, shards: int) -> DedupIndex:
        return DedupIndex(self.rows, stage(self.keys.withColumn("shard", _shard(shards)), "keys"), shards)

    def documents(self) -> DataFrame:
        """(doc_id, keep_id, group_size, kept, text_sha256) of every row the index stands for."""
        joined = self.rows.join(self.keys.select("digest", "keep_id", "keep_line", "group_size"), "digest")
        return joined.select(
            "doc_id", "keep_id", "group_size", (F.col("line") == F.col("keep_line")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )


def save_index(index: DedupIndex, path: str | None = None) -> str:
    """Write an index to ``path`` (a new folder below the shared one if not given)."""
    spark = index.rows.sparkSession
    path = path or new_folder(spark, "dedup-index")
    index.rows.write.parquet(f"{path}/rows")
    index.keys.withColumn("shards", F.lit(index.shards)).write.parquet(f"{path}/keys")
    return path


def load_index(spark: SparkSession, path: str) -> DedupIndex:
    keys = spark.read.parquet(f"{path}/keys")
    shards = keys.agg(F.max("shards")).first()[0] or 1
    return DedupIndex(spark.read.parquet(f"{path}/rows"), keys.drop("shards"), shards)
