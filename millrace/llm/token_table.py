"""Token ids as Parquet list columns, in id order, for selective reads.

One row per document: ``doc_id``, ``n_tokens``, ``shard``, the row's ``place`` in it and the ids as a list.
Documents are range-partitioned by id, so files and row groups follow the id
order and their statistics and page indexes prune reads of an id range; a read
of metadata never touches the ids' column chunks. Ids are dictionary-encoded
or, with ``encoding="delta"``, delta-encoded by format version 2. Row group and
page sizes are parameters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import one, texts
from millrace.llm.tokens import crc, encoded

SCHEMA = "doc_id bigint, n_tokens bigint, shard int, ids array<int>, place bigint"


def write_token_table(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    encoding: str = "dictionary",
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 256 << 10,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every text (NULL: empty), append the end id, write in ascending id order.

    Rows of one id follow each other, ordered by a hash of their text; NULL ids come first.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding!r}")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for batch in batches:
            ids = [np.frombuffer(x, np.uint32) for x in encoded(vocabulary, batch.column("text"))]
            sizes = np.array([len(x) for x in ids], np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            flat = np.concatenate([*ids, np.zeros(0, np.uint32)]).view(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            places = pa.array(np.arange(place, place + len(sizes)))
            place += len(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), batch.column("shard"), lists, places], ["doc_id", "n_tokens", "shard", "ids", "place"]
            )

    order = [F.col("doc_id"), F.xxhash64("text")]
    ranged = texts(docs, id_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = ranged.withColumn("shard", F.spark_partition_id()).mapInArrow(encode, SCHEMA)
    (
        rows.write.option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
        .option("parquet.writer.version", "v1" if encoding == "dictionary" else "v2")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def stored_documents(table: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored document, by reading the ids back.

    ``start`` is the number of ids before the document's in the files' order: sums per shard, one row
    each and from the metadata columns alone, and a running sum within a shard.
    Ids are checked where they lie; only numbers are shuffled.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = one(batch.column("ids"))
            values = lists.values.to_numpy(zero_copy_only=False).astype(np.uint32)
            at = lists.offsets.to_numpy()
            sums = [crc(values[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("shard"), batch.column("place"), pa.array(np.diff(at), pa.int64()), pa.array(sums, pa.int64())],
                ["doc_id", "shard", "place", "n_tokens", "ids_crc32"],
            )

    sums = table.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = sums.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    own = table.select("doc_id", "shard", "place", "ids").mapInArrow(check, "doc_id bigint, shard int, place bigint, n_tokens bigint, ids_crc32 bigint")
    order = Window.partitionBy("shard").orderBy("place")
    inner = F.coalesce(F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return own.withColumn("inner", inner).join(before, "shard").select(
        "doc_id", (F.col("inner") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
