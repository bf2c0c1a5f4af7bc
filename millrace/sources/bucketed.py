"""Targets stored in buckets of their key, so that a large increment is shuffled and they aren't."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

BUCKET_ROWS = 200_000  # rows of a bucket that a join sorts with the increment's in one task


def bucket_count(df: DataFrame, least: int = 1, rows: int | None = None) -> int:
    """Buckets for a table of the rows of ``df``, so that a task's share stays as it is when the table grows."""
    return max(least, -(-df.count() // (rows or BUCKET_ROWS)))


def save_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write the next state to a *new* path as the table ``name``, bucketed by ``keys``, and return it.

    A row's bucket is the partition that a join on the keys needs it in. Such a join, with an
    increment too large to broadcast, moves the increment only. The result of a merge into
    such a table is in its buckets still, the kept rows and the new ones each: writing
    it back takes no shuffle, and at most two files a bucket. Choose ``buckets`` for the
    table's size (``bucket_count``), and the same for tables that meet; AQE can't split
    a bucket, so the key must not be skewed.
    """
    (
        df.write.mode("errorifexists")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def open_bucketed(
    spark: SparkSession, name: str, path: str, schema: str, keys: Sequence[str], buckets: int
) -> DataFrame:
    """The table ``name`` over files that ``save_bucketed`` wrote, where the session's catalog lacks it."""
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{k}`" for k in keys)
        spark.sql(
            f"CREATE TABLE {name} ({schema}) USING parquet LOCATION '{path}' "
            f"CLUSTERED BY ({columns}) SORTED BY ({columns}) INTO {buckets} BUCKETS"
        )
    return spark.table(name)
