"""Ingest each file once, with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.sources.files import CHECK_HEADERS


def _new_files(
    spark: SparkSession, in_dir: str, schema: T.StructType, fmt: str, archive_dir: str | None, **options
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.options(**CHECK_HEADERS)
    reader = reader.options(**options)
    if archive_dir is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(in_dir)


def ingest_new_files(
    spark: SparkSession,
    in_dir: str,
    archive_dir: str | None,
    schema: T.StructType,
    checkpoint: str,
    out: str,
    fmt: str = "csv",
    **options,
) -> StreamingQuery:
    """Append the files that arrived since the last run to ``out``, then stop.

    The checkpoint remembers which files were read. Consumed files move to
    ``archive_dir``; Spark does that when a later run commits, on a best-effort
    basis. ``maxFilesPerTrigger`` in ``options`` bounds the size of a micro-batch.
    """
    return (
        _new_files(spark, in_dir, schema, fmt, archive_dir, **options)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", out)
        .trigger(availableNow=True)
        .start()
    )


def apply_new_files(
    spark: SparkSession,
    in_dir: str,
    archive_dir: str | None,
    schema: T.StructType,
    checkpoint: str,
    apply: Callable[[DataFrame, int], None],
    fmt: str = "csv",
    **options,
) -> StreamingQuery:
    """As ``ingest_new_files``, but hands each micro-batch to ``apply``.

    ``apply`` typically merges the rows and saves the next state. A micro-batch
    may be replayed after a failure, so it must be repeatable; merges are.
    """
    return (
        _new_files(spark, in_dir, schema, fmt, archive_dir, **options)
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(apply)
        .trigger(availableNow=True)
        .start()
    )
