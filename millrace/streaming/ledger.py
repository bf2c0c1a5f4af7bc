"""A table that streams append to, each micro-batch once.

A micro-batch that was written but not yet committed by its stream comes again
after a failure, under the same number. The table keeps a ledger of the (stream,
batch) pairs it holds, and the rows of each pair in a partition of their own. A pair the
ledger has is skipped. One that it lacks is written over what a failed try may have left,
and only then entered; readers see entered pairs only. So whether the failure
came before the rows, between rows and entry, or after the entry, each batch counts once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.streaming.ingest import apply_new_files

_PAIR = ("_stream", "_batch")
LEDGER = "_stream string, _batch bigint, rows bigint"


class OnceTable:
    """The table below ``path``: folders ``rows`` and ``ledger``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema
        self._save(spark.createDataFrame([], LEDGER), "ledger", "append")
        empty = spark.createDataFrame([], self._stored())
        self._save(empty, "rows", "append")

    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, *T.StructType.fromDDL("_stream string, _batch bigint").fields])

    def _save(self, df: DataFrame, name: str, mode: str = "overwrite") -> None:
        (
            df.write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*_PAIR)
            .parquet(f"{self.path}/{name}")
        )

    def ledger(self) -> DataFrame:
        """(_stream, _batch, rows) of the batches the table holds."""
        return self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger").select(*_PAIR, "rows")

    def rows(self) -> DataFrame:
        """The table: rows of entered batches, in the table's columns."""
        stored = self.spark.read.schema(self._stored()).parquet(f"{self.path}/rows")
        return stored.join(self.ledger().select(*_PAIR), list(_PAIR), "left_semi").select(*self.schema.names)

    def holds(self, stream: str, batch: int) -> bool:
        pair = (F.col("_stream") == stream) & (F.col("_batch") == batch)
        return not self.ledger().where(pair).isEmpty()

    def append_once(self, rows: DataFrame, stream: str, batch: int) -> bool:
        """Append the rows of a micro-batch; False if the table holds it already."""
        if self.holds(stream, batch):
            return False
        # Both partitions are replaced, never added to, so a try can follow any other.
        pair = {"_stream": F.lit(stream), "_batch": F.lit(batch).cast("bigint")}
        self._save(rows.select(*self.schema.names).withColumns(pair), "rows")
        self.enter(stream, batch)
        return True

    def enter(self, stream: str, batch: int) -> None:
        written = self.spark.read.schema(self._stored()).parquet(f"{self.path}/rows")
        count = written.where((F.col("_stream") == stream) & (F.col("_batch") == batch)).count()
        self._save(self.spark.createDataFrame([(stream, batch, count)], LEDGER), "ledger")


def consume_files(
    spark: SparkSession,
    in_dir: str,
    archive_dir: str | None,
    schema: T.StructType,
    checkpoint: str,
    table: OnceTable,
    land: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    *,
    stream: str = "files",
    fmt: str = "csv",
    **options,
) -> StreamingQuery:
    """Append the files that arrived since the last run to ``table``, each exactly once.

    The checkpoint knows which files make up a micro-batch, the table which micro-batches
    it holds. ``land`` turns file rows into table rows. ``stream`` names the checkpoint among all
    that append to the table.
    """

    def apply(batch: DataFrame, number: int) -> None:
        table.append_once(land(batch), stream, number)

    return apply_new_files(spark, in_dir, archive_dir, schema, checkpoint, apply, fmt, **options)
