"""Tables that a stream rewrites as a whole, and the deletion log kept by one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.columns import as_batch, as_ts
from millrace.operators.filters import delete_events
from millrace.operators.merge import conform, merge_update_subset

_VERSIONS = "rows bigint, version bigint"


class VersionedTable:
    """States of a table below ``path``, one folder per version, and the list of whole ones.

    A micro-batch with number ``n`` makes version ``n`` from the newest one below
    ``n``. When it comes again after a failure it starts from that same state
    and replaces what the failed try left. Readers see the newest version of the list.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema
        self._list(spark.createDataFrame([], _VERSIONS), "append")

    def _list(self, rows: DataFrame, mode: str) -> None:
        writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("version")
        writer.parquet(f"{self.path}/versions")

    def versions(self) -> DataFrame:
        return self.spark.read.schema(_VERSIONS).parquet(f"{self.path}/versions").select("version", "rows")

    def state(self, before: int | None = None) -> DataFrame:
        """The newest state, or the newest below a version; empty if there is none."""
        listed = self.versions() if before is None else self.versions().where(F.col("version") < before)
        version = listed.agg(F.max("version")).first()[0]
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v{version}")

    def save(self, df: DataFrame, version: int) -> None:
        folder = f"{self.path}/v{version}"
        conform(df, self.schema).write.mode("overwrite").parquet(folder)
        rows = self.spark.read.schema(self.schema).parquet(folder).agg(F.count(F.lit(1)).alias("rows"))
        self._list(rows.withColumn("version", F.lit(version).cast("bigint")), "overwrite")


def stream_deletion_log(
    spark: SparkSession,
    in_dir: str,
    schema: T.StructType,
    checkpoint: str,
    log: VersionedTable,
    *,
    model_id: str,
    model_grp: str,
    pipeline_name: str,
    batch_id,
    load_ts,
    key_col: str = "primary_key__pk",
    fmt: str = "parquet",
    **options,
) -> StreamingQuery:
    """Keep the newest delete event of every key in ``log``, from the journal files that arrive.

    The stream's state has one row per deleted key, its newest event; a micro-batch hands on the
    keys whose newest event changed, and only these are merged into the log. So the
    log after any number of increments is that of one run over all of them, whatever order the events come
    in. Equal keys are reduced before they are shuffled. Events without a key are left out.
    """
    journal = spark.readStream.format(fmt).schema(schema).options(**options).load(in_dir)
    newest = (
        delete_events(journal)
        .where(F.col(key_col).isNotNull())
        .groupBy(F.col(key_col).alias("pk"))
        .agg(F.max(F.struct("seen_at", "least_significant_position")).alias("last"))
    )

    def apply(changed: DataFrame, number: int) -> None:
        rows = changed.select(
            F.lit(model_id).alias("model_id"),
            F.lit(model_grp).alias("model_grp"),
            F.lit(pipeline_name).alias("pipeline_name"),
            "pk",
            F.col("last.seen_at").alias("src_load_ts"),
            as_batch(batch_id).alias("batch_id"),
            as_ts(load_ts).alias("etl_load_ts"),
            as_ts(load_ts).alias("etl_updt_ts"),
        )
        moved = ["model_grp", "pipeline_name", "src_load_ts", "etl_updt_ts"]
        log.save(merge_update_subset(log.state(number), rows, ["model_id", "pk"], moved, source_unique=True), number)

    return (
        newest.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(apply)
        .trigger(availableNow=True)
        .start()
    )
