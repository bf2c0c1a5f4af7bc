"""Session settings and the one place where a lineage is cut.

Operators are lazy and never write. The exception is distributed numbering
(``operators.numbering``), which has to freeze a physical row order first: it
stages that frame as parquet in the folder the cluster names in
``spark.checkpoint.dir``, so a lost executor re-reads the same rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators are written for. All are plain Spark SQL
# settings, so a cluster that sets them itself need not call ``configure``.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A task's share of a shuffle, as it is sent. Rows of a load repeat their stamps and compress more than
    # ten times, and the sorts of a merge hold a share's target and source rows at once.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    # Hot keys: joins are written with the table that may be skewed on the left
    # (left outer / semi / anti), the side AQE can split. "force" lets it split
    # even where an operator above must then be re-shuffled.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


# Whether Spark removes the shuffle files of an execution when it ends; else they stay until the driver
# happens to collect its garbage.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session, or
    the one given to ``SparkContext.setCheckpointDir``. Required in every mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder.rstrip("/")


def shared_dir_or(spark: SparkSession, folder: str) -> str:
    """``shared_dir``, with ``folder`` set for it where the session names none."""
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(folder)
    return shared_dir(spark)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, grouped by application for cleanup."""
    app = spark.conf.get("spark.app.id", None) or "app"
    return f"{shared_dir(spark)}/millrace-{app}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage", codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: rows are fixed from here on.

    Parquet rather than ``checkpoint()``: later readers fetch only the columns
    they use. ``codec`` is parquet's, the session's unless given; ``zstd`` halves hashes in hex, which
    ``snappy`` can't make smaller. The shuffle files of the write go with it: a write is planned
    anew each time, so nothing else reads them, and a job of several stages holds those of one at once.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
