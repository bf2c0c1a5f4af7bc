"""Writing a table's next state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def save_state(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    folders: Sequence[str] = (),
    observe: tuple[Observation, Sequence[Column]] | None = None,
) -> DataFrame:
    """Write the next state to a *new* path and return it read back.

    The path must not exist: the state being replaced is usually an input of
    ``df``. Point readers at the new path once this returns. ``partition_by``
    first rebalances by the partition values, which AQE splits again where one
    value is large, so neither tiny files nor one huge task result; ``sort_by``
    keeps parquet row-group statistics selective for watermark filters. ``folders`` are columns
    of a few values: rows are dealt to their folders where they are, without a shuffle. ``observe``
    gets its aggregates from the very rows that are written, in the writing tasks,
    where a task that runs again counts once.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    schema, columns = df.schema, df.columns
    if observe is not None:
        df = df.observe(observe[0], *observe[1])
    writer = df.write.mode("errorifexists")
    if partition_by or folders:
        writer = writer.partitionBy(*folders, *partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path).select(*columns)


def touched_partitions(target: DataFrame, source: DataFrame, column: str) -> DataFrame:
    """The target's rows in the partitions the source has rows for, NULL being one of them.

    For a merge into a table partitioned by ``column``, given that a key stays in
    its partition: the merge then reads and rewrites those partitions only. One
    NULL-safe semi join with the distinct values, whatever their number.
    """
    touched = source.select(F.col(column).alias("_touched")).distinct()
    return target.join(touched, F.col(column).eqNullSafe(F.col("_touched")), "left_semi")


def save_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df`` (dynamic overwrite).

    ``df`` may read from ``path``: old files go when the job commits. The commit
    moves partition by partition, so readers may meanwhile see some new ones.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
