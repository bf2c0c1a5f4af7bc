"""Stored surrogate keys: hash -> key, and the largest key given.

A dimension can tell which keys are known and which one is the largest, but
only by a scan. The registry keeps both beside it, as two append-only folders
with one partition per load: ``entries`` gets the load's new hashes, ``tops`` one row. A
load that runs again replaces its own partition and reads only those of other
loads, so it gives the same keys as the first time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import BATCH_TYPE

ENTRIES = f"hash_sk string, sk {BATCH_TYPE.simpleString()}, load string"
TOPS = f"top {BATCH_TYPE.simpleString()}, load string"
FIRST_LOAD = "bootstrap"


class KeyRegistry:
    """The registry below ``path``; without any load it is empty and its largest key 0."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        # Empty partitions of no load: the folders exist from here on.
        for name, ddl in (("entries", ENTRIES), ("tops", TOPS)):
            self._write(spark.createDataFrame([], ddl), name, "append")

    def _write(self, df: DataFrame, name: str, mode: str = "overwrite") -> None:
        (
            df.write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy("load")
            .parquet(f"{self.path}/{name}")
        )

    def _read(self, name: str, ddl: str, without: str | None) -> DataFrame:
        rows = self.spark.read.schema(ddl).parquet(f"{self.path}/{name}")
        return rows if without is None else rows.where(F.col("load") != without)

    def entries(self, without: str | None = None) -> DataFrame:
        """(hash_sk, sk) of all loads, or of all but one."""
        return self._read("entries", ENTRIES, without).select("hash_sk", "sk")

    def top(self, without: str | None = None) -> DataFrame:
        """The largest key as one row (``top``): a scan of one row per load."""
        rows = self._read("tops", TOPS, without)
        return rows.agg(F.coalesce(F.max("top"), F.lit(0)).cast(BATCH_TYPE).alias("top"))

    def extend(self, keyed: DataFrame, load: str, sk: str = "sk", hash_col: str = "hash_sk") -> None:
        """Add the hashes of ``keyed`` that no other load has. Known hashes keep their key."""
        pairs = keyed.groupBy(F.col(hash_col).alias("hash_sk")).agg(F.max(sk).cast(BATCH_TYPE).alias("sk"))
        new = pairs.join(self.entries(load), "hash_sk", "left_anti").withColumn("load", F.lit(load))
        # No new hash leaves the partition of an earlier try as it is: it has none either.
        self._write(new, "entries")
        given = self._read("entries", ENTRIES, None).where(F.col("load") == load)
        tops = given.agg(F.max("sk").alias("top")).where("top IS NOT NULL").withColumn("load", F.lit(load))
        self._write(tops, "tops")

    @classmethod
    def of_dimension(
        cls, dim: DataFrame, path: str, sk: str = "sk", hash_col: str = "hash_sk"
    ) -> KeyRegistry:
        """A registry of the keys a dimension has: the one scan of it for its keys."""
        registry = cls(dim.sparkSession, path)
        registry.extend(dim.where(F.col(hash_col).isNotNull()), FIRST_LOAD, sk, hash_col)
        return registry
