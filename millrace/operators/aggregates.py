"""Aggregations. Each one combines map-side, so hot groups shrink before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import semi_in


def max_per_key(df: DataFrame, keys: Sequence[str], col: str, out: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(col).alias(out or col))


def group_by_all_having(
    df: DataFrame, cols: Sequence[str], min_count: int = 2, out: str = "n"
) -> DataFrame:
    """Groups of at least ``min_count`` rows with their size."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) >= min_count)


def global_max_default(df: DataFrame, col: str, default: Column, out: str | None = None) -> DataFrame:
    return df.agg(F.coalesce(F.max(col), default).alias(out or col))


def row_counts() -> dict[str, Column]:
    """Rows inserted (load time = update time) and updated (load time earlier)."""
    load, update = F.col("etl_load_ts"), F.col("etl_updt_ts")
    return {
        "rows_inserted": F.sum(F.when(load == update, 1).otherwise(0)),
        "rows_updated": F.sum(F.when(load < update, 1).otherwise(0)),
    }


def conditional_counts(df: DataFrame, batch_id: Column | None = None) -> DataFrame:
    """Rows inserted and updated per batch, for one batch or all in one pass."""
    if batch_id is not None:
        df = df.where(F.col("batch_id") == batch_id)
    return df.groupBy("batch_id").agg(*[c.alias(n) for n, c in row_counts().items()])


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def count_matching(
    target: DataFrame, log: DataFrame, on: Sequence[str] | Mapping[str, str], out: str = "deleted_count"
) -> DataFrame:
    """How many target rows have their key in the log."""
    return semi_in(target, log, on).agg(F.count(F.lit(1)).alias(out))
