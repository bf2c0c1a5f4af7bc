"""Latest version per key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.filters import incremental_filter


def latest_by_max(df: DataFrame, keys: Sequence[str], ts_col: str) -> DataFrame:
    """Every row that carries its key's newest time; ties all stay.

    NULL keys and NULL times drop out, as an equality never matches them.

    The maxima come from a two-column scan with map-side aggregation and are
    applied as a semi join on (keys, time). A rank over the key would pull a hot
    key into one task, and ties at its newest time cannot be cut there; in the
    semi join the hot key spreads over its times, AQE can split what is left,
    and few keys mean a broadcast without any shuffle of ``df``.
    """
    newest = (
        df.select(*keys, ts_col)
        .dropna(subset=[*keys, ts_col])
        .groupBy(*keys)
        .agg(F.max(ts_col).alias(ts_col))
    )
    return df.join(newest, [*keys, ts_col], "left_semi")


def latest_by_rank(
    df: DataFrame, keys: Sequence[str], order_cols: Sequence[str | Column]
) -> DataFrame:
    """Exactly one row per key, the first by ``order_cols`` (strings sort descending).

    ``row_number() = 1`` becomes a group limit that runs before the shuffle too,
    so a hot key sends one row per input partition. Order columns should be
    unique within a key to make the choice repeatable.
    """
    order = [F.col(c).desc() if isinstance(c, str) else c for c in order_cols]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_then_increment(
    df: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    since: datetime | str | None = None,
) -> DataFrame:
    """Newest version per key, kept when newer than the watermark.

    A newest version above a constant is also the newest of the versions above
    it, so the watermark is applied first and prunes both scans.
    """
    return latest_by_max(incremental_filter(df, ts_col, since), keys, ts_col)
