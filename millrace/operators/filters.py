"""Row filters. All are plain predicates, so they reach the parquet scan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import as_ts

# Fixed value: the watermark of a model that has never been loaded.
EPOCH = "1900-01-01"
# Fixed value: the journal event that stands for a deleted source row.
DELETE_EVENT = "IncrementalDeleteRows"


def incremental_filter(df: DataFrame, ts_col: str, since: datetime | str | None = None) -> DataFrame:
    """Rows strictly newer than the watermark.

    A typed literal keeps the comparison pushable; NULL times never qualify.
    """
    return df.where(F.col(ts_col) > as_ts(since if since is not None else EPOCH))


def filter_above_target_watermark(
    source: DataFrame, target: DataFrame, src_ts: str = "etl_load_ts", tgt_ts: str = "etl_updt_ts"
) -> DataFrame:
    """Source rows newer than the newest row of the target.

    The watermark is a scalar subquery, whose value the scan can filter by.
    """
    newest = target.agg(F.coalesce(F.max(tgt_ts), as_ts(EPOCH)))
    return source.where(F.col(src_ts) > newest.scalar())


def active_rows(df: DataFrame, flag: str = "active_flg") -> DataFrame:
    return df.where(F.col(flag) == "Y")


def delete_events(journal: DataFrame, event_col: str = "event_type") -> DataFrame:
    return journal.where(F.col(event_col) == DELETE_EVENT)


def key_present(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def name_filter(
    df: DataFrame,
    col: str,
    *,
    contains: str | None = None,
    lacks: str | None = None,
    equals: str | None = None,
) -> DataFrame:
    """Case-insensitive name tests on the trimmed text; given tests must all hold."""
    name = F.upper(F.trim(F.col(col)))
    tests: list[Column] = []
    if contains is not None:
        tests.append(name.contains(contains.upper()))
    if lacks is not None:
        tests.append(~name.contains(lacks.upper()))
    if equals is not None:
        tests.append(name == equals.strip().upper())
    for test in tests:
        df = df.where(test)
    return df
