"""Top-k and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k_newest(df: DataFrame, cols: Sequence[str], k: int) -> DataFrame:
    """The k rows with the largest ``cols``: a per-task top k, no full sort."""
    return df.orderBy(*[F.col(c).desc() for c in cols]).limit(k)


def union_all(dfs: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()
