"""Join idioms of incremental loads.

The table that may be large or skewed is always the left side: broadcast of the
right side and AQE skew splitting of the left one both stay possible. Right
sides of semi and anti joins are reduced to distinct keys first, which merges
the copies of a hot key before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import blank_safe_key_equal

On = Sequence[str] | Mapping[str, str]


def _key_pairs(on: On) -> dict[str, str]:
    if isinstance(on, Column):
        raise TypeError("name the equality keys; a further condition goes into `residual`")
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    if not pairs:
        raise ValueError("a join without an equality key compares every pair of rows")
    return pairs


def distinct_keys(df: DataFrame, on: On) -> DataFrame:
    """The right-hand keys under the left-hand names, once each and without NULLs."""
    pairs = _key_pairs(on)
    keys = df.select([F.col(right).alias(left) for left, right in pairs.items()])
    return keys.dropna().distinct()


def inner_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys), "inner")


def _filtering_join(
    left: DataFrame, right: DataFrame, on: On, how: str, residual: Column | None
) -> DataFrame:
    pairs = _key_pairs(on)
    if residual is None:
        return left.join(distinct_keys(right, on), list(pairs), how)
    condition = residual
    for ours, theirs in pairs.items():
        condition = (F.col(f"t.{ours}") == F.col(f"s.{theirs}")) & condition
    return left.alias("t").join(right.alias("s"), condition, how)


def semi_exists(
    left: DataFrame, right: DataFrame, on: On, residual: Column | None = None
) -> DataFrame:
    """Left rows with a match. ``residual`` narrows the match (sides ``t`` and ``s``).

    There is always an equality key, so the join can be dealt by key.
    """
    return _filtering_join(left, right, on, "left_semi", residual)


def anti_not_exists(
    left: DataFrame, right: DataFrame, on: On, residual: Column | None = None
) -> DataFrame:
    """Left rows without a match; rows with a NULL key stay."""
    return _filtering_join(left, right, on, "left_anti", residual)


def semi_in(left: DataFrame, right: DataFrame, on: On) -> DataFrame:
    """``key in (select ...)``: NULL never qualifies."""
    return semi_exists(left, right, on)


def anti_left_null(
    left: DataFrame, right: DataFrame, on: On, residual: Column | None = None
) -> DataFrame:
    """``left join ... where right is null``."""
    return anti_not_exists(left, right, on, residual)


def unseen_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not in the (much larger) target.

    The target keys are cut down to those the source has before they meet the
    source, so a small source is broadcast against the target scan and the
    target is not shuffled.
    """
    keys = list(keys)
    seen = target.select(*keys).join(distinct_keys(source, keys), keys, "left_semi").distinct()
    return source.join(seen, keys, "left_anti")


def cross_join_scalar(df: DataFrame, scalar: DataFrame) -> DataFrame:
    """Attach an ungrouped aggregate (one row by construction) to every row.

    Its values are scalar subqueries: computed once, before the rows are read,
    and no join takes part.
    """
    return df.withColumns({c: scalar.select(c).scalar() for c in scalar.columns})


def correlated_scalar_max(
    df: DataFrame, lookup: DataFrame, keys: Sequence[str], value: str, out: str | None = None
) -> DataFrame:
    """``(select max(value) from lookup where keys match)`` per row, NULL when absent."""
    best = lookup.dropna(subset=list(keys)).groupBy(*keys).agg(F.max(value).alias(out or value))
    return df.join(best, list(keys), "left")


def join_mixed_on(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    residual: Column,
    how: str = "inner",
) -> DataFrame:
    """Equi keys plus a further predicate in the ON clause (sides ``t`` and ``s``).

    In an outer join the predicate decides about the match, not about the row.
    Returns the left columns, then the right non-key columns.
    """
    condition = residual
    for k in keys:
        condition = (F.col(f"t.{k}") == F.col(f"s.{k}")) & condition
    joined = left.alias("t").join(right.alias("s"), condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.select("t.*", *[F.col(f"s.{c}") for c in right.columns if c not in keys])


def join_blank_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], mode: str, how: str = "left_semi"
) -> DataFrame:
    """Join under one of the two blank-key conventions (sides ``t`` and ``s``)."""
    types = dict(left.dtypes)
    if how in ("left_semi", "left_anti"):
        right = right.select(*keys).distinct()
    condition = None
    for k in keys:
        same = blank_safe_key_equal(
            F.col(f"t.{k}"), F.col(f"s.{k}"), mode, is_string=types[k] == "string"
        )
        condition = same if condition is None else condition & same
    return left.alias("t").join(right.alias("s"), condition, how)
