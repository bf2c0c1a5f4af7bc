"""Numbering and next-row lookups that no single task has to do alone.

A window without partition keys, or partitioned by a key that may hold a third
of all rows, is one sort in one task. Here rows are range-partitioned instead:
a range boundary may fall inside a key, so hot keys split like any other rows.

Per-key results are a segmented scan. Each range is scanned by itself, keyed by
(range, key); what a key brings along from other ranges is a carry. Only the key at
a range's edge can have one, so the carries are a table of one row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stage

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def _ascending(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def _ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows in ranges along the order, staged with their range and their place (``_part``, ``_place``)."""
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    return stage(placed, "ranged", "zstd").withColumn("_part", F.shiftright("_place", _ROW_BITS))


def _per_range(carries: DataFrame) -> DataFrame:
    """One row per range, staged; that bounds its single-task windows and its broadcast."""
    return F.broadcast(stage(carries, "carries"))


def _number_in_order(df: DataFrame, order_cols: Sequence[str], out: str) -> DataFrame:
    """1..N along a *unique* order: a row's place in its range, and the rows of all ranges before."""
    placed = _ranged(df, _ascending(order_cols))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    place_in_part = F.col("_place") - F.shiftleft("_part", _ROW_BITS)
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_offset") + place_in_part + 1)
        .drop("_part", "_place", "_offset")
    )


def _addressed(
    df: DataFrame, order_cols: Sequence[str], unique_order: bool
) -> tuple[DataFrame, list[str], list[str]]:
    """Rows, the columns that address one row, and a unique order for them.

    Unless the order is known to be unique, rows are staged with a physical id
    that serves as address and as the last order column: even identical copies
    can then be cut into ranges.
    """
    if unique_order:
        return df, list(order_cols), list(order_cols)
    rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "rows", "zstd")
    return rows, ["_row"], [*order_cols, "_row"]


def row_number_global(
    df: DataFrame, order_cols: Sequence[str], out: str = "rn", unique_order: bool = False
) -> DataFrame:
    """``row_number()`` over the whole frame.

    Only the order columns are ranged and staged; the numbers then join back to
    the rows by their address, which is unique and so spreads evenly.
    """
    rows, address, order = _addressed(df, order_cols, unique_order)
    numbers = _number_in_order(rows.select(*order), order, out).select(*address, out)
    return join_null_safe(rows, numbers, address).select(*df.columns, out)


def dense_rank_global(df: DataFrame, key_cols: Sequence[str], out: str = "rank") -> DataFrame:
    """The distinct keys with their ``dense_rank()`` over the whole frame.

    Join it back on the keys (NULL-safe) to rank rows.
    """
    return _number_in_order(df.select(*key_cols).distinct(), key_cols, out)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which NULL keys match each other; the right keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def with_dense_rank(df: DataFrame, key_cols: Sequence[str], out: str = "rank") -> DataFrame:
    return join_null_safe(df, dense_rank_global(df, key_cols, out), key_cols)


def _rows_carried(ranged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(_part, _key, _carry): the first key of each range, and how many of its rows earlier ranges hold.

    A key's run begins at the last row of another key, or of none, before it. So
    the run at a range's end began in that range, or, if the range has one key
    only and continues the one before, where that one's run began: at the last range
    before that has a beginning.
    """
    key = F.struct(*keys)
    spans = ranged.groupBy("_part").agg(
        F.min(key).alias("_first"),
        # The largest key at its smallest place: where the last run begins here.
        F.max(F.struct(*keys, (-F.col("_place")).alias("_at"))).alias("_last"),
        F.count(F.lit(1)).alias("_size"),
    )
    along = Window.orderBy("_part")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    place_in_part = -F.col("_last._at") - F.shiftleft("_part", _ROW_BITS)
    last_key = F.struct(*[F.col(f"_last.`{k}`").alias(k) for k in keys])
    spans = spans.select(
        "_part",
        "_first",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        place_in_part.alias("_begin"),
        last_key.alias("_last"),
    )
    continues = F.lag("_last").over(along).eqNullSafe(F.col("_first"))
    spans = spans.withColumn("_continues", continues)
    goes_through = F.col("_continues") & F.col("_last").eqNullSafe(F.col("_first"))
    begins = F.when(~goes_through, F.col("_offset") + F.col("_begin"))
    began = F.last(begins, ignorenulls=True).over(before)
    carry = F.when(F.col("_continues"), F.col("_offset") - began).otherwise(0)
    return spans.select("_part", F.col("_first").alias("_key"), carry.alias("_carry"))


def row_number_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    out: str = "rn",
    unique_order: bool = False,
) -> DataFrame:
    """``row_number()`` within each key, as a segmented scan over ranges of (keys, order).

    A row's number is its number within (range, key), plus the key's rows in
    earlier ranges if the key is the range's first.
    """
    rows, _, order = _addressed(df, order_cols, unique_order)
    # Keys with NULLs first, as structs of them compare.
    ranged = _ranged(rows, [*[F.col(k).asc() for k in keys], *_ascending(order)])
    carries = _per_range(_rows_carried(ranged, keys))
    here = F.row_number().over(Window.partitionBy("_part", *keys).orderBy("_place"))
    carried = F.when(F.struct(*keys).eqNullSafe(F.col("_key")), F.col("_carry")).otherwise(0)
    return (
        ranged.withColumn("_here", here)
        .join(carries, "_part")
        .withColumn(out, F.col("_here") + carried)
        .select(*df.columns, out)
    )


def next_start(df: DataFrame, sk: str, start: str, tie: str) -> DataFrame:
    """Per (key, start): the key's next later start and the largest ``tie`` value.

    The distinct starts are scanned in ranges of (key, start). The last start of
    a key in its range is followed by the next range's first one, if that has the same key.
    """
    points = df.groupBy(sk, start).agg(F.max(tie).alias("_last_tie"))
    ranged = _ranged(points, [F.col(sk).asc(), F.col(start).asc()])
    heads = ranged.groupBy("_part").agg(F.min(F.struct(sk, start)).alias("_head"))
    along = Window.orderBy("_part")
    following = _per_range(heads.select("_part", F.lead("_head").over(along).alias("_head")))
    here = F.lead(start).over(Window.partitionBy("_part", sk).orderBy("_place"))
    beyond = F.when(F.col(f"_head.`{sk}`") == F.col(sk), F.col(f"_head.`{start}`"))
    return (
        ranged.withColumn("_here", here)
        .join(following, "_part")
        .select(sk, start, "_last_tie", F.coalesce("_here", beyond).alias("_next_start"))
    )


def lead_next_start(
    df: DataFrame, sk: str, start: str, tie: str, out: str = "next_start", where: Column | None = None
) -> DataFrame:
    """``lead(start)`` per key in order of (start, tie) on the rows picked by ``where``.

    Rows equal in (key, start, tie) share one answer. Rows outside ``where``, or
    without key, start or tie, get NULL and a false ``_in_order`` marker.
    """
    picked = F.col(sk).isNotNull() & F.col(start).isNotNull() & F.col(tie).isNotNull()
    if where is not None:
        picked = picked & where
    marked = df.withColumn("_in_order", F.coalesce(picked, F.lit(False)))
    points = next_start(marked.where("_in_order"), sk, start, tie)
    points = points.withColumnsRenamed({sk: "_sk", start: "_start"})
    joined = marked.join(
        points,
        F.col("_in_order") & (F.col(sk) == F.col("_sk")) & (F.col(start) == F.col("_start")),
        "left",
    )
    following = F.when(F.col(tie) < F.col("_last_tie"), F.col(start)).otherwise(F.col("_next_start"))
    return joined.withColumn(out, F.when(F.col("_in_order"), following)).drop(
        "_sk", "_start", "_last_tie", "_next_start"
    )
