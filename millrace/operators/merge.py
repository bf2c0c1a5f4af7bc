"""Keyed writes as next-state operators.

Plain parquet tables have no row-level MERGE, so each operator returns the
table as it is after the write, columns and types of the target.

Shape of a merge. The target goes through one left outer join with the source
(one row per key) and the source rows without a partner are appended. A small
source is therefore broadcast and the target never shuffled; a large one turns
both joins into sort-merge joins whose left side AQE can split. A single full
outer join would allow neither.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import BOOKKEEPING, align_to_target, as_ts, stamp_audit
from millrace.operators.filters import EPOCH, filter_above_target_watermark
from millrace.operators.joins import distinct_keys, unseen_rows


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name in the order and types of ``schema``; absent ones are NULL."""
    have = {f.name.lower(): f for f in df.schema.fields}

    def column(field: T.StructField) -> Column | str:
        found = have.get(field.name.lower())
        if found is not None and (found.name, found.dataType) == (field.name, field.dataType):
            return f"`{field.name}`"
        value = F.lit(None) if found is None else F.col(f"`{found.name}`")
        return value.cast(field.dataType).alias(field.name)

    return df.select([column(f) for f in schema.fields])


def _insert(target: DataFrame, rows: DataFrame, insert_cols: Sequence[str] | None = None) -> DataFrame:
    """Append rows; target columns outside ``insert_cols`` stay NULL."""
    if insert_cols is not None:
        rows = rows.select(*insert_cols)
    return target.union(conform(rows, target.schema))


def _merge(
    target: DataFrame,
    source: DataFrame,
    target_keys: Mapping[str, Column],
    source_keys: Mapping[str, Column],
    set_exprs: Mapping[str, Column],
    *,
    insert_cols: Sequence[str] | None,
    target_condition: Column | None,
    source_unique: bool,
) -> DataFrame:
    """Merge on computed keys (``_k0``, ``_k1``, ...).

    ``set_exprs`` see the target row as ``t`` and the source row as ``s``.
    ``target_condition`` is part of the match: rows failing it have no partner.
    """
    keys = list(target_keys)
    allowed = F.lit(True) if target_condition is None else F.coalesce(target_condition, F.lit(False))
    t = target.withColumns({**target_keys, "_allowed": allowed})
    s = source.withColumns(dict(source_keys))

    with_keys = s.dropna(subset=keys)
    if source_unique:
        one_per_key = with_keys.withColumn("_copies", F.lit(1))
    else:
        # Copies of a hot key collapse map-side. With more than one copy the
        # values do not matter: a match raises, and inserts use the raw rows.
        one_per_key = with_keys.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_copies"), *[F.first(c).alias(c) for c in source.columns]
        )
    on = F.col("t._allowed")
    for k in keys:
        on = (F.col(f"t.{k}") == F.col(f"s.{k}")) & on
    # The check sits inside the condition of every assigned column, so column
    # pruning cannot lose it.
    matched = F.when(
        F.col("s._copies") > 1,
        F.raise_error("several source rows match one target row").cast("boolean"),
    ).otherwise(F.col("s._copies").isNotNull())
    updated = (
        t.alias("t")
        .join(one_per_key.alias("s"), on, "left")
        .select(
            [
                F.when(matched, set_exprs[f.name].cast(f.dataType))
                .otherwise(F.col(f"t.`{f.name}`"))
                .alias(f.name)
                if f.name in set_exprs
                else f"t.`{f.name}`"
                for f in target.schema.fields
            ]
        )
    )
    fresh = unseen_rows(s, t.where("_allowed"), keys).select(*source.columns)
    return _insert(updated, fresh, insert_cols)


def _plain_keys(keys: Sequence[str]) -> dict[str, Column]:
    return {f"_k{i}": F.col(f"`{k}`") for i, k in enumerate(keys)}


def _non_blank_keys(df: DataFrame, keys: Sequence[str]) -> dict[str, Column]:
    types = dict(df.dtypes)
    return {
        f"_k{i}": F.nullif(F.col(k), F.lit("")) if types[k] == "string" else F.col(k)
        for i, k in enumerate(keys)
    }


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    insert_cols: Sequence[str] | None = None,
    *,
    preserve_load_ts: bool = False,
    source_unique: bool = False,
) -> DataFrame:
    """Matched rows take the source values, other source rows are inserted.

    NULL keys never match. Two source rows matching one target row are an error,
    raised in the plan. ``preserve_load_ts`` keeps the load time of updated rows,
    so that load metrics can tell updates from inserts. ``source_unique`` skips
    the duplicate check for sources that have one row per key by construction.
    """
    if update_cols is None:
        update_cols = [c for c in target.columns if c not in keys and c in source.columns]
    if preserve_load_ts:
        update_cols = [c for c in update_cols if c != "etl_load_ts"]
    return _merge(
        target,
        source,
        _plain_keys(keys),
        _plain_keys(keys),
        {c: F.col(f"s.`{c}`") for c in update_cols},
        insert_cols=insert_cols,
        target_condition=None,
        source_unique=source_unique,
    )


OUTCOME = "_outcome"


def merge_outcomes(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    alive: DataFrame | None = None,
    *,
    preserve_load_ts: bool = False,
    source_unique: bool = False,
) -> DataFrame:
    """``merge_upsert`` and the deletes of a snapshot in one frame that tells what became of each row.

    ``_outcome`` is ``kept``, ``updated`` or ``inserted``; with ``alive``, the keys the source still
    has, ``deleted`` for rows whose key isn't among them, and ``unaddressed`` for
    rows with a NULL in their key, which are missing there but can't be deleted.
    """
    marked = target.withColumn(OUTCOME, F.lit("kept"))
    new = source.withColumn(OUTCOME, F.lit("inserted"))
    fixed = {*keys, "etl_load_ts"} if preserve_load_ts else set(keys)
    update = {c: F.col(f"s.`{c}`") for c in target.columns if c not in fixed and c in source.columns}
    merged = _merge(
        marked,
        new,
        _plain_keys(keys),
        _plain_keys(keys),
        update | {OUTCOME: F.lit("updated")},
        insert_cols=None,
        target_condition=None,
        source_unique=source_unique,
    )
    if alive is None:
        return merged
    held = distinct_keys(alive, keys).withColumnsRenamed({k: f"_d_{k}" for k in keys})
    match = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_d_{k}") for k in keys])
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    joined = merged.join(held.withColumn("_alive", F.lit(True)), match, "left")
    outcome = F.when(no_key, "unaddressed").when(F.col("_alive").isNull(), "deleted").otherwise(F.col(OUTCOME))
    return joined.withColumn(OUTCOME, outcome).select(*target.columns, OUTCOME)


def merge_configurable(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = (),
    *,
    exclude_from_update: Iterable[str] = (),
    extra_on: Column | None = None,
    source_on: Column | None = None,
    update_flag: str | None = None,
    source_unique: bool = False,
) -> DataFrame:
    """Merge with blank keys as no match, excluded columns and match conditions.

    ``extra_on`` is a predicate on target columns, ``source_on`` one on source
    columns; ``update_flag`` names a target column that must be 'Y'. All are part
    of the match, so a source row whose partner fails them is inserted beside it.
    Without keys every source row is inserted.
    """
    if not keys:
        return append_load(target, source)
    excluded = {c.upper() for c in exclude_from_update}
    condition = extra_on
    if update_flag is not None:
        flag_on = F.col(update_flag) == "Y"
        condition = flag_on if condition is None else condition & flag_on
    source_keys = _non_blank_keys(source, keys)
    if source_on is not None:
        # A source row that may not match has no match key.
        source_keys = {k: F.when(source_on, column) for k, column in source_keys.items()}
    return _merge(
        target,
        source,
        _non_blank_keys(target, keys),
        source_keys,
        {
            c: F.col(f"s.`{c}`")
            for c in target.columns
            if c.upper() not in excluded and c in source.columns
        },
        insert_cols=None,
        target_condition=condition,
        source_unique=source_unique,
    )


def merge_update_subset(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    set_exprs: Sequence[str] | Mapping[str, Column],
    *,
    insert_cols: Sequence[str] | None = None,
    source_unique: bool = False,
) -> DataFrame:
    """Matched rows change only in the named columns; other source rows are inserted.

    Values are source columns of the same name, or expressions over ``t`` and ``s``.
    """
    if not isinstance(set_exprs, Mapping):
        set_exprs = {c: F.col(f"s.`{c}`") for c in set_exprs}
    return _merge(
        target,
        source,
        _plain_keys(keys),
        _plain_keys(keys),
        set_exprs,
        insert_cols=insert_cols,
        target_condition=None,
        source_unique=source_unique,
    )


def insert_when_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _insert(target, unseen_rows(source, target, keys))


def delete_insert_by_watermark(
    target: DataFrame, source: DataFrame, ts_col: str, since: datetime | str | None = None
) -> DataFrame:
    """Replace everything newer than the watermark; rows without a time stay.

    Two filters and a union: no shuffle, and running it again changes nothing.
    """
    mark = as_ts(since if since is not None else EPOCH)
    kept = target.where((F.col(ts_col) <= mark) | F.col(ts_col).isNull())
    return _insert(kept, source.where(F.col(ts_col) > mark))


def delete_insert_by_key(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    src_ts: str = "etl_load_ts",
    tgt_ts: str = "etl_updt_ts",
    *,
    batch_id=None,
    load_ts=None,
) -> DataFrame:
    """Replace the target rows of every key that has newer source rows.

    The target's watermark is taken before the delete and used for both steps.
    All newer source rows go in, with new stamps when ``batch_id`` is given.
    """
    newer = filter_above_target_watermark(source, target, src_ts, tgt_ts)
    kept = target.join(distinct_keys(newer, keys), list(keys), "left_anti").select(*target.columns)
    if batch_id is not None:
        newer = stamp_audit(newer, batch_id=batch_id, load_ts=load_ts)
    return _insert(kept, newer)


def full_replace(
    source: DataFrame, target_schema: T.StructType, *, batch_id, load_ts
) -> DataFrame:
    """The table after truncate and insert: stamped source rows only."""
    aligned = align_to_target(source, target_schema.names, BOOKKEEPING)
    return conform(stamp_audit(aligned, batch_id=batch_id, load_ts=load_ts), target_schema)


def append_load(target: DataFrame, source: DataFrame) -> DataFrame:
    return _insert(target, source)


def empty_like(df: DataFrame) -> DataFrame:
    """A frame of the same structure without rows."""
    return df.where(F.lit(False))


__all__ = [
    "append_load",
    "conform",
    "delete_insert_by_key",
    "delete_insert_by_watermark",
    "empty_like",
    "full_replace",
    "insert_when_absent",
    "merge_configurable",
    "merge_outcomes",
    "merge_update_subset",
    "merge_upsert",
]
