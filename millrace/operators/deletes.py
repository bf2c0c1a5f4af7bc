"""Delete capture and delete propagation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import as_batch, as_ts
from millrace.operators.filters import delete_events, incremental_filter
from millrace.operators.joins import (
    On,
    anti_not_exists,
    cross_join_scalar,
    distinct_keys,
    semi_exists,
)
from millrace.operators.latest import latest_by_rank
from millrace.operators.merge import OUTCOME, merge_update_subset


def capture_missing_rows(
    target: DataFrame, stage: DataFrame, keys: Sequence[str], load_ts
) -> DataFrame:
    """Target rows that the stage snapshot no longer has.

    They carry the target's newest batch and source time. A NULL key counts as
    missing, since nothing can match it.
    """
    newest = target.agg(
        F.max("batch_id").alias("_batch_id"), F.max("src_load_ts").alias("_src_load_ts")
    )
    gone = cross_join_scalar(anti_not_exists(target, stage, list(keys)), newest)
    return gone.withColumns(
        {
            "batch_id": F.col("_batch_id"),
            "src_load_ts": F.col("_src_load_ts"),
            "etl_load_ts": as_ts(load_ts),
            "etl_updt_ts": as_ts(load_ts),
        }
    ).select(*target.columns)


def captured_outcomes(outcomes: DataFrame, load_ts) -> DataFrame:
    """What ``capture_missing_rows`` gives, from the outcomes of a merge: no further join with the snapshot."""
    columns = [c for c in outcomes.columns if c != OUTCOME]
    newest = outcomes.agg(
        F.max("batch_id").alias("_batch_id"), F.max("src_load_ts").alias("_src_load_ts")
    )
    gone = cross_join_scalar(outcomes.where(F.col(OUTCOME).isin("deleted", "unaddressed")), newest)
    return gone.withColumns(
        {
            "batch_id": F.col("_batch_id"),
            "src_load_ts": F.col("_src_load_ts"),
            "etl_load_ts": as_ts(load_ts),
            "etl_updt_ts": as_ts(load_ts),
        }
    ).select(*columns)


def apply_hard_delete(
    target: DataFrame, deleted: DataFrame, on: On, residual: Column | None = None
) -> DataFrame:
    """Target rows without a partner in the delete set (sides ``t`` and ``s`` of ``residual``)."""
    return anti_not_exists(target, deleted, on, residual).select(*target.columns)


def newest_deletes(
    journal: DataFrame, since=None, *, key_col: str = "primary_key__pk", ts_col: str = "seen_at"
) -> DataFrame:
    """(pk, gone_at): the newest delete event above the watermark of every key."""
    events = incremental_filter(delete_events(journal), ts_col, since)
    return events.groupBy(F.col(key_col).alias("pk")).agg(F.max(ts_col).alias("gone_at"))


def deleted_since_written(row_ts: str = "src_load_ts") -> Column:
    """Residual for ``newest_deletes``: the delete isn't older than the row.

    A key that was inserted again after its delete stays. The image of the delete
    itself, which has the delete's time, goes; so does a row without a time.
    """
    return F.coalesce(F.col("s.gone_at") >= F.col(f"t.{row_ts}"), F.lit(True))


def surviving_rows(target: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after deleting what ``capture_missing_rows`` finds, in one pass.

    Rows the snapshot still has, and rows with a NULL key: those are captured as
    missing, but no delete can address them.
    """
    alive = distinct_keys(stage, keys).withColumnsRenamed({k: f"_d_{k}" for k in keys})
    match = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_d_{k}") for k in keys])
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    marked = target.join(alive.withColumn("_alive", F.lit(True)), match, "left")
    return marked.where(F.col("_alive") | no_key).select(*target.columns)


def capture_deleted_keys(
    log: DataFrame,
    journal: DataFrame,
    *,
    model_id: str,
    model_grp: str,
    pipeline_name: str,
    batch_id,
    load_ts,
    key_col: str = "primary_key__pk",
) -> DataFrame:
    """Merge the last delete event of every key into the deletion log.

    A key logged before keeps its source time and batch; only group, pipeline
    and update time move on.
    """
    last = latest_by_rank(
        delete_events(journal), [key_col], ["seen_at", "least_significant_position"]
    )
    rows = last.select(
        F.lit(model_id).alias("model_id"),
        F.lit(model_grp).alias("model_grp"),
        F.lit(pipeline_name).alias("pipeline_name"),
        F.col(key_col).alias("pk"),
        F.col("seen_at").alias("src_load_ts"),
        as_batch(batch_id).alias("batch_id"),
        as_ts(load_ts).alias("etl_load_ts"),
        as_ts(load_ts).alias("etl_updt_ts"),
    )
    return merge_update_subset(
        log,
        rows,
        ["model_id", "pk"],
        ["model_grp", "pipeline_name", "etl_updt_ts"],
        source_unique=True,
    )


def logged_keys(log: DataFrame, model_id: str, *, ignore_case: bool = False) -> DataFrame:
    """Distinct deleted keys of one model.

    ``ignore_case`` is the form for models named after a view: case does not
    matter and a trailing ``_v`` stands for the table's ``_t``.
    """
    name: Column = F.col("model_id")
    if ignore_case:
        table = model_id[:-2] + "_t" if model_id.lower().endswith("_v") else model_id
        rows = log.where(F.upper(name) == table.upper())
    else:
        rows = log.where(name == model_id)
    return rows.select("pk").dropna().distinct()


def apply_log_delete(
    target: DataFrame,
    log: DataFrame,
    model_id: str,
    key_col: str = "pk",
    *,
    ignore_case: bool = False,
) -> DataFrame:
    """Target rows whose key the log does not list for the model.

    All rows of ``log`` count. Pass only those of a batch to spare keys that were
    inserted again after an earlier delete.
    """
    keys = logged_keys(log, model_id, ignore_case=ignore_case)
    return apply_hard_delete(target, keys, {key_col: "pk"})


def soft_delete(
    dim: DataFrame, deleted: DataFrame, on: On, residual: Column | None = None
) -> DataFrame:
    """Close active rows that have a partner in the delete set.

    Keys alone take one pass with a left join to the distinct deleted keys. With
    a residual a row may match several deleted rows, so it is evaluated as semi
    and anti join, both on the keys.
    """
    closed = {"active_flg": F.lit("N"), "end_ts": F.col("etl_updt_ts")}
    active = F.col("active_flg") == "Y"
    if residual is not None:
        is_active = F.coalesce(active, F.lit(False))
        hit = semi_exists(dim.where(is_active), deleted, on, residual).withColumns(closed)
        missed = anti_not_exists(dim.where(is_active), deleted, on, residual)
        return (
            dim.where(~is_active)
            .unionByName(missed.select(*dim.columns))
            .unionByName(hit.select(*dim.columns))
        )
    keys = distinct_keys(deleted, on)
    renamed = keys.withColumnsRenamed({k: f"_d_{k}" for k in keys.columns})
    condition = active
    for k in keys.columns:
        condition = (F.col(k) == F.col(f"_d_{k}")) & condition
    marked = dim.join(renamed.withColumn("_gone", F.lit(True)), condition, "left")
    return marked.withColumns(
        {c: F.when(F.col("_gone"), value).otherwise(F.col(c)) for c, value in closed.items()}
    ).select(*dim.columns)


def soft_delete_by_log(
    dim: DataFrame, log: DataFrame, model_id: str, key_col: str = "pk", *, ignore_case: bool = True
) -> DataFrame:
    """``soft_delete`` with the deletion log of one model as the delete set."""
    keys = logged_keys(log, model_id, ignore_case=ignore_case)
    return soft_delete(dim, keys, {key_col: "pk"})
