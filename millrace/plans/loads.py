"""Whole loads, composed from the operators.

Each returns the next state of its tables as frames, so a load is one plan per
table and every table is written once. Loads that stage their increment or their
numbered versions write those when called; the rest is lazy.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import (
    BOOKKEEPING,
    BOOKKEEPING_WITH_SOURCE_TS,
    align_to_target,
    as_batch,
    as_ts,
    hash_key,
    rename_by_mapping,
    stamp_audit,
)
from millrace.operators.audit import (
    MODEL_KEYS,
    WrittenMetrics,
    finish_models,
    init_model_audit,
    model_state,
    start_models,
)
from millrace.operators.deletes import (
    apply_hard_delete,
    capture_deleted_keys,
    capture_missing_rows,
    captured_outcomes,
    deleted_since_written,
    logged_keys,
    newest_deletes,
    surviving_rows,
)
from millrace.operators.filters import delete_events, incremental_filter
from millrace.operators.journal import Scan, journal_reload, newest_journal_segments, segments_above
from millrace.operators.joins import anti_not_exists, semi_exists
from millrace.operators.latest import latest_by_max, latest_by_rank
from millrace.operators.merge import (
    OUTCOME,
    conform,
    delete_insert_by_key,
    delete_insert_by_watermark,
    full_replace,
    merge_outcomes,
    merge_upsert,
)
from millrace.operators.numbering import join_null_safe
from millrace.operators.quality import (
    column_inventory,
    exclude_bad_keys,
    find_duplicate_keys,
    find_null_keys,
    record_drift,
    record_issues,
    resolve_issues,
    schema_drift,
)
from millrace.operators.key_registry import KeyRegistry
from millrace.operators.scd2 import (
    apply_version_changes,
    assign_sequence_number,
    assign_surrogate_key,
    split_live,
    version_changes,
)
from millrace.session import stage
from millrace.sources.files import (
    by_name,
    load_files_by_name,
    load_files_replace,
    load_files_with_mapping,
)
from millrace.sources.sinks import save_state
from millrace.streaming.ledger import OnceTable, consume_files


class SilverLoad:
    """Next state of a silver table (``target``) and of what the load also maintains.

    The other tables (``deleted``, ``history``, ``log``, ``check``, ``drift``, ..) are frames too,
    built when first asked for; None where a load does not maintain them.
    """

    def __init__(self, target: DataFrame, **others: Callable[[], DataFrame]):
        self.target = target
        self._others = others

    def _other(self, name: str) -> DataFrame | None:
        build = self._others.get(name)
        return None if build is None else build()

    @cached_property
    def deleted(self) -> DataFrame | None:
        return self._other("deleted")

    @cached_property
    def history(self) -> DataFrame | None:
        return self._other("history")

    @cached_property
    def outcomes(self) -> DataFrame | None:
        return self._other("outcomes")

    @cached_property
    def log(self) -> DataFrame | None:
        return self._other("log")

    @cached_property
    def rows_deleted(self) -> DataFrame | None:
        return self._other("rows_deleted")

    @cached_property
    def check(self) -> DataFrame | None:
        return self._other("check")

    @cached_property
    def drift(self) -> DataFrame | None:
        return self._other("drift")


def file_to_stage(
    spark: SparkSession, path: str, target_schema: T.StructType, fmt: str = "csv", **kwargs
) -> DataFrame:
    return load_files_replace(spark, path, target_schema, fmt, **kwargs)


def file_to_bronze(
    spark: SparkSession,
    path: str,
    target: DataFrame,
    *,
    header: bool,
    mapping: dict[str, str] | None = None,
    **kwargs,
) -> DataFrame:
    """Files with a header load by name, files without one through the mapping."""
    if header:
        return load_files_by_name(spark, path, target, **kwargs)
    return load_files_with_mapping(spark, path, mapping or {}, target, **kwargs)


def file_to_bronze_once(
    spark: SparkSession,
    in_dir: str,
    archive_dir: str | None,
    table: OnceTable,
    file_schema: T.StructType,
    checkpoint: str,
    *,
    header: bool,
    mapping: dict[str, str] | None = None,
    batch_id,
    load_ts,
    **options,
) -> DataFrame:
    """``file_to_bronze`` for the files that arrived since the last run; returns the table.

    Each file is appended once, also if a run fails at any point and is started
    again. Files with a header load by name, others through the mapping; file columns
    outside both are dropped, table columns outside the mapping stay NULL.
    """

    def land(rows: DataFrame) -> DataFrame:
        named = by_name(rows, table.schema.names) if header else rename_by_mapping(rows, mapping or {})
        stamped = stamp_audit(named, batch_id=batch_id, load_ts=load_ts, src_load_ts=load_ts)
        return conform(stamped, table.schema)

    query = consume_files(
        spark, in_dir, archive_dir, file_schema, checkpoint, table, land, header=header, **options
    )
    query.awaitTermination()
    return table.rows()


def stage_to_bronze(
    target: DataFrame,
    source: DataFrame,
    *,
    load_type: str,
    ts_col: str,
    since=None,
    batch_id,
    load_ts,
) -> DataFrame:
    """Full loads replace the table, incremental ones everything above the watermark."""
    if load_type == "full":
        return full_replace(source, target.schema, batch_id=batch_id, load_ts=load_ts)
    if load_type != "incremental":
        raise ValueError(f"unknown load type {load_type!r}")
    aligned = align_to_target(source, target.columns, BOOKKEEPING)
    stamped = stamp_audit(aligned, batch_id=batch_id, load_ts=load_ts)
    return delete_insert_by_watermark(target, stamped, ts_col, since)


def journal_to_bronze(
    target: DataFrame,
    segments: DataFrame,
    read_segment: Callable[[str], DataFrame] | None,
    table: str,
    *,
    k: int | None = None,
    load_type: str = "incremental",
    since=None,
    scan: Callable[[list[str]], Scan] | None = None,
    **kwargs,
) -> DataFrame:
    """Reload from all journal segments that can hold rows above the watermark.

    ``read_segment`` reads one by name, a branch of the plan each; ``scan`` reads all
    together (``read_segments``), a plan of one size for any number of them.

    ``k`` takes the k newest ones instead; the target's rows of other segments
    then stay, above the watermark too. Only segment names come to the driver.
    """
    if k is not None:
        wanted = newest_journal_segments(segments, table, k)
    else:
        wanted = segments_above(segments, table, None if load_type == "full" else since)
    names = sorted(row["table_name"] for row in wanted.select("table_name").collect())
    if not names:
        return target
    read = scan(names) if scan is not None else [(name, read_segment(name)) for name in names]
    return journal_reload(
        target, read, load_type=load_type, since=since, only_listed=k is not None, **kwargs
    )


def _latest(
    source: DataFrame, keys: Sequence[str], ts_col: str, tie_break: Sequence[str] | None
) -> DataFrame:
    if tie_break is None:
        return latest_by_max(source, keys, ts_col)
    return latest_by_rank(source.dropna(subset=[*keys, ts_col]), keys, [ts_col, *tie_break])


def _increment(rows: DataFrame, staged: bool, batch_id, load_ts, src_load_ts=None) -> DataFrame:
    """The rows to merge, with stamps.

    A merge reads them three times. Staging them first means that the source is
    scanned and reduced once, and that the choice to broadcast them rests on
    the size of files that exist, not on an estimate.
    """
    rows = stamp_audit(rows, batch_id=batch_id, load_ts=load_ts, src_load_ts=src_load_ts)
    return stage(rows, "increment") if staged else rows


def bronze_to_silver(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    ts_col: str,
    since=None,
    batch_id,
    load_ts,
    stage_snapshot: DataFrame | None = None,
    tie_break: Sequence[str] | None = None,
    preserve_load_ts: bool = False,
    stage_increment: bool = True,
    save_to: str | None = None,
    delete_history: DataFrame | None = None,
) -> SilverLoad:
    """Upsert the newest version of every key changed since the watermark.

    Several versions at a key's newest time make the upsert fail, unless
    ``tie_break`` columns choose one. With ``stage_snapshot`` (the keys alive at
    the source) rows missing there are captured in ``deleted`` and removed.

    With ``save_to``, a new path, the merge is computed and written once, in folders by what became of
    each row: ``target`` reads those that stay, ``deleted`` those that are gone, ``outcomes`` how many there
    are of each. ``history`` is ``delete_history``, the lasting delete table, and this load's ``deleted``.
    """
    aligned = align_to_target(source, target.columns, BOOKKEEPING)
    newest = _latest(incremental_filter(aligned, ts_col, since), keys, ts_col, tie_break)
    stamped = _increment(newest, stage_increment, batch_id, load_ts)
    how = {"preserve_load_ts": preserve_load_ts, "source_unique": tie_break is not None}
    if save_to is not None:
        merged = merge_outcomes(target, stamped, keys, stage_snapshot, **how)
        written = save_state(merged, save_to, folders=[OUTCOME])
        deleted = captured_outcomes(written, load_ts)
        return SilverLoad(
            written.where(F.col(OUTCOME) != "deleted").select(*target.columns),
            deleted=lambda: deleted,
            history=lambda: deleted if delete_history is None else delete_history.unionByName(deleted),
            outcomes=lambda: written.groupBy(F.col(OUTCOME).alias("outcome")).agg(F.count(F.lit(1)).alias("rows")),
        )
    merged = merge_upsert(target, stamped, keys, **how)
    if stage_snapshot is None:
        return SilverLoad(merged)
    return SilverLoad(
        surviving_rows(merged, stage_snapshot, keys),
        deleted=lambda: capture_missing_rows(merged, stage_snapshot, keys, load_ts),
    )


def staged_cdc_to_silver(
    target: DataFrame,
    source: DataFrame,
    journal: DataFrame,
    log: DataFrame,
    keys: Sequence[str],
    *,
    ts_col: str,
    load_type: str = "incremental",
    since=None,
    model_id: str,
    model_grp: str,
    pipeline_name: str,
    batch_id,
    load_ts,
    key_col: str = "pk",
    drift_audit: DataFrame | None = None,
    journal_key: str = "primary_key__pk",
    sticky: bool = False,
    stage_increment: bool = True,
) -> SilverLoad:
    """Upsert staged change rows, then log and apply the journal's deletes.

    Removed are rows whose key has a delete event above ``since`` that isn't
    older than the row: a key inserted again after its delete stays. ``sticky``
    removes every key with a delete event in ``journal`` or in the model's log,
    even if it was inserted again since. ``rows_deleted`` counts the removed rows.

    Schema drift is recorded, not fatal: source columns the target lacks are
    ignored, a target column the source lacks is an error.
    """
    wanted = [c for c in target.columns if c not in BOOKKEEPING_WITH_SOURCE_TS]
    missing = [c for c in wanted if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    rows = incremental_filter(source, ts_col, since)
    if load_type == "full":
        rows = latest_by_max(rows, keys, ts_col)
    rows = rows.select(*wanted, F.col(ts_col).alias("_seen"))
    stamped = _increment(rows, stage_increment, batch_id, load_ts, F.col("_seen"))
    merged = merge_upsert(target, stamped.drop("_seen"), keys)
    if sticky:
        gone, residual = delete_events(journal).select(F.col(journal_key).alias("pk")), None
        gone = gone.unionByName(logged_keys(log, model_id))
    else:
        gone, residual = newest_deletes(journal, since, key_col=journal_key), deleted_since_written()
    on = {key_col: "pk"}
    remaining = apply_hard_delete(merged, gone, on, residual)
    others = {
        "rows_deleted": lambda: semi_exists(merged, gone, on, residual)
        .agg(F.count(F.lit(1)).alias("rows_deleted"))
        .select(F.lit(model_id).alias("model_id"), "rows_deleted"),
        "log": lambda: capture_deleted_keys(
            log,
            journal,
            model_id=model_id,
            model_grp=model_grp,
            pipeline_name=pipeline_name,
            batch_id=batch_id,
            load_ts=load_ts,
            key_col=journal_key,
        )
    }
    if drift_audit is not None:
        others["drift"] = lambda: _drift_rows(
            target, source, drift_audit, model_id, model_grp, pipeline_name, batch_id, load_ts
        )
    return SilverLoad(remaining, **others)


def _drift_rows(
    target, source, drift_audit, model_id, model_grp, pipeline_name, batch_id, load_ts
) -> DataFrame:
    """The drift audit after this model's check."""
    spark = target.sparkSession
    found = schema_drift(
        column_inventory(spark, {model_id: source}), column_inventory(spark, {model_id: target})
    )
    rows = stamp_audit(
        found.withColumns(
            {
                "model_grp": F.lit(model_grp),
                "pipeline_name": F.lit(pipeline_name),
                "source_table": F.lit(model_id),
                "target_table": F.lit(model_id),
            }
        ),
        batch_id=batch_id,
        load_ts=load_ts,
    )
    scope = spark.range(1).select(
        F.lit(model_id).alias("model_id"),
        F.lit(model_grp).alias("model_grp"),
        F.lit(pipeline_name).alias("pipeline_name"),
        as_batch(batch_id).alias("batch_id"),
    )
    return record_drift(drift_audit, rows, scope=scope)


def prevalidated_to_silver(
    target: DataFrame,
    source: DataFrame,
    check: DataFrame,
    keys: Sequence[str],
    *,
    ts_col: str,
    since=None,
    payload: str | None = None,
    prevalidate: bool = True,
    model_id: str,
    model_grp: str,
    batch_id,
    load_ts,
    grain: str = "key",
    blank_is_null: bool = False,
    stage_increment: bool = True,
) -> SilverLoad:
    """Upsert rows with sound keys and record the others as issues.

    ``since`` is applied before the duplicate check, so ordinary history of a key
    is not taken for a duplicate.
    """
    rows = source if since is None else incremental_filter(source, ts_col, since)
    ignore = [*BOOKKEEPING, "json_value"]
    aligned = align_to_target(rows, target.columns, ignore)
    if prevalidate:
        good = exclude_bad_keys(aligned, keys, ts_col, blank_is_null=blank_is_null)
    else:
        good = latest_by_max(aligned, keys, ts_col).distinct()
    stamped = _increment(good, stage_increment, batch_id, load_ts)
    merged = merge_upsert(target, stamped, keys, source_unique=prevalidate)

    def next_check() -> DataFrame:
        names = {"model_id": model_id, "model_grp": model_grp}
        recorded = check
        if prevalidate:
            how = {"payload": payload, "grain": grain, "ts_col": ts_col, **names}
            stamps = {"batch_id": batch_id, "load_ts": load_ts}
            issues = find_duplicate_keys(rows, keys, **how, **stamps).unionByName(
                find_null_keys(rows, keys, **how, **stamps)
            )
            recorded = record_issues(check, issues)
        # The keys of the merged table, without merging.
        held = target.select(*keys).unionByName(stamped.select(*keys))
        return resolve_issues(recorded, held, keys, batch_id, **names)

    return SilverLoad(merged, check=next_check)


def delete_insert_to_silver(
    target: DataFrame, source: DataFrame, keys: Sequence[str], *, batch_id, load_ts
) -> DataFrame:
    """Replace the rows of every key that has source rows above the target's watermark."""
    align_to_target(source, target.columns, BOOKKEEPING)  # the names must agree
    return delete_insert_by_key(target, source, keys, batch_id=batch_id, load_ts=load_ts)


class AuditedLoad(NamedTuple):
    """The saved next state, the model audit after the load, and the load's metrics."""

    target: DataFrame
    audit: DataFrame
    metrics: DataFrame


def audited_load(
    audit: DataFrame,
    model: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    path: str,
    *,
    batch_id,
    started,
    finished,
    ts_col: str = "src_load_ts",
    **saving,
) -> AuditedLoad:
    """Start a model's audit row, build and save its next state, finish the row with the metrics.

    ``model`` is one row of model keys. ``build`` gets the model's state in the audit
    (watermark, batch, status) and returns the next state of its table, written to the new
    ``path``. The metrics come from the rows as they are written. A batch that wrote no row
    completes with no counts and the watermark it had.
    """
    running = start_models(init_model_audit(audit, model, batch_id), model, batch_id, started)
    taken = WrittenMetrics(batch_id, ts_col)
    target = save_state(build(model_state(running, model, batch_id)), path, observe=taken.observe, **saving)
    named = model.select(*MODEL_KEYS, as_batch(batch_id).alias("batch_id")).withColumns(taken.columns())
    return AuditedLoad(target, finish_models(running, named, finished), taken.frame(target.sparkSession))


# Changes of type-2 versions up to this number are broadcast; a row has some hundred bytes.
BROADCAST_CHANGES = 500_000


def scd2_load(
    dim: DataFrame,
    src: DataFrame,
    *,
    sk: str,
    seq: str,
    key_cols: Sequence[str],
    version_cols: Sequence[str],
    start_ts: str,
    load_ts,
    deleted: DataFrame | None = None,
    deleted_on: Sequence[str] | None = None,
    unique_versions: bool = False,
    batch_keys_only: bool = False,
    registry: KeyRegistry | None = None,
    load: str | None = None,
    broadcast_changes: int = BROADCAST_CHANGES,
) -> DataFrame:
    """Type-2 dimension after adding the versions of a batch.

    Hash keys, surrogate keys and version numbers are given to the batch, its
    rows are appended as active versions, versions with a successor are closed,
    reporting flags reduced to one per version, and deleted keys closed.

    The dimension is read once for its next state, and joined once, with the
    changes of its rows. Those are found on a few columns of its live rows, and
    staged; in a dimension that the load before left closed they are as many as the batch
    has keys. Up to ``broadcast_changes`` of them are broadcast, and no row of the
    dimension moves. Beyond that the rows that are neither active nor reporting,
    which no step changes, are read apart and bypass the join.

    The numbered batch, which the later steps read several times, is staged; the
    dimension never is. Numbering reads ``src`` several times too: pass a table, or
    stage it, if it is costly to compute. With a ``registry`` of surrogate keys the
    dimension isn't read for them, and the registry is extended by the new ones under
    the name ``load``, which a load that runs again must give again.

    ``batch_keys_only`` looks for changes among the batch's keys alone. That gives the
    same table if the dimension was left closed by the load before.
    """
    if registry is not None and load is None:
        raise ValueError("a load that extends the registry needs a name")
    on = list(deleted_on or [sk])
    batch = src.withColumns(
        {"hash_sk": hash_key(key_cols), "hash_seq_no": hash_key(version_cols)}
    )
    # Keys are given to distinct keys, numbers to versions; the two meet in the staged versions.
    keys = batch.select(*key_cols, "hash_sk").distinct()
    keys = assign_surrogate_key(keys, dim, sk, key_cols, registry=registry, load=load)
    numbered = assign_sequence_number(batch, dim, seq, unique_order=unique_versions)
    keyed = join_null_safe(numbered.drop(sk), keys.select(*key_cols, sk), key_cols)
    versions = keyed.withColumns(
        {
            "start_ts": as_ts(F.col(start_ts)),
            "end_ts": as_ts(None),
            "active_flg": F.lit("Y"),
            "reporting_flg": F.lit("Y"),
            "etl_updt_ts": as_ts(load_ts),
        }
    )
    versions = stage(conform(versions, dim.schema), "scd2-versions", "zstd")
    if registry is not None:
        registry.extend(versions, load, sk)

    live, history = split_live(dim)
    among = live
    if batch_keys_only:
        among = semi_exists(live, versions, [sk])
        if deleted is not None:
            among = among.unionByName(semi_exists(anti_not_exists(live, versions, [sk]), deleted, on))
    changes = stage(
        version_changes(among.unionByName(versions), sk, seq, deleted=deleted, deleted_on=on if deleted is not None else ()),
        "scd2-changes",
        "zstd",
    )
    on = on if deleted is not None else []
    if changes.limit(broadcast_changes + 1).count() <= broadcast_changes:
        return apply_version_changes(dim.unionByName(versions), F.broadcast(changes), sk, seq, deleted_on=on)
    current = apply_version_changes(live.unionByName(versions), changes, sk, seq, deleted_on=on)
    return current.unionByName(history)


__all__ = [
    "AuditedLoad",
    "SilverLoad",
    "audited_load",
    "bronze_to_silver",
    "delete_insert_to_silver",
    "file_to_bronze",
    "file_to_bronze_once",
    "file_to_stage",
    "journal_to_bronze",
    "prevalidated_to_silver",
    "scd2_load",
    "stage_to_bronze",
    "staged_cdc_to_silver",
]
