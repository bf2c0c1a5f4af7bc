"""Type-2 dimensions: surrogate keys, version numbers, closing of versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import BATCH_TYPE
from millrace.operators.joins import cross_join_scalar, distinct_keys
from millrace.operators.key_registry import KeyRegistry
from millrace.operators.numbering import (
    dense_rank_global,
    join_null_safe,
    lead_next_start,
    row_number_global,
    row_number_per_key,
)


def _of_batch(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows of the batch's keys.

    A small batch is broadcast to the scan, so the dimension is cut down before it
    is grouped, and not shuffled.
    """
    return target.join(distinct_keys(source, list(keys)), list(keys), "left_semi")


def _without(df: DataFrame, col: str) -> list[str]:
    return [c for c in df.columns if c != col]


def assign_surrogate_key(
    src: DataFrame,
    target: DataFrame | None,
    sk: str,
    key_cols: Sequence[str],
    hash_col: str = "hash_sk",
    *,
    gapless: bool = False,
    registry: KeyRegistry | None = None,
    load: str | None = None,
) -> DataFrame:
    """Known hashes keep their surrogate key, new ones continue after the largest.

    New keys rank over the whole batch, so known keys leave gaps; ``gapless``
    ranks the new keys alone. With a ``registry`` the known keys and the largest one
    come from there, and ``target`` isn't read; entries of ``load`` itself don't count.
    """
    if registry is None:
        held = target.select(F.col(hash_col), F.col(sk))
        top = target.agg(F.coalesce(F.max(sk), F.lit(0)).cast(BATCH_TYPE).alias("_top"))
    else:
        held = registry.entries(load).select(F.col("hash_sk").alias(hash_col), F.col("sk").alias(sk))
        top = registry.top(load).withColumnRenamed("top", "_top")
    known = _of_batch(held, src, [hash_col]).groupBy(hash_col).agg(F.max(sk).alias("_known"))
    batch = src.drop(sk).join(known, [hash_col], "left")
    to_rank = batch.where("_known IS NULL") if gapless else src
    ranks = dense_rank_global(to_rank, key_cols, "_rank")
    numbered = cross_join_scalar(join_null_safe(batch, ranks, key_cols, "left"), top)
    value = F.coalesce(F.col("_known").cast(BATCH_TYPE), F.col("_rank") + F.col("_top"))
    return numbered.withColumn(sk, value.cast(BATCH_TYPE)).select(*_without(src, sk), sk)


def assign_sequence_number(
    src: DataFrame,
    target: DataFrame,
    seq: str,
    *,
    hash_sk: str = "hash_sk",
    hash_seq_no: str = "hash_seq_no",
    active_flg: str = "active_flg",
    global_numbering: bool = False,
    gapless: bool = False,
    unique_order: bool = False,
) -> DataFrame:
    """Active known versions keep their number, others continue after the key's largest.

    Numbers run per key in order of the version hash; ``global_numbering`` runs
    them over the batch. ``gapless`` leaves known versions out of the count.
    ``unique_order`` says that (key, version hash) is unique in the batch.
    """
    # One scan of the target for both: the largest number, and the largest of active rows.
    active = F.max(F.when(F.col(active_flg) == "Y", F.col(seq)))
    held = (
        _of_batch(target.select(hash_sk, hash_seq_no, active_flg, seq), src, [hash_sk])
        .groupBy(hash_sk, hash_seq_no)
        .agg(active.alias("_known"), F.max(seq).alias("_last"))
    )
    known = held.select(hash_sk, hash_seq_no, "_known").dropna()
    last = held.groupBy(hash_sk).agg(F.max("_last").alias("_last"))

    def with_known(rows: DataFrame) -> DataFrame:
        return rows.join(known, [hash_sk, hash_seq_no], "left")

    def number(rows: DataFrame) -> DataFrame:
        if global_numbering:
            return row_number_global(rows, [hash_sk, hash_seq_no], "_rn", unique_order)
        return row_number_per_key(rows, [hash_sk], [hash_seq_no], "_rn", unique_order)

    if gapless:
        batch = with_known(src.drop(seq))
        fresh = number(batch.where("_known IS NULL"))
        kept = batch.where("_known IS NOT NULL").withColumn("_rn", F.lit(None).cast("long"))
        numbered = fresh.unionByName(kept)
    else:
        numbered = with_known(number(src.drop(seq)))
    value = F.coalesce(
        F.col("_known").cast(BATCH_TYPE),
        F.col("_rn") + F.coalesce(F.col("_last"), F.lit(0)).cast(BATCH_TYPE),
    )
    return (
        numbered.join(last, [hash_sk], "left")
        .withColumn(seq, value.cast(BATCH_TYPE))
        .select(*_without(src, seq), seq)
    )


def close_versions(
    dim: DataFrame, sk: str, seq: str, start: str = "start_ts"
) -> DataFrame:
    """Active versions end where the key's next active version starts.

    The last one stays open and keeps both flags at 'Y'. Inactive rows, and rows
    without key, sequence or start, are not touched.
    """
    led = lead_next_start(dim, sk, start, seq, "_next", where=F.col("active_flg") == "Y")
    flag = F.when(F.col("_next").isNull(), "Y").otherwise("N")
    changes = {"end_ts": F.col("_next"), "active_flg": flag, "reporting_flg": flag}
    return led.withColumns(
        {c: F.when(F.col("_in_order"), value).otherwise(F.col(c)) for c, value in changes.items()}
    ).select(*dim.columns)


def demote_reporting(dim: DataFrame, sk: str, seq: str, start: str = "start_ts") -> DataFrame:
    """Reporting rows older than the newest reporting row of the same version drop out.

    The newest start per version is a map-side aggregate joined back, so a hot
    version is neither sorted nor collected anywhere.
    """
    newest = (
        dim.where(F.col("reporting_flg") == "Y")
        .groupBy(F.col(sk).alias("_sk"), F.col(seq).alias("_seq"))
        .agg(F.max(start).alias("_newest"))
    )
    older = (
        (F.col(sk) == F.col("_sk"))
        & (F.col(seq) == F.col("_seq"))
        & (F.col(start) < F.col("_newest"))
        & (F.col("reporting_flg") == "Y")
    )
    return (
        dim.join(newest, older, "left")
        .withColumn(
            "reporting_flg",
            F.when(F.col("_newest").isNotNull(), "N").otherwise(F.col("reporting_flg")),
        )
        .select(*dim.columns)
    )


def _in_order(sk: str, seq: str, start: str) -> Column:
    """Rows that closing may change: active ones with key, number and start."""
    told = F.col(sk).isNotNull() & F.col(seq).isNotNull() & F.col(start).isNotNull()
    return F.coalesce((F.col("active_flg") == "Y") & told, F.lit(False))


def version_changes(
    live: DataFrame,
    sk: str,
    seq: str,
    start: str = "start_ts",
    *,
    deleted: DataFrame | None = None,
    deleted_on: Sequence[str] = (),
) -> DataFrame:
    """What closing, demoting and deleting do to live rows, without the rows they leave alone.

    The outcome of a row depends on its key, number, start and flags (and on the columns
    it is deleted by), so only these are read, and they address the change
    in ``apply_version_changes``: one row per state that changes, with the new flags,
    the next start and whether the key was deleted.
    """
    state = _state(sk, seq, start, deleted_on)
    flags = {"active_flg": "_active", "reporting_flg": "_reporting"}
    rows = _ended(live).select(*state).withColumn("end_ts", F.lit(None).cast("timestamp_ntz"))
    rows = rows.withColumns({f"_was_{c}": F.col(c) for c in flags})
    done = demote_reporting(close_versions(rows, sk, seq, start), sk, seq, start)
    done = done.withColumnsRenamed({**flags, "end_ts": "_end"})
    done = done.withColumnsRenamed({f"_was_{c}": c for c in flags})
    gone = F.lit(False)
    if deleted is not None:
        keys = distinct_keys(deleted, deleted_on).withColumnsRenamed({k: f"_d_{k}" for k in deleted_on})
        match = F.col("_active") == "Y"
        for k in deleted_on:
            match = (F.col(k) == F.col(f"_d_{k}")) & match
        done = done.join(keys.withColumn("_hit", F.lit(True)), match, "left")
        gone = F.coalesce("_hit", F.lit(False))
    done = done.withColumn("_gone", gone)
    changed = (
        F.col("_gone")
        | F.col("_end").isNotNull()
        | (_in_order(sk, seq, start) & F.col("_ended"))
        | ~F.col("_active").eqNullSafe(F.col("active_flg"))
        | ~F.col("_reporting").eqNullSafe(F.col("reporting_flg"))
    )
    return done.where(changed).select(*state, "_active", "_reporting", "_end", "_gone").distinct()


def _state(sk: str, seq: str, start: str, deleted_on: Sequence[str]) -> list[str]:
    return list(dict.fromkeys([sk, seq, start, "active_flg", "reporting_flg", "_ended", *deleted_on]))


def _ended(dim: DataFrame) -> DataFrame:
    return dim.withColumn("_ended", F.col("end_ts").isNotNull())


def apply_version_changes(
    dim: DataFrame, changes: DataFrame, sk: str, seq: str, start: str = "start_ts", deleted_on: Sequence[str] = ()
) -> DataFrame:
    """``dim`` with the changes of ``version_changes``: one join, NULL matching NULL."""
    joined = join_null_safe(_ended(dim), changes, _state(sk, seq, start, deleted_on), "left")
    hit = F.col("_gone").isNotNull()
    end = F.when(hit & _in_order(sk, seq, start), F.col("_end")).otherwise(F.col("end_ts"))
    values = {
        "end_ts": F.when(F.col("_gone"), F.col("etl_updt_ts")).otherwise(end),
        "active_flg": F.when(F.col("_gone"), F.lit("N")).when(hit, F.col("_active")).otherwise(F.col("active_flg")),
        "reporting_flg": F.when(hit, F.col("_reporting")).otherwise(F.col("reporting_flg")),
    }
    return joined.select([values[c].alias(c) if c in values else F.col(f"`{c}`") for c in dim.columns])


def split_live(dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Live rows (active or reporting) and history, which the operators above keep as it is."""
    live = F.coalesce(F.col("active_flg") == "Y", F.lit(False)) | F.coalesce(
        F.col("reporting_flg") == "Y", F.lit(False)
    )
    return dim.where(live), dim.where(~live)
