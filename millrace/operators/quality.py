"""Key checks, quarantine records, column tests and schema drift."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import (
    BATCH_TYPE,
    BOOKKEEPING_WITH_SOURCE_TS,
    as_batch,
    as_ts,
    key_json,
)
from millrace.operators.aggregates import group_by_all_having
from millrace.operators.joins import anti_not_exists, distinct_keys
from millrace.operators.merge import conform, merge_update_subset
from millrace.operators.numbering import join_null_safe

# Names of the two key checks.
DUPLICATE_CHECK = "Duplication Check for Key Columns"
NULL_CHECK = "Null Check for Key Columns"

# Key types whose JSON text gives the same value back. Times lose their microseconds.
_EXACT_IN_JSON = (T.StringType, T.IntegralType, T.DecimalType, T.BooleanType, T.DateType)

ISSUE_KEYS = ("model_id", "model_grp", "key_column", "validation_type", "src_load_ts")


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _issues(
    rows: DataFrame,
    keys: Sequence[str],
    validation_type: str,
    min_count: int,
    *,
    payload: str | None,
    grain: str,
    ts_col: str,
    model_id: str,
    model_grp: str,
    batch_id,
    load_ts,
) -> DataFrame:
    keys = sorted(keys)
    content = F.col(payload) if payload else F.lit("{}")
    narrow = rows.select(*keys, F.col(ts_col).alias("_ts"), content.alias("_payload"))
    if grain == "key":
        # The newest row speaks for the group.
        newest = F.max(F.struct("_ts", "_payload")).alias("_newest")
        groups = narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), newest)
        groups = groups.select(*keys, "_n", "_newest._ts", "_newest._payload")
    elif grain == "row":
        groups = narrow.groupBy(*keys, "_ts", "_payload").agg(F.count(F.lit(1)).alias("_n"))
    else:
        raise ValueError(f"unknown grain {grain!r}")
    return groups.where(F.col("_n") >= min_count).select(
        F.lit(model_id).alias("model_id"),
        F.lit(model_grp).alias("model_grp"),
        key_json(keys).alias("key_column"),
        F.lit(validation_type).alias("validation_type"),
        F.col("_n").cast(BATCH_TYPE).alias("issue_record_count"),
        F.col("_payload").alias("json_value"),
        F.lit("N").alias("success_flg"),
        as_batch(batch_id).alias("batch_id"),
        as_ts(F.col("_ts")).alias("src_load_ts"),
        as_ts(load_ts).alias("etl_load_ts"),
        as_ts(load_ts).alias("etl_updt_ts"),
    )


def find_duplicate_keys(
    src: DataFrame,
    keys: Sequence[str],
    payload: str | None = None,
    grain: str = "key",
    *,
    ts_col: str = "src_load_ts",
    model_id: str,
    model_grp: str,
    batch_id,
    load_ts,
) -> DataFrame:
    """One issue per key that occurs more than once.

    ``grain="row"`` groups by payload and source time as well, which misses keys
    whose copies differ.

    Duplicated keys are found on the key columns alone; only their rows are then
    read with payload and grouped.
    """
    repeated = group_by_all_having(src.select(*keys), keys).select(*keys)
    return _issues(
        join_null_safe(src, repeated, keys, "left_semi"), keys, DUPLICATE_CHECK, 2, payload=payload, grain=grain, ts_col=ts_col,
        model_id=model_id, model_grp=model_grp, batch_id=batch_id, load_ts=load_ts,
    )


def find_null_keys(
    src: DataFrame,
    keys: Sequence[str],
    payload: str | None = None,
    grain: str = "key",
    *,
    ts_col: str = "src_load_ts",
    model_id: str,
    model_grp: str,
    batch_id,
    load_ts,
) -> DataFrame:
    """One issue per key with a NULL member; that member is absent from the key object."""
    return _issues(
        src.where(_any_null(keys)), keys, NULL_CHECK, 1, payload=payload, grain=grain, ts_col=ts_col,
        model_id=model_id, model_grp=model_grp, batch_id=batch_id, load_ts=load_ts,
    )


def exclude_bad_keys(
    src: DataFrame, keys: Sequence[str], ts_col: str, *, blank_is_null: bool = False
) -> DataFrame:
    """Rows whose key occurs once and has no NULL, provided they have a time.

    A key that occurs once is its own latest and only version, so neither a
    latest-row step nor a distinct is needed. The duplicated keys come from a
    key-only aggregate and are usually few: the rows themselves are then filtered
    by a broadcast anti join and never shuffled.

    ``blank_is_null`` lets a blank key count as a copy of a NULL one.
    """
    types = dict(src.dtypes)
    compared = {
        f"_c_{k}": F.coalesce(F.col(k), F.lit(""))
        if blank_is_null and types[k] == "string"
        else F.col(k)
        for k in keys
    }
    bad = group_by_all_having(src.select(*[c.alias(n) for n, c in compared.items()]), list(compared))
    good = src.where(~_any_null(keys) & F.col(ts_col).isNotNull()).withColumns(compared)
    return good.join(bad.select(*compared), list(compared), "left_anti").select(*src.columns)


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Values that occur more than once, with their count; NULLs are ignored."""
    return group_by_all_having(df.where(F.col(col).isNotNull()), [col])


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def record_issues(check: DataFrame, issues: DataFrame) -> DataFrame:
    """Merge issues into the check table; a known issue keeps its first load time."""
    updated = [
        "issue_record_count", "json_value", "success_flg", "batch_id", "etl_updt_ts",
    ]
    return merge_update_subset(check, issues, ISSUE_KEYS, updated)


def _present_keys(open_keys: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The key objects (``key_column``) whose key the target has."""
    fields = [T.StructField(k, target.schema[k].dataType) for k in keys]
    if not all(isinstance(f.dataType, _EXACT_IN_JSON) for f in fields):
        rendered = target.select(key_json(keys).alias("key_column"))
        return rendered.join(open_keys, ["key_column"], "left_semi").distinct()
    parsed = F.from_json("key_column", T.StructType(fields))
    typed = open_keys.select("key_column", parsed.alias("_k"))
    typed = typed.select("key_column", *[F.col("_k").getField(k).alias(k) for k in keys])
    typed = typed.where(key_json(keys) == F.col("key_column"))  # objects of other columns fall out
    held = join_null_safe(target.select(*keys), typed.select(*keys), keys, "left_semi").distinct()
    return join_null_safe(typed, held, keys, "left_semi").select("key_column")


def resolve_issues(
    check: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    batch_id,
    *,
    model_id: str,
    model_grp: str,
) -> DataFrame:
    """Issues of earlier batches succeed once their key is in the target.

    The open key objects, few next to the target, are parsed into columns, so the
    target is filtered by its own key columns.
    """
    is_open = (
        (F.col("model_id") == model_id)
        & (F.col("model_grp") == model_grp)
        & (F.col("batch_id") < as_batch(batch_id))
    )
    open_keys = distinct_keys(check.where(is_open), ["key_column"])
    present = _present_keys(open_keys, target, list(keys)).withColumnRenamed("key_column", "_key")
    return (
        check.join(present, is_open & (F.col("key_column") == F.col("_key")), "left")
        .withColumn(
            "success_flg", F.when(F.col("_key").isNotNull(), "Y").otherwise(F.col("success_flg"))
        )
        .select(*check.columns)
    )


def column_inventory(spark: SparkSession, models: Mapping[str, DataFrame]) -> DataFrame:
    """(model_id, column_name, data_type) of the given frames."""
    rows = [(model, name, dtype) for model, df in models.items() for name, dtype in df.dtypes]
    return spark.createDataFrame(rows, "model_id string, column_name string, data_type string")


def schema_drift(
    src_cols: DataFrame, tgt_cols: DataFrame, ignore: Iterable[str] = BOOKKEEPING_WITH_SOURCE_TS
) -> DataFrame:
    """Type changes and columns missing on either side, for all models at once.

    Both inputs are (model_id, column_name, data_type). They are stacked and
    grouped once instead of joined.
    """
    skip = [c.lower() for c in ignore]
    name, dtype = F.lower("column_name").alias("column_name"), F.lower("data_type")
    none = F.lit(None).cast("string")
    src = src_cols.select("model_id", name, dtype.alias("_src"), none.alias("_tgt"))
    tgt = tgt_cols.select("model_id", name, none.alias("_src"), dtype.alias("_tgt"))
    both = (
        src.unionByName(tgt)
        .where(~F.col("column_name").isin(skip))
        .groupBy("model_id", "column_name")
        .agg(F.max("_src").alias("source_column_type"), F.max("_tgt").alias("target_column_type"))
    )
    source, target = F.col("source_column_type"), F.col("target_column_type")
    diff = (
        F.when(target.isNull(), "MISSING_IN_TARGET")
        .when(source.isNull(), "MISSING_IN_SOURCE")
        .when(source != target, "TYPE_MISMATCH")
    )
    return both.withColumn("diff_type", diff).where("diff_type IS NOT NULL")


def record_drift(
    audit: DataFrame,
    drift: DataFrame,
    keys: Sequence[str] = ("model_id", "model_grp", "pipeline_name", "batch_id"),
    scope: DataFrame | None = None,
) -> DataFrame:
    """Replace the drift rows of the checked models.

    ``scope`` lists the checked models; it defaults to those with drift, which
    leaves the old rows of a model that no longer drifts in place.
    """
    kept = anti_not_exists(audit, drift if scope is None else scope, list(keys))
    return kept.select(*audit.columns).union(conform(drift, audit.schema))
