"""Batch and model audit, watermarks and load metrics, for many models at once.

The audit tables are frames like any other: a step that would be one statement
per model is one join over all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import BATCH_TYPE, as_batch, as_ts, batch_id_from_ts
from millrace.operators.aggregates import row_counts
from millrace.operators.filters import EPOCH
from millrace.operators.joins import anti_not_exists, distinct_keys
from millrace.operators.merge import merge_update_subset

MODEL_KEYS = ("model_id", "model_grp", "pipeline_name")

# What the lookups return when nothing is recorded.
NO_BATCH = 0
UNKNOWN_BATCH = 1900010101
UNKNOWN_STATUS = "none"


def open_batches(batch_audit: DataFrame, pipelines: DataFrame, now) -> DataFrame:
    """A new running batch for every pipeline that has none unfinished.

    A batch of the same id that exists already is reopened, not added.
    """
    unfinished = batch_audit.where(F.col("batch_status") != "completed")
    idle = pipelines.select("pipeline_name").distinct()
    opened = anti_not_exists(idle, unfinished, ["pipeline_name"]).select(
        "pipeline_name",
        batch_id_from_ts(as_ts(now)).alias("batch_id"),
        F.lit("running").alias("batch_status"),
        as_ts(now).alias("start_ts"),
        as_ts(None).alias("end_ts"),
    )
    return merge_update_subset(
        batch_audit, opened, ["pipeline_name", "batch_id"], ["end_ts"], source_unique=True
    )


def close_batches(batch_audit: DataFrame, pipelines: DataFrame, now) -> DataFrame:
    """Running batches of the given pipelines are completed."""
    closing = distinct_keys(pipelines, ["pipeline_name"]).select(
        F.col("pipeline_name").alias("_pipeline")
    )
    running = (F.col("pipeline_name") == F.col("_pipeline")) & (F.col("batch_status") == "running")
    marked = batch_audit.join(closing, running, "left")
    hit = F.col("_pipeline").isNotNull()
    return marked.withColumns(
        {
            "batch_status": F.when(hit, "completed").otherwise(F.col("batch_status")),
            "end_ts": F.when(hit, as_ts(now)).otherwise(F.col("end_ts")),
        }
    ).select(*batch_audit.columns)


def current_batch(batch_audit: DataFrame, pipelines: DataFrame) -> DataFrame:
    """The running batch per pipeline, numeric 0 when there is none."""
    running = (
        batch_audit.where(F.col("batch_status") == "running")
        .groupBy("pipeline_name")
        .agg(F.max("batch_id").alias("batch_id"))
    )
    return (
        pipelines.select("pipeline_name")
        .distinct()
        .join(running, ["pipeline_name"], "left")
        .withColumn("batch_id", F.coalesce("batch_id", F.lit(NO_BATCH).cast(BATCH_TYPE)))
    )


def init_model_audit(
    audit: DataFrame, models: DataFrame, batch_id, status: str = "yet to start", now=None
) -> DataFrame:
    """One audit row per model for the batch.

    New models start without a watermark, known ones carry that of their newest
    batch. Rows of this batch that exist already are reset while unfinished.
    ``status="running"`` is the form for a model that starts right away: it also
    sets the start time and clears the end time.
    """
    newest = audit.groupBy(*MODEL_KEYS).agg(F.max_by("inc_load_ts", "batch_id").alias("inc_load_ts"))
    starts = status == "running"
    start_ts = as_ts(now if starts else None)
    null_count = F.lit(None).cast("long")
    rows = (
        models.select(*MODEL_KEYS)
        .distinct()
        .join(newest, list(MODEL_KEYS), "left")
        .select(
            *MODEL_KEYS,
            "inc_load_ts",
            as_batch(batch_id).alias("batch_id"),
            F.lit(status).alias("model_load_status"),
            null_count.alias("rows_inserted"),
            null_count.alias("rows_updated"),
            start_ts.alias("start_ts"),
            as_ts(None).alias("end_ts"),
        )
    )
    unfinished = F.col("t.end_ts").isNull()
    changes: dict[str, Column] = {
        "model_load_status": F.when(unfinished, F.lit(status)).otherwise(
            F.col("t.model_load_status")
        )
    }
    if starts:
        changes |= {"start_ts": start_ts, "end_ts": as_ts(None)}
    else:
        changes["start_ts"] = F.when(~unfinished, F.col("t.start_ts"))
    return merge_update_subset(
        audit, rows, [*MODEL_KEYS, "batch_id"], changes, source_unique=True
    )


def _marked(audit: DataFrame, models: DataFrame, batch_id) -> DataFrame:
    """Audit rows with ``_hit`` set for the given models in the batch."""
    names = {k: f"_m_{k}" for k in MODEL_KEYS}
    picked = distinct_keys(models, MODEL_KEYS).withColumnsRenamed(names)
    condition = F.col("batch_id") == as_batch(batch_id)
    for k, renamed in names.items():
        condition = (F.col(k) == F.col(renamed)) & condition
    return audit.join(picked.withColumn("_hit", F.lit(True)), condition, "left")


def _set_where(marked: DataFrame, hit: Column, changes: dict[str, Column], cols) -> DataFrame:
    return marked.withColumns(
        {c: F.when(hit, value).otherwise(F.col(c)) for c, value in changes.items()}
    ).select(*cols)


def start_models(audit: DataFrame, models: DataFrame, batch_id, now) -> DataFrame:
    """Mark models of the batch as running and clear what an earlier try left."""
    changes = {
        "model_load_status": F.when(F.col("end_ts").isNull(), "running").otherwise(
            F.col("model_load_status")
        ),
        "rows_inserted": F.lit(None).cast("long"),
        "rows_updated": F.lit(None).cast("long"),
        "start_ts": as_ts(now),
        "end_ts": as_ts(None),
    }
    return _set_where(_marked(audit, models, batch_id), F.col("_hit"), changes, audit.columns)


def load_metrics(target: DataFrame, batch_id=None, ts_col: str = "src_load_ts") -> DataFrame:
    """Newest source time, rows inserted and rows updated per batch, in one pass."""
    if batch_id is not None:
        target = target.where(F.col("batch_id") == as_batch(batch_id))
    return target.groupBy("batch_id").agg(
        F.max(ts_col).alias("src_load_ts"), *[c.alias(n) for n, c in row_counts().items()]
    )


METRICS = f"batch_id {BATCH_TYPE.simpleString()}, src_load_ts timestamp_ntz, rows_inserted bigint, rows_updated bigint"


class WrittenMetrics:
    """``load_metrics`` of one batch, taken from the rows while they are written.

    Pass ``observe`` to ``save_state``. Once that returns, ``frame`` has the metrics as one
    row, or none if the batch wrote no row; the table isn't read for them.
    """

    def __init__(self, batch_id, ts_col: str = "src_load_ts"):
        self.batch_id = batch_id
        self._seen = Observation()
        mine = F.col("batch_id") == as_batch(batch_id)
        load, update = F.col("etl_load_ts"), F.col("etl_updt_ts")
        self.observe = self._seen, [
            F.count_if(mine).alias("rows"),
            F.max(F.when(mine, as_ts(F.col(ts_col)))).alias("src_load_ts"),
            F.count_if(mine & (load == update)).alias("rows_inserted"),
            F.count_if(mine & (load < update)).alias("rows_updated"),
        ]

    def columns(self) -> dict[str, Column]:
        """The metrics as literals; without a written row there is no source time and the counts are 0."""
        seen = self._seen.get
        counts = {c: F.lit(seen[c] or 0).cast("long") for c in ("rows_inserted", "rows_updated")}
        return {"src_load_ts": as_ts(seen["src_load_ts"])} | counts

    def frame(self, spark: SparkSession) -> DataFrame:
        seen = self._seen.get
        row = (str(self.batch_id), seen["src_load_ts"], seen["rows_inserted"], seen["rows_updated"])
        rows = spark.createDataFrame([row] if seen["rows"] else [], METRICS.replace(BATCH_TYPE.simpleString(), "string", 1))
        return rows.withColumn("batch_id", as_batch(F.col("batch_id")))


def full_load_metrics(target: DataFrame) -> DataFrame:
    """Metrics of a replaced table: every row counts as inserted."""
    return target.agg(
        F.count(F.lit(1)).alias("rows_inserted"), F.lit(0).cast("long").alias("rows_updated")
    )


def finish_models(audit: DataFrame, metrics: DataFrame, now, *, full_load: bool = False) -> DataFrame:
    """Write the metrics and complete the models that have some.

    ``metrics`` has one row per (model_id, model_grp, pipeline_name, batch_id). The
    watermark moves to the newest source time, or stays when the batch brought no
    rows; a full load has no watermark.
    """
    keys = [*MODEL_KEYS, "batch_id"]
    names = {c: f"_m_{c}" for c in metrics.columns}
    renamed = metrics.withColumnsRenamed(names).withColumn("_hit", F.lit(True))
    condition = None
    for k in keys:
        same = F.col(k) == F.col(f"_m_{k}")
        condition = same if condition is None else condition & same
    watermark = as_ts(None)
    if not full_load:
        watermark = F.coalesce(F.col("_m_src_load_ts"), F.col("inc_load_ts"))
    changes = {
        "inc_load_ts": watermark,
        "model_load_status": F.lit("completed"),
        "rows_inserted": F.col("_m_rows_inserted"),
        "rows_updated": F.col("_m_rows_updated"),
        "end_ts": as_ts(now),
    }
    joined = audit.join(renamed, condition, "left")
    return _set_where(joined, F.col("_hit"), changes, audit.columns)


def model_state(audit: DataFrame, models: DataFrame, batch_id) -> DataFrame:
    """Watermark, batch, status and counts per model, with defaults when unrecorded."""
    rows = audit.where(F.col("batch_id") == as_batch(batch_id)).select(
        *MODEL_KEYS, "inc_load_ts", "batch_id", "model_load_status", "rows_inserted", "rows_updated"
    )
    return (
        models.select(*MODEL_KEYS)
        .distinct()
        .join(rows, list(MODEL_KEYS), "left")
        .select(
            *MODEL_KEYS,
            F.coalesce("inc_load_ts", as_ts(EPOCH)).alias("inc_load_ts"),
            F.coalesce("batch_id", F.lit(UNKNOWN_BATCH).cast(BATCH_TYPE)).alias("batch_id"),
            F.coalesce("model_load_status", F.lit(UNKNOWN_STATUS)).alias("model_load_status"),
            F.coalesce("rows_inserted", F.lit(0)).alias("rows_inserted"),
            F.coalesce("rows_updated", F.lit(0)).alias("rows_updated"),
        )
    )


def pending_models(models: DataFrame, audit: DataFrame, batch_id) -> DataFrame:
    """Models not yet completed in the batch: the work list of a load."""
    done = audit.where(
        (F.col("batch_id") == as_batch(batch_id)) & (F.col("model_load_status") == "completed")
    )
    return anti_not_exists(models, done, list(MODEL_KEYS))

