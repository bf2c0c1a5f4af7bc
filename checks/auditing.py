"""Batch and model audit. A customer is a pipeline or a model, a year of orders a batch."""

from pyspark.sql import functions as F

from checks.keyed_writes import new_rows
from checks.registry import CTES, LOAD_TS, SQL_LOAD_TS, all_orders, bronze, query, silver, table
from checks.selection import merged_orders
from millrace.functions.columns import stamp_audit
from millrace.operators.audit import (
    close_batches,
    current_batch,
    finish_models,
    init_model_audit,
    load_metrics,
    model_state,
    open_batches,
    pending_models,
    start_models,
)
from millrace.operators.merge import merge_upsert
from millrace.plans.loads import audited_load
from millrace.session import new_folder

YEAR = "2000"  # the batch under test


def runs(spark, sf):
    year = F.year("src_load_ts").cast("decimal(38,0)")
    done = F.min("st") == "F"
    return (
        all_orders(spark, sf)
        .groupBy("c", year.alias("batch_id"))
        .agg(
            F.max("src_load_ts").alias("newest"),
            F.count(F.lit(1)).alias("n"),
            F.sum(F.when(F.col("st") == "P", 1).otherwise(0)).alias("n_p"),
            F.min("src_load_ts").alias("start_ts"),
            F.when(done, F.max("src_load_ts")).alias("end_ts"),
            F.when(done, "completed").otherwise("running").alias("status"),
        )
    )


CTES["runs"] = """
SELECT c, CAST(year(src_load_ts) AS DECIMAL(38,0)) AS batch_id, max(src_load_ts) AS newest, count(*) AS n,
       CAST(sum(CASE WHEN st = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS n_p, min(src_load_ts) AS start_ts,
       CASE WHEN min(st) = 'F' THEN max(src_load_ts) END AS end_ts,
       CASE WHEN min(st) = 'F' THEN 'completed' ELSE 'running' END AS status
FROM o GROUP BY ALL"""


def batch_audit(spark, sf):
    return runs(spark, sf).select(
        F.concat(F.lit("p"), F.col("c")).alias("pipeline_name"),
        "batch_id",
        F.col("status").alias("batch_status"),
        "start_ts",
        "end_ts",
    )


CTES["batches"] = (
    "SELECT 'p' || c AS pipeline_name, batch_id, status AS batch_status, start_ts, end_ts FROM runs"
)


def pipelines(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(F.concat(F.lit("p"), F.col("c_custkey")).alias("pipeline_name"))


CTES["pipes"] = "SELECT 'p' || c_custkey AS pipeline_name FROM customer"


@query(
    "open_batches",
    f"""SELECT * FROM batches UNION ALL
        SELECT pipeline_name, CAST('20260101000000000000000' AS DECIMAL(38,0)), 'running', {SQL_LOAD_TS}, NULL
        FROM pipes p WHERE NOT EXISTS (SELECT 1 FROM batches b
             WHERE b.pipeline_name = p.pipeline_name AND b.batch_status <> 'completed')""",
    "o runs batches pipes",
    ids=("batch_id",),
)
def _(spark, sf):
    return open_batches(batch_audit(spark, sf), pipelines(spark, sf), LOAD_TS)


@query(
    "close_batches",
    f"""SELECT * REPLACE (CASE WHEN batch_status = 'running' THEN {SQL_LOAD_TS} ELSE end_ts END AS end_ts,
                          'completed' AS batch_status)
        FROM batches WHERE pipeline_name IN (SELECT pipeline_name FROM pipes)""",
    "o runs batches pipes",
    ids=("batch_id",),
)
def _(spark, sf):
    return close_batches(batch_audit(spark, sf), pipelines(spark, sf), LOAD_TS)


@query(
    "current_batch",
    """SELECT p.pipeline_name, coalesce(max(batch_id), 0) AS batch_id FROM pipes p
       LEFT JOIN batches b ON b.pipeline_name = p.pipeline_name AND b.batch_status = 'running' GROUP BY ALL""",
    "o runs batches pipes",
    ids=("batch_id",),
)
def _(spark, sf):
    return current_batch(batch_audit(spark, sf), pipelines(spark, sf))


def model_audit(spark, sf):
    return runs(spark, sf).select(
        F.concat(F.lit("m"), F.col("c")).alias("model_id"),
        F.lit("g").alias("model_grp"),
        F.col("newest").alias("inc_load_ts"),
        F.lit("shop").alias("pipeline_name"),
        "batch_id",
        F.col("status").alias("model_load_status"),
        F.col("n").alias("rows_inserted"),
        F.col("n_p").alias("rows_updated"),
        "start_ts",
        "end_ts",
    )


CTES["audit"] = """
SELECT 'm' || c AS model_id, 'g' AS model_grp, newest AS inc_load_ts, 'shop' AS pipeline_name, batch_id,
       status AS model_load_status, n AS rows_inserted, n_p AS rows_updated, start_ts, end_ts FROM runs"""


def models(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(
        F.concat(F.lit("m"), F.col("c_custkey")).alias("model_id"),
        F.lit("g").alias("model_grp"),
        F.lit("shop").alias("pipeline_name"),
    )


CTES["models"] = (
    "SELECT 'm' || c_custkey AS model_id, 'g' AS model_grp, 'shop' AS pipeline_name FROM customer"
)


@query(
    "init_model_audit",
    """SELECT * REPLACE (
           CASE WHEN batch_id = 2000 AND end_ts IS NULL THEN 'yet to start' ELSE model_load_status END AS model_load_status,
           CASE WHEN batch_id = 2000 AND end_ts IS NULL THEN NULL ELSE start_ts END AS start_ts) FROM audit
       UNION ALL
       SELECT m.model_id, 'g', (SELECT arg_max(inc_load_ts, batch_id) FROM audit a WHERE a.model_id = m.model_id),
              'shop', 2000, 'yet to start', NULL, NULL, NULL, NULL FROM models m
       WHERE NOT EXISTS (SELECT 1 FROM audit a WHERE a.model_id = m.model_id AND a.batch_id = 2000)""",
    "o runs audit models",
    ids=("batch_id",),
)
def _(spark, sf):
    return init_model_audit(model_audit(spark, sf), models(spark, sf), YEAR)


@query(
    "start_models",
    f"""SELECT * FROM audit WHERE batch_id <> 2000 UNION ALL
        SELECT * REPLACE (CASE WHEN end_ts IS NULL THEN 'running' ELSE model_load_status END AS model_load_status,
               NULL AS rows_inserted, NULL AS rows_updated, {SQL_LOAD_TS} AS start_ts, NULL AS end_ts)
        FROM audit WHERE batch_id = 2000""",
    "o runs audit",
    ids=("batch_id",),
)
def _(spark, sf):
    return start_models(model_audit(spark, sf), models(spark, sf), YEAR, LOAD_TS)


@query(
    "load_metrics",
    """SELECT batch_id, max(src_load_ts) AS src_load_ts,
              count(*) FILTER (WHERE etl_load_ts = etl_updt_ts) AS rows_inserted,
              count(*) FILTER (WHERE etl_load_ts < etl_updt_ts) AS rows_updated FROM merged GROUP BY batch_id""",
    "o silver bronze merged",
    ids=("batch_id",),
)
def _(spark, sf):
    return load_metrics(merged_orders(spark, sf))


@query(
    "finish_models",
    f""", m AS (SELECT 'm' || c AS model_id, max(src_load_ts) AS newest, count(*) AS n FROM bronze
                WHERE year(src_load_ts) = 2000 GROUP BY 1)
        SELECT audit.* FROM audit ANTI JOIN m ON audit.model_id = m.model_id AND audit.batch_id = 2000
        UNION ALL
        SELECT audit.* REPLACE (coalesce(m.newest, inc_load_ts) AS inc_load_ts, 'completed' AS model_load_status,
               m.n AS rows_inserted, 0 AS rows_updated, {SQL_LOAD_TS} AS end_ts)
        FROM audit JOIN m ON audit.model_id = m.model_id AND audit.batch_id = 2000""",
    "o bronze runs audit",
    ids=("batch_id",),
)
def _(spark, sf):
    rows = new_rows(spark, sf).where(F.year("src_load_ts") == 2000)
    metrics = rows.groupBy(F.concat(F.lit("m"), F.col("c")).alias("model_id")).agg(
        F.max("src_load_ts").alias("src_load_ts"), F.count(F.lit(1)).alias("rows_inserted")
    )
    metrics = metrics.withColumns(
        {
            "model_grp": F.lit("g"),
            "pipeline_name": F.lit("shop"),
            "batch_id": F.lit(YEAR).cast("decimal(38,0)"),
            "rows_updated": F.lit(0).cast("long"),
        }
    )
    return finish_models(model_audit(spark, sf), metrics, LOAD_TS)


@query(
    "model_state",
    """SELECT m.model_id, m.model_grp, m.pipeline_name, coalesce(inc_load_ts, TIMESTAMP '1900-01-01') AS inc_load_ts,
              coalesce(batch_id, 1900010101) AS batch_id, coalesce(model_load_status, 'none') AS model_load_status,
              coalesce(rows_inserted, 0) AS rows_inserted, coalesce(rows_updated, 0) AS rows_updated
       FROM models m LEFT JOIN audit a ON a.model_id = m.model_id AND a.batch_id = 2000""",
    "o runs audit models",
    ids=("batch_id",),
)
def _(spark, sf):
    return model_state(model_audit(spark, sf), models(spark, sf), YEAR)


@query(
    "pending_models",
    """SELECT * FROM models WHERE model_id NOT IN
       (SELECT model_id FROM audit WHERE batch_id = 2000 AND model_load_status = 'completed')""",
    "o runs audit models",
)
def _(spark, sf):
    return pending_models(models(spark, sf), model_audit(spark, sf), YEAR)




def audited(spark, sf):
    """A load of one model: bronze orders into silver, in the batch of the test."""
    model = models(spark, sf).where("model_id = 'm1'")

    def build(state):
        since = state.select("inc_load_ts")
        source = bronze(spark, sf).where(F.col("src_load_ts") > since.scalar())
        rows = stamp_audit(source, batch_id=YEAR, load_ts=LOAD_TS)
        return merge_upsert(silver(spark, sf), rows, ["k"], preserve_load_ts=True)

    return audited_load(
        model_audit(spark, sf), model, build, new_folder(spark, "silver"), batch_id=YEAR, started="2026-01-01 01:00:00", finished=LOAD_TS
    )


# The model's watermark, and what the load writes: bronze rows above it.
CTES["m1_mark"] = """
SELECT coalesce((SELECT inc_load_ts FROM audit WHERE model_id = 'm1' AND batch_id = 2000),
                (SELECT arg_max(inc_load_ts, batch_id) FROM audit WHERE model_id = 'm1'), TIMESTAMP '1900-01-01') AS mark"""
CTES["m1_rows"] = """
SELECT b.*, b.k IN (SELECT k FROM silver) AS known FROM bronze b WHERE src_load_ts > (SELECT mark FROM m1_mark)"""


@query(
    "audited_load_metrics",
    """SELECT CAST(2000 AS DECIMAL(38,0)) AS batch_id, max(src_load_ts) AS src_load_ts, count(*) FILTER (WHERE NOT known) AS rows_inserted,
              count(*) FILTER (WHERE known) AS rows_updated FROM m1_rows HAVING count(*) > 0""",
    "o silver bronze runs audit m1_mark m1_rows",
    ids=("batch_id",),
)
def _(spark, sf):
    """Metrics taken while the table was written, without a read of it."""
    return audited(spark, sf).metrics


@query(
    "audited_load",
    f"""SELECT * FROM audit WHERE NOT (model_id = 'm1' AND batch_id = 2000) UNION ALL
        SELECT 'm1', 'g', coalesce((SELECT max(src_load_ts) FROM m1_rows), (SELECT nullif(mark, TIMESTAMP '1900-01-01') FROM m1_mark)), 'shop', 2000,
               'completed', (SELECT count(*) FROM m1_rows WHERE NOT known), (SELECT count(*) FROM m1_rows WHERE known),
               TIMESTAMP '2026-01-01 01:00:00', {SQL_LOAD_TS}""",
    "o silver bronze runs audit m1_mark m1_rows",
    ids=("batch_id",),
)
def _(spark, sf):
    """The model audit after the load."""
    return audited(spark, sf).audit
