"""Delete capture and propagation."""

from pyspark.sql import functions as F

from checks.registry import (
    BATCH,
    LOAD_TS,
    OLD_BATCH,
    OLD_TS,
    SQL_BATCH,
    SQL_LOAD_TS,
    SQL_OLD_STAMPS,
    CTES,
    all_orders,
    dimension,
    journal,
    query,
    silver,
    stamped,
    table,
    ts,
)
from millrace.session import new_folder
from millrace.streaming import VersionedTable, stream_deletion_log
from millrace.operators.deletes import (
    apply_hard_delete,
    apply_log_delete,
    capture_deleted_keys,
    capture_missing_rows,
    soft_delete,
)


def stage_snapshot(spark, sf):
    """Keys alive at the source: pending orders are gone."""
    return all_orders(spark, sf).where(F.col("st") != "P").select("k")


CTES["snapshot"] = "SELECT k FROM o WHERE st <> 'P'"


@query(
    "capture_missing_rows",
    f"""SELECT k, c, st, (SELECT max(src_load_ts) FROM silver) AS src_load_ts,
               (SELECT max(batch_id) FROM silver) AS batch_id,
               {SQL_LOAD_TS} AS etl_load_ts, {SQL_LOAD_TS} AS etl_updt_ts
        FROM silver s WHERE NOT EXISTS (SELECT 1 FROM snapshot x WHERE x.k = s.k)""",
    "o silver snapshot",
    ids=("batch_id",),
)
def _(spark, sf):
    return capture_missing_rows(silver(spark, sf), stage_snapshot(spark, sf), ["k"], LOAD_TS)


@query(
    "apply_hard_delete",
    "SELECT * FROM silver s WHERE EXISTS (SELECT 1 FROM snapshot x WHERE x.k = s.k)",
    "o silver snapshot",
    ids=("batch_id",),
)
def _(spark, sf):
    target = silver(spark, sf)
    gone = capture_missing_rows(target, stage_snapshot(spark, sf), ["k"], LOAD_TS)
    return apply_hard_delete(target, gone, ["k"])


@query(
    "apply_hard_delete_residual",
    """SELECT * FROM silver s WHERE NOT EXISTS (SELECT 1 FROM lineitem l
       WHERE l.l_orderkey = s.k AND l.l_shipdate < s.src_load_ts)""",
    "o silver",
    ids=("batch_id",),
)
def _(spark, sf):
    """Orders with a line shipped before the order was placed are gone: key and condition."""
    shipped = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    earlier = F.col("s.l_shipdate") < F.col("t.src_load_ts")
    return apply_hard_delete(silver(spark, sf), shipped, {"k": "l_orderkey"}, earlier)


def deletion_log(spark, sf):
    """Deletes logged by the previous load: errors of the first ten days."""
    early = journal(spark, sf).where(
        (F.col("event_type") == "IncrementalDeleteRows") & (F.col("seen_at") < ts("2024-01-03"))
    )
    rows = early.groupBy(F.col("primary_key__pk").alias("pk")).agg(
        F.max("seen_at").alias("src_load_ts")
    )
    named = rows.select(
        F.lit("silver.customer_t").alias("model_id"),
        F.lit("old_group").alias("model_grp"),
        F.lit("old_pipeline").alias("pipeline_name"),
        "pk",
        "src_load_ts",
    )
    return stamped(named, OLD_BATCH, OLD_TS)


CTES["log"] = f"""
SELECT 'silver.customer_t' AS model_id, 'old_group' AS model_grp, 'old_pipeline' AS pipeline_name,
       primary_key__pk AS pk, max(seen_at) AS src_load_ts, {SQL_OLD_STAMPS}
FROM journal WHERE event_type = 'IncrementalDeleteRows' AND seen_at < TIMESTAMP '2024-01-03'
GROUP BY primary_key__pk"""

NAMES = {"model_id": "silver.customer_t", "model_grp": "crm", "pipeline_name": "shop"}

CTES["new_log"] = f"""
SELECT 'silver.customer_t' AS model_id, 'crm' AS model_grp, 'shop' AS pipeline_name, d.pk,
       coalesce(l.src_load_ts, d.seen) AS src_load_ts, coalesce(l.batch_id, {SQL_BATCH}) AS batch_id,
       coalesce(l.etl_load_ts, {SQL_LOAD_TS}) AS etl_load_ts, {SQL_LOAD_TS} AS etl_updt_ts
FROM (SELECT primary_key__pk AS pk, max(seen_at) AS seen FROM journal
      WHERE event_type = 'IncrementalDeleteRows' GROUP BY 1) d
LEFT JOIN log l ON l.pk = d.pk"""


@query("capture_deleted_keys", "SELECT * FROM new_log", "journal log new_log", ids=("pk", "batch_id"))
def _(spark, sf):
    return capture_deleted_keys(
        deletion_log(spark, sf), journal(spark, sf), **NAMES, batch_id=BATCH, load_ts=LOAD_TS
    )


@query(
    "apply_log_delete",
    """SELECT c_custkey, c_name FROM customer
       WHERE c_custkey NOT IN (SELECT CAST(pk AS BIGINT) FROM log)""",
    "journal log",
)
def _(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return apply_log_delete(
        customers, deletion_log(spark, sf), "SILVER.CUSTOMER_v", "c_custkey", ignore_case=True
    )


@query(
    "soft_delete",
    """SELECT sk, seq, label, hash_sk, hash_seq_no, start_ts,
              CASE WHEN hit THEN etl_updt_ts ELSE end_ts END AS end_ts,
              CASE WHEN hit THEN 'N' ELSE active_flg END AS active_flg, reporting_flg, etl_updt_ts
       FROM (SELECT *, active_flg = 'Y' AND sk IN (SELECT pk FROM log) AS hit FROM dim)""",
    "journal log dim",
    ids=("sk", "seq"),
)
def _(spark, sf):
    return soft_delete(dimension(spark, sf), deletion_log(spark, sf), {"sk": "pk"})




def streamed_log(spark, sf):
    """The deletion log after three deliveries of journal files, the newest events first."""
    rows = journal(spark, sf)
    log = VersionedTable(spark, new_folder(spark, "log"), deletion_log(spark, sf).schema)
    inbox, offsets = new_folder(spark, "journal"), new_folder(spark, "offsets")
    for since, until in (("2024-01-20", "2025-01-01"), ("2024-01-01", "2024-01-10"), ("2024-01-10", "2024-01-20")):
        part = rows.where((F.col("seen_at") >= ts(since)) & (F.col("seen_at") < ts(until)))
        part.coalesce(2).write.mode("append").parquet(inbox)
        stream = stream_deletion_log(
            spark, inbox, rows.schema, offsets, log, **NAMES, batch_id=BATCH, load_ts=LOAD_TS, maxFilesPerTrigger=1
        )
        stream.awaitTermination()
    return log.state()


@query(
    "stream_deletion_log",
    f"""SELECT '{NAMES["model_id"]}' AS model_id, '{NAMES["model_grp"]}' AS model_grp, '{NAMES["pipeline_name"]}' AS pipeline_name,
               primary_key__pk AS pk, max(seen_at) AS src_load_ts, {SQL_BATCH} AS batch_id,
               {SQL_LOAD_TS} AS etl_load_ts, {SQL_LOAD_TS} AS etl_updt_ts
        FROM journal WHERE event_type = 'IncrementalDeleteRows' GROUP BY primary_key__pk""",
    "journal",
    ids=("pk", "batch_id"),
)
def _(spark, sf):
    """What one run over the whole journal gives, from a stream of its parts."""
    return streamed_log(spark, sf)


@query(
    "apply_streamed_deletes",
    """SELECT * FROM dim d WHERE NOT EXISTS (SELECT 1 FROM journal j
       WHERE j.event_type = 'IncrementalDeleteRows' AND j.primary_key__pk = d.sk)""",
    "dim journal",
    ids=("sk", "seq"),
)
def _(spark, sf):
    """A table without the keys of the streamed log."""
    return apply_log_delete(dimension(spark, sf), streamed_log(spark, sf), NAMES["model_id"], "sk")
