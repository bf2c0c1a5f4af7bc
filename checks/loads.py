"""Whole loads."""

from pyspark.sql import functions as F

from checks.deletes import NAMES, deletion_log
from checks.keyed_writes import (
    JOURNAL_COLUMNS,
    JOURNAL_IDS,
    JOURNAL_RELOADED,
    bronze_journal,
    empty_journal,
    segment_list,
)
from checks.quality import (
    IDS,
    LINE_KEY,
    issue_sql,
    recorded_sql,
    DUPLICATES,
    NULLS,
    NAMES as LINE_NAMES,
    old_issues,
)
from checks.registry import (
    CTES,
    OLD_BATCH,
    OLD_TS,
    SQL_BATCH,
    SQL_OLD_BATCH,
    SQL_OLD_TS,
    SQL_LOAD_TS,
    SQL_OLD_STAMPS,
    SQL_STAMPS,
    STAMPS,
    all_orders,
    bronze,
    journal,
    lines,
    query,
    segment,
    silver,
    stamped,
    table,
    ts,
)
from millrace.operators.journal import read_segments
from millrace.session import new_folder
from millrace.plans.loads import (
    bronze_to_silver,
    delete_insert_to_silver,
    journal_to_bronze,
    prevalidated_to_silver,
    stage_to_bronze,
    staged_cdc_to_silver,
)


@query(
    "stage_to_bronze",
    f"""SELECT * FROM silver WHERE src_load_ts <= TIMESTAMP '1999-01-01'
        UNION ALL SELECT *, {SQL_STAMPS} FROM bronze WHERE src_load_ts > TIMESTAMP '1999-01-01'""",
    "o silver bronze",
    ids=("batch_id",),
)
def _(spark, sf):
    return stage_to_bronze(
        silver(spark, sf),
        bronze(spark, sf),
        load_type="incremental",
        ts_col="src_load_ts",
        since="1999-01-01",
        **STAMPS,
    )


@query("journal_to_bronze", JOURNAL_RELOADED, "journal segmented", ids=JOURNAL_IDS)
def _(spark, sf):
    """The newest two of four listed segments; names come back in upper case."""

    def read(name):
        return segment(spark, sf, name.lower())

    loaded = journal_to_bronze(
        bronze_journal(spark, sf),
        segment_list(spark, sf),
        read,
        "events",
        since="2024-01-15",
        **STAMPS,
    )
    return loaded.withColumn("src_journal_tbl", F.lower("src_journal_tbl"))


def five_days(spark, sf):
    """The journal in segments of five days, numbered from 0."""
    number = F.floor((F.dayofmonth("seen_at") - 1) / 5).cast("string")
    return journal(spark, sf).withColumn("segment", F.concat(F.lit("EVENTS_"), number))


CTES["five_days"] = (
    "SELECT *, 'EVENTS_' || CAST((day(seen_at) - 1) // 5 AS VARCHAR) AS src_journal_tbl FROM journal"
)


@query(
    "journal_to_bronze_many_segments",
    f"""SELECT {JOURNAL_COLUMNS}, {SQL_OLD_STAMPS} FROM five_days WHERE seen_at <= TIMESTAMP '2024-01-07'
        UNION ALL SELECT {JOURNAL_COLUMNS}, {SQL_STAMPS} FROM five_days WHERE seen_at > TIMESTAMP '2024-01-07'""",
    "journal five_days",
    ids=JOURNAL_IDS,
)
def _(spark, sf):
    """Most segments lie above the watermark: all come again, and no event is lost."""
    parts = five_days(spark, sf)
    segments = parts.groupBy(F.col("segment").alias("table_name")).agg(F.min("seen_at").alias("created"))

    def read(name):
        return parts.where(F.col("segment") == name).drop("segment")

    before = journal_to_bronze(
        empty_journal(spark), segments, read, "events", load_type="full", batch_id=OLD_BATCH, load_ts=OLD_TS
    )
    return journal_to_bronze(before, segments, read, "events", since="2024-01-07", **STAMPS)


def written_segments(spark, sf, days: int) -> dict[str, str]:
    """The journal in segments of that many days, a folder each; the names come with it."""
    base = new_folder(spark, "segments")
    number = F.floor((F.dayofmonth("seen_at") - 1) / days).cast("string")
    rows = journal(spark, sf).withColumn("segment", F.concat(F.lit("EVENTS_"), number))
    names = [r["segment"] for r in rows.select("segment").distinct().collect()]
    rows.write.partitionBy("segment").parquet(base)
    return {n: f"{base}/segment={n}" for n in names}


@query(
    "journal_to_bronze_one_scan",
    f"""SELECT {JOURNAL_COLUMNS}, {SQL_OLD_STAMPS} FROM five_days WHERE seen_at <= TIMESTAMP '2024-01-07'
        UNION ALL SELECT {JOURNAL_COLUMNS}, {SQL_STAMPS} FROM five_days WHERE seen_at > TIMESTAMP '2024-01-07'""",
    "journal five_days",
    ids=JOURNAL_IDS,
)
def _(spark, sf):
    """All segments above the watermark by one scan of their folders."""
    folders = written_segments(spark, sf, 5)
    parts = five_days(spark, sf)
    segments = parts.groupBy(F.col("segment").alias("table_name")).agg(F.min("seen_at").alias("created"))
    schema = journal(spark, sf).schema

    def scan(names):
        return read_segments(spark, {n: folders[n] for n in names}, schema)

    before = journal_to_bronze(
        empty_journal(spark), segments, None, "events", load_type="full", scan=scan, batch_id=OLD_BATCH, load_ts=OLD_TS
    )
    return journal_to_bronze(before, segments, None, "events", since="2024-01-07", scan=scan, **STAMPS)


# Silver keeps the newest order per customer.
CTES["latest_before"] = f"""
SELECT c, max(k) AS k, any_value(src_load_ts) AS src_load_ts, {SQL_OLD_STAMPS} FROM (
    SELECT * FROM o WHERE src_load_ts < TIMESTAMP '2000-01-01'
    QUALIFY src_load_ts = max(src_load_ts) OVER (PARTITION BY c)) GROUP BY c"""
CTES["latest_now"] = f"""
SELECT c, max(k) AS k, any_value(src_load_ts) AS src_load_ts, {SQL_STAMPS} FROM (
    SELECT * FROM o QUALIFY src_load_ts = max(src_load_ts) OVER (PARTITION BY c)) 
WHERE src_load_ts > TIMESTAMP '1999-06-01' GROUP BY c"""
CTES["upserted"] = """
SELECT * FROM latest_now UNION ALL SELECT * FROM latest_before b
WHERE NOT EXISTS (SELECT 1 FROM latest_now n WHERE n.c = b.c)"""


def customer_state(spark, sf):
    before = all_orders(spark, sf).where(F.col("src_load_ts") < ts("2000-01-01"))
    newest = before.groupBy("c").agg(F.max(F.struct("src_load_ts", "k")).alias("m"))
    return stamped(newest.select("c", "m.k", "m.src_load_ts"), OLD_BATCH, OLD_TS)


@query(
    "bronze_to_silver",
    """SELECT u.* FROM upserted u
       WHERE EXISTS (SELECT 1 FROM o WHERE o.c = u.c AND o.src_load_ts >= TIMESTAMP '1999-01-01')""",
    "o latest_before latest_now upserted",
    ids=("batch_id",),
)
def _(spark, sf):
    """Newest order per customer since the watermark; customers without a recent order are gone."""
    orders = all_orders(spark, sf).select("c", "k", "src_load_ts")
    alive = orders.where(F.col("src_load_ts") >= ts("1999-01-01")).select("c")
    return bronze_to_silver(
        customer_state(spark, sf),
        orders,
        ["c"],
        ts_col="src_load_ts",
        since="1999-06-01",
        stage_snapshot=alive,
        tie_break=["k"],
        **STAMPS,
    ).target


# Two loads in a row. The first sees orders up to mid-1999 and customers with one since 1998, the second
# all orders and customers with one since 2000.
def upserted_sql(before: str, until: str, since: str, batch: str, load: str) -> str:
    return f"""
  SELECT c, k, src_load_ts, {batch} AS batch_id, {load} AS etl_load_ts, {load} AS etl_updt_ts, 'new' AS o FROM (
    SELECT c, max(k) AS k, any_value(src_load_ts) AS src_load_ts FROM (SELECT * FROM o WHERE src_load_ts < TIMESTAMP '{until}'
    AND src_load_ts > TIMESTAMP '{since}' QUALIFY src_load_ts = max(src_load_ts) OVER (PARTITION BY c)) GROUP BY c)
  UNION ALL SELECT b.*, 'kept' FROM {before} b WHERE c NOT IN (SELECT c FROM o WHERE src_load_ts < TIMESTAMP '{until}'
    AND src_load_ts > TIMESTAMP '{since}')"""


CTES["before"] = f"""
SELECT c, max(k) AS k, any_value(src_load_ts) AS src_load_ts, {SQL_OLD_STAMPS} FROM (
    SELECT * FROM o WHERE src_load_ts < TIMESTAMP '1998-01-01'
    QUALIFY src_load_ts = max(src_load_ts) OVER (PARTITION BY c)) GROUP BY c"""
CTES["first_merge"] = upserted_sql("before", "1999-06-01", "1997-06-01", SQL_OLD_BATCH, SQL_OLD_TS)
CTES["first_state"] = """SELECT * EXCLUDE (o) FROM first_merge WHERE c IN
    (SELECT c FROM o WHERE src_load_ts >= TIMESTAMP '1998-06-01' AND src_load_ts < TIMESTAMP '1999-06-01')"""
CTES["second_merge"] = upserted_sql("first_state", "2100-01-01", "1999-06-01", SQL_BATCH, SQL_LOAD_TS)
CTES["second_alive"] = "SELECT DISTINCT c FROM o WHERE src_load_ts >= TIMESTAMP '2000-06-01'"
TWO_LOADS = "o before first_merge first_state second_merge second_alive"


def two_loads(spark, sf):
    orders = all_orders(spark, sf).select("c", "k", "src_load_ts")
    at = F.col("src_load_ts")
    state = orders.where(at < ts("1998-01-01")).groupBy("c").agg(F.max(F.struct("src_load_ts", "k")).alias("m"))
    state = stamped(state.select("c", "m.k", "m.src_load_ts"), OLD_BATCH, OLD_TS)
    how = {"ts_col": "src_load_ts", "tie_break": ["k"]}
    early = orders.where(at < ts("1999-06-01"))
    first = bronze_to_silver(
        state, early, ["c"], since="1997-06-01", stage_snapshot=early.where(at >= ts("1998-06-01")).select("c"),
        save_to=new_folder(spark, "silver"), batch_id=OLD_BATCH, load_ts=OLD_TS, **how,
    )
    return bronze_to_silver(
        first.target, orders, ["c"], since="1999-06-01", stage_snapshot=orders.where(at >= ts("2000-06-01")).select("c"),
        save_to=new_folder(spark, "silver"), delete_history=first.history, **STAMPS, **how,
    )


@query(
    "bronze_to_silver_written_once",
    "SELECT * EXCLUDE (o) FROM second_merge WHERE c IN (SELECT c FROM second_alive)",
    TWO_LOADS,
    ids=("batch_id",),
)
def _(spark, sf):
    """The target after two loads, each computed and written once with the rows that go."""
    return two_loads(spark, sf).target


@query(
    "bronze_to_silver_history",
    f"""SELECT c, k, (SELECT max(src_load_ts) FROM first_merge) AS src_load_ts, {SQL_OLD_STAMPS} FROM first_merge
          WHERE c NOT IN (SELECT c FROM first_state)
        UNION ALL SELECT c, k, (SELECT max(src_load_ts) FROM second_merge), (SELECT max(batch_id) FROM second_merge),
          {SQL_LOAD_TS}, {SQL_LOAD_TS} FROM second_merge WHERE c NOT IN (SELECT c FROM second_alive)""",
    TWO_LOADS,
    ids=("batch_id",),
)
def _(spark, sf):
    """The lasting delete table after both loads."""
    return two_loads(spark, sf).history


@query(
    "bronze_to_silver_outcomes",
    """SELECT CASE WHEN c NOT IN (SELECT c FROM second_alive) THEN 'deleted' WHEN o = 'kept' THEN 'kept'
              WHEN c IN (SELECT c FROM first_state) THEN 'updated' ELSE 'inserted' END AS outcome, count(*) AS rows
       FROM second_merge GROUP BY 1""",
    TWO_LOADS,
)
def _(spark, sf):
    """How many rows the second load kept, updated, inserted and deleted."""
    return two_loads(spark, sf).outcomes


# Users as silver rows keyed by pk, upserted from the newest journal image.
CTES["users_before"] = f"""
SELECT CAST(user_id AS DECIMAL(38,0)) AS pk, min(event_id) AS first_event, TIMESTAMP '2024-01-05' AS src_load_ts,
       {SQL_OLD_STAMPS} FROM events WHERE ts < TIMESTAMP '2024-01-05' GROUP BY user_id"""
CTES["users_staged"] = """
SELECT CAST(user_id AS DECIMAL(38,0)) AS pk, event_id AS first_event, ts FROM events
QUALIFY ts = max(ts) OVER (PARTITION BY user_id)"""


CTES["cdc_merged"] = f"""
SELECT pk, first_event, ts AS src_load_ts, {SQL_STAMPS} FROM users_staged WHERE ts > TIMESTAMP '2024-01-10'
UNION ALL SELECT * FROM users_before b
WHERE NOT EXISTS (SELECT 1 FROM users_staged s WHERE s.pk = b.pk AND s.ts > TIMESTAMP '2024-01-10')"""
LATER_DELETE = """EXISTS (SELECT 1 FROM journal j WHERE j.primary_key__pk = m.pk AND j.event_type = 'IncrementalDeleteRows'
                    AND j.seen_at > TIMESTAMP '2024-01-10' AND j.seen_at >= m.src_load_ts)"""


def cdc_load(spark, sf, deletes, **options):
    events = table(spark, sf, "events")
    pk = F.col("user_id").cast("decimal(38,0)").alias("pk")
    before = events.where(F.col("ts") < ts("2024-01-05")).groupBy(pk).agg(
        F.min("event_id").alias("first_event")
    )
    target = stamped(before.withColumn("src_load_ts", ts("2024-01-05")), OLD_BATCH, OLD_TS)
    source = events.select(pk, F.col("event_id").alias("first_event"), "ts", "props")
    return staged_cdc_to_silver(
        target,
        source,
        deletes,
        deletion_log(spark, sf),
        ["pk"],
        ts_col="ts",
        load_type="full",
        since="2024-01-10",
        **options,
        **NAMES,
        **STAMPS,
    )


@query(
    "staged_cdc_to_silver",
    f"SELECT * FROM cdc_merged m WHERE NOT {LATER_DELETE}",
    "journal users_before users_staged cdc_merged",
    ids=("pk", "batch_id"),
)
def _(spark, sf):
    """Users whose newest image since the watermark is no delete."""
    return cdc_load(spark, sf, journal(spark, sf)).target


@query(
    "staged_cdc_to_silver_rows_deleted",
    f"SELECT 'silver.customer_t' AS model_id, count(*) AS rows_deleted FROM cdc_merged m WHERE {LATER_DELETE}",
    "journal users_before users_staged cdc_merged",
)
def _(spark, sf):
    return cdc_load(spark, sf, journal(spark, sf)).rows_deleted


@query(
    "staged_cdc_to_silver_log",
    "SELECT * FROM new_log",
    "journal log new_log",
    ids=("pk", "batch_id"),
)
def _(spark, sf):
    """The deletion log after the same load."""
    return cdc_load(spark, sf, journal(spark, sf)).log


@query(
    "staged_cdc_to_silver_sticky",
    """SELECT * FROM cdc_merged WHERE pk NOT IN
           (SELECT primary_key__pk FROM journal WHERE event_type = 'IncrementalDeleteRows'
            AND seen_at < TIMESTAMP '2024-01-08' UNION ALL SELECT pk FROM log)""",
    "journal log users_before users_staged cdc_merged",
    ids=("pk", "batch_id"),
)
def _(spark, sf):
    """All keys ever deleted go; the journal ends on 8 January, before most users had an error."""
    deletes = journal(spark, sf).where(F.col("seen_at") < ts("2024-01-08"))
    return cdc_load(spark, sf, deletes, sticky=True).target


def line_state(spark, sf):
    """Lines with sound keys that shipped before 2000."""
    old = lines(spark, sf).where(F.col("src_load_ts") < ts("2000-01-01"))
    newest = old.dropna(subset=["k", "line"]).groupBy("k", "line").agg(
        F.max(F.struct("src_load_ts", "payload")).alias("m")
    )
    return stamped(newest.select("k", "line", "m.payload", "m.src_load_ts"), OLD_BATCH, OLD_TS)


CTES["line_state"] = f"""
SELECT k, line, arg_max(payload, CAST(src_load_ts AS VARCHAR) || payload) AS payload,
       max(src_load_ts) AS src_load_ts, {SQL_OLD_STAMPS}
FROM lines WHERE src_load_ts < TIMESTAMP '2000-01-01' AND line IS NOT NULL GROUP BY k, line"""
CTES["recent_lines"] = "SELECT * FROM lines WHERE src_load_ts > TIMESTAMP '1999-01-01'"
CTES["good_lines"] = """
SELECT * FROM recent_lines l WHERE line IS NOT NULL
AND (SELECT count(*) FROM recent_lines x WHERE x.k = l.k AND x.line = l.line) = 1"""
CTES["lines_after"] = f"""
SELECT *, {SQL_STAMPS} FROM good_lines UNION ALL
SELECT * FROM line_state s WHERE NOT EXISTS (SELECT 1 FROM good_lines g WHERE g.k = s.k AND g.line = s.line)"""


def prevalidated(spark, sf):
    return prevalidated_to_silver(
        line_state(spark, sf),
        lines(spark, sf),
        old_issues(spark, sf),
        ["k", "line"],
        ts_col="src_load_ts",
        since="1999-01-01",
        payload="payload",
        **LINE_NAMES,
        **STAMPS,
    )


@query(
    "prevalidated_to_silver",
    "SELECT * FROM lines_after",
    "lines line_state recent_lines good_lines lines_after",
    ids=("batch_id",),
)
def _(spark, sf):
    return prevalidated(spark, sf).target


CTES["recent_issues"] = (
    issue_sql("recent_lines", *DUPLICATES, SQL_BATCH, SQL_LOAD_TS)
    + " UNION ALL "
    + issue_sql("recent_lines", *NULLS, SQL_BATCH, SQL_LOAD_TS)
)


@query(
    "prevalidated_to_silver_check",
    f""", recorded AS ({recorded_sql("recent_issues")}),
         sound AS (SELECT DISTINCT {LINE_KEY} AS key_column FROM lines_after),
         newest AS (SELECT max(batch_id) AS batch_id FROM recent_issues)
       SELECT r.model_id, r.model_grp, r.key_column, r.validation_type, r.issue_record_count, r.json_value,
              CASE WHEN r.batch_id < n.batch_id AND s.key_column IS NOT NULL THEN 'Y' ELSE r.success_flg END AS success_flg,
              r.batch_id, r.src_load_ts, r.etl_load_ts, r.etl_updt_ts
       FROM recorded r CROSS JOIN newest n LEFT JOIN sound s ON s.key_column = r.key_column""",
    "lines line_state recent_lines good_lines lines_after early_lines old_issues recent_issues",
    ids=IDS,
)
def _(spark, sf):
    """The check table maintained by the same load."""
    return prevalidated(spark, sf).check


@query(
    "delete_insert_to_silver",
    f""", s AS (SELECT k, st, src_load_ts FROM bronze WHERE src_load_ts > (SELECT max(src_load_ts) FROM silver WHERE st = 'F')),
          t AS (SELECT k, st, src_load_ts, batch_id, etl_load_ts, src_load_ts AS etl_updt_ts FROM silver WHERE st = 'F')
        SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.k = t.k)
        UNION ALL SELECT *, {SQL_STAMPS} FROM s""",
    "o silver bronze",
    ids=("batch_id",),
)
def _(spark, sf):
    """Source rows above the target's newest update time."""
    target = silver(spark, sf).where(F.col("st") == "F").drop("c")
    target = target.withColumn("etl_updt_ts", F.col("src_load_ts"))
    source = bronze(spark, sf).drop("c").withColumns(
        {
            "batch_id": F.lit(OLD_BATCH).cast("decimal(38,0)"),
            "etl_load_ts": F.col("src_load_ts"),
            "etl_updt_ts": F.col("src_load_ts"),
        }
    )
    return delete_insert_to_silver(target, source, ["k"], **STAMPS)
