"""Type-2 dimensions."""

from pyspark.sql import functions as F

from checks.registry import (
    CTES,
    LOAD_TS,
    SQL_LOAD_TS,
    dimension,
    query,
    table,
    ts,
)
from millrace.functions.columns import hash_key
from millrace.operators.key_registry import KeyRegistry
from millrace.operators.scd2 import (
    assign_sequence_number,
    assign_surrogate_key,
    close_versions,
    demote_reporting,
)
from millrace.plans.loads import scd2_load
from millrace.session import new_folder
from millrace.sources import save_state

# The dimension describes (user, kind of event). It was loaded from the events
# of the first ten days; the batch under test is all events of the month.


def event_batch(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    return e.withColumns(
        {"hash_sk": hash_key(["user_id"]), "hash_seq_no": hash_key(["event_type"])}
    )


CTES["ev"] = """
SELECT event_id, user_id, event_type, ts, sha256(CAST(user_id AS VARCHAR)) AS hash_sk,
       sha256(upper(event_type)) AS hash_seq_no FROM events"""


def keyed_before(spark, sf):
    """One row per (user, kind) seen early; users are keyed in order of appearance of their id."""
    early = event_batch(spark, sf).where(F.col("ts") < ts("2024-01-02"))
    rows = early.groupBy("hash_sk", "hash_seq_no").agg(
        F.max("user_id").alias("user_id"), F.min("event_id").alias("first_event")
    )
    return rows.select(
        "hash_sk",
        "hash_seq_no",
        (F.col("user_id") * 2 + 5).cast("decimal(38,0)").alias("sk"),
        (F.col("first_event") + 1).cast("decimal(38,0)").alias("seq"),
        F.when(F.col("first_event") < 100, "N").otherwise("Y").alias("active_flg"),
    )


CTES["keyed"] = """
SELECT hash_sk, hash_seq_no, CAST(max(user_id) * 2 + 5 AS DECIMAL(38,0)) AS sk,
       CAST(min(event_id) + 1 AS DECIMAL(38,0)) AS seq,
       CASE WHEN min(event_id) < 100 THEN 'N' ELSE 'Y' END AS active_flg
FROM ev WHERE ts < TIMESTAMP '2024-01-02' GROUP BY hash_sk, hash_seq_no"""


@query(
    "assign_surrogate_key",
    """SELECT event_id, user_id, coalesce((SELECT max(t.sk) FROM keyed t WHERE t.hash_sk = ev.hash_sk),
              dense_rank() OVER (ORDER BY user_id) + (SELECT coalesce(max(sk), 0) FROM keyed)) AS sk
       FROM ev""",
    "ev keyed",
    ids=("sk",),
)
def _(spark, sf):
    batch = event_batch(spark, sf).select("event_id", "user_id", "hash_sk")
    keyed = assign_surrogate_key(batch, keyed_before(spark, sf), "sk", ["user_id"])
    return keyed.select("event_id", "user_id", "sk")


@query(
    "assign_sequence_number",
    """, pairs AS (SELECT hash_sk, hash_seq_no, count(*) AS n FROM ev GROUP BY ALL)
       SELECT hash_sk, hash_seq_no, coalesce(
              (SELECT max(t.seq) FROM keyed t WHERE t.hash_sk = p.hash_sk AND t.hash_seq_no = p.hash_seq_no
                      AND t.active_flg = 'Y'),
              row_number() OVER (PARTITION BY hash_sk ORDER BY hash_seq_no)
              + coalesce((SELECT max(t.seq) FROM keyed t WHERE t.hash_sk = p.hash_sk), 0)) AS seq
       FROM pairs p""",
    "ev keyed",
    ids=("seq",),
)
def _(spark, sf):
    pairs = event_batch(spark, sf).select("hash_sk", "hash_seq_no").distinct()
    return assign_sequence_number(pairs, keyed_before(spark, sf), "seq", unique_order=True)


CLOSED = """
SELECT sk, seq, label, hash_sk, hash_seq_no, start_ts,
       CASE WHEN active_flg = 'Y' THEN nxt ELSE end_ts END AS end_ts,
       CASE WHEN active_flg = 'Y' THEN CASE WHEN nxt IS NULL THEN 'Y' ELSE 'N' END ELSE active_flg END AS active_flg,
       CASE WHEN active_flg = 'Y' THEN CASE WHEN nxt IS NULL THEN 'Y' ELSE 'N' END ELSE reporting_flg END AS reporting_flg,
       etl_updt_ts
FROM (SELECT *, lead(start_ts) OVER (PARTITION BY sk, active_flg ORDER BY start_ts, seq) AS nxt FROM dim)"""


@query("close_versions", CLOSED, "dim", ids=("sk", "seq"))
def _(spark, sf):
    return close_versions(dimension(spark, sf), "sk", "seq")


def by_kind(spark, sf):
    """Versions numbered by kind of event, so that a (key, number) repeats."""
    number = F.length("label").cast("decimal(38,0)")
    return dimension(spark, sf).withColumn("seq", number)


@query(
    "demote_reporting",
    """, d AS (SELECT * REPLACE (CAST(length(label) AS DECIMAL(38,0)) AS seq) FROM dim)
       SELECT * REPLACE (CASE WHEN reporting_flg = 'Y' AND start_ts <
           (SELECT max(start_ts) FROM d x WHERE x.sk = d.sk AND x.seq = d.seq AND x.reporting_flg = 'Y')
           THEN 'N' ELSE reporting_flg END AS reporting_flg) FROM d""",
    "dim",
    ids=("sk", "seq"),
)
def _(spark, sf):
    return demote_reporting(by_kind(spark, sf), "sk", "seq")


def known_users(spark, sf):
    """The dimension after a load of the first days: one open version per user, others closed."""
    e = table(spark, sf, "events").where(F.col("ts") < ts("2024-01-15"))
    return e.select(
        F.col("user_id"),
        F.col("event_id"),
        (F.col("user_id") + 1).cast("decimal(38,0)").alias("sk"),
        F.col("event_id").cast("decimal(38,0)").alias("seq"),
        hash_key(["user_id"]).alias("hash_sk"),
        hash_key(["event_id"]).alias("hash_seq_no"),
        F.col("ts").alias("start_ts"),
        F.lit(None).cast("timestamp_ntz").alias("end_ts"),
        F.when(F.col("event_type") == "error", "N").otherwise("Y").alias("active_flg"),
        F.when(F.col("event_type") == "view", "N").otherwise("Y").alias("reporting_flg"),
        ts("2025-01-01").alias("etl_updt_ts"),
    )


CTES["known"] = """
SELECT user_id, event_id, CAST(user_id + 1 AS DECIMAL(38,0)) AS sk, CAST(event_id AS DECIMAL(38,0)) AS seq,
       sha256(CAST(user_id AS VARCHAR)) AS hash_sk, sha256(CAST(event_id AS VARCHAR)) AS hash_seq_no,
       ts AS start_ts, CAST(NULL AS TIMESTAMP) AS end_ts,
       CASE WHEN event_type = 'error' THEN 'N' ELSE 'Y' END AS active_flg,
       CASE WHEN event_type = 'view' THEN 'N' ELSE 'Y' END AS reporting_flg,
       TIMESTAMP '2025-01-01' AS etl_updt_ts
FROM events WHERE ts < TIMESTAMP '2024-01-15'"""

def scd2_sql(known: str, batch: str, deleted: str) -> str:
    """The CTEs of one load, from ``known`` to the table ``shown`` that it leaves."""
    return f"""
  src AS (SELECT user_id, event_id, ts, sha256(CAST(user_id AS VARCHAR)) AS hash_sk,
                 sha256(CAST(event_id AS VARCHAR)) AS hash_seq_no
          FROM events WHERE {batch}),
  last_keys AS (SELECT hash_sk, max(sk) AS sk, max(seq) AS seq FROM {known} GROUP BY hash_sk),
  last_versions AS (SELECT hash_sk, hash_seq_no, max(seq) AS seq FROM {known} WHERE active_flg = 'Y' GROUP BY ALL),
  keyed AS (SELECT src.*,
                   coalesce(k.sk, dense_rank() OVER (ORDER BY user_id) + (SELECT coalesce(max(sk), 0) FROM {known})) AS sk,
                   coalesce(v.seq, row_number() OVER (PARTITION BY src.hash_sk ORDER BY src.hash_seq_no) + coalesce(k.seq, 0)) AS seq
            FROM src LEFT JOIN last_keys k ON k.hash_sk = src.hash_sk
            LEFT JOIN last_versions v ON v.hash_sk = src.hash_sk AND v.hash_seq_no = src.hash_seq_no),
  grown AS (SELECT * FROM {known} UNION ALL
            SELECT user_id, event_id, sk, seq, hash_sk, hash_seq_no, ts, CAST(NULL AS TIMESTAMP), 'Y', 'Y',
                   {SQL_LOAD_TS} FROM keyed),
  points AS (SELECT *, lead(start_ts) OVER (PARTITION BY sk ORDER BY start_ts, seq) AS nxt
             FROM (SELECT DISTINCT sk, start_ts, seq FROM grown WHERE active_flg = 'Y')),
  led AS (SELECT g.*, p.nxt FROM grown g LEFT JOIN points p
          ON g.active_flg = 'Y' AND p.sk = g.sk AND p.start_ts = g.start_ts AND p.seq = g.seq),
  closed AS (SELECT * EXCLUDE (nxt) REPLACE (
                 CASE WHEN active_flg = 'Y' THEN nxt ELSE end_ts END AS end_ts,
                 CASE WHEN active_flg = 'N' OR nxt IS NOT NULL THEN 'N' ELSE 'Y' END AS active_flg,
                 CASE WHEN active_flg = 'N' THEN reporting_flg WHEN nxt IS NULL THEN 'Y' ELSE 'N' END AS reporting_flg)
             FROM led),
  newest AS (SELECT *, max(CASE WHEN reporting_flg = 'Y' THEN start_ts END) OVER (PARTITION BY sk, seq) AS m FROM closed),
  demoted AS (SELECT * EXCLUDE (m) REPLACE (CASE WHEN reporting_flg = 'Y' AND start_ts < m THEN 'N' ELSE reporting_flg END AS reporting_flg)
              FROM newest),
  shown AS (SELECT * EXCLUDE (hit) REPLACE (CASE WHEN hit THEN etl_updt_ts ELSE end_ts END AS end_ts,
                   CASE WHEN hit THEN 'N' ELSE active_flg END AS active_flg)
            FROM (SELECT *, active_flg = 'Y' AND user_id IN (SELECT user_id FROM events WHERE {deleted}) AS hit FROM demoted))"""


LAST_ERRORS = "event_type = 'error' AND ts >= TIMESTAMP '2024-01-30'"
SCD2 = f", {scd2_sql('known', 'true', LAST_ERRORS)} SELECT * FROM shown"


DIMENSION = dict(
    sk="sk",
    seq="seq",
    key_cols=["user_id"],
    version_cols=["event_id"],
    start_ts="ts",
    load_ts=LOAD_TS,
    deleted_on=["user_id"],
    unique_versions=True,
)


def last_errors(spark, sf):
    return table(spark, sf, "events").where(
        (F.col("event_type") == "error") & (F.col("ts") >= ts("2024-01-30"))
    )


@query("scd2_load", SCD2, "known", ids=("sk", "seq"))
def _(spark, sf):
    source = table(spark, sf, "events").select("user_id", "event_id", "ts")
    deleted = last_errors(spark, sf).select("user_id")
    return scd2_load(known_users(spark, sf), source, deleted=deleted, **DIMENSION)


CTES["no_versions"] = "SELECT * FROM known WHERE false"
CTES["loaded_once"] = f"WITH {scd2_sql('no_versions', 'event_id % 2 = 0', 'false')} SELECT * FROM shown"


@query(
    "scd2_two_loads",
    f", {scd2_sql('loaded_once', 'true', LAST_ERRORS)} SELECT * FROM shown",
    "known no_versions loaded_once",
    ids=("sk", "seq"),
)
def _(spark, sf):
    """Every second event, then all of them: the keys come from a registry that both loads extend."""
    source = table(spark, sf, "events").select("user_id", "event_id", "ts")
    registry = KeyRegistry(spark, new_folder(spark, "registry"))
    empty = known_users(spark, sf).where(F.lit(False))
    once = scd2_load(
        empty, source.where("event_id % 2 = 0"), registry=registry, load="1", **DIMENSION
    )
    once = save_state(once, new_folder(spark, "dimension"))
    deleted = last_errors(spark, sf).select("user_id")
    return scd2_load(once, source, deleted=deleted, registry=registry, load="2", **DIMENSION)


@query(
    "surrogate_key_registry",
    """SELECT hash_sk, coalesce((SELECT max(t.sk) FROM keyed t WHERE t.hash_sk = ev.hash_sk),
              dense_rank() OVER (ORDER BY user_id) + (SELECT coalesce(max(sk), 0) FROM keyed)) AS sk
       FROM (SELECT DISTINCT hash_sk, user_id FROM ev) ev""",
    "ev keyed",
    ids=("sk",),
)
def _(spark, sf):
    """The registry of a dimension after a load, which ran twice: the second time changes nothing."""
    folder = new_folder(spark, "registry")
    registry = KeyRegistry.of_dimension(keyed_before(spark, sf), folder)
    for _ in range(2):
        batch = event_batch(spark, sf).select("user_id", "hash_sk")
        keyed = assign_surrogate_key(batch, None, "sk", ["user_id"], registry=registry, load="2")
        registry.extend(keyed, "2")
    return registry.entries()
