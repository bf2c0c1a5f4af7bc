"""Registration of queries and their oracle SQL, and the shared base tables.

Every base table exists twice: as a Spark frame and as a SQL common table
expression over the same parquet views. Oracles are written against the latter
and share no code with the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import configure, shared_dir_or

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Staged frames of a session without ``spark.checkpoint.dir`` (one machine) go here.
SCRATCH = "/tmp/checkpoints"

# Clock and batch id of the load under test, and of the load before it.
LOAD_TS = "2026-01-01 00:00:00"
OLD_TS = "2025-01-01 00:00:00"
BATCH = "20260101000000000000000"
OLD_BATCH = "20250101000000000000000"

SQL_LOAD_TS = f"TIMESTAMP '{LOAD_TS}'"
SQL_OLD_TS = f"TIMESTAMP '{OLD_TS}'"
SQL_BATCH = f"CAST('{BATCH}' AS DECIMAL(38,0))"
SQL_OLD_BATCH = f"CAST('{OLD_BATCH}' AS DECIMAL(38,0))"

STAMPS = {"batch_id": BATCH, "load_ts": LOAD_TS}
SQL_STAMPS = f"{SQL_BATCH} AS batch_id, {SQL_LOAD_TS} AS etl_load_ts, {SQL_LOAD_TS} AS etl_updt_ts"
SQL_OLD_STAMPS = (
    f"{SQL_OLD_BATCH} AS batch_id, {SQL_OLD_TS} AS etl_load_ts, {SQL_OLD_TS} AS etl_updt_ts"
)


def as_text_ids(df: DataFrame) -> DataFrame:
    """Render decimal(38,0) ids as text at the very end.

    They have 23 digits, more than a client that turns decimals into doubles
    keeps; the oracles do the same.
    """
    ids = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("string") for c in ids}) if ids else df


def query(name: str, sql: str | None = None, ctes: str = "", ids: tuple[str, ...] = ()):
    """Register a query. ``ctes`` names the base tables its SQL uses, in order."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            shared_dir_or(spark, SCRATCH)
            return as_text_ids(build(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            text = sql.strip()
            names = ctes.split()
            if names:
                # SQL with further CTEs of its own continues the list with a comma.
                how = {n: "AS MATERIALIZED" if n in USED_TWICE else "AS" for n in names}
                text = "WITH " + ", ".join(f"{n} {how[n]} ({CTES[n]})" for n in names) + f" {text}"
            if ids:
                text_ids = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ids)
                text = f"SELECT * REPLACE ({text_ids}) FROM ({text})"
            ORACLES[name] = text
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- base tables

CTES: dict[str, str] = {}

# Aggregates that an oracle reads more than once.
USED_TWICE = {"old_issues", "new_issues", "recent_issues", "good_lines", "lines_after"}


def ts(value: str):
    return F.lit(value).cast("timestamp_ntz")


def batch(value: str):
    return F.lit(value).cast("decimal(38,0)")


def stamped(df: DataFrame, batch_id: str, load_ts: str) -> DataFrame:
    return df.withColumns(
        {"batch_id": batch(batch_id), "etl_load_ts": ts(load_ts), "etl_updt_ts": ts(load_ts)}
    )


def all_orders(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("c"),
        F.col("o_orderstatus").alias("st"),
        F.col("o_orderdate").alias("src_load_ts"),
    )


CTES["o"] = (
    "SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, o_orderdate AS src_load_ts FROM orders"
)


def silver(spark, sf_dir) -> DataFrame:
    """Orders as the previous load left them: all placed before 2000."""
    return stamped(
        all_orders(spark, sf_dir).where(F.col("src_load_ts") < ts("2000-01-01")), OLD_BATCH, OLD_TS
    )


CTES["silver"] = (
    f"SELECT k, c, st, src_load_ts, {SQL_OLD_STAMPS} FROM o WHERE src_load_ts < TIMESTAMP '2000-01-01'"
)


def bronze(spark, sf_dir) -> DataFrame:
    """Orders as delivered now: all since 1998, with new customer and status."""
    o = all_orders(spark, sf_dir).where(F.col("src_load_ts") >= ts("1998-01-01"))
    return o.select("k", (F.col("c") + 1).alias("c"), F.lit("X").alias("st"), "src_load_ts")


CTES["bronze"] = (
    "SELECT k, c + 1 AS c, 'X' AS st, src_load_ts FROM o WHERE src_load_ts >= TIMESTAMP '1998-01-01'"
)


# Silver after an upsert of bronze that keeps the load time of updated rows.
CTES["merged"] = f"""
SELECT s.k, b.c, b.st, b.src_load_ts, {SQL_BATCH} AS batch_id, s.etl_load_ts, {SQL_LOAD_TS} AS etl_updt_ts
FROM silver s JOIN bronze b ON s.k = b.k
UNION ALL SELECT s.* FROM silver s WHERE NOT EXISTS (SELECT 1 FROM bronze b WHERE b.k = s.k)
UNION ALL SELECT b.*, {SQL_STAMPS} FROM bronze b WHERE NOT EXISTS (SELECT 1 FROM silver s WHERE s.k = b.k)"""


def journal(spark, sf_dir) -> DataFrame:
    """Events as journal images: the user is the row, an error its delete."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("decimal(38,0)").alias("primary_key__pk"),
        F.when(F.col("event_type") == "error", "IncrementalDeleteRows")
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.lit(0).cast("decimal(38,0)").alias("most_significant_position"),
        F.col("event_id").cast("decimal(38,0)").alias("least_significant_position"),
        F.col("ts").alias("seen_at"),
        F.lit("{}").alias("sf_metadata"),
        F.col("props").alias("PAYLOAD__PROPS"),
        F.nullif(F.col("user_id"), F.lit(1)).alias("PAYLOAD__USER_ID"),
    )


CTES["journal"] = """
SELECT CAST(user_id AS DECIMAL(38,0)) AS primary_key__pk,
       CASE WHEN event_type = 'error' THEN 'IncrementalDeleteRows' ELSE event_type END AS event_type,
       CAST(0 AS DECIMAL(38,0)) AS most_significant_position,
       CAST(event_id AS DECIMAL(38,0)) AS least_significant_position,
       ts AS seen_at, '{}' AS sf_metadata, props AS payload__props,
       nullif(user_id, 1) AS payload__user_id
FROM events"""

# Journal segments: three consecutive spans of the month.
SEGMENTS = {
    "events_1": ("2024-01-01", "2024-01-11"),
    "events_2": ("2024-01-11", "2024-01-21"),
    "events_3": ("2024-01-21", "2024-02-01"),
}


def segment(spark, sf_dir, name: str) -> DataFrame:
    start, end = SEGMENTS[name]
    return journal(spark, sf_dir).where(
        (F.col("seen_at") >= ts(start)) & (F.col("seen_at") < ts(end))
    )


CTES["segmented"] = (
    "SELECT *, CASE WHEN seen_at < TIMESTAMP '2024-01-11' THEN 'events_1' "
    "WHEN seen_at < TIMESTAMP '2024-01-21' THEN 'events_2' ELSE 'events_3' END AS src_journal_tbl "
    "FROM journal"
)


def dimension(spark, sf_dir) -> DataFrame:
    """Events as versions of users, none of them closed yet."""
    e = table(spark, sf_dir, "events")
    flag = F.when(F.col("event_type") == "error", "N").otherwise("Y")
    return e.select(
        F.col("user_id").cast("decimal(38,0)").alias("sk"),
        F.col("event_id").cast("decimal(38,0)").alias("seq"),
        F.col("event_type").alias("label"),
        F.sha2(F.col("user_id").cast("string"), 256).alias("hash_sk"),
        F.sha2(F.col("event_type"), 256).alias("hash_seq_no"),
        F.col("ts").alias("start_ts"),
        F.lit(None).cast("timestamp_ntz").alias("end_ts"),
        flag.alias("active_flg"),
        flag.alias("reporting_flg"),
        ts(OLD_TS).alias("etl_updt_ts"),
    )


CTES["dim"] = f"""
SELECT CAST(user_id AS DECIMAL(38,0)) AS sk, CAST(event_id AS DECIMAL(38,0)) AS seq,
       event_type AS label, sha256(CAST(user_id AS VARCHAR)) AS hash_sk, sha256(event_type) AS hash_seq_no,
       ts AS start_ts, CAST(NULL AS TIMESTAMP) AS end_ts,
       CASE WHEN event_type = 'error' THEN 'N' ELSE 'Y' END AS active_flg,
       CASE WHEN event_type = 'error' THEN 'N' ELSE 'Y' END AS reporting_flg,
       {SQL_OLD_TS} AS etl_updt_ts
FROM events"""


def lines(spark, sf_dir) -> DataFrame:
    """Order lines; (k, line) has duplicates in the data, and NULLs are put in."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("line"),
        F.col("l_returnflag").alias("payload"),
        F.col("l_shipdate").alias("src_load_ts"),
    )


CTES["lines"] = (
    "SELECT l_orderkey AS k, nullif(l_linenumber, 7) AS line, l_returnflag AS payload, "
    "l_shipdate AS src_load_ts FROM lineitem"
)
