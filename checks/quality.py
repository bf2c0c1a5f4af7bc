"""Key checks, quarantine records, column tests, schema drift."""

from pyspark.sql import functions as F

from checks.registry import (
    BATCH,
    CTES,
    LOAD_TS,
    OLD_BATCH,
    OLD_TS,
    SQL_BATCH,
    SQL_LOAD_TS,
    SQL_OLD_BATCH,
    SQL_OLD_TS,
    lines,
    query,
    stamped,
    table,
    ts,
)
from millrace.operators.quality import (
    check_not_null,
    check_unique,
    exclude_bad_keys,
    find_duplicate_keys,
    find_null_keys,
    record_drift,
    record_issues,
    resolve_issues,
    schema_drift,
)

NAMES = {"model_id": "silver.lines", "model_grp": "sales"}
NEW = {"batch_id": BATCH, "load_ts": LOAD_TS}
OLD = {"batch_id": OLD_BATCH, "load_ts": OLD_TS}


# The key object of a line as text; a NULL member is left out.
LINE_KEY = """('{' || concat_ws(',', '"k":' || k, '"line":' || line) || '}')"""


def issue_sql(rows: str, condition: str, having: str, check: str, batch_id: str, load_ts: str) -> str:
    """Issue rows of the key (k, line); the newest row gives time and payload."""
    return f"""
    SELECT 'silver.lines' AS model_id, 'sales' AS model_grp, {LINE_KEY} AS key_column,
           '{check}' AS validation_type, CAST(count(*) AS DECIMAL(38,0)) AS issue_record_count,
           arg_max(payload, CAST(src_load_ts AS VARCHAR) || payload) AS json_value, 'N' AS success_flg,
           {batch_id} AS batch_id, max(src_load_ts) AS src_load_ts,
           {load_ts} AS etl_load_ts, {load_ts} AS etl_updt_ts
    FROM {rows} WHERE {condition} GROUP BY k, line HAVING {having}"""


DUPLICATES = ("true", "count(*) > 1", "Duplication Check for Key Columns")
NULLS = ("k IS NULL OR line IS NULL", "true", "Null Check for Key Columns")
IDS = ("issue_record_count", "batch_id")


@query(
    "find_duplicate_keys",
    issue_sql("lines", *DUPLICATES, SQL_BATCH, SQL_LOAD_TS),
    "lines",
    ids=IDS,
)
def _(spark, sf):
    return find_duplicate_keys(lines(spark, sf), ["k", "line"], "payload", **NAMES, **NEW)


@query("find_null_keys", issue_sql("lines", *NULLS, SQL_BATCH, SQL_LOAD_TS), "lines", ids=IDS)
def _(spark, sf):
    return find_null_keys(lines(spark, sf), ["k", "line"], "payload", **NAMES, **NEW)


@query(
    "exclude_bad_keys",
    """SELECT * FROM lines l WHERE line IS NOT NULL AND k IS NOT NULL
       AND (SELECT count(*) FROM lines x WHERE x.k = l.k AND x.line = l.line) = 1""",
    "lines",
)
def _(spark, sf):
    return exclude_bad_keys(lines(spark, sf), ["k", "line"], "src_load_ts")


@query(
    "check_unique",
    "SELECT line, count(*) AS n FROM lines WHERE line IS NOT NULL GROUP BY line HAVING count(*) > 1",
    "lines",
)
def _(spark, sf):
    return check_unique(lines(spark, sf), "line")


@query("check_not_null", "SELECT * FROM lines WHERE line IS NULL", "lines")
def _(spark, sf):
    return check_not_null(lines(spark, sf), "line")


# The check table as the previous batch left it: issues of the lines shipped
# before 2000, with a newer line of the same key changing nothing there.
CTES["early_lines"] = "SELECT * FROM lines WHERE src_load_ts < TIMESTAMP '2000-01-01'"
CTES["old_issues"] = (
    issue_sql("early_lines", *DUPLICATES, SQL_OLD_BATCH, SQL_OLD_TS)
    + " UNION ALL "
    + issue_sql("early_lines", *NULLS, SQL_OLD_BATCH, SQL_OLD_TS)
)
CTES["new_issues"] = (
    issue_sql("lines", *DUPLICATES, SQL_BATCH, SQL_LOAD_TS)
    + " UNION ALL "
    + issue_sql("lines", *NULLS, SQL_BATCH, SQL_LOAD_TS)
)


def issues(rows, stamps):
    keys = ["k", "line"]
    return find_duplicate_keys(rows, keys, "payload", **NAMES, **stamps).unionByName(
        find_null_keys(rows, keys, "payload", **NAMES, **stamps)
    )


def old_issues(spark, sf):
    return issues(lines(spark, sf).where(F.col("src_load_ts") < ts("2000-01-01")), OLD)


def recorded_sql(new: str) -> str:
    """Old and new issues by their key: the new row if there is one, with the old one's load time."""
    return f"""
    SELECT model_id, model_grp, key_column, validation_type, issue_record_count, json_value, success_flg, batch_id, src_load_ts,
           coalesce(max(CASE WHEN is_new = 0 THEN etl_load_ts END) OVER same, etl_load_ts) AS etl_load_ts, etl_updt_ts
    FROM (SELECT *, 1 AS is_new FROM {new} UNION ALL SELECT *, 0 FROM old_issues)
    WINDOW same AS (PARTITION BY model_id, model_grp, key_column, validation_type, src_load_ts)
    QUALIFY is_new = max(is_new) OVER same"""


@query(
    "record_issues",
    recorded_sql("new_issues"),
    "lines early_lines old_issues new_issues",
    ids=IDS,
)
def _(spark, sf):
    return record_issues(old_issues(spark, sf), issues(lines(spark, sf), NEW))


@query(
    "resolve_issues",
    f"""SELECT * REPLACE (CASE WHEN key_column IN
           (SELECT {LINE_KEY} FROM lines
            WHERE payload = 'N') THEN 'Y' ELSE success_flg END AS success_flg) FROM old_issues""",
    "lines early_lines old_issues",
    ids=IDS,
)
def _(spark, sf):
    target = lines(spark, sf).where(F.col("payload") == "N")
    return resolve_issues(old_issues(spark, sf), target, ["k", "line"], BATCH, **NAMES)


# Column inventories: an order is a model, its lines are the columns, and the
# return flags of the lines the types.


def inventory(spark, sf, lacks: str, type_of):
    rows = table(spark, sf, "lineitem").where(F.col("l_returnflag") != lacks)
    return rows.groupBy(
        F.col("l_orderkey").cast("string").alias("model_id"),
        F.concat(F.lit("Col_"), F.col("l_linenumber")).alias("column_name"),
    ).agg(F.concat(F.lit("TYPE_"), type_of("l_returnflag")).alias("data_type"))


INVENTORY = """
SELECT CAST(l_orderkey AS VARCHAR) AS model_id, 'col_' || l_linenumber AS column_name,
       'type_' || lower({agg}(l_returnflag)) AS data_type
FROM lineitem WHERE l_returnflag <> '{lacks}' GROUP BY ALL"""
CTES["src_cols"] = INVENTORY.format(agg="max", lacks="R")
CTES["tgt_cols"] = INVENTORY.format(agg="min", lacks="A")
CTES["drift"] = """
SELECT coalesce(s.model_id, t.model_id) AS model_id, coalesce(s.column_name, t.column_name) AS column_name,
       s.data_type AS source_column_type, t.data_type AS target_column_type,
       CASE WHEN t.model_id IS NULL THEN 'MISSING_IN_TARGET' WHEN s.model_id IS NULL THEN 'MISSING_IN_SOURCE'
            ELSE 'TYPE_MISMATCH' END AS diff_type
FROM src_cols s FULL JOIN tgt_cols t ON s.model_id = t.model_id AND s.column_name = t.column_name
WHERE s.data_type IS DISTINCT FROM t.data_type"""


def drift(spark, sf):
    return schema_drift(inventory(spark, sf, "R", F.max), inventory(spark, sf, "A", F.min))


@query("schema_drift", "SELECT * FROM drift", "src_cols tgt_cols drift")
def _(spark, sf):
    return drift(spark, sf)


RUN = "'sales' AS model_grp, 'shop' AS pipeline_name"


@query(
    "record_drift",
    f"""SELECT *, {RUN}, {SQL_OLD_BATCH} AS batch_id, {SQL_OLD_TS} AS etl_load_ts, {SQL_OLD_TS} AS etl_updt_ts FROM drift
        UNION ALL
        SELECT *, {RUN}, {SQL_BATCH} AS batch_id, {SQL_LOAD_TS} AS etl_load_ts, {SQL_LOAD_TS} AS etl_updt_ts FROM drift""",
    "src_cols tgt_cols drift",
    ids=("batch_id",),
)
def _(spark, sf):
    """The second run of a batch replaces what the first one recorded."""
    named = drift(spark, sf).withColumns(
        {"model_grp": F.lit("sales"), "pipeline_name": F.lit("shop")}
    )
    before = stamped(named, OLD_BATCH, OLD_TS)
    first_run = stamped(named, BATCH, OLD_TS).withColumn("diff_type", F.lit("STALE"))
    return record_drift(before.unionByName(first_run), stamped(named, BATCH, LOAD_TS))
