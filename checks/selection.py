"""Latest versions, joins, aggregates, windows, sets."""

from pyspark.sql import functions as F

from checks.registry import (
    all_orders,
    bronze,
    dimension,
    journal,
    lines,
    query,
    silver,
    table,
    ts,
)
from millrace.operators.aggregates import (
    conditional_counts,
    count_matching,
    distinct_rows,
    global_max_default,
    group_by_all_having,
    max_per_key,
)
from millrace.operators.joins import (
    anti_left_null,
    anti_not_exists,
    correlated_scalar_max,
    cross_join_scalar,
    inner_on_keys,
    join_blank_safe,
    join_mixed_on,
    semi_exists,
    semi_in,
)
from millrace.operators.latest import latest_by_max, latest_by_rank, latest_then_increment
from millrace.operators.merge import merge_upsert
from millrace.operators.numbering import (
    lead_next_start,
    row_number_global,
    row_number_per_key,
    with_dense_rank,
)
from millrace.operators.sets import top_k_newest, union_all, union_distinct

# ------------------------------------------------------------ latest versions


@query(
    "latest_by_max",
    """SELECT o.* FROM o JOIN (SELECT c, max(src_load_ts) AS m FROM o GROUP BY c) x
       ON o.c = x.c AND o.src_load_ts = x.m""",
    "o",
)
def _(spark, sf):
    return latest_by_max(all_orders(spark, sf), ["c"], "src_load_ts")


@query(
    "latest_by_rank",
    """SELECT primary_key__pk, event_type, least_significant_position, seen_at FROM journal
       QUALIFY row_number() OVER (PARTITION BY primary_key__pk
               ORDER BY seen_at DESC, least_significant_position DESC) = 1""",
    "journal",
    ids=("primary_key__pk", "least_significant_position"),
)
def _(spark, sf):
    j = journal(spark, sf).select(
        "primary_key__pk", "event_type", "least_significant_position", "seen_at"
    )
    return latest_by_rank(j, ["primary_key__pk"], ["seen_at", "least_significant_position"])


@query(
    "latest_then_increment",
    """SELECT o.* FROM o JOIN (SELECT c, max(src_load_ts) AS m FROM o GROUP BY c) x
       ON o.c = x.c AND o.src_load_ts = x.m WHERE o.src_load_ts > TIMESTAMP '2001-06-01'""",
    "o",
)
def _(spark, sf):
    return latest_then_increment(all_orders(spark, sf), ["c"], "src_load_ts", "2001-06-01")


# ---------------------------------------------------------------------- joins


@query(
    "inner_on_keys",
    """SELECT o.k, o.c, o.st, o.src_load_ts FROM o
       JOIN (SELECT c, max(src_load_ts) AS src_load_ts FROM o GROUP BY c) x
       ON o.c = x.c AND o.src_load_ts = x.src_load_ts""",
    "o",
)
def _(spark, sf):
    o = all_orders(spark, sf)
    newest = max_per_key(o, ["c"], "src_load_ts")
    return inner_on_keys(o, newest, ["c", "src_load_ts"]).select("k", "c", "st", "src_load_ts")


@query(
    "semi_exists",
    """SELECT c_custkey, c_name FROM customer c
       WHERE EXISTS (SELECT 1 FROM o WHERE o.c = c.c_custkey AND o.src_load_ts >= TIMESTAMP '2001-06-01')""",
    "o",
)
def _(spark, sf):
    recent = all_orders(spark, sf).where(F.col("src_load_ts") >= ts("2001-06-01"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return semi_exists(customers, recent, {"c_custkey": "c"})


@query(
    "anti_not_exists",
    """SELECT k, line, payload FROM lines l
       WHERE NOT EXISTS (SELECT 1 FROM lines r WHERE r.payload = 'R' AND r.k = l.k AND r.line = l.line)""",
    "lines",
)
def _(spark, sf):
    all_lines = lines(spark, sf).select("k", "line", "payload")
    returned = all_lines.where(F.col("payload") == "R")
    return anti_not_exists(all_lines, returned, ["k", "line"])


@query(
    "semi_in",
    """SELECT k, c FROM o WHERE k IN
       (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '2001-01-01')""",
    "o",
)
def _(spark, sf):
    returned = table(spark, sf, "lineitem").where(
        (F.col("l_returnflag") == "R") & (F.col("l_shipdate") >= ts("2001-01-01"))
    )
    return semi_in(all_orders(spark, sf).select("k", "c"), returned, {"k": "l_orderkey"})


@query(
    "anti_left_null",
    """SELECT o.k, o.c FROM o LEFT JOIN
       (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') r ON o.k = r.l_orderkey
       WHERE r.l_orderkey IS NULL""",
    "o",
)
def _(spark, sf):
    returned = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    return anti_left_null(all_orders(spark, sf).select("k", "c"), returned, {"k": "l_orderkey"})


@query(
    "cross_join_scalar",
    "SELECT k, c, (SELECT max(batch_id) FROM silver) AS batch_id, (SELECT max(src_load_ts) FROM silver) AS newest FROM o",
    "o silver",
    ids=("batch_id",),
)
def _(spark, sf):
    newest = silver(spark, sf).agg(
        F.max("batch_id").alias("batch_id"), F.max("src_load_ts").alias("newest")
    )
    return cross_join_scalar(all_orders(spark, sf).select("k", "c"), newest)


@query(
    "correlated_scalar_max",
    """SELECT c_custkey AS c, c_name,
              (SELECT max(src_load_ts) FROM silver s WHERE s.c = c_custkey) AS newest FROM customer""",
    "o silver",
)
def _(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("c"), "c_name")
    return correlated_scalar_max(customers, silver(spark, sf), ["c"], "src_load_ts", "newest")


@query(
    "join_mixed_on",
    """SELECT b.k, b.c, b.st, s.batch_id FROM bronze b
       LEFT JOIN silver s ON b.k = s.k AND s.st = 'F'""",
    "o silver bronze",
    ids=("batch_id",),
)
def _(spark, sf):
    old = silver(spark, sf).select("k", F.col("st").alias("old_st"), "batch_id")
    new = bronze(spark, sf).select("k", "c", "st")
    joined = join_mixed_on(new, old, ["k"], F.col("s.old_st") == "F", how="left")
    return joined.select("k", "c", "st", "batch_id")


@query(
    "blank_safe_key_equal",
    """, l AS (SELECT k AS id, CASE st WHEN 'F' THEN '' WHEN 'P' THEN NULL ELSE CAST(k AS VARCHAR) END AS k FROM o),
         r AS (SELECT DISTINCT CASE st WHEN 'F' THEN NULL WHEN 'O' THEN CAST(k AS VARCHAR) END AS k FROM silver)
       SELECT id, k, 'blank_never' AS mode FROM l
       WHERE EXISTS (SELECT 1 FROM r WHERE nullif(r.k, '') = nullif(l.k, ''))
       UNION ALL
       SELECT id, k, 'blank_is_null' AS mode FROM l
       WHERE EXISTS (SELECT 1 FROM r WHERE coalesce(r.k, '') = coalesce(l.k, ''))""",
    "o silver",
)
def _(spark, sf):
    text = F.col("k").cast("string")
    left = all_orders(spark, sf).select(
        F.col("k").alias("id"),
        F.when(F.col("st") == "F", "").when(F.col("st") == "O", text).alias("k"),
    )
    right = silver(spark, sf).select(F.when(F.col("st") == "O", text).alias("k"))
    return union_all(
        [
            join_blank_safe(left, right, ["k"], mode).withColumn("mode", F.lit(mode))
            for mode in ("blank_never", "blank_is_null")
        ]
    )


# ----------------------------------------------------------------- aggregates


@query("max_per_key", "SELECT c, max(src_load_ts) AS newest FROM o GROUP BY c", "o")
def _(spark, sf):
    return max_per_key(all_orders(spark, sf), ["c"], "src_load_ts", "newest")


@query(
    "group_by_all_having",
    "SELECT c, src_load_ts, count(*) AS n FROM o GROUP BY c, src_load_ts HAVING count(*) > 1",
    "o",
)
def _(spark, sf):
    return group_by_all_having(all_orders(spark, sf), ["c", "src_load_ts"])


@query(
    "global_max_default",
    """SELECT coalesce(max(src_load_ts), TIMESTAMP '1900-01-01') AS newest,
              (SELECT coalesce(max(src_load_ts), TIMESTAMP '1900-01-01') FROM o WHERE st = 'none') AS missing FROM o""",
    "o",
)
def _(spark, sf):
    o = all_orders(spark, sf)
    start = ts("1900-01-01")
    newest = global_max_default(o, "src_load_ts", start, "newest")
    missing = global_max_default(o.where(F.col("st") == "none"), "src_load_ts", start, "missing")
    return cross_join_scalar(newest, missing)


def merged_orders(spark, sf):
    """Silver after an upsert that keeps load times: has inserts and updates."""
    source = bronze(spark, sf).withColumns(
        {
            "batch_id": F.lit("20260101000000000000000").cast("decimal(38,0)"),
            "etl_load_ts": ts("2026-01-01"),
            "etl_updt_ts": ts("2026-01-01"),
        }
    )
    return merge_upsert(silver(spark, sf), source, ["k"], preserve_load_ts=True)


@query(
    "conditional_counts",
    """SELECT batch_id, CAST(sum(CASE WHEN etl_load_ts = etl_updt_ts THEN 1 ELSE 0 END) AS BIGINT) AS rows_inserted,
              CAST(sum(CASE WHEN etl_load_ts < etl_updt_ts THEN 1 ELSE 0 END) AS BIGINT) AS rows_updated
       FROM merged GROUP BY batch_id""",
    "o silver bronze merged",
    ids=("batch_id",),
)
def _(spark, sf):
    return conditional_counts(merged_orders(spark, sf))


@query("distinct_rows", "SELECT DISTINCT k, line FROM lines", "lines")
def _(spark, sf):
    return distinct_rows(lines(spark, sf), ["k", "line"])


@query(
    "count_matching",
    """SELECT count(*) AS deleted_count FROM o
       WHERE k IN (SELECT k FROM lines WHERE payload = 'R')""",
    "o lines",
)
def _(spark, sf):
    log = lines(spark, sf).where(F.col("payload") == "R").select(F.col("k").alias("pk"))
    return count_matching(all_orders(spark, sf), log, {"k": "pk"})


# -------------------------------------------------------------------- windows


@query(
    "row_number_per_key",
    """SELECT event_id, user_id, ts,
              CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS rn FROM events""",
)
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return row_number_per_key(e, ["user_id"], ["ts", "event_id"], unique_order=True)


@query(
    "row_number_global",
    "SELECT k, c, CAST(row_number() OVER (ORDER BY c, k) AS BIGINT) AS rn FROM o",
    "o",
)
def _(spark, sf):
    return row_number_global(
        all_orders(spark, sf).select("k", "c"), ["c", "k"], unique_order=True
    )


@query(
    "dense_rank_global",
    """SELECT k, c, st, CAST(dense_rank() OVER (ORDER BY c, st) AS BIGINT) AS rank FROM o""",
    "o",
)
def _(spark, sf):
    return with_dense_rank(all_orders(spark, sf).select("k", "c", "st"), ["c", "st"])


@query(
    "lead_next_start",
    """SELECT sk, seq, start_ts, lead(start_ts) OVER (PARTITION BY sk ORDER BY start_ts, seq) AS next_start
       FROM dim WHERE active_flg = 'Y'""",
    "dim",
    ids=("sk", "seq"),
)
def _(spark, sf):
    d = dimension(spark, sf).where(F.col("active_flg") == "Y").select("sk", "seq", "start_ts")
    return lead_next_start(d, "sk", "start_ts", "seq").drop("_in_order")


# ----------------------------------------------------------------------- sets


@query(
    "top_k_newest", "SELECT * FROM o ORDER BY src_load_ts DESC, k DESC LIMIT 100", "o"
)
def _(spark, sf):
    return top_k_newest(all_orders(spark, sf), ["src_load_ts", "k"], 100)


@query(
    "union_all",
    "SELECT k, c, st, src_load_ts FROM silver UNION ALL SELECT k, c, st, src_load_ts FROM bronze",
    "o silver bronze",
)
def _(spark, sf):
    new = bronze(spark, sf)
    return union_all([silver(spark, sf).select(*new.columns), new])


@query(
    "union_distinct",
    "SELECT k, src_load_ts FROM silver UNION SELECT k, src_load_ts FROM bronze",
    "o silver bronze",
)
def _(spark, sf):
    columns = ["k", "src_load_ts"]
    return union_distinct(silver(spark, sf).select(*columns), bronze(spark, sf).select(*columns))
