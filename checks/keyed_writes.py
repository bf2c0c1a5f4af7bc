"""Keyed writes: each query returns the table after the write."""

import uuid

from pyspark.sql import functions as F

from checks.registry import (
    BATCH,
    CTES,
    LOAD_TS,
    SQL_LOAD_TS,
    SQL_STAMPS,
    STAMPS,
    all_orders,
    bronze,
    journal,
    query,
    segment,
    silver,
    stamped,
    ts,
)
from millrace.functions.columns import stamp_audit
from millrace.operators.journal import journal_reload, newest_journal_segments, union_journals
from millrace.operators.merge import (
    append_load,
    delete_insert_by_key,
    delete_insert_by_watermark,
    empty_like,
    full_replace,
    insert_when_absent,
    merge_configurable,
    merge_update_subset,
    merge_upsert,
)
from millrace.operators.deletes import apply_hard_delete
from millrace.session import new_folder
from millrace.sources import bucket_count, save_bucketed, save_partitions, save_state, touched_partitions
from millrace.sources.files import const_table, table_ref_filter
from millrace.streaming import VersionedTable, apply_new_files


def new_rows(spark, sf):
    return stamp_audit(bronze(spark, sf), **STAMPS)


@query("full_replace", f"SELECT k, c, st, src_load_ts, {SQL_STAMPS} FROM o", "o", ids=("batch_id",))
def _(spark, sf):
    return full_replace(all_orders(spark, sf), silver(spark, sf).schema, **STAMPS)


@query(
    "append_load",
    f"SELECT * FROM silver UNION ALL SELECT *, {SQL_STAMPS} FROM bronze",
    "o silver bronze",
    ids=("batch_id",),
)
def _(spark, sf):
    return append_load(silver(spark, sf), new_rows(spark, sf))


@query(
    "empty_like",
    f"SELECT k, c, st, src_load_ts, {SQL_STAMPS} FROM o",
    "o",
    ids=("batch_id",),
)
def _(spark, sf):
    """A table created as an empty copy, then filled with all orders."""
    return append_load(empty_like(silver(spark, sf)), stamp_audit(all_orders(spark, sf), **STAMPS))


@query(
    "const_table",
    """SELECT k, st, id FROM o LEFT JOIN (VALUES ('F', 1), ('O', NULL)) AS n(st, id) USING (st)""",
    "o",
)
def _(spark, sf):
    """A small constant table that names the status of every order."""
    constants = const_table(spark, [("F", 1), ("O", None)], "st string, id int")
    return all_orders(spark, sf).join(constants, "st", "left").select("k", "st", "id")


@query("table_ref_filter", "SELECT c AS id, k FROM o WHERE c = 1", "o")
def _(spark, sf):
    return table_ref_filter(all_orders(spark, sf).select(F.col("c").alias("id"), "k"))


@query(
    "merge_upsert",
    f"""SELECT *, {SQL_STAMPS} FROM bronze
        UNION ALL SELECT s.* FROM silver s WHERE NOT EXISTS (SELECT 1 FROM bronze b WHERE b.k = s.k)""",
    "o silver bronze",
    ids=("batch_id",),
)
def _(spark, sf):
    return merge_upsert(silver(spark, sf), new_rows(spark, sf), ["k"])


# Keys as text, blank for finished and NULL for pending orders; flag off before 1999.
TEXT_KEY = "CASE st WHEN 'F' THEN '' WHEN 'P' THEN NULL ELSE CAST(k AS VARCHAR) END"


@query(
    "merge_configurable",
    f""", t AS (SELECT *, {TEXT_KEY} AS tk, CASE WHEN src_load_ts < TIMESTAMP '1999-01-01' THEN 'N' ELSE 'Y' END AS flg
                FROM silver),
          s AS (SELECT k, c + 1 AS c, 'X' AS st, src_load_ts, {SQL_STAMPS}, {TEXT_KEY} AS tk, 'Y' AS flg
                FROM o WHERE src_load_ts >= TIMESTAMP '1998-01-01'),
          m AS (SELECT t.tk FROM t JOIN s ON nullif(t.tk, '') = nullif(s.tk, '') AND t.flg = 'Y')
        SELECT s.k, s.c, t.st, s.src_load_ts, s.batch_id, s.etl_load_ts, s.etl_updt_ts, s.tk, s.flg
        FROM t JOIN s ON nullif(t.tk, '') = nullif(s.tk, '') AND t.flg = 'Y'
        UNION ALL SELECT * FROM t WHERE tk IS NULL OR tk NOT IN (SELECT tk FROM m)
        UNION ALL SELECT * FROM s WHERE tk IS NULL OR tk NOT IN (SELECT tk FROM m)""",
    "o silver",
    ids=("batch_id",),
)
def _(spark, sf):
    text_key = F.expr(TEXT_KEY.replace("VARCHAR", "STRING"))
    target = silver(spark, sf).withColumns(
        {
            "tk": text_key,
            "flg": F.when(F.col("src_load_ts") < ts("1999-01-01"), "N").otherwise("Y"),
        }
    )
    recent = all_orders(spark, sf).where(F.col("src_load_ts") >= ts("1998-01-01"))
    source = stamped(recent.withColumns({"tk": text_key, "flg": F.lit("Y")}), BATCH, LOAD_TS)
    source = source.withColumns({"c": F.col("c") + 1, "st": F.lit("X")})
    merged = merge_configurable(
        target, source, ["tk"], exclude_from_update=["ST"], update_flag="flg"
    )
    return merged


@query(
    "merge_update_subset",
    f"""SELECT s.k, s.c, b.st, s.src_load_ts, s.batch_id, s.etl_load_ts, {SQL_LOAD_TS} AS etl_updt_ts
        FROM silver s JOIN bronze b ON s.k = b.k
        UNION ALL SELECT s.* FROM silver s WHERE NOT EXISTS (SELECT 1 FROM bronze b WHERE b.k = s.k)
        UNION ALL SELECT b.*, {SQL_STAMPS} FROM bronze b WHERE NOT EXISTS (SELECT 1 FROM silver s WHERE s.k = b.k)""",
    "o silver bronze",
    ids=("batch_id",),
)
def _(spark, sf):
    return merge_update_subset(
        silver(spark, sf), new_rows(spark, sf), ["k"], ["st", "etl_updt_ts"]
    )


@query(
    "delete_insert_by_watermark",
    f"""SELECT * FROM silver WHERE src_load_ts <= TIMESTAMP '1999-01-01'
        UNION ALL SELECT *, {SQL_STAMPS} FROM bronze WHERE src_load_ts > TIMESTAMP '1999-01-01'""",
    "o silver bronze",
    ids=("batch_id",),
)
def _(spark, sf):
    return delete_insert_by_watermark(
        silver(spark, sf), new_rows(spark, sf), "src_load_ts", "1999-01-01"
    )


@query(
    "delete_insert_by_key",
    f""", mark AS (SELECT coalesce(max(src_load_ts), TIMESTAMP '1900-01-01') AS m
                   FROM o WHERE st = 'F' AND src_load_ts < TIMESTAMP '2000-01-01'),
          t AS (SELECT c, k, st, src_load_ts FROM o WHERE st = 'F' AND src_load_ts < TIMESTAMP '2000-01-01'),
          s AS (SELECT c, k, 'X' AS st, src_load_ts FROM o, mark WHERE src_load_ts > m)
        SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.c = t.c) UNION ALL SELECT * FROM s""",
    "o",
)
def _(spark, sf):
    """Orders of a customer are replaced as a whole once newer ones arrive."""
    o = all_orders(spark, sf).select("c", "k", "st", "src_load_ts")
    target = o.where((F.col("st") == "F") & (F.col("src_load_ts") < ts("2000-01-01")))
    source = o.withColumn("st", F.lit("X"))
    return delete_insert_by_key(target, source, ["c"], "src_load_ts", "src_load_ts")


@query(
    "insert_when_absent",
    f"""SELECT * FROM silver UNION ALL
        SELECT b.*, {SQL_STAMPS} FROM bronze b WHERE NOT EXISTS (SELECT 1 FROM silver s WHERE s.k = b.k)""",
    "o silver bronze",
    ids=("batch_id",),
)
def _(spark, sf):
    return insert_when_absent(silver(spark, sf), new_rows(spark, sf), ["k"])


# ------------------------------------------------------------------- journals


def segment_list(spark, sf):
    """One entry per journal segment, created when its last event was seen, plus a snapshot."""
    j = journal(spark, sf)
    day = F.dayofmonth("seen_at")
    number = F.when(day < 11, 1).when(day < 21, 2).otherwise(3)
    names = j.groupBy(number.alias("n")).agg(F.max("seen_at").alias("created"))
    listed = names.select(F.concat(F.lit("EVENTS_"), F.col("n")).alias("table_name"), "created")
    snapshot = j.agg(F.max("seen_at").alias("created")).select(
        F.lit("EVENTS_SNAPSHOT_4").alias("table_name"), "created"
    )
    return listed.unionByName(snapshot)


@query(
    "newest_journal_segments",
    """SELECT upper(src_journal_tbl) AS table_name, max(seen_at) AS created FROM segmented
       GROUP BY 1 ORDER BY created DESC LIMIT 2""",
    "journal segmented",
)
def _(spark, sf):
    return newest_journal_segments(segment_list(spark, sf), "events")


@query(
    "union_journals",
    """SELECT primary_key__pk, event_type, least_significant_position, seen_at, payload__props AS PAYLOAD__PROPS, src_journal_tbl
       FROM segmented WHERE src_journal_tbl IN ('events_2', 'events_3') AND seen_at > TIMESTAMP '2024-01-15'""",
    "journal segmented",
    ids=("primary_key__pk", "least_significant_position"),
)
def _(spark, sf):
    newest = [(name, segment(spark, sf, name)) for name in ("events_2", "events_3")]
    return union_journals(newest, since="2024-01-15").select(
        "primary_key__pk", "event_type", "least_significant_position", "seen_at",
        "PAYLOAD__PROPS", "src_journal_tbl",
    )


PACKED = """CAST(json_merge_patch('{}', json_object('PAYLOAD__PROPS', payload__props,
            'PAYLOAD__USER_ID', payload__user_id)) AS VARCHAR) AS attribute_value_json"""


def bronze_journal(spark, sf):
    """The journal table after an earlier load of the first two segments."""
    return journal_reload(
        empty_journal(spark), [(n, segment(spark, sf, n)) for n in ("events_1", "events_2")],
        load_type="full", batch_id="20250101000000000000000", load_ts="2025-01-01",
    )


def empty_journal(spark):
    return spark.createDataFrame(
        [],
        "primary_key__pk decimal(38,0), event_type string, most_significant_position decimal(38,0), "
        "least_significant_position decimal(38,0), seen_at timestamp_ntz, sf_metadata string, "
        "attribute_value_json string, src_journal_tbl string, src_load_ts timestamp_ntz, "
        "batch_id decimal(38,0), etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz",
    )


JOURNAL_COLUMNS = (
    "primary_key__pk, event_type, most_significant_position, least_significant_position, seen_at, "
    f"sf_metadata, {PACKED}, src_journal_tbl, seen_at AS src_load_ts"
)
JOURNAL_RELOADED = f"""
SELECT {JOURNAL_COLUMNS}, CAST('20250101000000000000000' AS DECIMAL(38,0)) AS batch_id,
       TIMESTAMP '2025-01-01' AS etl_load_ts, TIMESTAMP '2025-01-01' AS etl_updt_ts
FROM segmented WHERE src_journal_tbl IN ('events_1', 'events_2') AND seen_at <= TIMESTAMP '2024-01-15'
UNION ALL
SELECT {JOURNAL_COLUMNS}, {SQL_STAMPS}
FROM segmented WHERE src_journal_tbl IN ('events_2', 'events_3') AND seen_at > TIMESTAMP '2024-01-15'"""
JOURNAL_IDS = (
    "primary_key__pk",
    "most_significant_position",
    "least_significant_position",
    "batch_id",
)


@query("journal_reload", JOURNAL_RELOADED, "journal segmented", ids=JOURNAL_IDS)
def _(spark, sf):
    newest = [(name, segment(spark, sf, name)) for name in ("events_2", "events_3")]
    return journal_reload(bronze_journal(spark, sf), newest, since="2024-01-15", **STAMPS)


def bucketed_merge(spark, sf):
    """Orders in buckets of their key, with the new ones merged: the table after it, in buckets again."""
    name = "orders_" + uuid.uuid4().hex
    buckets = bucket_count(all_orders(spark, sf), 8)
    target = save_bucketed(silver(spark, sf), f"{name}_old", new_folder(spark, "bucketed"), ["k"], buckets)
    merged = merge_upsert(target, new_rows(spark, sf), ["k"], preserve_load_ts=True)
    return save_bucketed(merged, f"{name}_new", new_folder(spark, "bucketed"), ["k"], buckets)


@query("merge_upsert_bucketed", "SELECT * FROM merged", "o silver bronze merged", ids=("batch_id",))
def _(spark, sf):
    return bucketed_merge(spark, sf)


@query(
    "apply_hard_delete_bucketed",
    "SELECT * FROM merged m WHERE EXISTS (SELECT 1 FROM o WHERE o.k = m.k AND o.st <> 'P')",
    "o silver bronze merged",
    ids=("batch_id",),
)
def _(spark, sf):
    """Deletes into the table that the merge left in its buckets."""
    gone = all_orders(spark, sf).where(F.col("st") == "P").select("k")
    return apply_hard_delete(bucketed_merge(spark, sf), gone, ["k"])


CTES["merged_years"] = f"""
SELECT *, CAST(year(src_load_ts) AS INTEGER) AS y FROM silver WHERE year(src_load_ts) <> 1999 UNION ALL
SELECT *, {SQL_STAMPS}, 1999 FROM bronze WHERE year(src_load_ts) = 1999"""


@query("merge_touched_partitions", "SELECT * FROM merged_years", "o silver bronze merged_years", ids=("batch_id",))
def _(spark, sf):
    """A merge into orders by year of order that reads and rewrites the years of the increment only."""
    year = F.year("src_load_ts").alias("y")
    target = save_state(silver(spark, sf).select("*", year), new_folder(spark, "years"), partition_by=["y"])
    path = target.inputFiles()[0].rsplit("/y=", 1)[0]
    source = new_rows(spark, sf).where(F.year("src_load_ts") == 1999).select("*", year)
    merged = merge_upsert(touched_partitions(target, source, "y"), source, ["k"])
    save_partitions(merged, path, ["y"])
    return spark.read.schema(target.schema).parquet(path).select(*target.columns)


@query("apply_new_files", "SELECT * FROM merged", "o silver bronze merged", ids=("batch_id",))
def _(spark, sf):
    """Silver orders as a table that a stream of files of new orders is merged into, a file at a time."""
    first = silver(spark, sf)
    versions = VersionedTable(spark, new_folder(spark, "versions"), first.schema)
    versions.save(first, -1)
    inbox = new_folder(spark, "inbox")
    rows = new_rows(spark, sf)
    rows.repartition(3).write.parquet(inbox)

    def apply(batch, number):
        merged = merge_upsert(versions.state(number), batch, ["k"], preserve_load_ts=True)
        versions.save(merged, number)

    stream = apply_new_files(
        spark, inbox, None, rows.schema, new_folder(spark, "offsets"), apply, "parquet", maxFilesPerTrigger=1
    )
    stream.awaitTermination()
    return versions.state()
