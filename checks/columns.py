"""Projections and filters."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import (
    SQL_STAMPS,
    STAMPS,
    all_orders,
    dimension,
    journal,
    query,
    silver,
    table,
    ts,
)
from millrace.functions.columns import (
    align_to_target,
    batch_id_from_ts,
    conform_layout,
    hash_key,
    pack_attributes,
    pack_variant,
    rename_by_mapping,
    stamp_audit,
    strip_bookkeeping,
    unpack_attributes,
    unpack_variant,
    variant_schema,
)
from millrace.session import stage
from millrace.operators.filters import (
    active_rows,
    delete_events,
    filter_above_target_watermark,
    incremental_filter,
    key_present,
    name_filter,
)


@query(
    "stamp_audit",
    f"SELECT k, c, st, src_load_ts, {SQL_STAMPS} FROM o",
    "o",
    ids=("batch_id",),
)
def _(spark, sf):
    o = all_orders(spark, sf)
    return stamp_audit(o, **STAMPS, src_load_ts=F.col("src_load_ts"))


@query("strip_bookkeeping", "SELECT k, c, st, src_load_ts FROM o", "o")
def _(spark, sf):
    return strip_bookkeeping(stamp_audit(all_orders(spark, sf), **STAMPS))


@query("align_to_target", "SELECT k, c, st, src_load_ts FROM o", "o")
def _(spark, sf):
    shuffled = all_orders(spark, sf).selectExpr("st AS ST", "src_load_ts", "c AS C", "k")
    return align_to_target(shuffled, silver(spark, sf).columns)


@query(
    "rename_by_mapping",
    "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer",
)
def _(spark, sf):
    mapping = {"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment"}
    return rename_by_mapping(table(spark, sf, "customer"), mapping)


@query(
    "conform_layout",
    """SELECT c_custkey AS pk, c_nationkey AS nation_id, c_mktsegment AS is_segment, c_name AS name,
       c_acctbal AS balance_metric, TIMESTAMP '2020-01-01' AS open_date, o.* FROM customer,
       (SELECT CAST('20260101000000000000000' AS VARCHAR) AS batch_id) o""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").select(
        F.lit("20260101000000000000000").alias("batch_id"),
        ts("2020-01-01").alias("open_date"),
        F.col("c_acctbal").alias("balance_metric"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("is_segment"),
        F.col("c_nationkey").alias("nation_id"),
        F.col("c_custkey").alias("pk"),
    )
    return conform_layout(c)


@query(
    "pack_attributes",
    """SELECT event_id, ts, CAST(json_merge_patch('{}', json_object('event_type', event_type,
       'props', props, 'user_id', nullif(user_id, 1), 'value', CAST(floor(value * 100) AS BIGINT))) AS VARCHAR)
       AS attribute_value_json FROM events""",
)
def _(spark, sf):
    """All columns; the value in hundredths, as the engines write doubles differently."""
    e = table(spark, sf, "events").withColumns(
        {
            "user_id": F.nullif(F.col("user_id"), F.lit(1)),
            "value": F.floor(F.col("value") * 100).cast("long"),
        }
    )
    return pack_attributes(e, ["event_id", "ts"])


@query(
    "unpack_attributes",
    """SELECT props, nullif(user_id, 1) AS user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       event_id, ts FROM events""",
)
def _(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id",
        "ts",
        F.col("props").alias("PAYLOAD__PROPS"),
        F.nullif(F.col("user_id"), F.lit(1)).alias("PAYLOAD__USER_ID"),
        F.get_json_object("props", "$.k").cast("int").alias("PAYLOAD__K"),
    )
    packed = pack_attributes(e, ["event_id", "ts"])
    schema = T.StructType().add("props", "string").add("user_id", "long").add("k", "integer")
    return unpack_attributes(packed, schema)


def nested_events(spark, sf):
    """Events with a struct, an array, a decimal, a time and parsed JSON among their attributes."""
    e = table(spark, sf, "events")
    return e.select(
        "event_id",
        F.struct(F.col("user_id").alias("id"), F.array("event_type", F.upper("event_type")).alias("names")).alias("who"),
        F.col("ts").alias("at"),
        F.col("value").cast("decimal(20,4)").alias("amount"),
        F.nullif(F.col("user_id"), F.lit(1)).alias("maybe"),
        F.parse_json("props").alias("props"),
    )


@query(
    "variant_round_trip",
    """SELECT event_id, user_id AS id, event_type || ',' || upper(event_type) AS names, upper(event_type) AS second, ts AS at,
              CAST(CAST(value AS DECIMAL(20,4)) AS VARCHAR) AS amount, nullif(user_id, 1) AS maybe,
              CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS INTEGER) AS unfit FROM events""",
)
def _(spark, sf):
    """Nested and typed attributes packed, written, read and unpacked again."""
    packed = stage(pack_variant(nested_events(spark, sf), ["event_id"]), "packed")
    schema = T.StructType.fromDDL(
        "who struct<id:bigint,names:array<string>>, second string, at timestamp_ntz, amount decimal(20,4), maybe bigint, k int, unfit int"
    )
    paths = {"second": "$.who.names[1]", "k": "$.props.k", "unfit": "$.who.names"}
    got = unpack_variant(packed, schema, paths=paths)
    return got.withColumns({"id": F.col("who.id"), "names": F.array_join("who.names", ","), "amount": F.col("amount").cast("string")}).drop("who")


@query(
    "variant_schema",
    """SELECT 'OBJECT<amount: DECIMAL, at: TIMESTAMP_NTZ, maybe: BIGINT, props: OBJECT<k: BIGINT>, who: OBJECT<id: BIGINT, names: ARRAY<STRING>>>'
       AS schema""",
)
def _(spark, sf):
    """What the packed attributes of all events are."""
    found = variant_schema(pack_variant(nested_events(spark, sf), ["event_id"]))
    return found.select(F.regexp_replace("schema", r"DECIMAL\(\d+,\d+\)", "DECIMAL").alias("schema"))


@query(
    "hash_key",
    """WITH p AS (SELECT p_partkey, nullif(p_brand, 'Brand#4') AS a,
                         CASE WHEN p_type = 'SMALL' THEN '  ' ELSE p_type END AS b, p_size AS n FROM part),
            t AS (SELECT p_partkey,
                         CASE WHEN a IS NULL OR trim(a) = '' THEN '^^' ELSE upper(trim(a)) END AS a,
                         CASE WHEN trim(b) = '' THEN '^^' ELSE upper(trim(b)) END AS b,
                         CAST(n AS VARCHAR) AS n FROM p)
       SELECT p_partkey,
              CASE WHEN a = '^^' AND b = '^^' THEN NULL ELSE sha256(a || '||' || b) END AS h2,
              sha256(a || '||' || b || '||' || n) AS h3,
              CASE WHEN a = '^^' THEN NULL ELSE sha256(a) END AS h1_blank_null FROM t""",
)
def _(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey",
        F.nullif(F.col("p_brand"), F.lit("Brand#4")).alias("a"),
        F.when(F.col("p_type") == "SMALL", "  ").otherwise(F.col("p_type")).alias("b"),
        F.col("p_size").alias("n"),
    )
    return p.select(
        "p_partkey",
        hash_key(["a", "b"]).alias("h2"),
        hash_key(["a", "b", "n"]).alias("h3"),
        hash_key(["a"], null_if_all_blank=True).alias("h1_blank_null"),
    )


@query(
    "batch_id_from_ts",
    "SELECT event_id, CAST(strftime(ts, '%Y%m%d%H%M%S%f') || '000' AS DECIMAL(38,0)) AS batch_id FROM events",
    ids=("batch_id",),
)
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", batch_id_from_ts("ts").alias("batch_id"))


@query("incremental_filter", "SELECT * FROM o WHERE src_load_ts > TIMESTAMP '1999-01-01'", "o")
def _(spark, sf):
    return incremental_filter(all_orders(spark, sf), "src_load_ts", "1999-01-01")


@query(
    "filter_above_target_watermark",
    """SELECT * FROM o WHERE src_load_ts >
       (SELECT coalesce(max(src_load_ts), TIMESTAMP '1900-01-01') FROM silver)""",
    "o silver",
)
def _(spark, sf):
    return filter_above_target_watermark(
        all_orders(spark, sf), silver(spark, sf), "src_load_ts", "src_load_ts"
    )


@query("active_rows", "SELECT * FROM dim WHERE active_flg = 'Y'", "dim", ids=("sk", "seq"))
def _(spark, sf):
    return active_rows(dimension(spark, sf))


@query(
    "delete_events",
    """SELECT primary_key__pk, event_type, least_significant_position, seen_at FROM journal
       WHERE event_type = 'IncrementalDeleteRows'""",
    "journal",
    ids=("primary_key__pk", "least_significant_position"),
)
def _(spark, sf):
    columns = ["primary_key__pk", "event_type", "least_significant_position", "seen_at"]
    return delete_events(journal(spark, sf)).select(*columns)


@query(
    "key_present",
    "SELECT k, nullif(c, 7) AS c, st FROM o WHERE nullif(c, 7) IS NOT NULL",
    "o",
)
def _(spark, sf):
    o = all_orders(spark, sf).withColumn("c", F.nullif(F.col("c"), F.lit(7)))
    return key_present(o, ["k", "c"]).select("k", "c", "st")


@query(
    "name_filter",
    """SELECT p_partkey, p_name FROM part
       WHERE upper(p_name) LIKE '%RING%' AND upper(p_name) NOT LIKE '%SMALL%'""",
)
def _(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    return name_filter(parts, "p_name", contains="ring", lacks="small")


