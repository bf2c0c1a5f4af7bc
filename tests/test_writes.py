"""Keyed writes: NULL keys, blanks, duplicates, re-runs."""

import datetime as dt
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

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
from millrace.session import stage

T1, T2, T3 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))


def test_upsert_null_keys_never_match(frame, rows):
    target = frame("k int, v string", (1, "a"), (None, "b"))
    source = frame("k int, v string", (1, "x"), (None, "y"), (2, "z"))
    merged = merge_upsert(target, source, ["k"])
    assert rows(merged) == sorted([(1, "x"), (None, "b"), (None, "y"), (2, "z")], key=repr)


def test_upsert_is_idempotent_and_complete(frame, rows):
    target = frame("k int, v string", (1, "a"), (2, "b"), (3, "c"))
    source = frame("k int, v string", (2, "x"), (4, "y"))
    once = merge_upsert(target, source, ["k"])
    assert rows(once) == rows(merge_upsert(once, source, ["k"]))
    assert once.count() == 4


def test_upsert_updates_every_copy_in_the_target(frame, rows):
    target = frame("k int, v string", (1, "a"), (1, "b"))
    assert rows(merge_upsert(target, frame("k int, v string", (1, "x")), ["k"])) == [(1, "x")] * 2


def test_upsert_two_matches_fail_in_the_plan(frame):
    target = frame("k int, v string", (1, "a"))
    source = frame("k int, v string", (1, "x"), (1, "y"))
    with pytest.raises(PySparkException, match="several source rows"):
        merge_upsert(target, source, ["k"]).collect()


def test_upsert_inserts_unmatched_copies(frame, rows):
    target = frame("k int, v string", (1, "a"))
    source = frame("k int, v string", (2, "x"), (2, "x"), (2, "y"))
    assert rows(merge_upsert(target, source, ["k"])) == [(1, "a"), (2, "x"), (2, "x"), (2, "y")]


def test_upsert_casts_and_fills_missing_columns(frame, rows):
    target = frame("k long, v string, extra int", (1, "a", 7))
    merged = merge_upsert(target, frame("v string, k int", ("x", 1), ("y", 2)), ["k"])
    assert merged.dtypes == target.dtypes
    assert rows(merged) == [(1, "x", 7), (2, "y", None)]


def test_upsert_can_keep_load_time(frame, rows):
    target = frame("k int, etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz", (1, T1, T1))
    source = frame("k int, etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz", (1, T2, T2), (2, T2, T2))
    assert rows(merge_upsert(target, source, ["k"])) == [(1, T2, T2), (2, T2, T2)]
    assert rows(merge_upsert(target, source, ["k"], preserve_load_ts=True)) == [(1, T1, T2), (2, T2, T2)]


def test_upsert_composite_key_and_column_lists(frame, rows):
    target = frame("a int, b string, v int, w int", (1, "x", 0, 0), (1, "y", 0, 0))
    source = frame("a int, b string, v int, w int", (1, "x", 5, 5), (2, "x", 6, 6))
    merged = merge_upsert(target, source, ["a", "b"], update_cols=["v"], insert_cols=["a", "b", "w"])
    assert rows(merged) == [(1, "x", 5, 0), (1, "y", 0, 0), (2, "x", None, 6)]


def test_configurable_blank_keys_do_not_match(frame, rows):
    target = frame("k string, v int", ("", 1), (None, 2), ("a", 3))
    source = frame("k string, v int", ("", 10), (None, 20), ("a", 30))
    merged = merge_configurable(target, source, ["k"])
    assert rows(merged) == sorted(
        [("", 1), (None, 2), ("a", 30), ("", 10), (None, 20)], key=repr
    )


def test_configurable_flag_inserts_beside_closed_row(frame, rows):
    target = frame("k int, v int, flg string", (1, 1, "N"), (2, 2, "Y"), (3, 3, None))
    source = frame("k int, v int, flg string", (1, 10, "Y"), (2, 20, "Y"), (3, 30, "Y"))
    merged = merge_configurable(target, source, ["k"], update_flag="flg")
    assert rows(merged) == sorted(
        [(1, 1, "N"), (1, 10, "Y"), (2, 20, "Y"), (3, 3, None), (3, 30, "Y")], key=repr
    )


def test_configurable_excluded_columns_and_conditions(frame, rows):
    target = frame("k int, v int, w int", (1, 1, 1), (2, 2, 2))
    source = frame("k int, v int, w int", (1, 10, 10), (2, 20, 20))
    merged = merge_configurable(target, source, ["k"], exclude_from_update=["W"], extra_on=F.col("v") > 1)
    assert rows(merged) == [(1, 1, 1), (1, 10, 10), (2, 20, 2)]
    merged = merge_configurable(target, source, ["k"], source_on=F.col("v") > 10)
    assert rows(merged) == [(1, 1, 1), (1, 10, 10), (2, 20, 20)]


def test_configurable_without_keys_appends(frame, rows):
    target = frame("k int", (1,))
    assert rows(merge_configurable(target, frame("k int", (1,)))) == [(1,), (1,)]


def test_update_subset_with_expressions(frame, rows):
    target = frame("k int, v int, w int", (1, 1, 1))
    source = frame("k int, v int, w int", (1, 10, 10), (2, 20, 20))
    assert rows(merge_update_subset(target, source, ["k"], ["w"])) == [(1, 1, 10), (2, 20, 20)]
    added = merge_update_subset(target, source, ["k"], {"v": F.col("t.v") + F.col("s.v")})
    assert rows(added) == [(1, 11, 1), (2, 20, 20)]


def test_insert_when_absent(frame, rows):
    target = frame("k int, v int", (1, 1), (None, 2))
    source = frame("k int, v int", (1, 10), (2, 20), (None, 30))
    merged = insert_when_absent(target, source, ["k"])
    assert rows(merged) == sorted([(1, 1), (None, 2), (2, 20), (None, 30)], key=repr)


def test_delete_insert_by_watermark_keeps_undated_rows(frame, rows):
    target = frame("k int, ts timestamp_ntz", (1, T1), (2, T3), (3, None))
    source = frame("k int, ts timestamp_ntz", (4, T1), (5, T3), (6, None))
    once = delete_insert_by_watermark(target, source, "ts", T2)
    assert rows(once, "k") == [(1,), (3,), (5,)]
    assert rows(once) == rows(delete_insert_by_watermark(once, source, "ts", T2))


def test_delete_insert_by_key_takes_watermark_before_delete(frame, rows):
    # Key 1 holds the newest target row. Taking the maximum again after the
    # delete would let the older source row of key 2 in.
    target = frame("k int, v string, ts timestamp_ntz", (1, "old", T2), (2, "old", T1))
    source = frame("k int, v string, ts timestamp_ntz", (1, "new", T3), (1, "newer", T3), (2, "late", T2))
    merged = delete_insert_by_key(target, source, ["k"], "ts", "ts")
    assert rows(merged, "k", "v") == [(1, "new"), (1, "newer"), (2, "old")]


def test_delete_insert_by_key_into_empty_target(frame, rows):
    target = frame("k int, ts timestamp_ntz")
    assert rows(delete_insert_by_key(target, frame("k int, ts timestamp_ntz", (1, T1)), ["k"], "ts", "ts")) == [(1, T1)]


def test_full_replace_append_and_empty(frame, rows):
    target = frame(
        "k int, batch_id decimal(38,0), etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz", (1, 5, T1, T1)
    )
    replaced = full_replace(frame("K int", (2,)), target.schema, batch_id=6, load_ts=T2)
    assert rows(replaced, "k", "etl_load_ts") == [(2, T2)]
    assert replaced.dtypes == target.dtypes
    assert empty_like(target).dtypes == target.dtypes and empty_like(target).count() == 0
    assert append_load(target, replaced).count() == 2
    with pytest.raises(ValueError):
        full_replace(frame("other int", (2,)), target.schema, batch_id=6, load_ts=T2)


ENVELOPE = (
    "primary_key__pk int, event_type string, most_significant_position int, "
    "least_significant_position int, seen_at timestamp_ntz, sf_metadata string"
)


def test_newest_segments(frame, rows):
    segments = frame(
        "table_name string, created timestamp_ntz",
        ("ORDERS_1", T1),
        ("ORDERS_2", T2),
        ("orders_3", T3),
        ("ORDERS_SNAPSHOT_4", T3),
        ("CUST_ORDERS_9", T3),
    )
    assert rows(newest_journal_segments(segments, "orders"), "table_name") == [("ORDERS_2",), ("orders_3",)]
    assert rows(newest_journal_segments(segments, "orders", 1, exact_name=False), "table_name") == [("orders_3",)]


def test_journal_segments_with_different_columns(frame, rows):
    a = frame(f"{ENVELOPE}, PAYLOAD__A int", (1, "x", 0, 1, T2, "{}", 5), (None, "x", 0, 2, T3, "{}", 6))
    b = frame(f"{ENVELOPE}, PAYLOAD__B string", (2, "x", 0, 3, T3, "{}", "v"), (3, "x", 0, 4, T1, "{}", "v"))
    union = union_journals([("s1", a), ("s2", b)], since=T1)
    assert rows(union, "primary_key__pk", "src_journal_tbl") == [(1, "s1"), (2, "s2")]
    target = journal_reload(
        frame(
            f"{ENVELOPE}, attribute_value_json string, src_journal_tbl string, src_load_ts timestamp_ntz, "
            "batch_id decimal(38,0), etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"
        ),
        [("s1", a)],
        load_type="full",
        batch_id=1,
        load_ts=T1,
    )
    again = journal_reload(target, [("s1", a), ("s2", b)], since=T1, batch_id=2, load_ts=T2)
    assert rows(again, "primary_key__pk", "attribute_value_json", "src_load_ts") == [
        (1, '{"PAYLOAD__A":5}', T2),
        (2, '{"PAYLOAD__B":"v"}', T3),
    ]


def test_staged_frames_leave_no_shuffle_files(spark):
    def files():
        found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in found.split("\n") if "/shuffle_" in f}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    unset = spark.conf.get(key)
    before = files()
    frame = spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count()
    staged = stage(frame, "counted")
    until = time.time() + 5  # removed beside the driver's work
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before
    assert staged.count() == frame.count() == stage(frame, "again").count() == 100
    assert spark.conf.get(key) == unset
