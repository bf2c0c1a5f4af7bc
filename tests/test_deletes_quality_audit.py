"""Deletes, key checks, drift and audit tables on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

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
from millrace.operators.deletes import (
    apply_hard_delete,
    apply_log_delete,
    capture_deleted_keys,
    capture_missing_rows,
    soft_delete,
    soft_delete_by_log,
    surviving_rows,
)
from millrace.operators.quality import (
    check_not_null,
    check_unique,
    column_inventory,
    exclude_bad_keys,
    find_duplicate_keys,
    find_null_keys,
    record_drift,
    record_issues,
    resolve_issues,
    schema_drift,
)
from millrace.sources.files import const_table, table_ref_filter

T1, T2, T3 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
STAMPED = "batch_id decimal(38,0), src_load_ts timestamp_ntz, etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"


# -------------------------------------------------------------------- deletes


def test_capture_and_survivors_cover_the_target(frame, rows):
    target = frame(f"k int, {STAMPED}", (1, 5, T1, T1, T1), (2, 6, T2, T1, T1), (None, 6, T2, T1, T1))
    stage = frame("k int", (1,), (1,), (9,))
    gone = capture_missing_rows(target, stage, ["k"], T3)
    # A NULL key counts as missing, with the newest batch and source time ...
    assert rows(gone, "k", "src_load_ts", "etl_load_ts") == sorted([(2, T2, T3), (None, T2, T3)], key=repr)
    assert {int(r.batch_id) for r in gone.collect()} == {6}
    # ... but no delete can address it.
    left = apply_hard_delete(target, gone, ["k"])
    assert rows(left, "k") == sorted([(1,), (None,)], key=repr)
    assert rows(left) == rows(surviving_rows(target, stage, ["k"]))


def test_hard_delete_by_keys_and_condition(frame, rows):
    target = frame("id int, v int", (1, 1), (2, 2), (3, None))
    deleted = frame("key int, lo int", (1, 0), (2, 5), (2, 1))
    residual = F.col("t.v") > F.col("s.lo")
    assert rows(apply_hard_delete(target, deleted, {"id": "key"}, residual)) == [(3, None)]
    with pytest.raises(TypeError, match="equality keys"):
        apply_hard_delete(target, deleted, F.col("t.v") > F.col("s.lo"))
    with pytest.raises(ValueError, match="equality key"):
        apply_hard_delete(target, deleted, [], residual)


LOG = (
    "model_id string, model_grp string, pipeline_name string, pk int, src_load_ts timestamp_ntz, "
    "batch_id decimal(38,0), etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"
)


def test_deletion_log(frame, rows):
    log = frame(LOG, ("db.t_t", "old", "old", 1, T1, 1, T1, T1), ("other", "g", "p", 2, T1, 1, T1, T1))
    journal = frame(
        "primary_key__pk int, event_type string, seen_at timestamp_ntz, least_significant_position int",
        (1, "IncrementalDeleteRows", T2, 1),
        (2, "IncrementalDeleteRows", T2, 1),
        (2, "IncrementalDeleteRows", T2, 2),
        (3, "IncrementalInsertRows", T2, 1),
    )
    new = capture_deleted_keys(
        log, journal, model_id="db.t_t", model_grp="g", pipeline_name="p", batch_id=2, load_ts=T3
    )
    got = {(r.model_id, r.pk): (r.model_grp, r.src_load_ts, int(r.batch_id), r.etl_load_ts, r.etl_updt_ts) for r in new.collect()}
    assert got == {
        ("db.t_t", 1): ("g", T1, 1, T1, T3),  # logged before: keeps time and batch
        ("db.t_t", 2): ("g", T2, 2, T3, T3),
        ("other", 2): ("g", T1, 1, T1, T1),
    }
    target = frame("pk int", (1,), (2,), (3,), (None,))
    assert rows(apply_log_delete(target, new, "db.t_t")) == sorted([(3,), (None,)], key=repr)
    assert apply_log_delete(target, new, "DB.T_V").count() == 4
    assert apply_log_delete(target, new, "DB.T_V", ignore_case=True).count() == 2


def test_soft_delete_closes_active_rows_only(frame, rows):
    dim = frame(
        "sk int, active_flg string, end_ts timestamp_ntz, etl_updt_ts timestamp_ntz",
        (1, "Y", None, T2), (1, "N", T1, T2), (2, "Y", None, T2), (None, "Y", None, T2), (1, None, None, T2),
    )
    expected = sorted(
        [(1, "N", T2, T2), (1, "N", T1, T2), (2, "Y", None, T2), (None, "Y", None, T2), (1, None, None, T2)], key=repr
    )
    deleted = frame("id int", (1,), (1,), (None,))
    assert rows(soft_delete(dim, deleted, {"sk": "id"})) == expected
    assert rows(soft_delete(dim, deleted, {"sk": "id"}, F.col("s.id") > 0)) == expected
    assert rows(soft_delete(dim, deleted, {"sk": "id"}, F.col("s.id") > 1)) == rows(dim)
    log = frame(LOG, ("Db.T_T", "g", "p", 1, T1, 1, T1, T1))
    assert rows(soft_delete_by_log(dim, log, "db.t_v", "sk")) == expected


# -------------------------------------------------------------------- quality

NAMES = {"model_id": "m", "model_grp": "g"}
STAMPS = {"batch_id": 2, "load_ts": T3}


def test_duplicate_grain(frame, rows):
    src = frame(
        "b int, a string, v string, src_load_ts timestamp_ntz",
        (1, "x", "p", T1), (1, "x", "q", T2), (2, "x", "p", T1), (2, "x", "p", T1), (3, "x", "p", T1),
    )
    by_key = find_duplicate_keys(src, ["b", "a"], "v", **NAMES, **STAMPS)
    assert rows(by_key, "key_column", "json_value", "src_load_ts", "success_flg") == [
        ('{"a":"x","b":1}', "q", T2, "N"),
        ('{"a":"x","b":2}', "p", T1, "N"),
    ]
    # The reference's own grain misses key 1, whose copies differ.
    by_row = find_duplicate_keys(src, ["b", "a"], "v", "row", **NAMES, **STAMPS)
    assert rows(by_row, "key_column") == [('{"a":"x","b":2}',)]
    with pytest.raises(ValueError):
        find_duplicate_keys(src, ["a"], grain="table", **NAMES, **STAMPS)


def test_null_keys_leave_the_key_object(frame, rows):
    src = frame("a string, b int, src_load_ts timestamp_ntz", ("x", None, T1), ("x", None, T2), (None, None, T1), ("y", 1, T1))
    issues = find_null_keys(src, ["a", "b"], **NAMES, **STAMPS)
    got = {r.key_column: (int(r.issue_record_count), r.json_value) for r in issues.collect()}
    assert got == {'{"a":"x"}': (2, "{}"), "{}": (1, "{}")}


def test_exclude_bad_keys(frame, rows):
    src = frame(
        "a string, b int, ts timestamp_ntz",
        ("x", 1, T1), ("x", 1, T2), ("y", 1, T1), ("z", None, T1), ("", 2, T1), (None, 2, T1), ("w", 3, None),
    )
    assert rows(exclude_bad_keys(src, ["a", "b"], "ts"), "a") == [("",), ("y",)]
    # A blank key with a NULL twin goes too, as under coalesce(key, '').
    assert rows(exclude_bad_keys(src, ["a", "b"], "ts", blank_is_null=True), "a") == [("y",)]


def test_starter_models(spark, rows):
    first = const_table(spark, [(1,), (None,)], "id int")
    assert rows(table_ref_filter(first)) == [(1,)]
    assert check_unique(first, "id").count() == 0
    assert check_not_null(first, "id").count() == 1
    assert check_not_null(table_ref_filter(first), "id").count() == 0


def test_issue_lifecycle(frame, rows):
    src = frame("k int, src_load_ts timestamp_ntz", (1, T1), (1, T1), (None, T1))
    first = find_duplicate_keys(src, ["k"], **NAMES, batch_id=1, load_ts=T1)
    check = record_issues(first.limit(0), first.unionByName(find_null_keys(src, ["k"], **NAMES, batch_id=1, load_ts=T1)))
    assert check.count() == 2
    again = record_issues(check, find_duplicate_keys(src, ["k"], **NAMES, **STAMPS))
    got = {r.key_column: (int(r.batch_id), r.etl_load_ts, r.etl_updt_ts) for r in again.collect()}
    assert got == {'{"k":1}': (2, T1, T3), "{}": (1, T1, T1)}
    target = frame("k int", (1,))
    # Issues of the current batch stay open.
    assert rows(resolve_issues(again, target, ["k"], 2, **NAMES), "success_flg") == [("N",), ("N",)]
    later = resolve_issues(again, target, ["k"], 3, **NAMES)
    assert {r.key_column: r.success_flg for r in later.collect()} == {'{"k":1}': "Y", "{}": "N"}
    other = resolve_issues(again, target, ["k"], 3, model_id="m", model_grp="else")
    assert rows(other, "success_flg") == [("N",), ("N",)]


@pytest.mark.parametrize("kind", ["int", "string", "decimal(9,2)", "double", "timestamp_ntz"])
def test_resolve_issues_by_typed_keys(spark, rows, kind):
    values = "(2, 'x'), (NULL, 'y'), (3, NULL), (5, 'é\"')"
    target = spark.sql(f"SELECT CAST(a AS {'timestamp' if 'time' in kind else kind}) AS a, b FROM VALUES {values} AS t(a, b)")
    target = target.withColumn("a", F.col("a").cast(kind))
    src = target.unionByName(target).withColumn("src_load_ts", F.lit(T1).cast("timestamp_ntz"))
    found = find_duplicate_keys(src, ["b", "a"], **NAMES, batch_id=1, load_ts=T1)
    foreign = found.limit(1).withColumn("key_column", F.lit('{"other":1}'))
    some = target.where("b IS NULL OR b <> 'x'")
    done = resolve_issues(found.unionByName(foreign), some, ["b", "a"], 2, **NAMES)
    got = {r.key_column: r.success_flg for r in done.collect()}
    assert sorted(got.values()) == ["N", "N", "Y", "Y", "Y"]
    assert got['{"other":1}'] == "N" and next(v for k, v in got.items() if '"x"' in k) == "N"


def test_schema_drift(spark, frame, rows):
    src = column_inventory(spark, {"m": frame("A int, b string, batch_id int, only_src int")})
    tgt = column_inventory(spark, {"m": frame("a long, B string, only_tgt int, etl_load_ts timestamp")})
    drift = schema_drift(src, tgt)
    assert rows(drift) == [
        ("m", "a", "int", "bigint", "TYPE_MISMATCH"),
        ("m", "only_src", "int", None, "MISSING_IN_TARGET"),
        ("m", "only_tgt", None, "int", "MISSING_IN_SOURCE"),
    ]


def test_record_drift_scope(frame, rows):
    schema = "model_id string, model_grp string, pipeline_name string, batch_id int, column_name string"
    audit = frame(schema, ("m", "g", "p", 1, "old"), ("m", "g", "p", 2, "stale"), ("n", "g", "p", 2, "gone"))
    drift = frame(schema, ("m", "g", "p", 2, "new"))
    assert rows(record_drift(audit, drift), "column_name") == [("gone",), ("new",), ("old",)]
    scope = frame(schema.rsplit(",", 1)[0], ("m", "g", "p", 2), ("n", "g", "p", 2))
    assert rows(record_drift(audit, drift, scope=scope), "column_name") == [("new",), ("old",)]


# ---------------------------------------------------------------------- audit

BATCHES = "pipeline_name string, batch_id decimal(38,0), batch_status string, start_ts timestamp_ntz, end_ts timestamp_ntz"


def test_batches_open_and_close(frame, rows):
    audit = frame(BATCHES, ("a", 1, "completed", T1, T1), ("b", 1, "running", T1, None))
    pipes = frame("pipeline_name string", ("a",), ("b",), ("c",), ("c",))
    opened = open_batches(audit, pipes, T2)
    got = {(r.pipeline_name, int(r.batch_id)): r.batch_status for r in opened.collect()}
    new = 20240102000000000000000
    assert got == {("a", 1): "completed", ("a", new): "running", ("b", 1): "running", ("c", new): "running"}
    assert rows(open_batches(opened, pipes, T2)) == rows(opened)
    current = {r.pipeline_name: int(r.batch_id) for r in current_batch(audit, pipes).collect()}
    assert current == {"a": 0, "b": 1, "c": 0}
    closed = close_batches(opened, frame("pipeline_name string", ("b",), ("c",)), T3)
    got = {(r.pipeline_name, int(r.batch_id)): (r.batch_status, r.end_ts) for r in closed.collect()}
    assert got == {
        ("a", 1): ("completed", T1), ("a", new): ("running", None),
        ("b", 1): ("completed", T3), ("c", new): ("completed", T3),
    }


def test_open_batch_of_same_id_is_reopened(frame):
    audit = frame(BATCHES, ("a", 20240102000000000000000, "completed", T1, T1))
    opened = open_batches(audit, frame("pipeline_name string", ("a",)), T2)
    assert [(r.batch_status, r.end_ts) for r in opened.collect()] == [("completed", None)]


AUDIT = (
    "model_id string, model_grp string, inc_load_ts timestamp_ntz, pipeline_name string, batch_id decimal(38,0), "
    "model_load_status string, rows_inserted long, rows_updated long, start_ts timestamp_ntz, end_ts timestamp_ntz"
)
MODELS = "model_id string, model_grp string, pipeline_name string"


@pytest.fixture
def audit(frame):
    return frame(
        AUDIT,
        ("a", "g", T1, "p", 1, "completed", 5, 6, T1, T1),
        ("a", "g", T2, "p", 2, "completed", 7, 8, T2, T2),
        ("a", "g", T3, "other", 9, "completed", 0, 0, T3, T3),
        ("b", "g", T1, "p", 3, "running", 1, 1, T2, None),
    )


@pytest.fixture
def models(frame):
    return frame(MODELS, ("a", "g", "p"), ("b", "g", "p"), ("c", "g", "p"))


def of_batch(df, batch):
    return {
        r.model_id: (r.inc_load_ts, r.model_load_status, r.rows_inserted, r.start_ts, r.end_ts)
        for r in df.where((F.col("batch_id") == batch) & (F.col("pipeline_name") == "p")).collect()
    }


def test_init_carries_watermarks_within_the_pipeline(audit, models):
    seeded = init_model_audit(audit, models, 3)
    assert of_batch(seeded, 3) == {
        "a": (T2, "yet to start", None, None, None),  # not T3 of the other pipeline
        "b": (T1, "yet to start", 1, None, None),  # existing and unfinished: reset
        "c": (None, "yet to start", None, None, None),
    }
    assert seeded.count() == audit.count() + 2
    again = init_model_audit(seeded, models, 3)
    assert of_batch(again, 3) == of_batch(seeded, 3) and again.count() == seeded.count()


def test_init_single_model_starts_it(audit, models):
    started = init_model_audit(audit, models.where("model_id != 'c'"), 2, status="running", now=T3)
    assert of_batch(started, 2) == {
        "a": (T2, "completed", 7, T3, None),  # finished status stays, times restart
        "b": (T1, "running", None, T3, None),
    }


def test_start_finish_and_state(audit, models, frame):
    started = start_models(init_model_audit(audit, models, 3), models, 3, T3)
    assert of_batch(started, 3)["b"] == (T1, "running", None, T3, None)
    metrics = frame(
        f"{MODELS}, batch_id decimal(38,0), src_load_ts timestamp_ntz, rows_inserted long, rows_updated long",
        ("a", "g", "p", 3, T3, 2, 1),
        ("b", "g", "p", 3, None, None, None),
    )
    finished = finish_models(started, metrics, T3)
    assert of_batch(finished, 3) == {
        "a": (T3, "completed", 2, T3, T3),
        "b": (T1, "completed", None, T3, T3),  # no rows: the watermark stays
        "c": (None, "running", None, T3, None),
    }
    assert of_batch(finish_models(started, metrics, T3, full_load=True), 3)["a"][0] is None
    assert [r.model_id for r in pending_models(models, finished, 3).collect()] == ["c"]
    state = {r.model_id: tuple(r)[3:] for r in model_state(finished, models, 3).collect()}
    assert state["c"][0] == dt.datetime(1900, 1, 1) and state["c"][2:] == ("running", 0, 0)
    unknown = model_state(finished, models, 77).first()
    assert (int(unknown.batch_id), unknown.model_load_status, unknown.rows_inserted) == (1900010101, "none", 0)


def test_load_metrics_tell_updates_apart(frame):
    target = frame(f"k int, {STAMPED}", (1, 5, T1, T1, T1), (2, 5, T2, T1, T2), (3, 6, T3, T3, T3))
    got = {int(r.batch_id): (r.src_load_ts, r.rows_inserted, r.rows_updated) for r in load_metrics(target).collect()}
    assert got == {5: (T2, 1, 1), 6: (T3, 1, 0)}
    assert load_metrics(target, 5).count() == 1
