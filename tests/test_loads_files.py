"""File sources, streaming ingestion, sinks and whole loads."""

import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from millrace.operators.audit import WrittenMetrics, load_metrics
from millrace.operators.deletes import capture_missing_rows, captured_outcomes, surviving_rows
from millrace.operators.journal import read_segments
from millrace.operators.merge import OUTCOME, merge_outcomes, merge_upsert
from millrace.plans.loads import (
    bronze_to_silver,
    file_to_bronze,
    journal_to_bronze,
    prevalidated_to_silver,
    stage_to_bronze,
    staged_cdc_to_silver,
)
from millrace.session import new_folder, shared_dir, stage
from millrace.sources.files import (
    infer_file_schema,
    load_files_by_name,
    load_files_replace,
    load_files_with_mapping,
)
from millrace.sources.inference import clashing_files, csv_schema, file_columns, merged_columns
from millrace.sources.sinks import save_partitions, save_state, touched_partitions
from millrace.streaming.ingest import apply_new_files, ingest_new_files
from millrace.streaming.ledger import OnceTable, consume_files
from millrace.streaming.versions import VersionedTable, stream_deletion_log

T1, T2, T3, T4 = (dt.datetime(2024, 1, d) for d in (1, 2, 3, 4))
STAMPS = {"batch_id": 2, "load_ts": T4}
STAGE = (
    T.StructType().add("id", "integer").add("name", "string").add("amount", "double").add("note", "string")
)


@pytest.fixture
def write(tmp_path):
    def build(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
        return str(path.parent if "/" in name else path)

    return build


def test_infer(spark, write):
    path = write("a.csv", "id,Name,d\n1,x,2.5\n2,y,3.5\n")
    assert infer_file_schema(spark, path).dtypes == [("id", "int"), ("Name", "string"), ("d", "double")]
    explicit = T.StructType.fromDDL("id long, Name string, d string")
    assert infer_file_schema(spark, path, schema=explicit).dtypes[0] == ("id", "bigint")


def test_columns_of_files_in_one_aggregate(spark, write, rows, tmp_path):
    write("in/a.csv", "id,at,day,ok,x,t\n1,2024-01-01 10:00:00,2024-01-01,true,1,\n-2147483649,2024-01-02,2024-01-31,FALSE,2.5e3,\n")
    write("in/b.csv", "id,at,day,ok,x,t\n+7,,,,nan,\n")
    write("in/c.csv", "id,at,day,ok,x,t\n")  # a header alone
    write("in/d.csv", "id,day,at\n9,2024-01-01,z\n")
    write("in/e.csv", "")
    columns = file_columns(spark, str(tmp_path / "in"))
    assert rows(merged_columns(columns), "position", "name", "type", "files", "rows") == [
        (0, "id", "bigint", 3, 3), (1, "at", "timestamp", 3, 3), (2, "day", "date", 3, 3),
        (3, "ok", "boolean", 3, 3), (4, "x", "string", 3, 3), (5, "t", "string", 3, 3),
    ]
    assert [r["columns"] for r in clashing_files(columns).collect()] == [["id", "day", "at"]]
    assert columns.where("file LIKE '%c.csv'").agg({"rows": "max", "filled": "max"}).first()[:] == (0, 0)
    no_header = csv_schema(spark, write("n/a.csv", "1,2.5\n3,x\n"), header=False)
    assert no_header.simpleString() == "struct<_c0:int,_c1:string>"
    odd = csv_schema(spark, write("o/a.csv", "1,b\n2,\"q,\"\"r\"\n"))  # a header that looks like a value
    assert odd.simpleString() == "struct<1:int,b:string>"
    text = columns._jdf.queryExecution().simpleString()
    assert text.count("FileScan") == 1 and len([x for x in text.split() if x == "Exchange"]) <= 1


def test_replace_skips_bad_records(spark, write, rows):
    path = write("a.csv", "ID,Amount,NAME\n1,2.5,a\n2,x,b\n3,1.0\n4,1.0,d,extra\n5,,e\nq,1,f\n")
    loaded = load_files_replace(spark, path, STAGE)
    expected = [(1, "a", 2.5, None), (5, "e", None, None)]
    assert rows(loaded) == expected
    # Also when a query needs one column only.
    assert loaded.count() == 2
    assert rows(loaded, "id") == [(1,), (5,)]
    assert loaded.schema.names == STAGE.names


def test_files_with_another_column_order_fail(spark, write, frame):
    write("d/a.csv", "id,name,amount\n1,a,2.5\n")
    path = write("d/b.csv", "name,id,amount\n2,2,2.5\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        load_files_replace(spark, path, STAGE).collect()
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        load_files_by_name(spark, path, frame(BRONZE), **STAMPS).collect()


def test_replace_json_and_parquet(spark, write, rows, tmp_path):
    path = write("a.json", '{"ID": 1, "name": "a", "amount": 1.5}\n{"ID": "x"}\nnot json\n{"name": "b"}\n')
    expected = [(1, "a", 1.5, None), (None, "b", None, None)]
    assert rows(load_files_replace(spark, path, STAGE, "json")) == expected
    assert rows(load_files_replace(spark, path, STAGE, "json"), "name") == [("a",), ("b",)]
    parquet = str(tmp_path / "p")
    spark.createDataFrame([("1", "a"), ("x", "b")], "id string, name string").write.parquet(parquet)
    assert rows(load_files_replace(spark, parquet, STAGE, "parquet")) == [(1, "a", None, None)]


BRONZE = (
    "id int, name string, amount double, src_load_ts timestamp_ntz, batch_id decimal(38,0), "
    "etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"
)


def test_by_name_append_truncate_and_missing(spark, write, frame, rows):
    target = frame(BRONZE, (9, "old", 0.0, T1, 1, T1, T1))
    path = write("a.csv", "NAME,Id,Amount,other\na,1,2.5,z\n")
    appended = load_files_by_name(spark, path, target, **STAMPS)
    assert rows(appended, "id", "name", "src_load_ts") == [(1, "a", T4), (9, "old", T1)]
    replaced = load_files_by_name(spark, path, target, truncate=True, **STAMPS)
    assert rows(replaced, "id") == [(1,)]
    with pytest.raises(ValueError, match="lack"):
        load_files_by_name(spark, write("b.csv", "id\n1\n"), target, **STAMPS)


def test_mapping_for_headerless_files(spark, write, frame, rows):
    target = frame(BRONZE)
    path = write("a.csv", "2.5,1\n3.5,2\n")
    loaded = load_files_with_mapping(spark, path, {"_c0": "amount", "_c1": "id"}, target, **STAMPS)
    assert rows(loaded, "id", "name", "amount") == [(1, None, 2.5), (2, None, 3.5)]
    same = file_to_bronze(
        spark, path, target, header=False, mapping={"_c0": "amount", "_c1": "id"}, **STAMPS
    )
    assert rows(same) == rows(loaded)


def test_ingest_reads_each_file_once_and_archives(spark, write, tmp_path, rows):
    schema = T.StructType.fromDDL("id int")
    inbox = write("in/a.csv", "1\n2\n")
    args = (inbox, str(tmp_path / "archive"), schema, str(tmp_path / "cp"), str(tmp_path / "out"))
    for text in (None, "3\n", None):
        if text:
            write("in/b.csv", text)
        ingest_new_files(spark, *args).awaitTermination()
    assert rows(spark.read.parquet(args[4])) == [(1,), (2,), (3,)]
    archived = [f for _, _, files in os.walk(args[1]) for f in files if f.endswith(".csv")]
    assert "a.csv" in archived


@pytest.mark.parametrize("point", ["before the rows", "before the entry", "after the entry"])
def test_a_batch_that_comes_again_counts_once(spark, write, tmp_path, rows, point):
    """The stream dies in its second batch at each point in turn; what it leaves differs."""

    class Failing(OnceTable):
        left = 2

        def _fail(self, where, batch):
            if where == point and batch == 1 and self.left:
                self.left -= 1
                raise RuntimeError(where)

        def append_once(self, rows, stream, batch):
            self._fail("before the rows", batch)
            return super().append_once(rows, stream, batch)

        def enter(self, stream, batch):
            self._fail("before the entry", batch)
            super().enter(stream, batch)
            self._fail("after the entry", batch)

    schema = T.StructType.fromDDL("id int, name string")
    table = Failing(spark, str(tmp_path / "table"), schema)
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "offsets")

    def run():
        consume_files(spark, inbox, None, schema, checkpoint, table, header=True).awaitTermination()

    write("in/a.csv", "id,name\n1,x\n2,y\n")
    run()
    write("in/b.csv", "id,name\n2,y\n3,z\n")
    for _ in range(2 if point != "after the entry" else 1):
        with pytest.raises(PySparkException):
            run()
        # Readers see whole batches: all of the second one or nothing of it.
        assert len(rows(table.rows())) == (4 if point == "after the entry" else 2)
    run()
    run()
    assert rows(table.rows()) == [(1, "x"), (2, "y"), (2, "y"), (3, "z")]
    assert rows(table.ledger()) == [("files", 0, 2), ("files", 1, 2)]
    assert table.append_once(table.rows().limit(1), "other stream", 0) and table.rows().count() == 5


def test_stream_into_merge(spark, write, tmp_path, frame, rows):
    """Each micro-batch is merged into the newest state and saved beside it."""
    states = [save_state(frame("id int, v string", (1, "old"), (9, "old")), str(tmp_path / "s0"))]

    def apply(batch, epoch):
        merged = merge_upsert(states[-1], batch, ["id"])
        states.append(save_state(merged, str(tmp_path / f"s{len(states)}")))

    schema = T.StructType.fromDDL("id int, v string")
    inbox = write("in/a.csv", "1,new\n2,new\n")
    apply_new_files(spark, inbox, None, schema, str(tmp_path / "cp"), apply).awaitTermination()
    assert rows(states[-1]) == [(1, "new"), (2, "new"), (9, "old")]


def test_sinks(spark, tmp_path, frame, rows):
    path = str(tmp_path / "t")
    df = frame("day int, k int", (1, 1), (1, 2), (2, 3))
    assert rows(save_state(df, path, partition_by=["day"], sort_by=["k"])) == rows(df)
    with pytest.raises(PySparkException):
        save_state(df, path)
    save_partitions(frame("day int, k int", (2, 30)), path, ["day"])
    assert rows(spark.read.parquet(path), "day", "k") == [(1, 1), (1, 2), (2, 30)]


def test_merge_rewrites_touched_partitions_only(spark, tmp_path, frame, rows):
    path = str(tmp_path / "t")
    spark.range(40).selectExpr("id AS k", "0 AS v", "cast(id % 4 AS int) AS day").write.partitionBy("day").parquet(path)
    files = {day: sorted(os.listdir(f"{path}/day={day}")) for day in range(4)}
    table = spark.read.parquet(path)
    source = frame("k long, v int, day int", (1, 7, 1), (2, 8, 2), (100, 9, 1))
    part = touched_partitions(table, source, "day")
    assert part.count() == 20
    save_partitions(merge_upsert(part, source, ["k"]), path, ["day"])
    after = {day: sorted(os.listdir(f"{path}/day={day}")) for day in range(4)}
    assert [day for day in range(4) if files[day] == after[day]] == [0, 3]
    assert spark.read.parquet(path).count() == 41
    assert rows(spark.read.parquet(path).where("v > 0"), "k", "v") == [(1, 7), (100, 9), (2, 8)]


@pytest.mark.parametrize("days", [2, 60])
def test_merge_keeps_the_rows_of_the_null_partition(spark, tmp_path, frame, rows, days):
    path = str(tmp_path / "t")
    day = f"CASE WHEN id % 4 > 0 THEN cast(id % {days} AS int) END AS day"
    spark.range(400).selectExpr("id AS k", "0 AS v", day).write.partitionBy("day").parquet(path)
    table = spark.read.parquet(path)
    source = table.where("k % 40 < 4").selectExpr("k", "1 AS v", "day").union(frame("k long, v int, day int", (1000, 1, None)))
    source = stage(source)
    part = touched_partitions(table, source, "day")
    assert part.where("day IS NULL").count() == 100
    save_partitions(merge_upsert(part, source, ["k"]), path, ["day"])
    assert spark.read.parquet(path).count() == 401
    assert spark.read.parquet(path).where("v = 1").count() == 41


def test_stage_uses_the_shared_folder(spark, frame):
    staged = stage(frame("a int", (1,)))
    assert shared_dir(spark).removeprefix("file:") in staged.inputFiles()[0]


def test_stage_to_bronze(frame, rows):
    target = frame("k int, ts timestamp_ntz, batch_id decimal(38,0), etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz",
                   (1, T1, 1, T1, T1), (2, T3, 1, T1, T1))
    source = frame("ts timestamp_ntz, k int", (T3, 3), (T1, 4))
    full = stage_to_bronze(target, source, load_type="full", ts_col="ts", **STAMPS)
    assert rows(full, "k") == [(3,), (4,)]
    part = stage_to_bronze(target, source, load_type="incremental", ts_col="ts", since=T2, **STAMPS)
    assert rows(part, "k") == [(1,), (3,)]
    with pytest.raises(ValueError):
        stage_to_bronze(target, source, load_type="other", ts_col="ts", **STAMPS)


SILVER = "k int, v string, ts timestamp_ntz, batch_id decimal(38,0), etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"


def test_bronze_to_silver_ties_fail_unless_broken(frame, rows):
    target = frame(SILVER, (1, "old", T1, 1, T1, T1))
    source = frame("k int, v string, ts timestamp_ntz", (1, "a", T2), (1, "b", T2), (1, "c", T1))
    with pytest.raises(PySparkException, match="several source rows"):
        bronze_to_silver(target, source, ["k"], ts_col="ts", **STAMPS).target.collect()
    loaded = bronze_to_silver(target, source, ["k"], ts_col="ts", tie_break=["v"], **STAMPS)
    assert rows(loaded.target, "k", "v") == [(1, "b")]
    assert loaded.deleted is None


def test_bronze_to_silver_deletes(frame, rows):
    target = frame(
        "k int, v string, src_load_ts timestamp_ntz, batch_id decimal(38,0), etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz",
        (1, "old", T1, 1, T1, T1), (2, "gone", T1, 1, T1, T1),
    )
    source = frame("k int, v string, src_load_ts timestamp_ntz", (1, "new", T2), (3, "late", T1))
    loaded = bronze_to_silver(
        target, source, ["k"], ts_col="src_load_ts", since=T1, stage_snapshot=frame("k int", (1,), (3,)), **STAMPS
    )
    assert rows(loaded.target, "k", "v") == [(1, "new")]
    assert rows(loaded.deleted, "k", "src_load_ts") == [(2, T2)]
    with pytest.raises(ValueError):
        bronze_to_silver(target, source.drop("v"), ["k"], ts_col="src_load_ts", **STAMPS)


LOG = (
    "model_id string, model_grp string, pipeline_name string, pk int, src_load_ts timestamp_ntz, "
    "batch_id decimal(38,0), etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"
)
DRIFT = (
    "model_id string, model_grp string, pipeline_name string, source_table string, target_table string, "
    "column_name string, source_column_type string, target_column_type string, diff_type string, "
    "batch_id decimal(38,0), etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"
)


def test_outcomes_of_one_merge(frame, rows, tmp_path, spark):
    """What the separate merge, capture and delete give, from one frame written once."""
    columns = "k int, v string, batch_id decimal(38,0), src_load_ts timestamp_ntz, etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"
    target = frame(columns, (1, "a", 1, T1, T1, T1), (2, "b", 1, T1, T1, T1), (None, "n", 1, T1, T1, T1), (4, "d", 1, T2, T1, T1))
    source = frame(columns, (2, "B", 2, T3, T3, T3), (3, "c", 2, T3, T3, T3), (5, "e", 2, T3, T3, T3), (None, "m", 2, T3, T3, T3))
    alive = frame("k int", (1,), (2,), (2,), (3,), (None,))
    outcomes = merge_outcomes(target, source, ["k"], alive, preserve_load_ts=True)
    assert rows(outcomes, "k", "v", OUTCOME) == sorted(
        [
            (1, "a", "kept"), (2, "B", "updated"), (3, "c", "inserted"), (4, "d", "deleted"), (5, "e", "deleted"),
            (None, "m", "unaddressed"), (None, "n", "unaddressed"),
        ], key=repr,
    )
    merged = merge_upsert(target, source, ["k"], preserve_load_ts=True)
    assert rows(outcomes.where("_outcome <> 'deleted'").drop(OUTCOME)) == rows(surviving_rows(merged, alive, ["k"]))
    assert rows(captured_outcomes(outcomes, T4)) == rows(capture_missing_rows(merged, alive, ["k"], T4))
    without = merge_outcomes(target, source, ["k"])
    assert {r[OUTCOME] for r in without.collect()} == {"kept", "updated", "inserted"}
    saved = save_state(outcomes, str(tmp_path / "s"), folders=[OUTCOME])
    assert rows(saved) == rows(outcomes)
    twice = source.union(source.where("k = 2"))
    with pytest.raises(PySparkException):
        merge_outcomes(target, twice, ["k"], alive).collect()


def test_metrics_of_written_rows(frame, rows, tmp_path, spark):
    columns = "k int, batch_id decimal(38,0), src_load_ts timestamp_ntz, etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"
    data = [(i, 2, T2 if i % 3 else None, T1 if i % 4 else T3, T3) for i in range(50)] + [(99, 1, T4, T1, T1), (98, None, T4, T1, T1)]
    df = frame(columns, *data).repartition(4)
    for name, saving in (("a", {}), ("b", {"partition_by": ["k"]}), ("c", {"sort_by": ["k"]})):
        taken = WrittenMetrics(2)
        saved = save_state(df, str(tmp_path / name), observe=taken.observe, **saving)
        metrics = taken.frame(spark)
        assert rows(metrics, "batch_id", "src_load_ts", "rows_inserted", "rows_updated") == rows(
            load_metrics(saved, 2), "batch_id", "src_load_ts", "rows_inserted", "rows_updated"
        )
        assert "FileScan" not in metrics._jdf.queryExecution().toString()
    none = WrittenMetrics(3)
    save_state(df, str(tmp_path / "d"), observe=none.observe)
    assert none.frame(spark).isEmpty()


def test_segments_in_one_scan(spark, frame, rows):
    """Rows know their segment; a plan has one size for any number of segments."""
    base = new_folder(spark, "odd name+%")
    sizes = []
    for n in (3, 40):
        for i in range(n):
            frame("pk int, v string", (i, f"v{i}"), (None, "x")).write.mode("overwrite").parquet(f"{base}/s{i}")
        scan = read_segments(spark, {f"EV_{i}": f"{base}/s{i}/" for i in range(n)}, "pk int, v string, w string")
        assert rows(scan.rows.where("pk IS NOT NULL"), "pk", "v", "w", "src_journal_tbl") == sorted(
            [(i, f"v{i}", None, f"EV_{i}") for i in range(n)], key=repr
        )
        assert len(scan.names) == n
        sizes.append(scan.rows._jdf.queryExecution().toString().count("\n"))
    assert sizes[0] == sizes[1]


def test_staged_cdc(frame, rows):
    target = frame(
        "pk int, v string, src_load_ts timestamp_ntz, batch_id decimal(38,0), etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz",
        (1, "old", T1, 1, T1, T1), (2, "old", T1, 1, T1, T1), (3, "old", T1, 1, T1, T1),
    )
    source = frame("pk int, v string, at timestamp_ntz, extra int", (1, "a", T2, 0), (1, "b", T3, 0), (4, "c", T3, 0))
    journal = frame(
        "primary_key__pk int, event_type string, seen_at timestamp_ntz, least_significant_position int",
        (2, "IncrementalDeleteRows", T3, 1),
    )
    log = frame(LOG, ("m", "g", "p", 3, T1, 1, T1, T1))
    options = dict(
        ts_col="at", load_type="full", model_id="m", model_grp="g", pipeline_name="p",
        drift_audit=frame(DRIFT), **STAMPS,
    )
    loaded = staged_cdc_to_silver(target, source, journal, log, ["pk"], **options)
    # Key 3 was deleted by an earlier batch and is there again: it stays.
    assert rows(loaded.target, "pk", "v", "src_load_ts") == [(1, "b", T3), (3, "old", T1), (4, "c", T3)]
    assert rows(loaded.log, "pk") == [(2,), (3,)]
    assert rows(loaded.drift, "column_name", "diff_type") == [
        ("at", "MISSING_IN_TARGET"),
        ("extra", "MISSING_IN_TARGET"),
    ]
    assert [tuple(r) for r in loaded.rows_deleted.collect()] == [("m", 1)]
    sticky = staged_cdc_to_silver(target, source, journal, log, ["pk"], sticky=True, **options)
    assert rows(sticky.target, "pk") == [(1,), (4,)]
    with pytest.raises(ValueError, match="lacks"):
        staged_cdc_to_silver(target, source.drop("v"), journal, log, ["pk"], **options)


def test_staged_cdc_keeps_keys_inserted_again(frame, rows):
    target = frame(
        "pk int, v string, src_load_ts timestamp_ntz, batch_id decimal(38,0), etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz",
        (1, "old", T1, 1, T1, T1), (2, "old", T1, 1, T1, T1), (3, "old", None, 1, T1, T1), (5, "old", T1, 1, T1, T1),
    )
    source = frame("pk int, v string, at timestamp_ntz", (1, "back", T3), (4, "image of the delete", T3))
    journal = frame(
        "primary_key__pk int, event_type string, seen_at timestamp_ntz, least_significant_position int",
        (1, "IncrementalDeleteRows", T2, 1),  # inserted again since
        (2, "IncrementalDeleteRows", T2, 2),
        (3, "IncrementalDeleteRows", T2, 3),
        (4, "IncrementalDeleteRows", T3, 4),
        (5, "IncrementalDeleteRows", T1, 5),  # not above the watermark
        (None, "IncrementalDeleteRows", T3, 6),
    )
    options = dict(ts_col="at", since=T1, model_id="m", model_grp="g", pipeline_name="p", **STAMPS)
    loaded = staged_cdc_to_silver(target, source, journal, frame(LOG), ["pk"], **options)
    assert rows(loaded.target, "pk") == [(1,), (5,)]
    assert loaded.rows_deleted.first().rows_deleted == 3


CHECK = (
    "model_id string, model_grp string, key_column string, validation_type string, issue_record_count decimal(38,0), "
    "json_value string, success_flg string, batch_id decimal(38,0), src_load_ts timestamp_ntz, "
    "etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"
)


def test_prevalidated(frame, rows):
    target = frame(SILVER, (1, "old", T1, 1, T1, T1))
    source = frame(
        "k int, v string, ts timestamp_ntz, json_value string",
        (1, "hist", T1, "{}"), (1, "new", T3, "{}"), (2, "a", T3, "{}"), (2, "b", T3, "{}"), (None, "n", T3, "{}"),
    )
    check = frame(CHECK, ("m", "g", '{"k":1}', "Duplication Check for Key Columns", 2, "{}", "N", 1, T1, T1, T1))
    options = dict(ts_col="ts", payload="json_value", model_id="m", model_grp="g", **STAMPS)
    loaded = prevalidated_to_silver(target, source, check, ["k"], since=T2, **options)
    # Key 1 has history below the watermark, which is no duplicate.
    assert rows(loaded.target, "k", "v") == [(1, "new")]
    got = {(r.key_column, int(r.batch_id)): r.success_flg for r in loaded.check.collect()}
    assert got == {('{"k":1}', 1): "Y", ('{"k":2}', 2): "N", ("{}", 2): "N"}
    # Without the watermark the history counts, as it does in the original.
    whole = prevalidated_to_silver(target, source, check, ["k"], **options)
    assert rows(whole.target, "k", "v") == [(1, "old")]
    unchecked = prevalidated_to_silver(
        target, source.where("k = 1"), check, ["k"], prevalidate=False, **options
    )
    assert rows(unchecked.target, "k", "v") == [(1, "new")]


def test_journal_to_bronze_without_segments(frame, rows):
    target = frame("primary_key__pk int", (1,))
    segments = frame("table_name string, created timestamp_ntz", ("OTHER_1", T1))
    same = journal_to_bronze(target, segments, lambda name: pytest.fail(name), "orders", **STAMPS)
    assert rows(same) == [(1,)]


def test_journal_to_bronze_loses_no_segment(frame, rows):
    envelope = (
        "primary_key__pk int, event_type string, most_significant_position int, least_significant_position int, "
        "seen_at timestamp_ntz, sf_metadata string"
    )
    bronze = frame(
        f"{envelope}, attribute_value_json string, src_journal_tbl string, src_load_ts timestamp_ntz, "
        "batch_id decimal(38,0), etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"
    )
    days = [T1.replace(day=d) for d in range(1, 7)]
    parts = {
        f"ORDERS_{n}": frame(f"{envelope}, PAYLOAD__A int", (n, "x", 0, n, day, "{}", n)) for n, day in enumerate(days)
    }
    segments = frame("table_name string, created timestamp_ntz", *[(name, day) for name, day in zip(parts, days)])
    options = dict(since=days[1], batch_id=2, load_ts=T3)
    before = journal_to_bronze(bronze, segments, parts.get, "orders", batch_id=1, load_ts=T1)
    assert rows(before, "primary_key__pk") == [(n,) for n in range(6)]
    read = []
    after = journal_to_bronze(before, segments, lambda name: read.append(name) or parts[name], "orders", **options)
    assert rows(after, "primary_key__pk", "batch_id") == [(n, 1 if n < 2 else 2) for n in range(6)]
    assert read == [f"ORDERS_{n}" for n in range(1, 6)]
    two = journal_to_bronze(before, segments, parts.get, "orders", k=2, **options)
    assert rows(two, "primary_key__pk", "batch_id") == [(n, 1 if n < 4 else 2) for n in range(6)]


JOURNAL = "primary_key__pk decimal(38,0), event_type string, least_significant_position decimal(38,0), seen_at timestamp_ntz"
LOG = (
    "model_id string, model_grp string, pipeline_name string, pk decimal(38,0), src_load_ts timestamp_ntz, "
    "batch_id decimal(38,0), etl_load_ts timestamp_ntz, etl_updt_ts timestamp_ntz"
)


def test_deletion_log_of_increments_is_that_of_one_run(spark, frame, rows, tmp_path):
    """Late, repeated and keyless events, and a micro-batch that comes again."""
    gone, other = "IncrementalDeleteRows", "IncrementalUpdateRows"
    parts = [
        [(1, gone, 5, T3), (2, gone, 1, T1), (3, other, 1, T1), (None, gone, 1, T1)],
        [(1, gone, 2, T2), (2, gone, 3, T2), (2, gone, 2, T2)],
        [(1, other, 9, T4), (4, gone, 7, T4), (4, gone, 7, T4)],
    ]
    names = dict(model_id="m", model_grp="g", pipeline_name="p")

    class Failing(VersionedTable):
        left = 1

        def save(self, df, version):
            super().save(df, version)
            if version == 1 and self.left:
                self.left = 0
                raise RuntimeError("lost after the save")

    def run(log, folder, name):
        schema = T.StructType.fromDDL(JOURNAL)
        stream_deletion_log(spark, folder, schema, str(tmp_path / f"offsets-{name}"), log, **names, **STAMPS).awaitTermination()

    steps = Failing(spark, str(tmp_path / "steps"), T.StructType.fromDDL(LOG))
    for i, part in enumerate(parts):
        frame(JOURNAL, *part).write.mode("append").parquet(str(tmp_path / "in"))
        if i == 1:
            with pytest.raises(PySparkException):
                run(steps, str(tmp_path / "in"), "steps")
        run(steps, str(tmp_path / "in"), "steps")
    whole = VersionedTable(spark, str(tmp_path / "whole"), T.StructType.fromDDL(LOG))
    run(whole, str(tmp_path / "in"), "whole")
    expected = [("m", "g", "p", k, t, 2, T4, T4) for k, t in ((1, T3), (2, T2), (4, T4))]
    assert rows(steps.state()) == rows(whole.state()) == rows(frame(LOG, *expected))
    assert rows(steps.state(before=1), "pk") == rows(frame("pk decimal(38,0)", (1,), (2,)))
