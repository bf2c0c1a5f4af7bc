"""What the plans look like, and that results hold on the large-data path.

Small tests broadcast nearly everything. Here broadcasts are switched off and
skew thresholds set to almost nothing, so that joins sort, merge and split.
"""

import re
import uuid
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from checks import ORACLES, QUERIES
from checks.registry import all_orders, silver
from compare import difference
from millrace.functions.columns import stamp_audit
from millrace.operators.deletes import apply_hard_delete
from millrace.operators.latest import latest_by_rank
from millrace.operators.merge import merge_upsert
from millrace.operators.numbering import lead_next_start, row_number_per_key
from millrace.session import new_folder
from millrace.sources import bucketed, open_bucketed, save_bucketed


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


@contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


LARGE = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "1b",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.0",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "1kb",
}


@contextmanager
def large(spark):
    if spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
    with settings(spark, **LARGE):
        yield


JOINING = (
    "merge_upsert merge_configurable merge_update_subset insert_when_absent delete_insert_by_key "
    "capture_missing_rows apply_hard_delete capture_deleted_keys soft_delete latest_by_max "
    "correlated_scalar_max blank_safe_key_equal assign_surrogate_key assign_sequence_number "
    "row_number_per_key close_versions demote_reporting exclude_bad_keys record_issues "
    "resolve_issues bronze_to_silver prevalidated_to_silver scd2_load init_model_audit"
).split()


@pytest.mark.parametrize("name", JOINING)
def test_result_holds_without_broadcasts(spark, con, sf_dir, name):
    with large(spark):
        df = QUERIES[name](spark, sf_dir)
        assert difference(df, con, ORACLES[name]) is None


def test_hot_target_key_is_split(spark):
    """A third of the target has one key: AQE reads that partition in pieces."""
    n = 200_000
    target = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    source = spark.range(0, n, 2).select(F.col("id").alias("k"), (-F.col("id")).alias("v"))
    with large(spark):
        merged = merge_upsert(target.repartition(8), source, ["k"])
        merged.write.format("noop").mode("overwrite").save()
        counts = merged.groupBy((F.col("v") <= 0).alias("hit")).count().collect()
        merged.collect()
        assert "skew=true" in plan(merged)
    hits = sum(1 for i in range(n) if i % 3 == 0 or i % 2 == 0)
    got = {r.hit: r["count"] for r in counts}
    fresh = sum(1 for i in range(0, n, 2) if i % 3 == 0 and i != 0)  # keys the target lost to 0
    assert got == {True: hits + fresh, False: n - hits}


def test_small_source_leaves_the_target_unshuffled(spark, sf_dir):
    target = silver(spark, sf_dir)
    source = stamp_audit(all_orders(spark, sf_dir).limit(5), batch_id=1, load_ts="2026-01-01")
    text = plan(merge_upsert(target, source, ["k"], source_unique=True))
    assert "SortMergeJoin" not in text
    # Target rows reach the union through the broadcast join alone.
    first_branch = text.split("Union")[1].split("LeftAnti")[0]
    assert "LeftOuter, BuildRight" in first_branch


def test_watermark_reaches_the_scan(spark, sf_dir):
    text = plan(QUERIES["latest_then_increment"](spark, sf_dir))
    scans = re.findall(r"PushedFilters: \[[^\]]*\]", text)
    assert len(scans) == 2 and all("GreaterThan(o_orderdate" in s for s in scans)


def test_latest_by_rank_limits_groups_before_the_shuffle(spark, sf_dir):
    text = plan(latest_by_rank(all_orders(spark, sf_dir), ["c"], ["src_load_ts", "k"]))
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_columns_are_pruned(spark, sf_dir):
    text = plan(QUERIES["max_per_key"](spark, sf_dir))
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>", text)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_workers_and_no_wide_cross_joins(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not re.search(r"EvalPython|InPandas|InArrow|PythonMap", text)
    assert not re.search(r"CartesianProduct|NestedLoopJoin", text)


@pytest.mark.parametrize(
    "name, most", [("row_number_per_key", 3), ("close_versions", 4), ("scd2_load", 8)]
)
def test_exchanges_of_scans_without_broadcasts(spark, sf_dir, name, most):
    with large(spark):
        text = plan(QUERIES[name](spark, sf_dir))
    assert len(re.findall(r"Exchange ", text)) <= most


def test_scd2_load_reads_the_dimension_once(spark, sf_dir):
    text = plan(QUERIES["scd2_load"](spark, sf_dir))
    assert len(re.findall(r"FileScan parquet .*events.parquet", text)) == 1


def test_a_hot_key_is_scanned_by_many_tasks(spark):
    """Half of the rows have one key; the scan's shuffle is keyed by (range, key)."""
    n = 40_000
    df = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("at"),
        F.col("id").alias("v"),
    )
    with settings(spark, spark__sql__adaptive__enabled="false"):
        numbered = row_number_per_key(df.repartition(8), ["k"], ["at"], unique_order=True)
        tasks = numbered.where("k = 0").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(tasks) > 1 and max(r["count"] for r in tasks) < n // 2
        assert numbered.where("k = 0 AND rn <> v / 2 + 1").isEmpty() and numbered.where("k > 0 AND rn <> 1").isEmpty()
        led = lead_next_start(df, "k", "at", "v")
        wrong = led.where("k = 0 AND v < 39998 AND next_start <> timestamp_seconds(v + 2)::timestamp_ntz")
        assert wrong.isEmpty() and led.where("next_start IS NULL AND k = 0").count() == 1


def lines_above(text: str, pattern: str) -> list[str]:
    """The operators above the first line of a plan that matches."""
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if re.search(pattern, line))
    depth = lambda line: re.search(r"[A-Za-z*(]", line).start()
    out, own = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if re.search("[A-Za-z]", line) and depth(line) < own:
            out.append(line)
            own = depth(line)
    return out


def test_a_larger_table_has_more_buckets(spark, sf_dir, monkeypatch):
    rows = QUERIES["merge_upsert_bucketed"](spark, sf_dir).count()
    monkeypatch.setattr(bucketed, "BUCKET_ROWS", 100)
    large = QUERIES["merge_upsert_bucketed"](spark, sf_dir)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    files = {re.search(r"_(\d{5})\.", f.rsplit("/", 1)[1])[1] for f in large.inputFiles()}
    assert large.count() == rows and 8 < orders // 100 >= len(files) > 8
    assert bucketed.bucket_count(spark.range(1001)) == 11 and bucketed.bucket_count(spark.range(0), 8) == 8


def test_a_large_increment_leaves_bucketed_targets_where_they_are(spark, sf_dir):
    """Merge, write back and delete: only the increment is shuffled, with broadcasts off."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        name, rows = "t_" + uuid.uuid4().hex, all_orders(spark, sf_dir)
        target = save_bucketed(silver(spark, sf_dir), name, new_folder(spark, "b"), ["k"], 8)
        source = stamp_audit(rows, batch_id=1, load_ts="2026-01-01")
        merged = merge_upsert(target, source, ["k"])
        for df in (merged, apply_hard_delete(target, rows, ["k"])):
            above = lines_above(plan(df), "Bucketed: true")
            assert not any("Exchange" in line for line in above) and any("SortMergeJoin" in line for line in above)
        again = save_bucketed(merged, name + "_2", new_folder(spark, "b"), ["k"], 8)
        assert len(again.inputFiles()) <= 16 and again.count() == rows.count()
        path = again.inputFiles()[0].rsplit("/", 1)[0]
        opened = open_bucketed(spark, name + "_3", path, again.schema.toDDL(), ["k"], 8)
        assert "Bucketed: true" in plan(apply_hard_delete(opened, rows, ["k"])) and opened.count() == again.count()
