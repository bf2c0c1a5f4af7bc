"""Numbering, next-start lookup and type-2 steps, with hot keys, ties and copies.

Expected values come from brute force in Python.
"""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.latest import latest_by_max, latest_by_rank, latest_then_increment
from millrace.operators.numbering import (
    dense_rank_global,
    lead_next_start,
    row_number_global,
    row_number_per_key,
    with_dense_rank,
)
from millrace.operators.deletes import soft_delete
from millrace.operators.key_registry import KeyRegistry
from millrace.operators.scd2 import (
    apply_version_changes,
    assign_sequence_number,
    assign_surrogate_key,
    close_versions,
    demote_reporting,
    split_live,
    version_changes,
)
from millrace.plans.loads import scd2_load
from millrace.session import new_folder, stage
from millrace.functions.columns import hash_key

T1, T2, T3, T4 = (dt.datetime(2024, 1, d) for d in (1, 2, 3, 4))


@pytest.fixture
def hot(spark):
    """900 rows, a third of them one key; times tie, and some rows are exact copies."""
    rng = random.Random(7)
    start = dt.datetime(2024, 1, 1)
    data = [
        (
            0 if i % 3 == 0 else rng.randrange(1, 40),
            start + dt.timedelta(seconds=rng.randrange(0, 4000) * 7),
            rng.randrange(0, 5),
        )
        for i in range(860)
    ]
    data += [data[0]] * 40
    return data, spark.createDataFrame(data, "k int, ts timestamp_ntz, v int").repartition(5)


def test_row_number_global_numbers_copies_apart(hot):
    data, df = hot
    got = sorted((r.rn, r.k, r.ts, r.v) for r in row_number_global(df, ["k", "ts", "v"]).collect())
    assert got == [(i + 1, *row) for i, row in enumerate(sorted(data))]


def test_row_number_per_key(hot):
    data, df = hot
    got = sorted((r.k, r.rn, r.ts, r.v) for r in row_number_per_key(df, ["k"], ["ts", "v"]).collect())
    expected, previous, n = [], None, 0
    for k, ts, v in sorted(data):
        n = n + 1 if k == previous else 1
        previous = k
        expected.append((k, n, ts, v))
    assert got == expected


def test_row_number_per_key_with_nulls_and_runs_over_many_ranges(spark):
    """Keys that fill several ranges, NULL keys and NULL orders, whatever the number of ranges."""
    rng = random.Random(3)
    data = [(rng.choice([None, 1, 1, 1, 2]), rng.choice([None, "a", "b"]), i) for i in range(400)]
    df = spark.createDataFrame(data, "k int, o string, i int").repartition(3)
    low = lambda v: (v is None, v or "")
    for ranges in (1, 4, 60):
        spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
        try:
            got = {r.i: r.rn for r in row_number_per_key(df, ["k"], ["o", "i"], unique_order=True).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        expected = {}
        for key in (None, 1, 2):
            own = sorted((r for r in data if r[0] == key), key=lambda r: (low(r[1]), r[2]))
            expected |= {r[2]: n for n, r in enumerate(own, 1)}
        assert got == expected


def test_dense_rank_puts_nulls_last(hot, spark):
    data, df = hot
    df = df.select("k", "v").union(spark.createDataFrame([(None, 1), (None, 1)], "k int, v int"))
    distinct = sorted({(k, v) for k, _, v in data}) + [(None, 1)]
    ranks = {(r.k, r.v): r.rank for r in dense_rank_global(df, ["k", "v"]).collect()}
    assert ranks == {key: i + 1 for i, key in enumerate(distinct)}
    assert with_dense_rank(df, ["k", "v"]).count() == df.count()


def test_next_start_with_ties_and_hot_key(hot):
    data, df = hot
    got = {(r.k, r.ts, r.v): r.next_start for r in lead_next_start(df, "k", "ts", "v").collect()}
    expected = {}
    for key in {k for k, _, _ in data}:
        points = sorted({(ts, v) for k, ts, v in data if k == key})
        for i, (ts, v) in enumerate(points):
            expected[key, ts, v] = points[i + 1][0] if i + 1 < len(points) else None
    assert got == expected


def test_latest(hot, rows):
    data, df = hot
    newest = {k: max(ts for k2, ts, _ in data if k2 == k) for k, _, _ in data}
    ties = sorted(row for row in data if row[1] == newest[row[0]])
    assert sorted(map(tuple, latest_by_max(df, ["k"], "ts").collect())) == ties
    one = latest_by_rank(df, ["k"], ["ts", "v"]).collect()
    assert sorted((r.k, r.ts) for r in one) == sorted(newest.items())
    since = sorted(newest.values())[len(newest) // 2]
    kept = sorted(map(tuple, latest_then_increment(df, ["k"], "ts", since).collect()))
    assert kept == [row for row in ties if row[1] > since]


def test_latest_by_max_drops_null_keys_and_times(frame, rows):
    df = frame("k int, ts timestamp_ntz", (None, T1), (1, None), (1, T1), (2, None))
    assert rows(latest_by_max(df, ["k"], "ts")) == [(1, T1)]


# ----------------------------------------------------------------- type-2 steps

DIM = (
    "sk decimal(38,0), seq decimal(38,0), hash_sk string, hash_seq_no string, start_ts timestamp_ntz, "
    "end_ts timestamp_ntz, active_flg string, reporting_flg string, etl_updt_ts timestamp_ntz"
)


def test_surrogate_keys(frame):
    target = frame("sk decimal(38,0), hash_sk string", (10, "hb"), (12, "hb"))
    src = frame("key string, hash_sk string", ("a", "ha"), ("b", "hb"), ("c", "hc"), ("c", "hc"))
    keyed = assign_surrogate_key(src, target, "sk", ["key"])
    assert keyed.columns == ["key", "hash_sk", "sk"]
    assert sorted((r.key, int(r.sk)) for r in keyed.collect()) == [("a", 13), ("b", 12), ("c", 15), ("c", 15)]
    gapless = assign_surrogate_key(src, target, "sk", ["key"], gapless=True)
    assert sorted((r.key, int(r.sk)) for r in gapless.collect()) == [("a", 13), ("b", 12), ("c", 14), ("c", 14)]
    empty = assign_surrogate_key(src, target.limit(0), "sk", ["key"])
    assert {int(r.sk) for r in empty.collect()} == {1, 2, 3}


def test_sequence_numbers(frame):
    target = frame(
        "hash_sk string, hash_seq_no string, seq decimal(38,0), active_flg string",
        ("a", "v1", 3, "Y"), ("a", "v2", 4, "N"), ("b", "v1", 1, "Y"),
    )
    src = frame("hash_sk string, hash_seq_no string", ("a", "v1"), ("a", "v2"), ("a", "v3"), ("c", "v1"))
    got = {(r.hash_sk, r.hash_seq_no): int(r.seq) for r in assign_sequence_number(src, target, "seq").collect()}
    # v2 is known but closed, so it counts as new: second in its key, after 4.
    assert got == {("a", "v1"): 3, ("a", "v2"): 6, ("a", "v3"): 7, ("c", "v1"): 1}
    tight = assign_sequence_number(src, target, "seq", gapless=True, unique_order=True)
    got = {(r.hash_sk, r.hash_seq_no): int(r.seq) for r in tight.collect()}
    assert got == {("a", "v1"): 3, ("a", "v2"): 5, ("a", "v3"): 6, ("c", "v1"): 1}
    over_all = assign_sequence_number(src, target, "seq", global_numbering=True)
    got = {(r.hash_sk, r.hash_seq_no): int(r.seq) for r in over_all.collect()}
    assert got == {("a", "v1"): 3, ("a", "v2"): 6, ("a", "v3"): 7, ("c", "v1"): 4}


def test_close_versions_leaves_other_rows(frame):
    dim = frame(
        DIM,
        (1, 1, "", "", T1, None, "Y", "Y", T1),
        (1, 2, "", "", T2, None, "Y", "N", T1),
        (1, 3, "", "", T3, T4, "N", "Y", T1),  # inactive
        (2, 1, "", "", None, None, "Y", "Y", T1),  # no start
        (None, 1, "", "", T1, None, "Y", "Y", T1),  # no key
    )
    closed = close_versions(dim, "sk", "seq")
    got = sorted(
        ((r.sk and int(r.sk), int(r.seq), r.end_ts, r.active_flg, r.reporting_flg) for r in closed.collect()), key=repr
    )
    assert got == sorted(
        [
            (1, 1, T2, "N", "N"), (1, 2, None, "Y", "Y"), (1, 3, T4, "N", "Y"),
            (2, 1, None, "Y", "Y"), (None, 1, None, "Y", "Y"),
        ], key=repr,
    )
    assert closed.columns == dim.columns
    active = closed.where("active_flg = 'Y' AND start_ts IS NOT NULL AND sk IS NOT NULL")
    assert active.groupBy("sk").count().where("count > 1").count() == 0


def test_demote_reporting(frame):
    dim = frame(
        DIM,
        (1, 1, "", "", T1, None, "N", "Y", T1),
        (1, 1, "", "", T2, None, "Y", "Y", T1),
        (1, 1, "", "", T3, None, "N", "N", T1),  # not reporting: does not count as newest
        (1, 2, "", "", T1, None, "N", "Y", T1),
        (1, 2, "", "", None, None, "N", "Y", T1),
    )
    demoted = demote_reporting(dim, "sk", "seq")
    got = sorted(((int(r.seq), r.start_ts, r.reporting_flg) for r in demoted.collect()), key=repr)
    assert got == sorted(
        [(1, T1, "N"), (1, T2, "Y"), (1, T3, "N"), (2, T1, "Y"), (2, None, "Y")], key=repr
    )


def test_changes_do_what_the_steps_do(spark):
    """One join with the changes against closing, demoting and deleting one after the other."""
    rng = random.Random(11)
    flags = ["Y", "Y", "N", None]
    times = [T1, T2, T3, T4, None]
    data = [
        (rng.choice([1, 2, 3, None]), rng.choice([1, 2, None]), "", "", rng.choice(times), rng.choice([None, T4]),
         rng.choice(flags), rng.choice(flags), T4, rng.choice(["a", "b", None]), i)
        for i in range(300)
    ]
    dim = spark.createDataFrame(
        data, DIM.replace("decimal(38,0)", "int") + ", id string, i int"
    ).withColumns({c: F.col(c).cast("decimal(38,0)") for c in ("sk", "seq")})
    deleted = spark.createDataFrame([("a",), (None,)], "id string")
    expected = soft_delete(demote_reporting(close_versions(dim, "sk", "seq"), "sk", "seq"), deleted, ["id"])
    live, _ = split_live(dim)
    changes = version_changes(live, "sk", "seq", deleted=deleted, deleted_on=["id"])
    got = apply_version_changes(dim, changes, "sk", "seq", deleted_on=["id"])
    assert got.schema == dim.schema
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_registry_gives_a_load_that_runs_again_the_same_keys(spark, frame):
    registry = KeyRegistry(spark, new_folder(spark, "registry"))
    assert registry.entries().isEmpty() and int(registry.top().first().top) == 0

    def load(name, *keys):
        src = frame("key string, hash_sk string", *[(k, "h" + k) for k in keys])
        keyed = assign_surrogate_key(src, None, "sk", ["key"], registry=registry, load=name)
        registry.extend(keyed, name)
        return {r.key: int(r.sk) for r in keyed.collect()}

    assert load("1", "a", "b") == {"a": 1, "b": 2}
    assert load("2", "b", "c", "c") == {"b": 2, "c": 4} and load("2", "b", "c") == {"b": 2, "c": 4}
    assert load("3", "d") == {"d": 5} and load("4", "a") == {"a": 1}
    assert sorted((r.hash_sk, int(r.sk)) for r in registry.entries().collect()) == [("ha", 1), ("hb", 2), ("hc", 4), ("hd", 5)]
    assert int(registry.top().first().top) == 5
    again = KeyRegistry.of_dimension(
        frame("sk decimal(38,0), hash_sk string", (7, "x"), (9, "x"), (3, None)), new_folder(spark, "registry")
    )
    assert [(r.hash_sk, int(r.sk)) for r in again.entries().collect()] == [("x", 9)]


def test_scd2_load_in_two_batches(frame, rows):
    empty = frame("id string, " + DIM)
    options = dict(sk="sk", seq="seq", key_cols=["id"], version_cols=["color"], start_ts="at", load_ts=T4)
    # The dimension keeps no color; it is known by its hash only.
    first = scd2_load(
        empty, frame("id string, color string, at timestamp_ntz", ("a", "red", T1), ("b", "red", T1)), **options
    )
    assert sorted((r.id, int(r.sk), int(r.seq), r.end_ts, r.active_flg) for r in first.collect()) == [
        ("a", 1, 1, None, "Y"),
        ("b", 2, 1, None, "Y"),
    ]
    batch = frame(
        "id string, color string, at timestamp_ntz", ("a", "blue", T2), ("a", "green", T3), ("c", "red", T2), ("b", "red", T3)
    )
    deleted = frame("id string", ("c",))
    registry = KeyRegistry.of_dimension(first, new_folder(first.sparkSession, "registry"))
    for how in (
        {}, {"batch_keys_only": True}, {"broadcast_changes": 0}, {"registry": registry, "load": "2"}
    ):
        second = scd2_load(first, batch, deleted=deleted, deleted_on=["id"], **how, **options)
        got = sorted((r.id, int(r.sk), r.start_ts, r.end_ts, r.active_flg, r.reporting_flg) for r in second.collect())
        assert got == [
            ("a", 1, T1, T2, "N", "N"),
            ("a", 1, T2, T3, "N", "N"),
            ("a", 1, T3, None, "Y", "Y"),
            ("b", 2, T1, T3, "N", "N"),
            ("b", 2, T3, None, "Y", "Y"),
            ("c", 5, T2, T4, "N", "Y"),
        ]
    numbers = {(r.id, r.start_ts): int(r.seq) for r in second.collect()}
    assert numbers["b", T3] == 1  # the same version again keeps its number
    assert sorted(n for (key, _), n in numbers.items() if key == "a") == [1, 2, 3]


def test_split_live_is_a_partition(frame):
    dim = frame(
        "a int, active_flg string, reporting_flg string", (1, "Y", "N"), (2, "N", "Y"), (3, "N", "N"), (4, None, None), (5, None, "Y")
    )
    live, history = split_live(dim)
    assert sorted(r.a for r in live.collect()) == [1, 2, 5]
    assert sorted(r.a for r in history.collect()) == [3, 4]


def test_hashes_are_what_the_load_uses(frame):
    df = frame("id string", (" a ",))
    assert df.select(hash_key(["id"]).alias("h")).where(F.col("h") == F.sha2(F.lit("A"), 256)).count() == 1


def test_hashes_are_staged_compressed(spark):
    df = spark.range(3000).select((F.col("id") % 7).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    numbered = row_number_per_key(df, ["k"], ["h"], "rn", unique_order=True)
    staged = [f for f in numbered.inputFiles() if "/ranged-" in f]
    assert staged and all(f.endswith(".zstd.parquet") for f in staged)
    sizes = [sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in stage(df, codec=c).inputFiles()) for c in ("snappy", "zstd")]
    assert sizes[1] < 0.7 * sizes[0]
    assert numbered.where("rn = 1").count() == 7
