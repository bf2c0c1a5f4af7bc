"""Projections: order, NULLs, blanks."""

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import (
    align_to_target,
    batch_id_from_ts,
    blank_safe_key_equal,
    conform_layout,
    hash_key,
    key_json,
    pack_attributes,
    pack_variant,
    stamp_audit,
    unpack_attributes,
    unpack_variant,
    variant_schema,
)
from millrace.operators.filters import incremental_filter, name_filter


def test_stamp_types(frame):
    df = stamp_audit(
        frame("k int", (1,)), batch_id="20260101000000000000000", load_ts="2026-01-01", src_load_ts="2025-12-31"
    )
    assert dict(df.dtypes) == {
        "k": "int",
        "src_load_ts": "timestamp_ntz",
        "batch_id": "decimal(38,0)",
        "etl_load_ts": "timestamp_ntz",
        "etl_updt_ts": "timestamp_ntz",
    }
    assert int(df.first().batch_id) == 20260101000000000000000


def test_align_ignores_case_and_bookkeeping(frame):
    source = frame("B int, A int, batch_id int", (2, 1, 9))
    assert align_to_target(source, ["a", "b", "batch_id", "etl_load_ts"]).columns == ["a", "b"]


@pytest.mark.parametrize("columns", ["a int", "a int, b int, c int"])
def test_align_rejects_other_columns(frame, columns):
    with pytest.raises(ValueError, match="differ"):
        align_to_target(frame(columns), ["a", "b"])


def test_layout_first_rule_wins(frame):
    names = (
        "batch_id a_date x _snowflake_id size_metric is_new other_pk _snowflake_deleted pk user_id "
        "src_load_ts done_timestamp etl_updt_ts etl_load_ts b"
    ).split()
    df = frame(", ".join(f"{n} int" for n in names))
    assert conform_layout(df).columns == (
        "pk other_pk _snowflake_id user_id is_new x b size_metric a_date done_timestamp "
        "_snowflake_deleted src_load_ts batch_id etl_load_ts etl_updt_ts"
    ).split()


def test_pack_drops_nulls_and_unpack_restores(frame):
    df = frame("pk int, PAYLOAD__B string, PAYLOAD__A int", (1, "x", None), (2, None, None))
    packed = pack_attributes(df, ["pk"])
    assert [r.attribute_value_json for r in packed.orderBy("pk").collect()] == [
        '{"PAYLOAD__B":"x"}',
        "{}",
    ]
    schema = T.StructType().add("a", "integer").add("b", "string").add("_snowflake_deleted", "string")
    restored = unpack_attributes(packed, schema)
    assert restored.columns == ["a", "b", "pk"]
    assert sorted(map(tuple, restored.collect()), key=repr) == [(None, "x", 1), (None, None, 2)]


def test_pack_without_attributes(frame):
    assert pack_attributes(frame("pk int", (1,)), ["pk"]).first().attribute_value_json == "{}"


def test_hash_only_the_two_blank_text_is_null(frame):
    df = frame("a string, b string", (None, "  "), (" x", None), ("X", ""))
    h2 = [r[0] for r in df.select(hash_key(["a", "b"])).collect()]
    expected = hashlib.sha256(b"X||^^").hexdigest()
    assert h2 == [None, expected, expected]
    one = df.select(hash_key(["b"]), hash_key(["b"], null_if_all_blank=True)).collect()
    assert one[0][0] == hashlib.sha256(b"^^").hexdigest()
    assert one[0][1] is None
    three = df.select(hash_key(["a", "b", "b"])).collect()
    assert three[0][0] == hashlib.sha256(b"^^||^^||^^").hexdigest()


@pytest.mark.parametrize(
    "moment, digits",
    [
        (dt.datetime(2024, 1, 2, 3, 4, 5), "20240102030405000000000"),
        (dt.datetime(2024, 1, 2, 3, 4, 5, 60), "20240102030405000060000"),
        (dt.datetime(2024, 12, 31, 23, 59, 59, 500000), "20241231235959500000000"),
    ],
)
def test_batch_id_has_nine_fraction_digits(frame, moment, digits):
    df = frame("ts timestamp_ntz", (moment,))
    assert str(df.select(batch_id_from_ts("ts")).first()[0]) == digits


def test_blank_conventions(frame):
    df = frame("a string, b string", ("", ""), ("", None), (None, None), ("x", "x"), ("x", "y"))
    never = [r[0] for r in df.select(blank_safe_key_equal(F.col("a"), F.col("b"))).collect()]
    assert never == [None, None, None, True, False]
    same = df.select(blank_safe_key_equal(F.col("a"), F.col("b"), "blank_is_null")).collect()
    assert [r[0] for r in same] == [True, True, True, True, False]


def test_key_json_is_canonical(frame):
    df = frame("b int, a string", (1, "x"), (None, "y"))
    assert [r[0] for r in df.select(key_json(["b", "a"])).collect()] == ['{"a":"x","b":1}', '{"a":"y"}']


def test_watermark_is_strict_and_defaults_to_1900(frame, rows):
    df = frame(
        "k int, ts timestamp_ntz",
        (1, dt.datetime(1899, 1, 1)),
        (2, dt.datetime(2024, 1, 1)),
        (3, dt.datetime(2024, 1, 2)),
        (4, None),
    )
    assert rows(incremental_filter(df, "ts"), "k") == [(2,), (3,)]
    assert rows(incremental_filter(df, "ts", dt.datetime(2024, 1, 1)), "k") == [(3,)]


def test_name_filter_trims_and_ignores_case(frame, rows):
    df = frame("n string", (" Orders_1",), ("orders_SNAPSHOT_2",), ("lines_1",))
    assert rows(name_filter(df, "n", contains="ORDERS", lacks="snapshot")) == [(" Orders_1",)]
    assert rows(name_filter(df, "n", equals="orders_1")) == [(" Orders_1",)]


def test_variant_keeps_types_that_json_text_loses(spark, tmp_path):
    """Numbers beyond a double, times to the microsecond, text that looks like a number, nesting."""
    at = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    rows = [
        (1, Decimal("12345678901234567890"), at, "007", ([1, None], {"a": 1.5}), None),
        (2, None, None, "", ([], {}), "x"),
        (3, Decimal(-1), at, None, None, "y"),
    ]
    df = spark.createDataFrame(
        rows, "id int, n decimal(38,0), at timestamp_ntz, code string, deep struct<l:array<int>,m:map<string,double>>, o string"
    )
    packed = pack_variant(df, ["ID"])
    assert packed.columns == ["id", "attributes"]
    packed.write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    back = unpack_variant(stored, df.drop("id").schema).select(*df.columns)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    schema = T.StructType.fromDDL("x int, first int, missing string, code int, id string")
    other = unpack_variant(stored, schema, paths={"x": "$.deep", "first": "$.deep.l[0]"})
    # What doesn't fit is NULL; a column beside the object isn't taken from it.
    got = sorted(map(tuple, other.select("id", "x", "first", "missing", "code").collect()))
    assert got == [(1, None, 1, None, 7), (2, None, None, None, None), (3, None, None, None, None)]
    assert "deep: OBJECT<l: ARRAY<BIGINT>, m: OBJECT<a: " in variant_schema(stored).first().schema
    assert pack_variant(df.select("id"), ["id"]).count() == 3
