"""Projections and scalar expressions (all JVM-side, no UDFs)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_TYPE = T.DecimalType(38, 0)

# Bookkeeping columns a load ignores when it compares schemas.
BOOKKEEPING = ("batch_id", "etl_load_ts", "etl_updt_ts")
BOOKKEEPING_WITH_SOURCE_TS = ("src_load_ts", "batch_id", "etl_load_ts", "etl_updt_ts")

# Journal envelope columns, and attributes never unpacked.
JOURNAL_ENVELOPE = (
    "primary_key__pk",
    "event_type",
    "most_significant_position",
    "least_significant_position",
    "seen_at",
    "sf_metadata",
)
JOURNAL_METADATA = (
    *JOURNAL_ENVELOPE,
    "src_journal_tbl",
    "src_load_ts",
    "batch_id",
    "etl_load_ts",
    "etl_updt_ts",
)
UNPACK_SKIP = ("_snowflake_inserted_at", "_snowflake_updated_at", "_snowflake_deleted")


def as_ts(value: Column | datetime | str | None) -> Column:
    """A zone-less timestamp from a literal or a column."""
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast("timestamp_ntz")


def as_batch(value: Column | Decimal | int | str | None) -> Column:
    # An int beyond 64 bits has no Spark literal, so numbers travel as text.
    column = value if isinstance(value, Column) else F.lit(None if value is None else str(value))
    return column.cast(BATCH_TYPE)


def stamp_audit(
    df: DataFrame,
    *,
    batch_id: Column | Decimal | int | str,
    load_ts: Column | datetime | str,
    src_load_ts: Column | datetime | str | None = None,
) -> DataFrame:
    """Add the batch id and load times; optionally the source time."""
    stamps = {}
    if src_load_ts is not None:
        stamps["src_load_ts"] = as_ts(src_load_ts)
    stamps["batch_id"] = as_batch(batch_id)
    stamps["etl_load_ts"] = as_ts(load_ts)
    stamps["etl_updt_ts"] = as_ts(load_ts)
    return df.withColumns(stamps)


def strip_bookkeeping(df: DataFrame, cols: Iterable[str] = BOOKKEEPING) -> DataFrame:
    return df.drop(*cols)


def align_to_target(
    source: DataFrame, target_cols: Sequence[str], ignore: Iterable[str] = BOOKKEEPING
) -> DataFrame:
    """Source columns in target order; a differing set of names is an error.

    Names compare without regard to case, as a column catalog does. Bookkeeping
    columns are left out on both sides.
    """
    skip = {c.lower() for c in ignore}
    wanted = [c for c in target_cols if c.lower() not in skip]
    have = {c.lower(): c for c in source.columns if c.lower() not in skip}
    expected = {c.lower() for c in wanted}
    if expected != set(have):
        raise ValueError(
            "source and target columns differ: "
            f"missing {sorted(expected - set(have))}, unexpected {sorted(set(have) - expected)}"
        )
    return source.select([F.col(f"`{have[c.lower()]}`").alias(c) for c in wanted])


def rename_by_mapping(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.select([F.col(f"`{old}`").alias(new) for old, new in mapping.items()])


def _layout_rank(name: str) -> int:
    name = name.lower()
    if name == "pk":
        return 0
    if name.endswith("_pk"):
        return 1
    if name.endswith("_id"):
        return 2
    if name.startswith("is_"):
        return 3
    if name.startswith("_snowflake"):
        return 7
    if name.endswith("_metric"):
        return 5
    if name.endswith(("_date", "_timestamp")):
        return 6
    return 4


def conform_layout(df: DataFrame) -> DataFrame:
    """Columns ordered by naming rule, bookkeeping columns last."""
    tail = [c for c in BOOKKEEPING_WITH_SOURCE_TS if c in df.columns]
    body = sorted((c for c in df.columns if c not in tail), key=_layout_rank)
    return df.select(*body, *tail)


def pack_attributes(
    df: DataFrame,
    envelope_cols: Sequence[str] = JOURNAL_ENVELOPE,
    out: str = "attribute_value_json",
) -> DataFrame:
    """Fold every non-envelope column into one JSON object; NULLs are left out."""
    envelope = {c.lower() for c in envelope_cols}
    kept = [c for c in df.columns if c.lower() in envelope]
    packed = sorted(c for c in df.columns if c.lower() not in envelope)
    body = F.to_json(F.struct(*packed)) if packed else F.lit("{}")
    return df.select(*kept, body.alias(out))


def unpack_attributes(
    df: DataFrame,
    schema: T.StructType,
    prefix: str = "PAYLOAD__",
    skip: Iterable[str] = UNPACK_SKIP,
    packed: str = "attribute_value_json",
) -> DataFrame:
    """Typed columns from the packed JSON, then the other columns of ``df``.

    One ``from_json`` parses all attributes of a row at once.
    """
    rest = [c for c in df.columns if c != packed]
    left_out = {c.lower() for c in (*skip, *rest)}
    fields = [f for f in schema.fields if f.name.lower() not in left_out]
    parsed_type = T.StructType([T.StructField(prefix + f.name.upper(), f.dataType) for f in fields])
    parsed = df.withColumn("_parsed", F.from_json(F.col(packed), parsed_type))
    typed = [F.col(f"_parsed.`{prefix}{f.name.upper()}`").alias(f.name) for f in fields]
    return parsed.select(*typed, *rest)


def pack_variant(
    df: DataFrame, envelope_cols: Sequence[str] = JOURNAL_ENVELOPE, out: str = "attributes"
) -> DataFrame:
    """Fold every non-envelope column into one VARIANT object.

    Structs, arrays, dates, times and decimals stay what they are inside, where JSON text would
    make text or doubles of them; JSON text is a nested value after ``parse_json``.
    """
    envelope = {c.lower() for c in envelope_cols}
    kept = [c for c in df.columns if c.lower() in envelope]
    packed = sorted(c for c in df.columns if c.lower() not in envelope)
    body = F.to_variant_object(F.struct(*packed)) if packed else F.parse_json(F.lit("{}"))
    return df.select(*kept, body.alias(out))


def unpack_variant(
    df: DataFrame, schema: T.StructType, packed: str = "attributes", paths: Mapping[str, str] | None = None
) -> DataFrame:
    """Typed columns from a VARIANT object, then the other columns of ``df``.

    A field comes from the attribute of its name, or from the path given for it
    (``$.customer.address[0]``). An attribute that is absent, or doesn't fit the type, is NULL.
    """
    where = dict(paths or {})
    rest = [c for c in df.columns if c != packed]
    typed = [
        F.try_variant_get(F.col(packed), where.get(f.name, f"$['{f.name}']"), f.dataType.simpleString()).alias(f.name)
        for f in schema.fields
        if f.name not in rest
    ]
    return df.select(*typed, *rest)


def variant_schema(df: DataFrame, packed: str = "attributes") -> DataFrame:
    """The schema that all objects of a VARIANT column have together, as one row (``schema``)."""
    return df.agg(F.schema_of_variant_agg(packed).alias("schema"))


def hash_key(
    cols: Sequence[str | Column],
    null_sentinel: str = "^^",
    sep: str = "||",
    null_if_all_blank: bool = False,
) -> Column:
    """SHA-256 of the trimmed, upper-cased key texts.

    A blank or NULL part counts as the sentinel. The result is NULL when the
    joined text equals two sentinels, whatever the number of columns; with
    ``null_if_all_blank`` it is NULL when every part is blank.
    """
    parts = []
    for c in cols:
        column = F.col(c) if isinstance(c, str) else c
        parts.append(
            F.coalesce(F.nullif(F.upper(F.trim(column.cast("string"))), F.lit("")), F.lit(null_sentinel))
        )
    blanks = sep.join([null_sentinel] * (len(parts) if null_if_all_blank else 2))
    return F.sha2(F.nullif(F.concat_ws(sep, *parts), F.lit(blanks)), 256)


def batch_id_from_ts(ts: str | Column) -> Column:
    """Digits of the time down to nanoseconds as a number.

    Built from the text of the timestamp, so no session time zone is involved.
    """
    column = F.col(ts) if isinstance(ts, str) else ts
    digits = F.regexp_replace(column.cast("timestamp_ntz").cast("string"), "[^0-9]", "")
    return F.rpad(digits, 23, "0").cast(BATCH_TYPE)


def blank_safe_key_equal(
    a: Column, b: Column, mode: str = "blank_never", is_string: bool = True
) -> Column:
    """Key equality under one of two conventions.

    ``blank_never``: blank and NULL match nothing.
    ``blank_is_null``: blank and NULL match each other.
    Blank only exists for strings; other types use ``=`` and ``<=>``.
    """
    if mode == "blank_never":
        return F.nullif(a, F.lit("")) == F.nullif(b, F.lit("")) if is_string else a == b
    if mode == "blank_is_null":
        if is_string:
            return F.coalesce(a, F.lit("")) == F.coalesce(b, F.lit(""))
        return a.eqNullSafe(b)
    raise ValueError(f"unknown key mode {mode!r}")


def key_json(keys: Sequence[str]) -> Column:
    """Canonical key object: names sorted, NULL members left out."""
    return F.to_json(F.struct(*[F.col(k) for k in sorted(keys)]))
