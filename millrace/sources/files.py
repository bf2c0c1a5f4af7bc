"""File sources: CSV, JSON and parquet folders to frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import BOOKKEEPING_WITH_SOURCE_TS, rename_by_mapping, stamp_audit
from millrace.operators.merge import append_load, conform
from millrace.sources.inference import csv_schema

_CORRUPT = "_corrupt_record"

# Files of one load must have their columns in the same order: compare each
# header with the schema and fail, where the default would go by position.
CHECK_HEADERS = {"enforceSchema": False}


def infer_file_schema(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    header: bool = True,
    schema: T.StructType | None = None,
    **options,
) -> DataFrame:
    """Files as a typed frame, columns in file order.

    CSV and JSON types are inferred in an extra pass over the files; pass
    ``schema`` (or ``samplingRatio`` for JSON) to avoid it on large inputs. For CSV that pass is one
    aggregate (``inference.file_columns``), which also tells files of another header apart.
    """
    if fmt == "csv" and schema is None:
        schema = csv_schema(spark, path, header, **options)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.options(header=header, **CHECK_HEADERS)
    return reader.options(**options).format(fmt).load(path)


def _read_text_columns(spark: SparkSession, path: str, fmt: str, header: bool, **options) -> DataFrame:
    """Files with every column still as text; malformed records left out."""
    if fmt == "parquet":
        return spark.read.options(**options).parquet(path)
    if fmt == "json":
        df = spark.read.options(**options).option("primitivesAsString", True).json(path)
        if _CORRUPT not in df.columns:
            return df
        # All fields stay referenced, or the parser would not notice bad records.
        return df.where(F.col(_CORRUPT).isNull()).drop(_CORRUPT)
    # Reads the first line of a file only: names, no type inference.
    names = spark.read.options(**options).option("header", header).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _CORRUPT]])
    return (
        spark.read.schema(schema)
        .options(header=header, columnNameOfCorruptRecord=_CORRUPT, **CHECK_HEADERS)
        .options(**options)
        # With pruning on, a wrong number of fields goes unnoticed whenever the
        # query above does not need all columns.
        .option("columnPruning", False)
        .csv(path)
        .where(F.col(_CORRUPT).isNull())
        .drop(_CORRUPT)
    )


def load_files_replace(
    spark: SparkSession,
    path: str,
    target_schema: T.StructType,
    fmt: str = "csv",
    *,
    header: bool = True,
    load_ts=None,
    **options,
) -> DataFrame:
    """The new content of a stage table: file columns matched by name without case.

    A record with the wrong number of fields, or with a value that does not fit
    its column, is skipped. Target columns the files lack are NULL. With
    ``load_ts`` the load times of the target are stamped.
    """
    raw = _read_text_columns(spark, path, fmt, header, **options)
    have = {c.lower(): c for c in raw.columns}
    fields = [f for f in target_schema.fields if f.name.lower() in have]
    source = {f.name: F.col(f"`{have[f.name.lower()]}`") for f in fields}
    typed = raw.select(
        *[source[f.name].try_cast(f.dataType).alias(f"_v_{f.name}") for f in fields],
        *[source[f.name].isNotNull().alias(f"_p_{f.name}") for f in fields],
    )
    fits = [F.col(f"_v_{f.name}").isNotNull() | ~F.col(f"_p_{f.name}") for f in fields]
    if fits:
        typed = typed.where(reduce(lambda a, b: a & b, fits))
    rows = typed.select([F.col(f"_v_{f.name}").alias(f.name) for f in fields])
    if load_ts is not None:
        stamps = {c: F.lit(load_ts) for c in ("etl_load_ts", "etl_updt_ts") if c in target_schema.names}
        rows = rows.withColumns(stamps)
    return conform(rows, target_schema)


def _land(target: DataFrame, rows: DataFrame, batch_id, load_ts, truncate: bool) -> DataFrame:
    stamped = stamp_audit(rows, batch_id=batch_id, load_ts=load_ts, src_load_ts=load_ts)
    return conform(stamped, target.schema) if truncate else append_load(target, stamped)


def by_name(landed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The target's columns from a frame's by name without case; bookkeeping isn't expected in files."""
    have = {c.lower(): c for c in landed.columns}
    wanted = [c for c in columns if c.lower() not in BOOKKEEPING_WITH_SOURCE_TS]
    missing = [c for c in wanted if c.lower() not in have]
    if missing:
        raise ValueError(f"files lack target columns {missing}")
    return landed.select([F.col(f"`{have[c.lower()]}`").alias(c) for c in wanted])


def load_files_by_name(
    spark: SparkSession,
    path: str,
    target: DataFrame,
    *,
    fmt: str = "csv",
    batch_id,
    load_ts,
    truncate: bool = False,
    schema: T.StructType | None = None,
    **options,
) -> DataFrame:
    """Files with a header: target columns by name without case, stamped.

    Appended to the target, or in its place with ``truncate``. A target column
    the files lack is an error.
    """
    landed = infer_file_schema(spark, path, fmt, True, schema, **options)
    return _land(target, by_name(landed, target.columns), batch_id, load_ts, truncate)


def load_files_with_mapping(
    spark: SparkSession,
    path: str,
    mapping: Mapping[str, str],
    target: DataFrame,
    *,
    fmt: str = "csv",
    batch_id,
    load_ts,
    truncate: bool = False,
    schema: T.StructType | None = None,
    **options,
) -> DataFrame:
    """Files without a header: positions (``_c0``, ``_c1``, ...) renamed to target columns.

    Target columns outside the mapping stay NULL.
    """
    landed = infer_file_schema(spark, path, fmt, False, schema, **options)
    return _land(target, rename_by_mapping(landed, mapping), batch_id, load_ts, truncate)


def const_table(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """Constant rows, as a ``union all`` of literals would give."""
    return spark.createDataFrame(list(rows), schema)


def table_ref_filter(df: DataFrame, column: str = "id", value=1) -> DataFrame:
    """Rows of another model's output with the given value."""
    return df.where(F.col(column) == value)
