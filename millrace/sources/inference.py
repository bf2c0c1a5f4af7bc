"""What CSV files hold, column by column: one scan and one aggregate over all of them.

Every value is text at first. Per file and column the aggregate counts the
values and how many of them fit each type; a type holds for a column if all values of all files fit
it. The header is a file's first row, so the same aggregate tells which files have
another one: those are reported, and don't take part in the types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types from narrow to wide, and the text that is meant by each.
TYPES = {
    "int": r"[+-]?\d+",
    "bigint": r"[+-]?\d+",
    "double": r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?",
    "date": r"\d{4}-\d{1,2}-\d{1,2}",
    "timestamp": r"\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?)?(Z|[+-]\d{1,2}:?\d{2})?",
    "boolean": r"(?i)true|false",
}


def _fits(value: Column, kind: str) -> Column:
    looks = F.trim(value).rlike(f"^(?:{TYPES[kind]})$")
    return looks & F.trim(value).try_cast(kind).isNotNull()


def file_columns(spark: SparkSession, path: str, header: bool = True, **options) -> DataFrame:
    """(file, position, name, rows, filled, int, bigint, double, date, timestamp, boolean, columns).

    One row per file and column: its name (``_c0``, .. without headers), rows below the
    header, values, how many of them fit each type, and the file's list of names. A file
    without rows but its header counts none. The number of columns is that of the widest header:
    names of narrower files end early.
    """
    width = len(spark.read.options(**options).csv(path).columns)  # of a first line, as the reader takes it
    names = [f"_c{i}" for i in range(width)]
    text = T.StructType([T.StructField(c, T.StringType()) for c in names])
    rows = spark.read.schema(text).options(**options).csv(path).withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            # Splits of a file by their start; within one, rows come in order.
            "_at": F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()),
        }
    )
    counted = [
        F.struct(
            F.count(c).alias("filled"), *[F.count_if(_fits(F.col(c), kind)).alias(kind) for kind in TYPES]
        ).alias(f"_n{i}")
        for i, c in enumerate(names)
    ]
    first = F.min_by(F.array(*names), F.col("_at")).alias("_first")
    per_file = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"), first, *counted)

    lines = F.lit(1 if header else 0)
    own_names = F.col("_first") if header else F.array(*map(F.lit, names))
    columns = per_file.select(
        F.col("_file").alias("file"),
        (F.col("_rows") - lines).alias("rows"),
        F.filter(own_names, lambda n: n.isNotNull()).alias("columns"),
        F.posexplode(F.arrays_zip(own_names.alias("name"), F.array(*[f"_n{i}" for i in range(width)]).alias("n"))).alias(
            "position", "c"
        ),
    ).where("c.name IS NOT NULL")
    # The header's own value isn't one of the column's.
    own = F.when(F.lit(header), 1).otherwise(0)
    counts = [(F.col(f"c.n.{kind}") - own * _fits(F.col("c.name"), kind).cast("int")).alias(kind) for kind in TYPES]
    return columns.select(
        "file", "position", F.col("c.name").alias("name"), "rows", (F.col("c.n.filled") - own).alias("filled"), *counts, "columns"
    )


def _reference(columns: DataFrame) -> DataFrame:
    """The header most files have; of equally many, the one of the first file by name."""
    per_file = columns.select("file", "columns").distinct()
    headers = per_file.groupBy("columns").agg(F.count(F.lit(1)).alias("n"), F.min("file").alias("file"))
    return headers.orderBy(F.desc("n"), "file").limit(1).select(F.col("columns").alias("_reference"))


def clashing_files(columns: DataFrame) -> DataFrame:
    """(file, columns) of the files whose header isn't that of most."""
    per_file = columns.select("file", "columns").distinct()
    return per_file.join(F.broadcast(_reference(columns)), F.col("columns") == F.col("_reference"), "left_anti")


def merged_columns(columns: DataFrame) -> DataFrame:
    """(position, name, type, files, rows): the schema of the files that agree on their header.

    A column's type is the narrowest that all its values fit, text if there is none or
    no value.
    """
    agreeing = columns.join(F.broadcast(_reference(columns)), F.col("columns") == F.col("_reference"), "left_semi")
    sums = agreeing.groupBy("position", "name").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), *[F.sum(c).alias(c) for c in ("filled", *TYPES)]
    )
    kind = F.lit("string")
    for name in reversed(TYPES):
        kind = F.when((F.col("filled") > 0) & (F.col(name) == F.col("filled")), name).otherwise(kind)
    return sums.select("position", "name", kind.alias("type"), "files", "rows")


def csv_schema(spark: SparkSession, path: str, header: bool = True, **options) -> T.StructType:
    """The merged schema of a folder of CSV files: one row per column comes to the driver."""
    rows = merged_columns(file_columns(spark, path, header, **options)).orderBy("position").collect()
    return T.StructType([T.StructField(r["name"], T.DataType.fromDDL(r["type"])) for r in rows])
