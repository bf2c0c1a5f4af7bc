"""File sources. The files are written by Spark from the customer table first."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import (
    LOAD_TS,
    SQL_LOAD_TS,
    SQL_OLD_STAMPS,
    SQL_OLD_TS,
    SQL_STAMPS,
    STAMPS,
    OLD_BATCH,
    OLD_TS,
    query,
    stamped,
    table,
    ts,
)
from pyspark.errors import StreamingQueryException

from millrace.plans.loads import file_to_bronze, file_to_bronze_once, file_to_stage
from millrace.operators.merge import conform
from millrace.session import new_folder
from millrace.sources.files import (
    infer_file_schema,
    load_files_by_name,
    load_files_replace,
    load_files_with_mapping,
)
from millrace.sources.inference import clashing_files, file_columns, merged_columns
from millrace.streaming.ingest import ingest_new_files
from millrace.streaming.ledger import OnceTable

TYPED = T.StructType().add("c_custkey", "integer").add("c_name", "string").add("c_acctbal", "double")


def customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")


def csv_files(spark, df, header=True) -> str:
    path = new_folder(spark, "csv")
    df.write.option("header", header).csv(path)
    return path


def bronze_customers(spark, sf):
    """Bronze as the previous load left it: customers in debt."""
    rows = customers(spark, sf).where(F.col("c_acctbal") < 0)
    typed = rows.select([F.col(f.name).cast(f.dataType) for f in TYPED])
    return stamped(typed.withColumn("src_load_ts", ts(OLD_TS)), OLD_BATCH, OLD_TS)


OLD_ROWS = (
    f"SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_acctbal, {SQL_OLD_TS} AS src_load_ts, "
    f"{SQL_OLD_STAMPS} FROM customer WHERE c_acctbal < 0"
)


def new_rows(columns: str) -> str:
    return f"SELECT {columns}, {SQL_LOAD_TS} AS src_load_ts, {SQL_STAMPS} FROM customer"


ALL_COLUMNS = "CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_acctbal"


@query("infer_file_schema", "SELECT * REPLACE (CAST(c_custkey AS INTEGER) AS c_custkey, CAST(c_nationkey AS INTEGER) AS c_nationkey) FROM customer")
def _(spark, sf):
    return infer_file_schema(spark, csv_files(spark, table(spark, sf, "customer")))


def two_layouts(spark, sf) -> str:
    """All columns of the customers in several files, and suppliers in one file among them."""
    path = csv_files(spark, table(spark, sf, "customer").repartition(3))
    table(spark, sf, "supplier").coalesce(1).write.mode("append").option("header", True).csv(path)
    return path


@query(
    "infer_file_schema_columns",
    """SELECT position, name, type, 3 AS files, (SELECT count(*) FROM customer) AS rows
       FROM (VALUES (0, 'c_custkey', 'int'), (1, 'c_name', 'string'), (2, 'c_nationkey', 'int'), (3, 'c_acctbal', 'double'),
             (4, 'c_mktsegment', 'string')) v(position, name, type)""",
)
def _(spark, sf):
    """The schema of the files that agree, from one aggregate over all of them."""
    return merged_columns(file_columns(spark, two_layouts(spark, sf)))


@query(
    "infer_file_schema_clashes",
    "SELECT 's_suppkey,s_name,s_nationkey,s_acctbal' AS columns, count(*) AS rows FROM supplier",
)
def _(spark, sf):
    """The file with another header, and what it holds."""
    columns = file_columns(spark, two_layouts(spark, sf))
    rows = columns.groupBy("file").agg(F.max("rows").alias("rows"))
    return clashing_files(columns).join(rows, "file").select(F.array_join("columns", ",").alias("columns"), "rows")


# Accounts above 9000 are written as text that is no number: bad records.
def spoiled(df):
    text = F.when(F.col("c_acctbal") > 9000, "much").otherwise(F.col("c_acctbal").cast("string"))
    return df.withColumn("c_acctbal", text).withColumnRenamed("c_name", "C_NAME")


STAGE = T.StructType([*TYPED.fields, T.StructField("comment", T.StringType())])
STAGE = STAGE.add("etl_load_ts", "timestamp_ntz").add("etl_updt_ts", "timestamp_ntz")
STAGE_SQL = (
    f"SELECT {ALL_COLUMNS}, CAST(NULL AS VARCHAR) AS comment, {SQL_LOAD_TS} AS etl_load_ts, "
    f"{SQL_LOAD_TS} AS etl_updt_ts FROM customer WHERE c_acctbal <= 9000"
)


@query("load_files_replace", STAGE_SQL)
def _(spark, sf):
    path = csv_files(spark, spoiled(customers(spark, sf)))
    return load_files_replace(spark, path, STAGE, load_ts=LOAD_TS)


@query("load_files_by_name", f"{OLD_ROWS} UNION ALL {new_rows(ALL_COLUMNS)}", ids=("batch_id",))
def _(spark, sf):
    shuffled = customers(spark, sf).selectExpr("c_acctbal AS C_AcctBal", "c_name", "c_custkey")
    target = bronze_customers(spark, sf)
    return load_files_by_name(spark, csv_files(spark, shuffled), target, **STAMPS)


@query(
    "load_files_with_mapping",
    f"{OLD_ROWS} UNION ALL {new_rows('CAST(c_custkey AS INTEGER), NULL, c_acctbal')}",
    ids=("batch_id",),
)
def _(spark, sf):
    path = csv_files(spark, customers(spark, sf), header=False)
    mapping = {"_c0": "c_custkey", "_c2": "c_acctbal"}
    target = bronze_customers(spark, sf)
    return load_files_with_mapping(spark, path, mapping, target, **STAMPS)


@query("ingest_new_files", f"SELECT {ALL_COLUMNS} FROM customer")
def _(spark, sf):
    """Two runs over one folder; the second finds only the files added in between."""
    parts = customers(spark, sf)
    inbox, out = new_folder(spark, "inbox"), new_folder(spark, "ingested")
    checkpoint, archive = new_folder(spark, "offsets"), new_folder(spark, "archive")
    for rows in (parts.where("c_acctbal < 0"), parts.where("c_acctbal >= 0")):
        rows.write.mode("append").option("header", True).csv(inbox)
        stream = ingest_new_files(spark, inbox, archive, TYPED, checkpoint, out, header=True)
        stream.awaitTermination()
    return spark.read.schema(TYPED).parquet(out)


@query("file_to_stage", STAGE_SQL)
def _(spark, sf):
    path = csv_files(spark, spoiled(customers(spark, sf)))
    return file_to_stage(spark, path, STAGE, load_ts=LOAD_TS)


@query("file_to_bronze", new_rows(ALL_COLUMNS), ids=("batch_id",))
def _(spark, sf):
    path = csv_files(spark, customers(spark, sf), header=False)
    mapping = {"_c0": "c_custkey", "_c1": "c_name", "_c2": "c_acctbal"}
    target = bronze_customers(spark, sf)
    return file_to_bronze(
        spark, path, target, header=False, mapping=mapping, truncate=True, **STAMPS
    )


class Failing(OnceTable):
    """A table whose second batch fails once, after it was entered: the stream will replay it."""

    failed = False

    def enter(self, stream, batch):
        super().enter(stream, batch)
        if batch == 1 and not self.failed:
            self.failed = True
            raise RuntimeError("lost after the entry, before the stream's commit")


@query("file_to_bronze_once", new_rows(ALL_COLUMNS), ids=("batch_id",))
def _(spark, sf):
    """Two deliveries. The second run dies, the third replays its batch and finds it entered."""
    target = bronze_customers(spark, sf)
    inbox, checkpoint = new_folder(spark, "inbox"), new_folder(spark, "offsets")
    once = Failing(spark, new_folder(spark, "bronze"), target.schema)
    parts = customers(spark, sf)

    def run():
        mapping = {"_c0": "c_custkey", "_c1": "c_name", "_c2": "c_acctbal"}
        positions = T.StructType([T.StructField(c, TYPED[n].dataType) for c, n in mapping.items()])
        return file_to_bronze_once(
            spark, inbox, None, once, positions, checkpoint, header=False, mapping=mapping, **STAMPS
        )

    parts.where("c_acctbal < 0").write.csv(inbox)
    run()
    parts.where("c_acctbal >= 0").write.mode("append").csv(inbox)
    try:
        run()
    except StreamingQueryException:
        pass
    return run()


@query(
    "file_to_bronze_once_ledger",
    """SELECT 'files' AS _stream, CAST(0 AS BIGINT) AS _batch, count(*) AS rows FROM customer WHERE c_acctbal < 0
       UNION ALL SELECT 'files', 1, count(*) FROM customer WHERE c_acctbal >= 0""",
)
def _(spark, sf):
    """What the ledger has after two batches, each handed over twice."""
    target = bronze_customers(spark, sf)
    once = OnceTable(spark, new_folder(spark, "bronze"), target.schema)
    rows = conform(customers(spark, sf), target.schema)
    for number, part in enumerate((rows.where("c_acctbal < 0"), rows.where("c_acctbal >= 0"))):
        for _ in range(2):
            once.append_once(part, "files", number)
    return once.ledger()
