"""Change journals: segments of row images with event type, position and time."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import JOURNAL_ENVELOPE, as_ts, pack_attributes, stamp_audit
from millrace.operators.filters import incremental_filter, key_present, name_filter
from millrace.operators.merge import conform, delete_insert_by_watermark
from millrace.operators.sets import top_k_newest, union_all


def _segments_of(segments: DataFrame, table: str, exact_name: bool) -> DataFrame:
    named = name_filter(segments, "table_name", lacks="SNAPSHOT")
    if exact_name:
        name = F.upper(F.trim("table_name"))
        expected = F.concat(F.lit(table.upper() + "_"), F.split_part(name, F.lit("_"), F.lit(-1)))
        named = named.where(name == expected)
    else:
        named = name_filter(named, "table_name", contains=table)
    return named


def newest_journal_segments(
    segments: DataFrame, table: str, k: int = 2, *, exact_name: bool = True
) -> DataFrame:
    """The k newest segments of a table, snapshots left out.

    Segments are called ``<table>_<last token>``. ``exact_name=False`` accepts any
    name that contains the table's, as a schema lookup does.
    """
    return top_k_newest(_segments_of(segments, table, exact_name), ["created", "table_name"], k)


def segments_above(
    segments: DataFrame, table: str, since=None, *, exact_name: bool = True
) -> DataFrame:
    """All segments of a table that can hold rows above the watermark.

    A segment holds rows from its creation on, so these are the ones created after
    the watermark and the newest one created before. One without a creation time
    is always among them.
    """
    named = _segments_of(segments, table, exact_name)
    if since is None:
        return named
    created, mark = as_ts(F.col("created")), as_ts(since)
    before = named.where(created <= mark).agg(F.max(created).alias("created")).scalar()
    return named.where(created.isNull() | (created >= F.coalesce(before, mark)))


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:/*"


class Scan(NamedTuple):
    """Segments read together: their names, and their rows with the name in ``src_journal_tbl``."""

    names: list[str]
    rows: DataFrame


def read_segments(
    spark: SparkSession, folders: Mapping[str, str], schema: T.StructType | str | None = None, fmt: str = "parquet"
) -> Scan:
    """All segments in one scan, whatever their number.

    ``folders`` has a segment's folder by its name, with the files directly in it. A row's segment
    is the folder of the file it comes from, so the plan has one scan and one join with the list of names. Columns that only some
    segments have are NULL in the others if ``schema`` names them.
    """
    reader = spark.read.format(fmt)
    reader = reader.option("mergeSchema", True) if schema is None else reader.schema(schema)
    rows = reader.load(list(folders.values())).withColumn("_file", F.col("_metadata.file_path"))
    # File paths are URLs; of those and of the folders as given only the path counts.
    path = F.url_decode(F.regexp_replace("_file", "[+]", "%2B"))
    folder = F.regexp_replace(F.regexp_replace(path, _SCHEME, "/"), "/[^/]*$", "")
    own = [(re.sub(_SCHEME, "/", f).rstrip("/"), name) for name, f in folders.items()]
    names = F.broadcast(spark.createDataFrame(own, "_folder string, src_journal_tbl string"))
    unknown = F.raise_error(F.concat(F.lit("no segment has the file "), F.col("_file")))
    named = rows.withColumn("_folder", folder).join(names, "_folder", "left")
    named = named.withColumn("src_journal_tbl", F.coalesce("src_journal_tbl", unknown))
    return Scan(list(folders), named.drop("_file", "_folder"))


def union_journals(
    segments: Sequence[tuple[str, DataFrame]],
    key: str = "primary_key__pk",
    ts_col: str = "seen_at",
    since=None,
) -> DataFrame:
    """All selected segments in one plan, with the segment name per row."""
    named = [
        incremental_filter(key_present(df, [key]), ts_col, since).withColumn(
            "src_journal_tbl", F.lit(name)
        )
        for name, df in segments
    ]
    return union_all(named, allow_missing=True)


def journal_reload(
    target: DataFrame,
    segments: Sequence[tuple[str, DataFrame]] | Scan,
    *,
    load_type: str = "incremental",
    since=None,
    batch_id,
    load_ts,
    key: str = "primary_key__pk",
    ts_col: str = "seen_at",
    only_listed: bool = False,
) -> DataFrame:
    """Bronze journal after a reload of the given segments.

    A full load starts empty; otherwise everything above the watermark is
    replaced, with ``only_listed`` everything of these segments. Attributes are packed to JSON, the envelope stays as columns.
    ``segments`` are frames by name, or the names and one frame of all, as ``read_segments`` gives them.
    """
    if isinstance(segments, Scan):
        names, rows = segments.names, incremental_filter(key_present(segments.rows, [key]), ts_col, since)
    else:
        names, rows = [name for name, _ in segments], union_journals(segments, key, ts_col, since)
    packed = pack_attributes(rows, [*JOURNAL_ENVELOPE, "src_journal_tbl"])
    stamped = stamp_audit(packed, batch_id=batch_id, load_ts=load_ts, src_load_ts=F.col("seen_at"))
    if load_type == "full":
        return conform(stamped, target.schema)
    if not only_listed:
        return delete_insert_by_watermark(target, stamped, ts_col, since)
    listed = F.coalesce(F.upper("src_journal_tbl").isin([n.upper() for n in names]), F.lit(False))
    reloaded = delete_insert_by_watermark(target.where(listed), stamped, ts_col, since)
    return target.where(~listed).unionByName(reloaded)

