from millrace.sources.bucketed import bucket_count, open_bucketed, save_bucketed
from millrace.sources.files import (
    const_table,
    infer_file_schema,
    load_files_by_name,
    load_files_replace,
    load_files_with_mapping,
    table_ref_filter,
)
from millrace.sources.sinks import save_partitions, save_state, touched_partitions

__all__ = [
    "bucket_count",
    "const_table",
    "infer_file_schema",
    "load_files_by_name",
    "load_files_replace",
    "load_files_with_mapping",
    "open_bucketed",
    "save_bucketed",
    "save_partitions",
    "save_state",
    "table_ref_filter",
    "touched_partitions",
]
