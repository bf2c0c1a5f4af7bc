from millrace.streaming.ingest import apply_new_files, ingest_new_files
from millrace.streaming.ledger import OnceTable, consume_files
from millrace.streaming.versions import VersionedTable, stream_deletion_log

__all__ = [
    "OnceTable",
    "VersionedTable",
    "apply_new_files",
    "consume_files",
    "ingest_new_files",
    "stream_deletion_log",
]
