from millrace.functions.columns import (
    BOOKKEEPING,
    BOOKKEEPING_WITH_SOURCE_TS,
    align_to_target,
    batch_id_from_ts,
    blank_safe_key_equal,
    conform_layout,
    hash_key,
    key_json,
    pack_attributes,
    rename_by_mapping,
    stamp_audit,
    strip_bookkeeping,
    unpack_attributes,
)

__all__ = [
    "BOOKKEEPING",
    "BOOKKEEPING_WITH_SOURCE_TS",
    "align_to_target",
    "batch_id_from_ts",
    "blank_safe_key_equal",
    "conform_layout",
    "hash_key",
    "key_json",
    "pack_attributes",
    "rename_by_mapping",
    "stamp_audit",
    "strip_bookkeeping",
    "unpack_attributes",
]
