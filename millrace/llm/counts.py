"""Exact corpus counts of n-grams for every document, by exchanging sorted key blocks.

Documents are packed into blocks (``blocks``). Each block counts its distinct keys and
sends them, cut by key range, to the ranges' tasks (``requests``); these add up the
counts of all blocks (``totals``) and answer every block with the totals in the
order of its keys, so no key travels back. A frequent key is one entry per
block, whatever its number of occurrences, so no range is hot. Blocks and ranges
are as many as the text has bytes for, not as there are partitions, and a pair of both
that share no key sends no row: there are never more rows than distinct keys of blocks.

Keys travel sorted, as planes of their bytes: the high planes of sorted keys hardly
change, and those of small numbers are zero, so both nearly vanish when compressed. As rows of a
Spark aggregate and a join back they take some 15 bytes twice: about 110 million of them for
0.5 GB of input, beyond the disk that four times the input allows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

REQUESTS = "range int, block bigint, kind int, keys binary, counts binary"
TOTALS = "block bigint, range int, kind int, totals binary, n_keys bigint, n_all bigint"


RANGE_BYTES = 16 << 20  # of text whose keys one range gets


def planes(values: np.ndarray) -> bytes:
    """64-bit numbers as their highest bytes, then the next ones, down to the lowest; compressed."""
    raw = values.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def of_planes(data: bytes) -> np.ndarray:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    columns = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(columns.T).view(">u8").ravel().astype(np.uint64)


def _joined(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows, and where each row's end."""
    rows = column.to_pylist()
    ends = np.cumsum([int.from_bytes(r[:8], "little") // 8 for r in rows])
    out, a = np.empty(ends[-1], np.uint64), 0
    for row, b in zip(rows, ends):
        out[a:b] = of_planes(row)
        a = b
    return out, ends


def n_ranges(text_bytes: int, range_bytes: int = RANGE_BYTES) -> int:
    return text_bytes // range_bytes + 1


def _edges(ranges: int, bits: int) -> np.ndarray:
    """First key of every range but the first."""
    return np.array([(k << bits) // ranges + 1 for k in range(1, ranges)], np.uint64)


def requests(block: int, keys: dict[int, tuple[np.ndarray, np.ndarray, int]], ranges: int) -> list[dict]:
    """Rows of ``REQUESTS``. keys: kind -> (sorted distinct keys, their counts, bits of a key)."""
    rows = []
    for kind, (values, counts, bits) in keys.items():
        cuts = [0, *np.searchsorted(values, _edges(ranges, bits)), len(values)]
        for k in range(ranges):
            a, b = int(cuts[k]), int(cuts[k + 1])
            if a < b:
                keys_, counts_ = planes(values[a:b]), planes(counts[a:b])
                rows.append({"range": k, "block": block, "kind": kind, "keys": keys_, "counts": counts_})
    return rows


def as_table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


REQUEST_ARROW = pa.schema([
    ("range", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()),
    ("keys", pa.binary()), ("counts", pa.binary()),
])
TOTAL_ARROW = pa.schema([
    ("block", pa.int64()), ("range", pa.int32()), ("kind", pa.int32()),
    ("totals", pa.binary()), ("n_keys", pa.int64()), ("n_all", pa.int64()),
])


def totals(table: pa.Table) -> pa.Table:
    """Answers for one range and kind. One row without block has the range's own sums:
    keys with a count, and all counts."""
    blocks = table.column("block").to_pylist()
    # A task's largest arrays: each goes as soon as it can.
    keys, ends = _joined(table.column("keys"))
    by_key = np.argsort(keys, kind="stable")  # rows come sorted
    keys = keys[by_key]
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    del keys
    first = np.flatnonzero(new)
    del new
    answers, _ = _joined(table.column("counts"))
    answers = answers[by_key]
    total = np.add.reduceat(answers, first)
    answers[by_key] = np.repeat(total, np.diff(first, append=len(answers)))
    del by_key, first
    at, kind = table.column("range")[0].as_py(), table.column("kind")[0].as_py()
    rows, a = [], 0
    for block, b in zip(blocks, ends):
        rows.append({"block": block, "range": at, "kind": kind, "totals": planes(answers[a:b])})
        a = b
    rows.append({
        "block": None, "range": at, "kind": kind, "totals": None,
        "n_keys": int((total > 0).sum()), "n_all": int(total.sum()),
    })
    return as_table(rows, TOTAL_ARROW)


def answered(table: pa.Table, kind: int) -> np.ndarray:
    """The totals of a block's sorted distinct keys of one kind."""
    rows = sorted(
        (k, t)
        for k, x, t in zip(*(table.column(c).to_pylist() for c in ("range", "kind", "totals")))
        if x == kind
    )
    return np.concatenate([of_planes(t) for _, t in rows] or [np.zeros(0, np.uint64)]).astype(np.int64)
