"""What tasks and the workers between them hold."""

import gc
import tracemalloc

import numpy as np
import pyarrow as pa

from millrace.llm import blocks, counts, tokens
from millrace.llm.packing import pack
from millrace.llm.queries import vocabulary


def test_batches_for_python_are_bounded_by_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    docs = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('some words ', 800) AS text")
    found = docs.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in found) == 3000 and max(r.size for r in found) < 6 << 20  # 26 MB in one before


def test_a_vocabulary_goes_when_another_step_begins(spark):
    def encoders(batches):
        list(batches)
        held = sum(isinstance(x, tokens.PartEncoder) for x in gc.get_objects())
        yield pa.RecordBatch.from_arrays([pa.array([held])], ["held"])

    docs = spark.range(0, 64, 1, 64).selectExpr("id AS doc_id", "concat('word ', id) AS text")
    assert pack(docs, vocabulary()).count() == 64
    assert blocks.pack_blocks(docs).count() == 64
    assert {r.held for r in docs.mapInArrow(encoders, "held long").collect()} == {0}


def test_totals_of_a_range_hold_few_arrays():
    rng = np.random.default_rng(23)
    rows, asked = [], []
    for block in range(6):
        keys = np.unique(np.concatenate([rng.integers(0, 1 << 48, 50_000, dtype=np.uint64), rng.integers(0, 9000, 3000, dtype=np.uint64)]))
        times = rng.integers(0, 9, len(keys))
        asked.append((keys, times))
        rows += counts.requests(block, {0: (keys, times, 48)}, 1)
    expected = {}
    for keys, times in asked:
        for k, t in zip(keys.tolist(), times.tolist()):
            expected[k] = expected.get(k, 0) + t
    table = counts.as_table(rows, counts.REQUEST_ARROW)
    tracemalloc.start()
    try:
        out = counts.totals(table)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 55 * sum(len(k) for k, _ in asked)  # bytes; 70 a key before
    answers = out.to_pylist()
    for (keys, _), row in zip(asked, answers):
        assert counts.of_planes(row["totals"]).tolist() == [expected[k] for k in keys.tolist()]
    assert answers[-1]["n_keys"] == sum(t > 0 for t in expected.values()) and answers[-1]["n_all"] == sum(expected.values())
