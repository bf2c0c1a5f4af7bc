"""Prefix trie, deduplication index and importance resampling against brute force."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm.cuckoo_dedup import CuckooIndex, DedupIndex, exact_dedup, load_index, save_index
from millrace.llm.importance_resampling import digit_passes, importance_resample, radix_ranks
from millrace.llm.prefix_trie import NODES, RangeMinimum, prefix_trie, regrafted, sequences

# ---------------------------------------------------------------- trie


def trie(rows, group=5, most=8):
    """Nodes of (conv_id, turn, role, text) rows, by prefix."""
    own = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % (most + 1)
        head = c - int(math.fmod(c, group))
        rebuilt[c] = [x[2:] for x in sorted(own.get(head, []))[:h]] + [x[2:] for x in sorted(own[c])[h:]]
    nodes = collections.defaultdict(list)
    for c, w in rebuilt.items():
        for d in range(len(w) + 1):
            nodes[tuple(w[:d])].append(c)
    children = collections.Counter(p[:-1] for p in nodes if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1].encode()) if p else 0
    return collections.Counter(
        (min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(p)).encode()).hexdigest())
        for p, m in nodes.items()
    )


def found_trie(spark, rows, **options):
    wide = [(*r, "x", 1, "k") for r in rows]
    frame = spark.createDataFrame(wide, "conv_id long, turn long, role string, text string, turns string, h int, block string")
    out = prefix_trie(regrafted(sequences(frame)), **options)
    assert out.columns == [c.split()[0] for c in NODES.split(", ")]
    return collections.Counter(map(tuple, out.collect()))


def talk(rng, n, words=3):
    """Conversations of few different turns, so that prefixes are shared at all depths."""
    rows = []
    for c in range(n):
        for t in range(int(rng.integers(1, 9))):
            rows.append((c, t, ("user", "assistant")[t % 2], f"é{rng.integers(0, words)}"))
    return rows


ODD = [
    (10, 0, "user", "a"), (10, None, None, None), (10, None, "user", ""), (11, 5, "user", "a"), (11, 5, "user", "a"), (11, 2, "", "b"),
    (None, 0, "user", "lost"), (12, 0, "user", "w" * 30_000), (13, 0, "us", "era"), (14, 0, "u", "sera"), (-7, 0, "user", "minus"), (-5, 1, "user", "five"),
    (26, 0, "user", "no head"), *((30, t, "user", f"long {t % 7}") for t in range(600)), *((31, t, "user", f"long {t % 7}") for t in range(600)),
]


@pytest.mark.parametrize("block_turns", [1, 7, 40, 1 << 18])
def test_trie_against_brute_force_in_blocks_of_any_size(spark, block_turns):
    rows = talk(np.random.default_rng(4), 60)
    assert found_trie(spark, rows, block_turns=block_turns) == trie(rows)


@pytest.mark.parametrize("block_turns", [60, 1 << 18])
def test_trie_of_odd_rows(spark, block_turns):
    assert found_trie(spark, ODD, block_turns=block_turns) == trie(ODD)


def test_trie_of_a_hot_conversation_and_of_turnless_ones(spark):
    rows = [(5 * c, t, "user", f"turn {t}") for c in range(80) for t in range(3)]
    rows += [(401, 0, "user", "x"), (406, 0, "user", "x")]  # their heads exist not: what is left depends on h
    assert found_trie(spark, rows, block_turns=25) == trie(rows)
    gone = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0][:2]
    rows = [(c, 0, "user", "only") for c in gone]
    assert found_trie(spark, rows) == trie(rows) and sum(trie(rows).values()) == 1


def test_range_minimum_against_loops():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 17, 64):
        v = rng.integers(0, 5, n)
        table = RangeMinimum(v)
        at = np.repeat(np.arange(n), 6)
        least = np.tile(np.arange(6), n)
        for i, d, r, x in zip(at, least, table.reach_right(at, least), table.reach_left(at, least)):
            j = i
            while j + 1 < n and v[j + 1] >= d:
                j += 1
            k = i
            while k >= 1 and v[k] >= d:
                k -= 1
            assert (r, x) == (j, k)
        pairs = [(a, b) for a in range(n) for b in range(a, n)]
        a, b = map(np.array, zip(*pairs))
        assert table.least(a, b).tolist() == [v[i : j + 1].min() for i, j in pairs]


# ---------------------------------------------------------------- deduplication


def digest(k):
    return hashlib.sha256(str(k).encode()).digest()


def test_index_inserts_deletes_and_grows():
    index, live = CuckooIndex(2), {}
    rng = np.random.default_rng(6)
    for step in range(6000):
        k = int(rng.integers(0, 2500))
        if rng.random() < 0.6:
            index.put(digest(k), (k, step, 1))
            live[k] = (k, step, 1)
        else:
            assert index.delete(digest(k)) == (live.pop(k, None) is not None)
    assert index.size == len(live) and index.resizes > 3
    assert dict(index.items()) == {digest(k): e for k, e in live.items()}
    assert all(index.get(digest(k)) == live.get(k) for k in range(2600))


def test_false_hits_are_verified():
    index = CuckooIndex(64)
    base = digest("x")
    alike = [base[:10] + bytes([k]) * 22 for k in range(6)]  # one fingerprint, the same buckets
    for k in range(0, 6, 2):
        index.put(alike[k], (k, 0, 1))
    assert [index.get(a) and index.get(a)[0] for a in alike] == [0, None, 2, None, 4, None]
    assert not index.delete(alike[1]) and index.delete(alike[2]) and index.get(alike[4]) == (4, 0, 1)


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def expected_dedup(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[low(t)].append(i)
    out = collections.Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for k, i in enumerate(sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)):
            out[(i, keep, len(ids), k == 0, hashlib.sha256(text.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("shard_rows", [2, 1 << 18])
def test_dedup_against_brute_force(spark, docs, odd_docs, shard_rows):
    hot = [(k, "Same TEXT") for k in range(300)] + [(k, f"t{k % 200}É") for k in range(300, 700)] + [(9, "Same text"), (None, "É"), (None, "é")]
    hot = spark.createDataFrame(hot, "doc_id long, text string").withColumns({"line": F.lit("x"), "digest": F.lit(1), "salt": F.lit(None)})
    for frame in (docs, odd_docs, hot.repartition(7)):
        rows = [(r.doc_id, r.text) for r in frame.collect()]
        found = exact_dedup(frame, shard_rows=shard_rows if frame is not docs else 1 << 18, buckets=2)
        assert collections.Counter(map(tuple, found.collect())) == expected_dedup(rows)


def test_stored_index_follows_insertions_and_deletions(spark):
    rng = np.random.default_rng(8)
    index, rows = DedupIndex.empty(spark, shards=3), []
    for step in range(3):
        new = [(1000 * step + k, f"T{rng.integers(0, 12)}") for k in range(30)] + [(1000 * step, "Twice"), (1000 * step, "twice")]
        rows += new
        index = index.insert(spark.createDataFrame(new, "doc_id long, text string"))
        assert collections.Counter(map(tuple, index.documents().collect())) == expected_dedup(rows)
        gone = {i for i, _ in rows if rng.random() < 0.4} | {1000 * step + 29}
        index = index.delete(spark.createDataFrame([(i,) for i in gone] + [(-1,)], "doc_id long"))
        rows = [r for r in rows if r[0] not in gone]
        assert collections.Counter(map(tuple, index.documents().collect())) == expected_dedup(rows)
        assert index.keys.count() == len({low(t) for _, t in rows})
        index = load_index(spark, save_index(index.resharded(2 + step)))
    everything = index.rows.select("doc_id")
    assert index.delete(everything).keys.isEmpty() and index.delete(everything).documents().isEmpty()


# ---------------------------------------------------------------- resampling


def test_radix_ranks_are_a_sort(spark):
    rng = np.random.default_rng(9)
    wide = [-(2**63), 2**63 - 1, 0, None, 5, 5]
    for ids in (rng.integers(-50, 400, 300).tolist() + [None, None], rng.integers(0, 40, 100).tolist(), wide, [None], [3]):
        rows = [(i, int(s)) for i, s in zip(ids, rng.integers(-4000, 4000, len(ids)) // 100)]
        frame = spark.createDataFrame(rows, "doc_id long, score long").repartition(5)
        for chunk_rows, width in ((7, 3), (1 << 18, 12)):
            found = sorted(radix_ranks(frame, chunk_rows, width).collect(), key=lambda r: r.rank)
            assert [r.rank for r in found] == list(range(1, len(rows) + 1))
            assert [(r.doc_id, r.score) for r in found] == sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))


def test_digits_cover_the_key():
    for high, low_bits in ((0, 0), (1, 64), (13, 25)):
        for word, bits in (("high", high), ("low", low_bits)):
            own = [(a, b) for w, a, b in digit_passes(high, low_bits) if w == word]
            assert sum(b for _, b in own) == bits and all(0 < b <= 12 for _, b in own)


def expected_draw(rows, items, size, buckets=10_000, percent=10, min_words=20):
    def words(text):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low(text))

    def features(text):
        w = words(text)
        runs = [" ".join(w[i : i + k]) for k in range(1, size + 1) for i in range(len(w) - k + 1)]
        return [zlib.crc32(f.encode()) % buckets for f in runs]

    s = collections.Counter(f for _, t in rows for f in features(t))
    t = collections.Counter(f for x in items for f in features(x))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    out, drawn = [], []
    for i, text in rows:
        f = features(text)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        (drawn if len(words(text)) >= min_words else out).append((i, len(f), weight, score))
    drawn.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    k = percent * len(drawn) // 100
    return collections.Counter([(*r, None) for r in out] + [(*r, n if n <= k else None) for n, r in enumerate(drawn, 1)])


@pytest.mark.parametrize("size", [1, 2])
def test_resampling_against_brute_force(spark, docs, odd_docs, sf_dir, size):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    none = spark.createDataFrame([(None, "x"), ("", "y")], "text string, doc_id string")
    for frame, target, min_words in ((docs, bench, 20), (odd_docs, bench, 1), (odd_docs, none, 0)):
        rows = [(r.doc_id, r.text) for r in frame.collect()]
        items = [r.text for r in target.collect()]
        found = importance_resample(frame, target, size=size, percent=30, min_words=min_words, chunk_rows=50).collect()
        assert collections.Counter(map(tuple, found)) == expected_draw(rows, items, size, percent=30, min_words=min_words)
