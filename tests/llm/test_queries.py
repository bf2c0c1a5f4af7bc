"""Queries of the contracts: against their SQL, or against brute force where SQL can't express them."""

import collections
import math
import re
import zlib
from html import unescape

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from compare import difference
from millrace.llm import blocks, components, counts, decontaminate, pii, quality_rules, tokens, url_filters, wrappers
from millrace.llm.interpolated_lm import interpolated_lm, mixture_weights
from millrace.llm.ngram_join import drop_near_duplicates, ngram_jaccard_join, prefixes
from millrace.llm.packing import best_fit_decreasing, pack, sequences
from millrace.llm.pairwise_quality import pairwise_quality
from millrace.llm.queries import ORACLES, QUERIES, vocabulary
from millrace.llm.token_table import read_tokens, stored_documents, write_token_table
from millrace.session import new_folder


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def words(text):
    return (text or "").encode().lower().split()


def lm_scores(rows):
    """(id, held out, tokens, known, N, base, score) by dictionaries; the weights from the same cells."""
    docs = [(i, words(r) + [0], zlib.crc32(("" if i is None else str(i)).encode()) % 10 > 0) for i, r in rows]
    c1 = collections.Counter(w for _, t, train in docs if train for w in t)
    c2 = collections.Counter(p for _, t, train in docs if train for p in zip([1, *t], t))
    n, v = sum(c1.values()), len(c1)
    seen = lambda h: c1[0] if h == 1 else c1[h]  # noqa: E731  a text begins as often as one ends
    cells = collections.Counter()
    for _, t, train in docs:
        if train:
            o1, o2 = collections.Counter(t), collections.Counter(zip([1, *t], t))
            for h, w in zip([1, *t], t):
                a, c, b = c2[h, w] - o2[h, w], seen(h) - (1 if h == 1 else o1[h]), c1[w] - o1[w]
                r2 = round(8 * math.log2(a / c * (v + 1))) if a > 0 and c > 0 else -512
                r1 = round(8 * math.log2(b / max(n - len(t), 1) * (v + 1))) if b > 0 else -512
                cells[max(c, 0).bit_length(), r2, r1] += 1
    weights = mixture_weights(np.array([(*k, x) for k, x in cells.items()], np.int64).reshape(-1, 4))
    if not cells:
        weights[:] = (0, 0, 1)
    out = []
    for i, t, train in docs:
        p = [weights[seen(h).bit_length()] @ (c2[h, w] / max(seen(h), 1), c1[w] / max(n, 1), 1 / (v + 1)) for h, w in zip([1, *t], t)]
        base = sum(math.log10((c1[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        out.append((-1 if i is None else i, not train, len(t), sum(c1[w] > 0 for w in t), n, round(base, 6), round(sum(map(math.log10, p)), 6)))
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [3000, 4 << 20])
def test_language_model_against_brute_force(docs, odd_docs, block_bytes):
    for frame in (docs, odd_docs, odd_docs.filter("doc_id = 11")):
        found = interpolated_lm(frame, block_bytes=block_bytes).collect()
        actual = [(-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in found]
        expected = lm_scores([(r.doc_id, r.text) for r in frame.collect()])
        for x, y in zip(sorted(actual), expected, strict=True):
            assert x[:5] == y[:5] and x[5:] == pytest.approx(y[5:], abs=1e-5)
    held = [r for r in interpolated_lm(docs).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("block_bytes", [1, 500, 4 << 20])
def test_blocks_hold_all_rows_and_no_more_bytes(spark, odd_docs, block_bytes):
    frame = odd_docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang").repartition(2)
    packed = blocks.pack_blocks(frame, block_bytes).toArrow()
    rows, sizes = collections.Counter(), packed.column("n_bytes").to_pylist()
    for (block, table), size in zip(blocks.unpacked(packed), sizes):
        rows += collections.Counter(map(tuple, (r.values() for r in table.to_pylist())))
        assert table.num_rows == 1 or size <= block_bytes
        assert size == sum(64 + len(t.encode()) for t in table.column("text").to_pylist())
    assert rows == collections.Counter(map(tuple, frame.collect())) and len(set(packed.column("block").to_pylist())) == len(sizes)


def test_planes_of_bytes_round_trip():
    for values in (np.zeros(0, np.uint64), np.array([0, 1, 255, 2**63, 2**64 - 1], np.uint64), np.arange(1000, dtype=np.int64)):
        assert counts.of_planes(counts.planes(values)).tolist() == values.tolist()


def test_rows_of_the_count_exchange_follow_the_text(spark, docs):
    """Not the number of partitions: a block and a range exist for so many bytes each."""
    made = []
    for n in (2, 40):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            found = ngram_jaccard_join(docs.repartition(2)).select("component_id").collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        made.append(sorted(r.component_id for r in found))
    assert made[0] == made[1] and counts.n_ranges(0) == 1 and counts.n_ranges(1 << 30) == 65


def test_join_and_near_duplicates_on_odd_rows(odd_docs):
    rows = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_jaccard_join(odd_docs, 3, 9, 10).collect()}
    assert rows[(1, 8)] == rows[(2, 8)] == rows[(3, 8)] == 1
    assert rows[(7, 1)] == rows[(8, 1)] == 7 and rows[(9, 1)] == 9
    assert rows[(4, 0)] == 4 and rows[(5, 0)] == 5 and rows[(6, 0)] == 6
    assert rows[(10, 3)] == 10 and (None, 8) in rows and rows[(None, 8)] is None
    kept = [r.doc_id for r in drop_near_duplicates(odd_docs).collect()]
    assert sorted(i for i in kept if i is not None) == [1, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14] and kept.count(None) == 2


def test_components_against_brute_force(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (150, 2))] + [(k, k + 1) for k in range(400, 440)]
    edges += [(500, k) for k in range(501, 560)] + [(7, 7), (None, 3), (4, None)]
    low = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    for _ in low:
        for a, b in edges:
            if a in low and b in low:
                low[a] = low[b] = min(low[a], low[b])
    found = components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)).collect()
    assert sorted((r.node, r.component) for r in found) == sorted(low.items())
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).isEmpty()


def test_near_copies_link_through_chains(spark):
    text = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(40):  # each row differs from the next by one word: ends are far apart
        rows.append((100 - k, " ".join([f"x{i}" if i < 3 * k else w for i, w in enumerate(text)])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: {tuple(t.split()[j : j + 3]) for j in range(198)} for i, t in rows}
    group = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if 10 * len(sets[i] & sets[j]) >= 9 * len(sets[i] | sets[j]):
                    group[i] = group[j] = min(group[i], group[j])
    assert {r.doc_id: r.component_id for r in ngram_jaccard_join(frame).collect()} == group


def test_quality_rules_against_brute_force(docs, odd_docs):
    for frame in (docs.select("doc_id", "text", "lang"), odd_docs):
        measured = quality_rules.measure(frame)
        judged = quality_rules.judge(measured, quality_rules.references(quality_rules.histograms(frame))).collect()
        for r in judged:
            text = r.text or ""
            w = [x for x in re.split("[\x20\x09-\x0D]+", text) if x]
            times = collections.Counter(zip(w, w[1:], w[2:]))
            hit = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if times[x] > 1 for k in range(3)}
            lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
            symbols = sum(c in "#*$%&|<>" for c in text)
            expected = (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(hit))
            assert (r.rule_n_words, r.rule_word_chars, r.rule_n_symbols, r.rule_n_dup_lines, r.rule_n_repeat_words) == expected
            assert r.rule_base_failed == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
            assert not (r.rule_base_failed and r.rule_kept)


def test_rules_reject_junk_and_keep_clean(spark, docs, sf_dir):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = [(labels[r.doc_id], r.kept) for r in QUERIES["op5_quality_rules"](spark, sf_dir).collect() if r.doc_id in labels and not r.base_failed]
    assert all(k for q, k in kept if q == 1) and not all(k for q, k in kept if q == 0)


def test_rules_keep_short_clean_documents_with_personal_data(spark, sf_dir):
    larger = sf_dir.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{larger}/labels.parquet").select("doc_id", "quality")
    judged = QUERIES["op5_quality_rules"](spark, larger).join(labels, "doc_id").filter("not base_failed").collect()
    assert [r.doc_id for r in judged if r.quality == 1 and not r.kept] == []
    assert [r.doc_id for r in judged if r.quality == 0 and r.kept] == []


def test_wide_letters_are_letters(spark):
    rows = [(1, "abc " * 80, "en"), (2, "\u00e9\u00e8\u00ea " * 80, "en")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: list(r.rule_classes) for r in quality_rules.measure(frame).collect()}
    assert found[1] == found[2]


def test_classes_of_short_texts_need_the_common_words_too(spark):
    def kept(n, near, common):
        classes = [0] * 8 + [100] if n else [100] + [0] * 8
        row = spark.createDataFrame([(n, 0, classes, common, "en")], "rule_n_words long, rule_n_repeat_words long, rule_classes array<int>, rule_common array<double>, rule_lang string")
        refs = spark.createDataFrame([("en", [100.0] + [0.0] * 8, near)], "rule_ref_lang string, rule_ref_classes array<double>, rule_ref_common array<double>")
        return quality_rules.judge(row, refs).first().rule_kept

    assert kept(60, [1.0, 9.0], [1.0, 9.0]) and not kept(100, [1.0, 9.0], [1.0, 9.0])  # noise of classes alone, short and long
    assert not kept(60, [1.0, 9.0], [9.0, 1.0]) and not kept(60, [1.0, 9.0], [None, None])


def test_many_repeated_windows_are_counted(spark):
    text = " ".join(f"w{i % 100}" for i in range(200))
    row = quality_rules.measure(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")).first()
    assert row.rule_n_repeat_words == 200  # 98 windows, above the scanned list's length


PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == 1:
        return all(int(p) <= 255 for p in text.split("."))
    if kind == 2:
        odd = sum(int(d) for d in digits[-1::-2])
        return 13 <= len(digits) <= 19 and (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def test_personal_data_against_brute_force(docs, odd_docs):
    for frame in (docs, odd_docs):
        text = {(r.doc_id, r.text or "") for r in frame.collect()}
        expected = collections.Counter(
            (i, tuple((k, *m.span()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, t) if valid(k, m.group()))) for i, t in text
        )
        found = pii.find_pii(frame).collect()
        assert {(r.doc_id, tuple(map(tuple, r.base))) for r in found} == set(expected)
        assert len(found) == frame.count() and all(set(map(tuple, r.base)) <= set(map(tuple, r.spans)) for r in found)


def test_contexts_discover_identifiers_and_masks_apply(spark):
    rows = [(i, f"please call now {'+1 (555) 010-%04d' % i} today") for i in range(20)]
    rows += [(50, "please call now 555-0199-77 today"), (51, "some other number 777 888 999 here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find_pii(frame).collect()}
    assert [tuple(s) for s in found[50].spans] == [(3, 16, 27)] and found[50].base == [] and found[51].spans == []
    masked = {r.doc_id: r.text for r in pii.redact(frame).collect()}
    assert masked[50] == masked[3] == "please call now [PHONE] today" and masked[51] == rows[-1][1]


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(vocabulary())
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_is_exact(monkeypatch, docs, odd_docs):
    """Part by part and cached against the tokenizer on whole texts, also with a cache that is always full."""
    rng = np.random.default_rng(21)
    pieces = ["a", "b.", "c,", "D", "it's.", "x", "1.", "2", ").", "..", ".", ",", "é.", "ß,", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>.", "<|", "|>", " ", "  ", "\n", "\t", "\x0b", "\u00a0", "\u2003", "\x1f", "\x00", "İ", "don't,", "😀", "中文。", "'ll", "a.b", "a.,", "z" * 300 + "."]
    rows = ["".join(pieces[k] for k in rng.integers(0, len(pieces), rng.integers(0, 14))) for _ in range(6000)]
    rows += [r.text or "" for frame in (docs, odd_docs) for r in frame.collect()]
    tokenizer = Tokenizer.from_file(vocabulary())
    expected = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(rows, add_special_tokens=False)]
    for most in (tokens.CACHE_PARTS, 50):
        monkeypatch.setattr(tokens, "CACHE_PARTS", most)
        own = tokens.PartEncoder(vocabulary())
        found = [x for i in range(0, len(rows), 700) for x in own.ids([t.encode() for t in rows[i : i + 700]])]
        wrong = [t for t, x, y in zip(rows, found, expected, strict=True) if x != y]
        assert wrong == []  # a full cache holds what one call brought


def test_encoder_looks_up_distinct_parts_and_encodes_each_word_once():
    class Lookups(dict):
        def get(self, *key):
            asked.append(key[0])
            return super().get(*key)

    class Recorder:
        def encode_batch_fast(self, rows, **more):
            sent.extend(rows)
            return tokenizer.encode_batch_fast(rows, **more)

    asked, sent = [], []
    own, tokenizer = tokens.PartEncoder(vocabulary()), Tokenizer.from_file(vocabulary())
    own.cache, own.tokenizer = Lookups(), Recorder()
    parts = ["gesté", "gesté.", "gesté***", "(gesté)", "it's", "it", "a.b", "12"]
    rows = [" ".join(parts[k:] + parts[:k]) for k in range(8)] * 50
    found = own.ids([t.encode() for t in rows])
    assert found == [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(rows, add_special_tokens=False)]
    assert sorted(asked) == sorted(p.encode() for p in parts)  # not once per occurrence
    assert sorted(" ".join(sent).split()) == sorted(["gesté", ".", "***", "(", ")", "it", "'s", "a", "b", "1", "2"])


def test_pieces_are_cut_as_the_vocabulary_cuts_them():
    rng = np.random.default_rng(22)
    letters = [chr(c) for c in range(0xC0, 0x490)] + list("stremlvdSTREMLVD")  # some beyond those cut here, and marks
    signs = [chr(c) for c in range(0x21, 0x7F)] + ["'"] * 20
    rows = [f"{c} a{c}b {c}{c}. {c}'{c.upper()}" for c in letters] + ["J\u030c H\u0331, T\u0308ab", "x W\u030a"]
    rows += ["".join(rng.choice(letters if rng.random() < 0.5 else signs) for _ in range(rng.integers(1, 12))) for _ in range(20000)]
    tokenizer = Tokenizer.from_file(vocabulary())
    expected = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(rows, add_special_tokens=False)]
    own = tokens.PartEncoder(vocabulary())
    found = own.ids([t.encode() for t in rows])
    assert [t for t, x, y in zip(rows, found, expected, strict=True) if x != y] == []
    own = tokens.PartEncoder(vocabulary())
    own.ends[:] = False  # a vocabulary that doesn't mark them
    assert own.ids([t.encode() for t in rows]) == expected
    assert own.ids([]) == [] and own.ids([b"", b" \n ", b"a"]) == [b"", b"", np.array(tokenizer.encode("a").ids, "<u4").tobytes()]


def test_id_ranges_prune_row_groups_and_metadata_reads_skip_ids(spark, tmp_path):
    frame = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.array_repeat(F.concat(F.lit("w"), "id"), 40)).alias("text"))
    for encoding in ("dictionary", "delta"):
        path = str(tmp_path / encoding)
        write_token_table(frame.coalesce(1), path, vocabulary(), encoding=encoding, row_group_bytes=16 << 10, page_bytes=4 << 10)
        files = sorted((tmp_path / encoding).glob("*.parquet"))
        groups = [pq.ParquetFile(f).metadata.row_group(g) for f in files for g in range(pq.ParquetFile(f).metadata.num_row_groups)]
        spans = sorted((g.column(0).statistics.min, g.column(0).statistics.max) for g in groups)
        assert len(spans) > 2 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # an id lies in one row group
        hit = [s for s in spans if s[0] <= 1234 <= s[1]]
        assert len(hit) == 1 and all(g.column(0).has_offset_index and g.column(0).has_column_index for g in groups)
        kinds = {str(e) for g in groups for e in g.column(3).encodings}
        assert ("DELTA_BINARY_PACKED" in kinds) == (encoding == "delta") and any("DICTIONARY" in k for k in kinds) == (encoding == "dictionary")
        some = read_tokens(spark, path).filter("doc_id BETWEEN 1230 AND 1240")
        assert some.count() == 11
        text = some._jdf.queryExecution().toString()
        assert "GreaterThanOrEqual(doc_id,1230)" in text
        meta = read_tokens(spark, path).groupBy("shard").agg(F.sum("n_tokens"))._jdf.queryExecution().toString()
        assert re.search(r"ReadSchema: struct<n_tokens:bigint,shard:int>", meta)


def test_starts_of_repeated_ids_are_places_in_the_file(spark, encode):
    rows = [(7, f"text {k} " * (1 + k % 5)) for k in range(40)] + [(3, "a b"), (3, "a"), (None, "x y z"), (9, None)]
    path = new_folder(spark, "tokens")
    write_token_table(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), path, vocabulary())
    table = read_tokens(spark, path)
    stored = [r.ids for r in table.orderBy("shard", "place").collect()]
    found = sorted(stored_documents(table).collect(), key=lambda r: r.start)
    at = 0
    for r, ids in zip(found, stored, strict=True):
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)


def test_token_table_round_trip(spark, docs, odd_docs, encode):
    for frame, encoding in ((docs, "dictionary"), (odd_docs, "delta")):
        path = new_folder(spark, "tokens")
        write_token_table(frame, path, vocabulary(), encoding=encoding)
        found = sorted(stored_documents(read_tokens(spark, path)).collect(), key=lambda r: r.start)
        ids = [(r.doc_id, encode(r.text)) for r in frame.collect()]
        assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == collections.Counter((i, len(x), crc(x)) for i, x in ids)
        order = [-1 if r.doc_id is None else r.doc_id for r in found]
        assert order == sorted(order)
        at = 0
        for r in found:
            assert r.start == at
            at += r.n_tokens


def test_packing_round_trip(docs, odd_docs, encode):
    for frame in (docs, odd_docs):
        placed = pack(frame, vocabulary(), 4096, keep_ids=True)
        pieces = placed.collect()
        expected = collections.Counter((r.doc_id, *encode(r.text)) for r in frame.collect())
        for r in pieces:
            assert r.length == len(r.ids) and crc(r.ids) == r.ids_crc32
        by_doc = collections.defaultdict(lambda: collections.defaultdict(list))
        for r in pieces:
            by_doc[(r.doc_id, r.doc_tokens)][r.start].append(tuple(r.ids))
        if frame is docs:
            rebuilt = collections.Counter((i, *(x for s in sorted(p) for x in p[s][0])) for (i, _), p in by_doc.items())
            assert rebuilt == expected
        assert sum(r.length for r in pieces) == sum(n * (len(k) - 1) for k, n in expected.items())
        windows = collections.defaultdict(list)
        for r in pieces:
            windows[r.sequence_id].append((r.offset, r.length))
        for parts in windows.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 4096
        assert sum(map(len, (r.ids for r in sequences(placed).collect()))) == sum(r.length for r in pieces)


def test_best_fit_takes_the_tightest_window():
    rng = np.random.default_rng(3)
    lengths = sorted(rng.integers(1, 101, 500).tolist(), reverse=True)
    rooms, expected = [], []
    for x in lengths:
        fits = [(room, k) for k, room in enumerate(rooms) if room >= x]
        if fits:
            rooms[min(fits)[1]] -= x
        else:
            rooms.append(100 - x)
        expected.append(sorted(rooms))
    windows, offsets = best_fit_decreasing(lengths, 100)
    used = collections.Counter()
    for w, o, x in zip(windows, offsets, lengths):
        assert used[w] == o
        used[w] += x
    assert sorted(100 - v for v in used.values()) == expected[-1]


def test_quality_classifier_on_held_out_documents(spark, docs, odd_docs, sf_dir):
    rows = QUERIES["op1_pairwise_quality"](spark, sf_dir.replace("sf0.001", "sf0.01")).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/labels.parquet").collect()}
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert sum(p == y for p, y in held) / len(held) >= 0.95
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.score == pytest.approx(0.3) for r in pairwise_quality(odd_docs, none).collect())


def markup_text(html):
    article = html.split("<article>")[1].split("</article>")[0]
    parts = (" ".join(unescape(re.sub("<br>", " ", re.sub("</?b>", "", x))).split()) for x in re.split("</?(?:p|h1)>", article))
    return "\n\n".join(x for x in parts if x)


@pytest.mark.parametrize("tag", ["article", "div"])
def test_main_text_against_markup(spark, sf_dir, tag):
    """Also where the pages don't mark their article: then the aligned slots alone lead to it."""
    pages = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    told = pages.withColumn("html", F.replace(F.replace("html", F.lit("<article>"), F.lit(f"<{tag}>")), F.lit("</article>"), F.lit(f"</{tag}>")))
    found = wrappers.extract_main_text(told).collect()
    assert len(found) == len(html)
    for r in found:
        assert r.text == markup_text(html[r.page_id])


def test_query_gives_the_length_of_main_text(spark, sf_dir):
    assert all(r.n_chars == len(r.text) for r in QUERIES["op10_main_text"](spark, sf_dir).collect())


def extracted(spark, *pages):
    """Text by page id; pages are (id, url, html)."""
    frame = spark.createDataFrame([(*p, "h", 1) for p in pages], "page_id long, url string, html string, host string, part int")
    found = collections.defaultdict(list)
    for r in wrappers.extract_main_text(frame).collect():
        found[r.page_id].append(r.text)
    return found


def test_wrapper_without_article_and_odd_pages(spark):
    page = "<body><div class=x><p>Same everywhere</p></div><div><p>{0} one &amp; two<br>three</p><div id=comments>no</div><p>{0} end</div><form>f</form>"
    rows = [(k, f"http://a.example.com/{k}", page.format(f"text {k} long enough")) for k in range(3)]
    rows += [(7, None, None), (8, "", ""), (9, "http://b.example.org/", "<p>only <b>page"), (9, "http://b.example.org/", "<p>only <b>page"), (10, "x", "<div>" * 30_000 + "deep")]
    found = extracted(spark, *rows)
    assert found[1] == ["text 1 long enough one & two three\n\ntext 1 long enough end"]
    assert found[7] == found[8] == [""] and found[9] == ["only page"] * 2 and found[10] == ["deep"]


def test_copies_are_no_evidence_and_shared_passages_stay(spark):
    page = "<body><div id=top>Menu text</div><div><p>{}</p><p>{}</p></div>"
    same = page.format("one page only", "that is all of it")
    twins = [(k, f"http{'s' * (k % 2)}://t.example.com/?u={k}", same) for k in range(4)]
    license = "Free to copy under the licence."
    rows = [(10 + k, f"http://l.example.com/{k}", page.format(f"text number {k} of some length", license if k < 2 else f"own end {k}")) for k in range(6)]
    found = extracted(spark, *twins, *rows)
    assert all(found[k] == ["Menu text\n\none page only\n\nthat is all of it"] for k in range(4))
    # Two of six pages have the licence; it is template for none of them.
    assert all(found[10 + k][0].endswith(license) for k in (0, 1)) and "Menu" not in "".join(x for k in range(6) for x in found[10 + k])


def test_names_of_large_elements_and_titles_beside_the_text(spark):
    def site(host, page):
        return [(k, f"http://{host}.example.com/{k}", page.format(k=k, long=f"a long text {k} " * 30)) for k in range(3)]

    pages = {
        "body": "<body class='has-sidebar'><nav>x {k}</nav><div class='content no-sidebar'><h1>T {k}</h1><p>{long}</p></div>",
        "lead": "<body><div class=post><h1>T {k}</h1><p>lead {k}</p><div class=body><p>{long}</p></div></div><div class='site-footer'>f {k}</div>",
        "parts": "<body><section><p>{long}</p></section><section><p>short {k}</p></section><div class='cookie-banner'>c {k}</div>",
        "names": "<body><div id='search-result-article'><h1>T {k}</h1><p>{long}</p><div class='header-image'>i {k}</div><div class='main-nav'>n {k}</div></div>",
        "wrong": "<body><div class='sidebar'><h1>T {k}</h1><p>{long}</p></div><div class=ad>buy {k}</div>",
        "teaser": "<body><article>card {k}</article><div><h1>T {k}</h1><p>{long}</p></div>",
    }
    long = " ".join(["a long text 1"] * 30)
    expected = {
        "body": f"T 1\n\n{long}", "lead": f"T 1\n\nlead 1\n\n{long}", "parts": f"{long}\n\nshort 1",
        "names": f"T 1\n\n{long}\n\ni 1", "wrong": f"T 1\n\n{long}", "teaser": f"T 1\n\n{long}",
    }
    for host, page in pages.items():
        assert extracted(spark, *site(host, page))[1] == [expected[host]], host


def tree_weight(a, b):
    """Largest matching of two trees by plain recursion over all ways."""
    if a.tag != b.tag:
        return 0

    def rest(xs, ys):
        if not xs or not ys:
            return 0
        return max(rest(xs[1:], ys), rest(xs, ys[1:]), tree_weight(xs[0], ys[0]) + rest(xs[1:], ys[1:]))

    return 1 + rest(tuple(a.kids), tuple(b.kids))


def test_tree_matching_against_brute_force(monkeypatch):
    rng = np.random.default_rng(12)

    def page(depth):
        tag = ("div", "p", "ul")[rng.integers(0, 3)]
        return f"<{tag}>{rng.integers(0, 3)}" + "".join(page(depth - 1) for _ in range(rng.integers(0, 4) if depth else 0)) + f"</{tag}>"

    for _ in range(40):
        a, b = (wrappers.parse("<div>" + page(2).replace("p>", "b>") + page(2).replace("p>", "b>") + "</div>") for _ in range(2))
        assert wrappers.align(a, b, set()) == tree_weight(a, b)
    # Long lists of children beyond the table's bound: equal ends are matched, the middle in order.
    monkeypatch.setattr(wrappers, "MATCH_CELLS", 50)
    a = wrappers.parse("<div>" + "".join(f"<i>{k}</i>" for k in range(40)) + "</div>")
    b = wrappers.parse("<div>" + "".join(f"<i>{k}</i>" for k in range(40) if k != 20) + "</div>")
    constant = set()
    assert wrappers.align(a, b, constant) == 41 and len(constant) == 41


def test_long_lists_of_children_match_as_short_ones_do(monkeypatch):
    rng = np.random.default_rng(13)
    kinds = "<p>{}</p>", "<ul><li>{}</li><li>b</li></ul>", "<table><tr><td>{}</td></tr></table>", "<ul><li>{}</li></ul>", "<p>{}<b>c</b></p>"

    def page(n):
        return wrappers.parse("<div>" + "".join(kinds[rng.integers(0, 5)].format(rng.integers(0, 3)) for _ in range(n)) + "</div>")

    for n in (7, 20, 50):  # narrow rows and wide ones
        a, b = page(n), page(n + 3)
        found = []
        for cells in (1_000_000, 30):
            monkeypatch.setattr(wrappers, "MATCH_CELLS", cells)
            constant = set()
            found.append((wrappers.align(a, b, constant), constant))
        assert found[0] == found[1]
        if n == 7:
            assert found[0][0] == tree_weight(a, b)


def test_many_siblings_and_many_pages_of_a_host(spark, monkeypatch):
    wide = "<body><div>" + "".join(f"<p>{{}} {i}</p>" for i in range(3000)) + "</div>"
    pages = [(k, "http://w.example.com/", re.sub("{}", f"w{k}", wide)) for k in range(2)]
    page = "<body><div>Menu</div><div><p>text {0} of its own</p></div>"
    monkeypatch.setattr(wrappers, "HOST_PART", 20)
    pages += [(100 + k, f"http://hot.example.com/{k}", page.format(k)) for k in range(150)]
    found = extracted(spark, *pages)
    assert found[1][0].startswith("w1 0\n\nw1 1\n\n") and found[1][0].endswith("w1 2999")
    assert all(found[100 + k] == [f"text {k} of its own"] for k in range(150))


def test_decontamination_and_urls_on_odd_rows(spark, odd_docs):
    bench = spark.createDataFrame([("i", "A b-c d"), ("j", "q"), (None, "one"), ("k", None), ("i", "a B c D")], "item_id string, text string")
    rows = {(r.doc_id, r.n_words): (r.n_hit, list(r["items"])) for r in decontaminate.decontaminate(odd_docs, bench).collect()}
    assert rows[(1, 10)] == rows[(3, 10)] == rows[(None, 10)] == (4, ["i"]) and rows[(4, 0)] == (0, [])
    assert rows[(7, 1)] == (1, []) and rows[(11, 5)] == (1, ["j"]) and rows[(9, 2)] == (0, [])
    left = decontaminate.drop_contaminated(odd_docs, bench)
    assert left.columns == odd_docs.columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 4, 5, 6, 9, 10, 12, 12, 13, 14]
    empty = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.drop_contaminated(odd_docs, empty).count() == odd_docs.count()
    rules = spark.createDataFrame([("com/", "allow"), ("a.com/x/", "block"), ("a.com/x/", "allow"), (None, "block")], "rule string, verdict string")
    urls = [("http://b.A.com/x/y?z",), ("http://a.com",), ("ftp://a.com/x",), (None,), ("nothing",), ("http:///x/",)]
    pages = spark.createDataFrame([(*u, 1, "r", "u", "b", 2) for u in urls], "url string, host int, rule string, u string, best string, url_ int")
    found = {r.url: (r.url_host, r.url_path, r.url_rule, r.url_verdict) for r in url_filters.filter_urls(pages, rules).collect()}
    assert found["http://b.A.com/x/y?z"] == ("b.a.com", "/x/y", "a.com/x/", "block")
    assert found["http://a.com"] == ("a.com", "", None, "allow") and found["ftp://a.com/x"] == ("a.com", "/x", "com/", "allow")
    assert found[None] == found["nothing"] == ("", "", None, "allow") and found["http:///x/"] == ("", "/x/", None, "allow")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, sf_dir, tmp_path, name):
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0


def test_pipeline_against_brute_force(spark, docs, sf_dir, encode):
    """Stage by stage on real rows: what each one keeps, by plain rules."""
    rows = {r.doc_id: r.text for r in docs.collect()}
    kept = docs
    for name, build in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, build(spark, kept, sf_dir)
        assert kept.columns == docs.columns, name
        if name == "quality_rules":
            assert all(len(words(r.text)) >= 50 for r in kept.collect())
        elif name == "ngram_jaccard_join":
            sets = {r.doc_id: {tuple(words(r.text)[i : i + 5]) for i in range(len(words(r.text)) - 4)} for r in before.collect()}
            group = {i: i for i in sets}
            for _ in range(4):
                for i in sets:
                    for j in sets:
                        if i < j and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                            group[i] = group[j] = min(group[i], group[j])
            assert {r.doc_id for r in kept.collect()} == {i for i in sets if group[i] == i}
        elif name == "decontamination":
            hit = {r.doc_id for r in QUERIES["op4_decontaminate"](spark, sf_dir).collect() if r.contaminated}
            assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in before.collect()} - hit
        else:
            for r in kept.collect():
                assert r.n_chars == len(r.text)
                assert not any(valid(k, m.group()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, r.text))
                assert "[" in r.text or r.text == rows[r.doc_id]
    last = {r.doc_id: r.text for r in kept.collect()}
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    assert {(r.doc_id, r.doc_tokens) for r in pieces} == {(i, len(encode(t))) for i, t in last.items()}


def test_near_duplicates_hold_one_shuffle_at_a_time(spark, docs):
    """The exchange of keys is over, its shuffle gone, before the blocks are moved."""
    base = docs.selectExpr("doc_id", "coalesce(text, '') AS text")
    plan = prefixes(base, 5, 80, 100)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "FlatMapGroupsInArrow" not in plan


def test_rules_stage_whole_texts_with_zstd(spark, docs, sf_dir):
    files = corpus_pipeline.rules(spark, docs, sf_dir).inputFiles()
    measured = [f for f in files if "/measured-" in f]
    assert measured and all(".zstd." in f for f in measured)
