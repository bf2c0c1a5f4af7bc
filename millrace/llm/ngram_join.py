"""Near-duplicate join on word n-grams: rare-first prefix filtering, verified once per pair.

Two texts link when ``intersection >= threshold * union`` of their distinct
word n-grams. All grams are put in one order, rare ones first, by their exact
number of documents. Two linked texts must share a gram among the first
``n - ceil(threshold * n) + 1`` of each (prefix filter). A gram that occurs in
one document only can't be shared, so a text whose whole prefix is such grams
has no partner and leaves at once; that is nearly every original text.

Copies (equal gram sets) are one class from then on. Candidate pairs of classes
share a prefix gram and pass, where they meet,

* the length filter, on the two set sizes,
* the positional filter: at the first shared gram, what is left of the shorter
  rest bounds the intersection,
* the suffix filter: the gram space is cut at fixed pivots, and the differences
  of the two sets' counts between pivots bound their symmetric difference.

A pair is verified on the full sets, once, however many grams it met on.

Groups of near copies aren't expanded into all pairs. First each member meets
one class per prefix gram, the one whose earlier grams are fewest; links found
so join classes into components. Then every candidate pair still in different
components is verified, so no link between components is lost: components are
exact. Grams are compared by 64-bit hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.blocks import BLOCK_BYTES, pack_blocks, text_bytes, unpacked
from millrace.llm.common import chain, mix, one, raw, release, texts, utf8, word_hashes
from millrace.llm.components import connected_components
from millrace.llm.counts import REQUEST_ARROW, REQUESTS, TOTALS, answered, as_table, n_ranges, requests, totals
from millrace.session import stage

PIVOTS = 16  # parts of the gram space for the suffix filter
_BITS = 48  # of a key in the count exchange; a clash only makes a gram look more frequent

PREFIXES = (
    "doc_id bigint, n bigint, class binary, cuts array<int>, "
    "grams array<bigint>, places array<int>, members binary"
)
_PREFIX_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("class", pa.binary()), ("cuts", pa.list_(pa.int32())),
    ("grams", pa.list_(pa.int64())), ("places", pa.list_(pa.int32())), ("members", pa.binary()),
])


def gram_sets(words: np.ndarray, ends: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of every text; a shorter text is one gram, an empty one none."""
    grams = chain(*(words[k : max(len(words) - n + 1 + k, k)] for k in range(n))) if len(words) >= n else words[:0]
    out = []
    for a, b in zip(ends[:-1], ends[1:]):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            out.append(chain(*(words[k : k + 1] for k in range(a, b))))
        else:
            out.append(words[:0])
    return out


def _block_sets(table: pa.Table, n: int) -> list[np.ndarray]:
    return gram_sets(*word_hashes(*utf8(table.column("text"))), n)


def _keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([*sets, np.zeros(0, np.uint64)]) >> np.uint64(64 - _BITS)
    return np.unique(keys, return_counts=True)


def prefixes(docs: DataFrame, n: int, num: int, den: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: set size, and for texts that may have a partner their class,
    prefix grams with their places, and (once per class and block) the full set."""
    blocks = pack_blocks(docs, block_bytes)
    ranges = n_ranges(text_bytes(blocks))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, table in unpacked(batch):
                rows = requests(block, {0: (*_keys(_block_sets(table, n)), _BITS)}, ranges)
                yield from as_table(rows, REQUEST_ARROW).to_batches()

    def order(block: pa.Table, answers: pa.Table) -> pa.Table:
        release()
        [(_, table)] = unpacked(block)
        sets = _block_sets(table, n)
        keys, _ = _keys(sets)
        found = answered(answers, 0)
        rows, seen = [], set()
        for doc_id, grams in zip(table.column("doc_id").to_pylist(), sets):
            size = len(grams)
            row = {"doc_id": doc_id, "n": size}
            rows.append(row)
            if not size:
                continue
            df = found[np.searchsorted(keys, grams >> np.uint64(64 - _BITS))]
            length = size - (num * size + den - 1) // den + 1
            if int((df == 1).sum()) >= length:
                continue
            rare_first = np.lexsort((grams, df))[:length]
            shared = np.flatnonzero(df[rare_first] > 1)
            row["class"] = hashlib.md5(raw(grams)).digest()
            row["grams"] = grams[rare_first[shared]].view(np.int64)
            row["places"] = shared.astype(np.int32)
            row["cuts"] = np.bincount((mix(grams) >> np.uint64(60)).astype(np.int64), minlength=PIVOTS).astype(np.int32)
            if row["class"] not in seen:
                seen.add(row["class"])
                row["members"] = raw(grams)
        return as_table(rows, _PREFIX_ARROW)

    asked = blocks.select("block", "packed").mapInArrow(ask, REQUESTS)
    # Staged, so that the keys' shuffle, about as large as the text, is gone before the blocks are moved.
    answers = stage(asked.groupBy("range").applyInArrow(totals, TOTALS).filter("block IS NOT NULL"), "counts")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(order, PREFIXES)


def _suffix_ok(num: int, den: int):
    """Symmetric difference allowed by the sizes, against its lower bound between pivots."""
    least = F.aggregate(F.zip_with("x.cuts", "y.cuts", lambda p, q: F.abs(p - q)), F.lit(0), lambda s, d: s + d)
    need = F.ceil(F.lit(num) * (F.col("x.n") + F.col("y.n")) / F.lit(num + den))
    return least <= F.col("x.n") + F.col("y.n") - 2 * need


def _meet_ok(num: int, den: int):
    """Length and positional filter of two rows that meet on a gram."""
    a, b = F.col("x.n"), F.col("y.n")
    rest = F.least(a - F.col("x.place"), b - F.col("y.place"))
    return (den * F.least(a, b) >= num * F.greatest(a, b)) & ((num + den) * rest >= num * (a + b))


def _pairs(met: DataFrame, num: int, den: int) -> DataFrame:
    return (
        met.filter(_suffix_ok(num, den))
        .select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b"))
        .distinct()
    )


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose full sets link."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            keep = []
            for x, y in zip(one(batch.column("x")).to_pylist(), one(batch.column("y")).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * same >= num * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return (
        pairs.join(sets.select(F.col("class").alias("a"), F.col("members").alias("x")), "a")
        .join(sets.select(F.col("class").alias("b"), F.col("members").alias("y")), "b")
        .mapInArrow(check, "a binary, b binary")
    )


def ngram_jaccard_join(
    docs: DataFrame, n: int = 3, num: int = 9, den: int = 10, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document, linked at ``num / den``.

    ``component_id`` is the smallest id reachable by links, the own id if there
    is none. An empty or NULL text has no grams and no link; a text of fewer
    than ``n`` words has its whole sequence as one gram. Rows of one id are one
    node with several sets. A row of NULL id is linked with nothing and has a
    NULL component.
    """
    base = texts(docs, id_col, text_col)
    rows = stage(prefixes(base, n, num, den), "prefixes")
    known = rows.filter("class IS NOT NULL AND doc_id IS NOT NULL")
    grams = (
        known.select("class", "n", "cuts", F.explode(F.arrays_zip("grams", "places")).alias("g"))
        .select(F.col("g.grams").alias("gram"), F.col("g.places").alias("place"), "class", "n", "cuts")
        .distinct()
    )
    first = F.min(F.struct("place", "class", "n", "cuts")).alias("y")
    leaders = grams.groupBy("gram").agg(first, F.count("*").alias("met")).filter("met > 1").select("gram", "y.*")
    stars = grams.alias("x").join(leaders.alias("y"), "gram").filter(F.col("x.class") != F.col("y.class"))
    pairs = stage(_pairs(stars.filter(_meet_ok(num, den)), num, den), "pairs")

    sets = known.filter("members IS NOT NULL").select("class", "members").dropDuplicates(["class"])
    links = stage(_verified(pairs, sets, num, den), "links")

    # Classes as nodes: a class is all documents of one set, named by its smallest id.
    classes = known.groupBy("class").agg(F.min("doc_id").alias("node"))
    copies = known.select("class", "doc_id").distinct().join(classes, "class").filter("doc_id <> node")
    copies = copies.select(F.col("node").alias("a"), F.col("doc_id").alias("b"))

    def named(links: DataFrame) -> DataFrame:
        a = classes.select(F.col("class").alias("a"), F.col("node").alias("na"))
        b = classes.select(F.col("class").alias("b"), F.col("node").alias("nb"))
        return links.join(a, "a").join(b, "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))

    edges = named(links).union(copies)
    found = connected_components(edges)

    # What is still apart: members outside their leader's component against all members.
    label = classes.join(found, classes["node"] == found["node"], "left").select(
        "class", F.coalesce("component", classes["node"]).alias("label")
    )
    labelled = grams.join(label, "class")
    per_gram = labelled.groupBy("gram").agg(F.min(F.struct("place", "class", "label")).alias("l"), F.min("label").alias("p"), F.max("label").alias("q"))
    mixed = stage(
        labelled.join(per_gram.filter("p <> q").select("gram", F.col("l.label").alias("main")), "gram"), "mixed"
    )
    x, y = mixed.filter("label <> main").alias("x"), mixed.alias("y")
    meets = (F.col("x.gram") == F.col("y.gram")) & (F.col("x.label") != F.col("y.label")) & _meet_ok(num, den)
    rest = stage(_pairs(x.join(y, meets), num, den).join(pairs, ["a", "b"], "left_anti"), "pairs")
    more = stage(_verified(rest, sets, num, den), "links")
    if not more.isEmpty():
        stars = found.select(F.col("component").alias("a"), F.col("node").alias("b"))
        found = connected_components(stars.union(named(more)))
    found = found.select(F.col("node").alias("doc_id"), "component")
    return rows.select("doc_id", F.col("n").alias("n_shingles")).join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def drop_near_duplicates(
    docs: DataFrame, n: int = 5, num: int = 8, den: int = 10, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id.

    Of several rows of one id, the one of the smallest text hash stays; rows of
    NULL id stay all.
    """
    found = ngram_jaccard_join(docs, n, num, den, id_col, text_col)
    away = found.filter("component_id <> doc_id").select(F.col("doc_id").alias("__id")).distinct()
    order = Window.partitionBy(id_col).orderBy(F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    rest = docs.join(away, F.col(id_col).cast("bigint") == F.col("__id"), "left_anti")
    named = rest.filter(F.col(id_col).isNotNull()).withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")
    return named.unionByName(rest.filter(F.col(id_col).isNull()))
