"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

A window is ``size`` consecutive words of a benchmark item; a shorter item is
one window. A document contains a window only if it contains all its words, so
one necessary token decides which documents to look at: the window's rarest
word, by its number of occurrences in all documents. Document words join the
windows on that token; the token's place in the window gives the only possible
start (positional bound), which must leave room for the whole window in the
document (length bound). What passes is compared word by word.

The benchmark is the stated query set. Its windows are broadcast in blocks of a
bounded number of bytes, so one benchmark of any size is handled by more blocks,
not by a larger broadcast; documents are never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import texts

# What separates words, before and after A-Z are lower-cased.
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SEPARATOR_CHARS = "".join(chr(c) for c in (*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_BYTES = 32 << 20  # of windows or words broadcast at once


def words_of(text: Column) -> Column:
    """Words in their own case; cutting doesn't depend on the case of A-Z."""
    trimmed = F.btrim(text, F.lit(_SEPARATOR_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SEPARATORS))


def _exact(words: Column) -> Column:
    return F.translate(F.array_join(words, " "), _UPPER, _LOWER)


def benchmark_windows(benchmark: DataFrame, size: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(window, length, items): distinct windows, lower-cased and joined by blanks."""
    items = benchmark.select(
        F.col(id_col).cast("string").alias("item"), words_of(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("words")
    ).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))
    cut = items.select("item", "words", F.explode(starts).alias("s")).select("item", F.slice("words", F.col("s") + 1, size).alias("w"))
    return cut.groupBy(_exact(F.col("w")).alias("window"), F.size("w").alias("length")).agg(F.collect_set("item").alias("items"))


def _blocks(small: DataFrame, measure: Column) -> list[DataFrame]:
    """Broadcast parts of at most about ``BLOCK_BYTES`` each, dealt by hash."""
    total = small.agg(F.sum(measure)).first()[0] or 0
    n = int(total) // BLOCK_BYTES + 1
    part = F.pmod(F.xxhash64(*small.columns[:1]), F.lit(n))
    return [F.broadcast(small.filter(part == k)) for k in range(n)]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def rarest_words(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """``windows`` with their necessary token: (token, offset, window, length, items)."""
    placed = windows.select("window", "length", "items", F.posexplode(F.split("window", " ")).alias("offset", "word")).withColumn(
        "token", F.lower("word")
    )
    vocabulary = placed.select(F.col("token").alias("word")).distinct()
    words = docs.select(F.explode(words_of(F.col("text"))).alias("w")).select(F.lower("w").alias("word"))
    counts = _union([words.join(v, "word").groupBy("word").count() for v in _blocks(vocabulary, F.octet_length("word") + 64)])
    ranked = placed.join(counts.withColumnRenamed("word", "token"), "token", "left")
    rarest = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token", "offset")).alias("r")
    chosen = ranked.groupBy("window", "length").agg(rarest)
    return windows.join(chosen, ["window", "length"]).select(
        F.col("r.token").alias("token"), F.col("r.offset").alias("offset"), "window", "length", "items"
    )


def window_matches(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Occurrences of windows: ``docs`` columns but the text, with ``start``, ``length``, ``items``."""
    keep = [c for c in docs.columns if c != "text"]
    cut = docs.select(*keep, words_of(F.col("text")).alias("words"))
    tokens = cut.select(*keep, "words", F.posexplode("words").alias("at", "w")).withColumn("token", F.lower("w"))
    start = F.col("at") - F.col("offset")
    found = (F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.size("words"))
    same = _exact(F.slice("words", F.greatest(F.col("start") + 1, F.lit(1)), F.col("length"))) == F.col("window")
    weight = 2 * F.octet_length("window") + 32 * F.size("items") + 64
    return _union([
        tokens.join(block, "token").withColumn("start", start).filter(found & same).select(*keep, "start", "length", "items")
        for block in _blocks(windows, weight)
    ])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) of every document.

    ``items`` are the sorted ids, as text, of the items with occurring windows;
    ``spans`` the sorted (start, end) word ranges of the occurrences. Equal items
    all count, an item of NULL id counts as hit words but has no name. Empty and
    NULL texts have no words; empty items no window. Rows of the same id and text
    are reported each.
    """
    base = texts(docs, id_col, text_col).withColumn("row", F.xxhash64("text"))
    windows = rarest_words(benchmark_windows(benchmark, size, item_col, item_text_col), base)
    hits = window_matches(base, windows).select(
        F.col("doc_id").alias("hit_id"), F.col("row").alias("hit_row"), F.struct("start", (F.col("start") + F.col("length")).alias("end")).alias("span"), "items"
    )
    per_doc = hits.groupBy("hit_id", "hit_row").agg(
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )

    def covered(acc: Column, s: Column) -> Column:
        add = F.greatest(s.getField("end") - F.greatest(acc.getField("end"), s.getField("start")), F.lit(0))
        return F.struct(F.greatest(acc.getField("end"), s.getField("end")).alias("end"), (acc.getField("n") + add).alias("n"))

    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    n_hit = F.aggregate("spans", zero, covered, lambda acc: acc.getField("n"))
    counted = base.select("doc_id", "row", F.size(words_of(F.col("text"))).cast("bigint").alias("n_words"))
    joined = counted.join(per_doc, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("row") == F.col("hit_row")), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce(n_hit, F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
    )


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``docs`` without the rows whose text contains a benchmark window."""
    base = texts(docs, id_col, text_col).withColumn("row", F.xxhash64("text"))
    windows = rarest_words(benchmark_windows(benchmark, size, item_col, item_text_col), base)
    hits = window_matches(base, windows).select(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).distinct()
    row = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return docs.join(hits, F.col(id_col).cast("bigint").eqNullSafe(F.col("__id")) & (row == F.col("__row")), "left_anti")
