"""Personal data: fixed patterns as seeds, and contexts bootstrapped from them.

Every text is searched once. Matches of the fixed patterns are seed entities.
Identifier-like strings the fixed patterns don't cover (numbers of seven digits
or more, anything around an ``@``) are candidates. Seeds and candidates have
lexical patterns: the two words to the left, and the words on both sides, with
the kind of entity.

Patterns and instances form a graph that Spark scores in rounds. A pattern's
confidence is the mean confidence of its distinct instances, if enough of
them are trusted; an instance is trusted as seeds are (1), or by its confident patterns
(one minus the product of their doubts). A candidate whose confidence passes
the limit is an identifier wherever it occurs, and so is one that equals a seed
up to its punctuation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import one, release, texts
from millrace.session import stage

KINDS = ("email", "ip", "card", "phone")
MASKS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")

# The base patterns. A run of digits can't begin a match within itself,
# which the look-behind says to keep the search linear.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_NUMBER = re.compile(r"(?<![0-9A-Za-z@.])[0-9(](?:[\x20().-]{0,2}[0-9]){6,18}(?![0-9A-Za-z@])")
_AT = re.compile(r"[^\s@]+@[^\s@]+")
_WORD = re.compile(r"\S+")
_CONTEXT = 80  # characters searched for context words on each side

_MENTION = "kind int, start int, end int, seed boolean, value string, left string, around string"
FOUND = f"doc_id bigint, row bigint, mentions array<struct<{_MENTION.replace(' ', ': ').replace(',:', ',')}>>"
_MENTION_ARROW = pa.struct([
    ("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_()),
    ("value", pa.string()), ("left", pa.string()), ("around", pa.string()),
])


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns' matches, by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(map(_small, m.group().split("."))):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        found = digits_of(m.group())
        if 13 <= len(found) <= 19 and _luhn(found):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return out


def _candidates(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Identifier-like strings that touch no base span."""
    spans = sorted((a, b) for _, a, b in taken)

    def free(a: int, b: int) -> bool:
        return all(b <= x or a >= y for x, y in spans)

    for m in _NUMBER.finditer(text):
        if free(*m.span()):
            n = len(digits_of(m.group()))
            yield (1 if m.group().count(".") == 3 else 2 if n >= 12 else 3), *m.span()
    if "@" in text:
        for m in _AT.finditer(text):
            if free(*m.span()):
                yield 0, *m.span()


def _context(word: str) -> str:
    return re.sub(r"[0-9]+", "0", word.strip(".,;:!?\"'()[]").lower())


def mentions(text: str) -> list[dict]:
    seeds = base_spans(text)
    rows = []
    for seed, (kind, a, b) in [*((True, s) for s in seeds), *((False, c) for c in _candidates(text, seeds))]:
        left = [_context(w) for w in _WORD.findall(text[max(0, a - _CONTEXT) : a])[-2:]]
        right = [_context(w) for w in _WORD.findall(text[b : b + _CONTEXT])[:1]]
        value = text[a:b].lower() if kind == 0 else digits_of(text[a:b]) if kind > 1 else text[a:b]
        rows.append({
            "kind": kind, "start": a, "end": b, "seed": seed, "value": value,
            "left": f"{KINDS[kind]} L {' '.join(left)}" if len(left) == 2 else None,
            "around": f"{KINDS[kind]} A {left[-1]} _ {right[0]}" if left and right else None,
        })
    return rows


def search(docs: DataFrame) -> DataFrame:
    """(doc_id, row, mentions) of each (doc_id, row, text)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        digit = re.compile("[0-9]")
        for batch in batches:
            found = [mentions(t) if "@" in t or digit.search(t) else [] for t in one(batch.column("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(found, pa.list_(_MENTION_ARROW))], ["doc_id", "row", "mentions"]
            )

    return docs.mapInArrow(find, FOUND)


def bootstrap(found: DataFrame, rounds: int = 3, min_trusted: float = 3.0, min_confidence: float = 0.8) -> DataFrame:
    """(kind, value) of the discovered identifiers, by scoring the pattern-instance graph."""
    m = found.select(F.explode("mentions").alias("m")).select("m.*")
    edges = stage(
        m.select("kind", "value", "seed", F.explode(F.array("left", "around")).alias("pattern"))
        .groupBy("kind", "value", "pattern")
        .agg(F.max("seed").alias("seed")),
        "edges",
    )
    known = m.groupBy("kind", "value").agg(F.max("seed").cast("double").alias("trust"))
    trust = stage(known, "trust")
    edges = edges.filter("pattern IS NOT NULL").select("kind", "value", "pattern")
    for _ in range(rounds):
        patterns = (
            edges.join(trust, ["kind", "value"])
            .groupBy("pattern")
            .agg(F.avg("trust").alias("confidence"), F.sum("trust").alias("trusted"))
            .filter((F.col("trusted") >= min_trusted) & (F.col("confidence") >= min_confidence))
        )
        doubt = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9))))
        lent = edges.join(patterns, "pattern").groupBy("kind", "value").agg((1 - F.exp(doubt)).alias("lent"))
        trust = stage(
            trust.join(lent, ["kind", "value"], "left").select("kind", "value", F.greatest("trust", F.coalesce("lent", F.lit(0.0))).alias("trust")),
            "trust",
        )
    return trust.filter(F.col("trust") >= min_confidence).select("kind", "value")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bootstrapping) -> DataFrame:
    """(doc_id, row, base, spans) of every row: sorted (kind, start, end) spans, offsets in
    code points, end exclusive. ``base`` are the fixed patterns' spans, ``spans`` all.

    ``row`` is the text's hash; rows of the same id and text are reported each.
    NULL and empty texts have no spans.
    """
    base = texts(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("row"), "text")
    # Numbers of rows are fixed by writing them: repeated rows stay apart below.
    found = stage(search(base).withColumn("line", F.monotonically_increasing_id()), "mentions")
    accepted = bootstrap(found, **bootstrapping)
    wanted = found.select("line", F.explode("mentions").alias("m")).select("line", "m.*").filter("NOT seed")
    extra = wanted.join(accepted, ["kind", "value"], "left_semi").groupBy("line").agg(F.collect_set(F.struct("kind", "start", "end")).alias("extra"))
    seeds = F.transform(F.filter("mentions", lambda x: x["seed"]), _span)
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    return found.join(extra, "line", "left").select(
        "doc_id", "row", F.array_sort(seeds).alias("base"), F.array_sort(F.array_union(seeds, F.coalesce("extra", none))).alias("spans")
    )


def _span(x: Column) -> Column:
    return F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))


def mask(text: str, spans: list[dict]) -> str:
    """The text with every span replaced by its kind's mask; overlapping spans by the first one's."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [text[at : s["start"]], MASKS[s["kind"]]]
        at = max(at, s["end"])
    return "".join(out) + text[at:]


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bootstrapping) -> DataFrame:
    """``docs`` with masked texts; NULL texts stay NULL. Columns and rows stay as they are."""
    spans = find_pii(docs, id_col, text_col, **bootstrapping).filter(F.size("spans") > 0).dropDuplicates(["doc_id", "row"])
    spans = spans.select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"), F.col("spans").alias("__spans"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    same = F.col(id_col).cast("bigint").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__row"))
    joined = docs.join(spans, same, "left").drop("__id", "__row")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            found, column = one(batch.column("__spans")).to_pylist(), one(batch.column(text_col))
            masked = [mask(t, s) if s else t for t, s in zip(column.to_pylist(), found)]
            names = [n for n in batch.schema.names if n != "__spans"]
            yield pa.RecordBatch.from_arrays([pa.array(masked, column.type) if n == text_col else batch.column(n) for n in names], names)

    return joined.mapInArrow(rewrite, docs.schema)
