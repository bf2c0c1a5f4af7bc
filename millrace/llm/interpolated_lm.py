"""Word language model by deleted interpolation, counted and applied over the whole corpus.

    p(w | h) = l2(b) * c(h w) / c(h) + l1(b) * c(w) / N + l0(b) / (V + 1),  b = bucket of c(h)

Maximum-likelihood estimates of two orders and a uniform floor (one share for
all unknown words) are mixed by weights that depend on how often the context
was seen: bucket ``b`` holds contexts of 2**(b-1) to 2**b - 1 occurrences,
bucket 0 unseen ones. The weights come from expectation-maximisation on held-out
counts: every training document is scored by the counts of all training documents
but itself (deleted estimation).

Counts are exact; words and pairs are told apart by 64-bit hashes, so that of ``n`` pairs
one in ``2**64 / n`` shares its key with another one. Documents are packed into blocks; ``llm.counts`` answers each
block with the corpus counts of its distinct words and word pairs, so common
words cost one entry per block. The answers are written once and read by both
later passes, the EM statistics and the scores. EM itself runs on a table of
(bucket, ratio, ratio) cells whose ratios are rounded to eighths of a binary
order: at most some hundred thousand cells whatever the corpus, typically a
few thousand.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import BLOCK_BYTES, pack_blocks, text_bytes, unpacked
from millrace.llm.common import chain, fold, texts, utf8, word_hashes
from millrace.llm.counts import REQUEST_ARROW, REQUESTS, TOTALS, answered, as_table, n_ranges, requests, totals
from millrace.session import stage

# Keys of the text's begin and end; a word's hash meets them with the odds of 2**-64.
_BEGIN, _END = np.uint64(0x5BD1E9955BD1E995), np.uint64(0xC2B2AE3D27D4EB4F)
_WORD, _PAIR = 0, 1  # kinds of keys
_STEPS = 8  # EM cells per binary order
_FLOOR = 64  # a zero estimate's place in the cells, below any ratio
_SHIFT = 1 << 16

SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
_SCORE_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
    ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
])
CELLS = "bucket int, r2 int, r1 int, n bigint"


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(values, return_inverse=True)
    return found, at.astype(np.int32)


class _Block:
    """Tokens of a block of documents as arrays: each token with its predecessor."""

    def __init__(self, table: pa.Table):
        words, ends = word_hashes(*utf8(table.column("text")))
        docs = len(ends) - 1
        # One end per document, after its words.
        tokens = np.insert(words, ends[1:], _END) if docs else words
        self.ends = ends + np.arange(docs + 1)
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[self.ends[:-1]] = _BEGIN
        pairs = chain(before, tokens)
        del words, before
        self.words, self.word_at = _distinct(tokens)
        del tokens
        self.keys, self.pair_at = _distinct(pairs)
        self.train = np.repeat(np.array(table.column("train").to_pylist(), bool), np.diff(self.ends))

    def requests(self, block: int, ranges: int) -> list[dict]:
        def count(at, size):
            return np.bincount(at, weights=self.train, minlength=size).astype(np.uint32)

        keys = {
            _WORD: (self.words, count(self.word_at, len(self.words)), 64),
            _PAIR: (self.keys, count(self.pair_at, len(self.keys)), 64),
        }
        return requests(block, keys, ranges)

    def counts(self, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """c(h w), c(h), c(w) of every token. A text begins as often as one ends."""
        word = answered(answers, _WORD)
        c1 = word[self.word_at]
        end = int(word[np.searchsorted(self.words, _END)]) if len(self.words) else 0
        ch = np.empty_like(c1)
        ch[1:] = c1[:-1]
        ch[self.ends[:-1]] = end
        return answered(answers, _PAIR)[self.pair_at], ch, c1


def _buckets(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1]  # bit length; 0 for 0


def _cells(n: int, v: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """EM events of training documents, each scored without its own counts."""

    def cells(packed: pa.Table, answers: pa.Table) -> pa.Table:
        [(_, table)] = unpacked(packed)
        block = _Block(table)
        chw, ch, cw = block.counts(answers)
        found = []
        for a, b in zip(block.ends[:-1], block.ends[1:]):
            if not block.train[a]:
                continue
            size = b - a

            def own(ids):
                _, at, times = np.unique(ids[a:b], return_inverse=True, return_counts=True)
                return times[at]

            mine = own(block.word_at)
            before = np.concatenate([[1], mine[:-1]])
            c2, c, c1 = chw[a:b] - own(block.pair_at), ch[a:b] - before, cw[a:b] - mine
            r2 = np.full(size, -_FLOOR * _STEPS)
            r1 = r2.copy()
            ok = (c2 > 0) & (c > 0)
            r2[ok] = np.rint(_STEPS * np.log2(c2[ok] / c[ok] * (v + 1)))
            ok = c1 > 0
            r1[ok] = np.rint(_STEPS * np.log2(c1[ok] / max(n - size, 1) * (v + 1)))
            # One number per cell: three fields, the ratios shifted to be positive.
            found.append((_buckets(np.maximum(c, 0)).astype(np.int64) << 40) | ((r2 + _SHIFT) << 20) | (r1 + _SHIFT))
        codes, times = np.unique(np.concatenate([*found, np.zeros(0, np.int64)]), return_counts=True)
        field = (1 << 20) - 1
        return pa.table({
            "bucket": pa.array((codes >> 40).astype(np.int32)),
            "r2": pa.array(((codes >> 20 & field) - _SHIFT).astype(np.int32)),
            "r1": pa.array(((codes & field) - _SHIFT).astype(np.int32)),
            "n": pa.array(times.astype(np.int64)),
        })

    return cells


def mixture_weights(cells: np.ndarray, rounds: int = 40) -> np.ndarray:
    """(buckets, 3) weights l2, l1, l0 by EM. cells: rows of (bucket, r2, r1, n).

    A bucket without events takes the weights of the next lower one; bucket 0
    gives nothing to the pair estimate, which doesn't exist there.
    """
    out = np.zeros((65, 3))
    last = np.array([0.0, 0.0, 1.0])
    for b in range(65):
        own = cells[cells[:, 0] == b]
        if len(own):
            p = np.stack([
                np.where(own[:, 1] <= -_FLOOR * _STEPS, 0.0, 2.0 ** (own[:, 1] / _STEPS)),
                np.where(own[:, 2] <= -_FLOOR * _STEPS, 0.0, 2.0 ** (own[:, 2] / _STEPS)),
                np.ones(len(own)),
            ], axis=1)
            if b == 0:
                p[:, 0] = 0.0
            last = np.full(3, 1 / 3)
            for _ in range(rounds):
                share = p * last
                share *= (own[:, 3] / share.sum(axis=1))[:, None]
                last = share.sum(axis=0) / own[:, 3].sum()
        out[b] = last
    return out


def _scores(n: int, v: int, weights: np.ndarray, alpha: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def scores(packed: pa.Table, answers: pa.Table) -> pa.Table:
        [(_, table)] = unpacked(packed)
        block = _Block(table)
        chw, ch, cw = block.counts(answers)
        mix = weights[_buckets(ch)]
        p = mix[:, 1] * cw / max(n, 1) + mix[:, 2] / (v + 1)
        seen = ch > 0
        p[seen] += mix[seen, 0] * chw[seen] / ch[seen]
        firsts = block.ends[:-1]

        def per_doc(x):
            return np.add.reduceat(x, firsts) if len(firsts) else np.zeros(0)

        return pa.table({
            "doc_id": table.column("doc_id"), "held_out": table.column("held_out"),
            "n_tokens": pa.array(np.diff(block.ends)),
            "n_known": pa.array(per_doc((cw > 0).astype(np.int64)).astype(np.int64)),
            "base_score": pa.array(per_doc(np.log10((cw + alpha) / (n + alpha * (v + 1))))),
            "score": pa.array(per_doc(np.log10(p))),
        }, schema=_SCORE_ARROW)

    return scores


def interpolated_lm(
    docs: DataFrame, folds: int = 10, alpha: float = 0.1, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Fold 0 of the ids' crc32 is held out and never counted. Empty texts are one end
    token. Without any training text all tokens are unknown and share the floor,
    which then has all the weight.
    """
    base = texts(docs, id_col, text_col)
    held = fold("doc_id", folds) == 0
    blocks = pack_blocks(base.select("doc_id", "text", held.alias("held_out"), (~held).alias("train")), block_bytes)
    ranges = n_ranges(text_bytes(blocks))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, table in unpacked(batch):
                yield from as_table(_Block(table).requests(block, ranges), REQUEST_ARROW).to_batches()

    asked = blocks.select("block", "packed").mapInArrow(ask, REQUESTS)
    counted = stage(asked.groupBy("range", "kind").applyInArrow(totals, TOTALS), "counts")
    sums = counted.filter(f"block IS NULL AND kind = {_WORD}").agg(F.sum("n_all"), F.sum("n_keys")).first()
    n, v = int(sums[0] or 0), int(sums[1] or 0)

    answers = counted.filter("block IS NOT NULL")
    met = blocks.groupBy("block").cogroup(answers.groupBy("block"))
    cells = met.applyInArrow(_cells(n, v), CELLS).groupBy("bucket", "r2", "r1").agg(F.sum("n").alias("n"))
    events = np.array([tuple(r) for r in cells.collect()], np.int64).reshape(-1, 4)
    weights = mixture_weights(events)
    if not len(events):
        weights[:] = (0.0, 0.0, 1.0)
    scored = met.applyInArrow(_scores(n, v, weights, alpha), SCORES)
    return scored.withColumn("train_tokens", F.lit(n).cast("bigint")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
