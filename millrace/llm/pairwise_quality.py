"""Quality scores from preference pairs: a Bradley-Terry model on text features.

A document of label 1 is preferred to one of label 0. The strength of a document
is linear in features of its whole text; the probability that one is preferred
is the logistic function of the difference of strengths, so the weights are those
of a logistic regression on feature differences, without intercept.

The model is fitted on a bounded sample: at most ``sample_per_label`` labelled
documents of each label, the smallest by a hash of the id, outside the held-out
fold. Pairs are drawn from the sample, ``pairs_per_document`` for each document.
The threshold is a quantile of the sample's strengths, at the share of label 0
among all labelled documents of the training folds; scores are the logistic
function of the strength, shifted to be 0.3 there.

Labels are used for fitting only; language, source and id are never features.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fold, one, texts

SAMPLE_PER_LABEL = 4000
PAIRS_PER_DOCUMENT = 8
THRESHOLD = 0.3
_EPS = 1e-3

# Byte classes of the character features.
_GROUPS = (b"#*$%&<>@^_~\\+=", b"|", b"!", b"?", b".", b",;:", b"0123456789", b"()[]{}\"'/-", b"\n")
_BYTE_CLASS = np.full(256, len(_GROUPS) + 2, np.int64)
for _k, _chars in enumerate(_GROUPS):
    _BYTE_CLASS[list(_chars)] = _k
_BYTE_CLASS[65:91] = len(_GROUPS)
_BYTE_CLASS[97:123] = len(_GROUPS) + 1
_BYTE_CLASS[128:] = len(_GROUPS) + 3
N_FEATURES = 2 * len(_GROUPS) + 17


def features(text: bytes) -> list[float]:
    """Fixed-length features of a whole text; of an empty one, those of no words."""
    counts = np.bincount(_BYTE_CLASS[np.frombuffer(text, np.uint8)], minlength=len(_GROUPS) + 4)
    size = max(len(text), 1)
    words = text.split()
    n = max(len(words), 1)
    times = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    same = sum(map(bytes.__eq__, words, words[1:]))
    top = times.most_common(1)[0][1] if times else 0
    lines = [x for x in text.split(b"\n") if x.strip()]
    ended = sum(x.rstrip()[-1:] in b".!?" for x in lines)
    marked = sum(w[-1:] not in b".,;:?" and not w[-1:].isalnum() and w[-1] < 128 for w in words)
    m = max(len(lines), 1)
    shares = [c / size for c in counts]
    out = [
        np.log1p(len(words)), float(lengths.mean()), float(lengths.std()),
        len(times) / n, np.log(_EPS + same / n), np.log(_EPS + top / n), np.log(_EPS + marked / n),
        len(set(lines)) / m, ended / m, np.log1p(n / m), np.log(_EPS + 1 - len(times) / n),
        shares[len(_GROUPS)], shares[len(_GROUPS) + 1], shares[len(_GROUPS) + 3],
        np.log(_EPS + shares[len(_GROUPS)]), float(len(words) < 20), float(len(words) < 50),
    ]
    for share in shares[: len(_GROUPS)]:
        out += [np.log(_EPS + share), share]
    return out


def _matrix(column) -> np.ndarray:
    array = one(column)
    wide = pa.types.is_large_string(array.type)
    rows = [features(x) for x in array.cast(pa.large_binary() if wide else pa.binary()).to_pylist()]
    return np.array(rows, np.float64).reshape(-1, N_FEATURES)


class BradleyTerry:
    """Strength of a text: a linear function of its standardised features."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, cut: float):
        self.mean, self.scale, self.weights, self.cut = mean, scale, weights, cut

    def strengths(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.strengths(x) - self.cut, -500, 500) + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-z))


def fit_pairs(x: np.ndarray, y: np.ndarray, share_bad: float, pairs: int = PAIRS_PER_DOCUMENT, l2: float = 1.0) -> BradleyTerry:
    """Newton's method on the logistic loss of feature differences.

    Without documents of both labels there are no pairs: all weights are 0 and
    every text scores the threshold.
    """
    mean = x.mean(axis=0) if len(x) else np.zeros(N_FEATURES)
    scale = np.maximum(x.std(axis=0), 1e-9) if len(x) else np.ones(N_FEATURES)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    model = BradleyTerry(mean, scale, np.zeros(N_FEATURES), 0.0)
    if not len(good) or not len(bad):
        return model
    z = np.clip((x - mean) / scale, -6, 6)
    n = pairs * max(len(good), len(bad))
    rng = np.random.Generator(np.random.PCG64(7))
    d = z[good[rng.permutation(n) % len(good)]] - z[bad[rng.permutation(n) % len(bad)]]
    w = np.zeros(N_FEATURES)
    for _ in range(30):
        p = 1 / (1 + np.exp(d @ w))
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + l2 * np.eye(N_FEATURES), d.T @ p - l2 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    model.weights = w
    # The sample has its own share of label 0; weights restore that of the labelled documents.
    s = model.strengths(x)
    mass = np.where(y == 1, (1 - share_bad) / len(good), share_bad / len(bad))
    order = np.argsort(s)
    at = min(int(np.searchsorted(np.cumsum(mass[order]), share_bad)), len(s) - 1)
    model.cut = float((s[order[at]] + s[order[min(at + 1, len(s) - 1)]]) / 2)
    return model


def training_sample(docs: DataFrame, labels: DataFrame, folds: int, per_label: int, label_col: str) -> tuple[np.ndarray, np.ndarray, float]:
    """Features and labels of the bounded sample, and the share of label 0 of all that could be in it.

    A document labelled both ways is left out; repeated equal labels count once.
    """
    own = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    own = own.filter("doc_id IS NOT NULL AND y IN (0, 1)").filter(fold("doc_id", folds) != 0)
    own = own.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("other")).filter("y = other").select("doc_id", "y")
    n, ones = own.agg(F.count("*"), F.sum("y")).first()
    first = [own.filter(F.col("y") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for k in (0, 1)]
    chosen = F.broadcast(first[0].union(first[1]))  # at most 2 * per_label rows

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("text"))
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), N_FEATURES).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), values], ["doc_id", "y", "x"])

    rows = docs.join(chosen, "doc_id").select("doc_id", "y", "text").mapInArrow(extract, "doc_id bigint, y int, x array<double>").toArrow()
    x = np.array(rows.column("x").to_pylist(), np.float64).reshape(-1, N_FEATURES)
    y = np.array(rows.column("y").to_pylist(), np.int64)
    order = np.lexsort((*x.T[:3], np.array(rows.column("doc_id").to_pylist(), np.int64)))  # whatever order tasks end in
    return x[order], y[order], 1 - (ones or 0) / n if n else 0.0


def pairwise_quality(
    docs: DataFrame, labels: DataFrame, folds: int = 5, sample_per_label: int = SAMPLE_PER_LABEL, label_col: str = "quality",
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; NULL texts are scored as empty ones."""
    base = texts(docs, id_col, text_col)
    model = fit_pairs(*training_sample(base, labels, folds, sample_per_label, label_col))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(_matrix(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores)], ["doc_id", "held_out", "score"])

    rows = base.withColumn("held_out", fold("doc_id", folds) == 0)
    scored = rows.mapInArrow(score, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
