"""Quality classifier: supervised subword embeddings.

A document is the mean of the vectors of its words, word pairs and byte n-grams, all hashed into one table; a softmax over two classes
follows. Vectors and softmax are learned together by stochastic gradient descent in numpy. For scoring, each vector is
projected on the difference of the two output rows, so a document's logit is the mean of one number for each feature.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.llm import tables

BUCKET_BITS = 17
DIMENSIONS = 8
GRAMS = (3, 5)
#: Bound of the training sample, in labelled rows; it bounds the fit, not the scoring.
MAX_TRAINING_ROWS = 2000
EPOCHS = 4
RATE = 0.5
#: Bytes that are hashed at a time; longer texts are hashed in slices that share their n-grams.
SLICE = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3
_POWERS = np.array([pow(_BASE, k, 1 << 64) for k in range(64)], np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0, 9, 10, 11, 12, 13, 32]] = True


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def _offsets(starts: np.ndarray, n: int) -> np.ndarray:
    """Distance of each position from the last start at or before it."""
    last = np.zeros(n, np.int64)
    last[starts] = starts
    return np.arange(n) - np.maximum.accumulate(last)


def features(raw: bytes) -> np.ndarray:
    """Buckets of the byte n-grams, words and word pairs of one slice of text; a pair's hash is the difference of its words'."""
    b = np.frombuffer(raw, np.uint8)
    x = b.astype(np.uint64) + np.uint64(1)
    out = []
    for n in GRAMS:
        if len(x) >= n:
            h = np.zeros(len(x) - n + 1, np.uint64)
            for k in range(n):
                h = h * np.uint64(_BASE) + x[k : len(x) - n + 1 + k]
            out.append(_bucket(h + np.uint64(n)))
    inside = np.concatenate(([False], ~_SPACE[b], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if len(starts):
        at = _offsets(starts, len(b))
        terms = np.where(inside[1:-1], x * _POWERS[at & 63], np.uint64(0))
        words = np.add.reduceat(terms, starts) * np.uint64(3) + (ends - starts).astype(np.uint64)
        out.append(_bucket(words))
        out.append(_bucket((words[1:] - words[:-1]) * np.uint64(5) + np.uint64(1)))
    return np.concatenate(out) if out else np.zeros(0, np.int32)


def slices(raw: bytes) -> Iterator[bytes]:
    step = SLICE - max(GRAMS) + 1
    for at in range(0, max(len(raw) - max(GRAMS) + 1, 1), step):
        yield raw[at : at + SLICE]


class Model:
    """``weights[b]`` is what a feature in bucket b adds to the mean; ``bias`` comes on top."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def score(self, text: str) -> float:
        total, n = 0.0, 0
        for part in slices(text.encode("utf-8", "surrogatepass")):
            f = features(part)
            total += float(self.weights[f].sum(dtype=np.float64))
            n += len(f)
        return float(1 / (1 + np.exp(-np.clip((total / n if n else 0.0) + self.bias, -40, 40))))


def train(texts: list[str], labels: list[int], seed: int = 7) -> Model:
    """Fit on the given rows; without both classes the score is their share of ones (a half when there are none)."""
    share = (sum(labels) + 0.5) / (len(labels) + 1)
    if len(set(labels)) < 2:
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    bags = []
    for t in texts:
        counts: list[np.ndarray] = [features(p) for p in slices(t.encode("utf-8", "surrogatepass"))]
        f, n = np.unique(np.concatenate(counts), return_counts=True)
        bags.append((f, (n / max(1, n.sum())).astype(np.float32)))
    table = rng.normal(0, 0.1, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    output = rng.normal(0, 0.1, (2, DIMENSIONS)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    steps = EPOCHS * len(bags)
    done = 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            f, w = bags[i]
            rate = RATE * (1 - done / steps) + 0.01
            hidden = w @ table[f] if len(f) else np.zeros(DIMENSIONS, np.float32)
            logits = output @ hidden + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = p @ output
            output -= rate * np.outer(p, hidden)
            bias -= rate * 0.1 * p
            if len(f):
                table[f] -= (rate * 20 * w)[:, None] * back
            done += 1
    return Model((table @ (output[1] - output[0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_TRAINING_ROWS) -> Model:
    """Train on at most ``max_rows`` labelled rows outside the held-out fold; repeated texts count as often as they come."""
    rows = tables.labelled(docs, labels, label, max_rows).orderBy("doc_id", "text").collect()
    return train([r["text"] for r in rows], [r["label"] for r in rows])


def score(text: Column, model: Model) -> Column:
    """Score of every text, 0 to 1; null and empty texts get what the model gives to no features."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.score(t) for t in texts], dtype="float64")

    return run(F.coalesce(text, F.lit("")))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Labels of the held-out fold are never seen; language, source and id are never inputs. Null texts count as empty, null ids
    as held out, repeated rows each get a row; other columns are not read; an empty table gives an empty result. Whole
    texts are read: long ones in slices that share their n-grams, where a word cut at a slice's end counts as two.
    """
    model = fit(docs, labels, "quality", max_rows)
    scored = docs.select("doc_id", tables.held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
