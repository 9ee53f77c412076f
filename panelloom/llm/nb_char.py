"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text is the set of the hashed n-grams of its lower-cased characters. On a bounded sample of labelled texts each n-gram
gets the log ratio of its document frequencies in the two classes; those whose frequencies differ beyond chance
become features, present ones with their ratio as value; a logistic regression weighs them. Scoring looks every
n-gram of a text up in one table, so its memory does not depend on the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.labelled import fold, sample

SIZES = (3, 4, 5, 6)
HASH_BITS = 20
_FACTOR = 0x9E3779B97F4A7C15
_STEP = 1 << 18
#: Bounds of the training sample.
PER_CLASS = 2000
MAX_CHARS = 100_000


def _grams(data: np.ndarray) -> Iterator[np.ndarray]:
    """Bucket of every n-gram of each size, of code points already lower-cased."""
    total = np.zeros(len(data), np.uint64)
    for n in range(1, SIZES[-1] + 1):
        total = total[: max(0, len(data) - n + 1)] + data[n - 1 :] * np.uint64(pow(_FACTOR, n, 1 << 64))
        if not len(total):
            return
        if n in SIZES:
            mixed = (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            yield (mixed >> np.uint64(64 - HASH_BITS)).astype(np.uint32)


def buckets(text: str | None, wanted: np.ndarray | None = None) -> np.ndarray:
    """The distinct buckets of a text, or those of them that are ``wanted``; in steps, whatever its length."""
    low = f" {text or ''} ".lower()
    found = [np.zeros(0, np.uint32)]
    for at in range(0, max(1, len(low) - SIZES[-1] + 1), _STEP):
        data = np.frombuffer(low[at : at + _STEP + SIZES[-1] - 1].encode("utf-32-le"), "<u4")
        for grams in _grams(data.astype(np.uint64)):
            found.append(np.unique(grams if wanted is None else grams[wanted[grams]]))
    return np.unique(np.concatenate(found))


@dataclass
class Model:
    """Weights of the buckets (ratio times coefficient), zero for those that are no feature, and the bias."""

    feature: np.ndarray
    weight: np.ndarray
    bias: float

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        wanted, weights = np.zeros(1 << HASH_BITS, bool), np.zeros(1 << HASH_BITS)
        wanted[self.feature], weights[self.feature] = True, self.weight
        return wanted, weights


def train(texts: list[str], labels: np.ndarray, significance: float = 5.0, decay: float = 1e-3, rounds: int = 300) -> Model:
    """Logistic regression on ratio-scaled features, both classes weighing the same.

    With one class only, the score is that class's share for every text.
    """
    size = 1 << HASH_BITS
    rows = [buckets(t) for t in texts]
    positive = np.asarray(labels) == 1
    n_pos, n_neg = int(positive.sum()), int((~positive).sum())
    if not n_pos or not n_neg:
        return Model(np.zeros(0, np.int64), np.zeros(0), 20.0 if n_pos else -20.0)
    count = lambda keep: np.bincount(np.concatenate([r for r, k in zip(rows, keep, strict=True) if k]), minlength=size)
    pos, neg = count(positive), count(~positive)
    ratio = np.log((pos + 1) / (n_pos + 2)) - np.log((neg + 1) / (n_neg + 2))
    share = (pos + neg) / (n_pos + n_neg)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n_pos + 1 / n_neg))
    feature = np.flatnonzero((np.abs(pos / n_pos - neg / n_neg) >= significance * spread) & (pos + neg >= 3))
    place = np.full(size, -1)
    place[feature] = np.arange(len(feature))
    held = [place[r][place[r] >= 0] for r in rows]
    column, scale = np.concatenate(held).astype(np.int64), ratio[feature]
    row = np.repeat(np.arange(len(rows)), [len(h) for h in held])
    value = scale[column]
    importance = np.where(positive, 0.5 / n_pos, 0.5 / n_neg)
    beta, bias = np.zeros(len(feature) + 1), 0.0
    first, second = np.zeros(len(feature) + 1), np.zeros(len(feature) + 1)
    for step in range(1, rounds + 1):
        score = np.bincount(row, value * beta[:-1][column], len(rows)) + beta[-1]
        error = (1 / (1 + np.exp(-np.clip(score, -40, 40))) - positive) * importance
        slope = np.append(np.bincount(column, value * error[row], len(feature)) + decay * beta[:-1], error.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        beta = beta - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    bias = float(beta[-1])
    return Model(feature, beta[:-1] * scale, bias)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Model:
    """Train on the rows of ``labels`` (key, label 0 or 1) that lie in the training folds."""
    learnt = labels.filter(fold(F.col("key"), 3) != 1)
    found = sample(learnt, docs, per_class, max_chars)
    return train(found["text"].tolist(), found["label"].to_numpy())


def score_documents(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``score`` per row. A null text scores as an empty one; repeated rows score alike."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most 2 ** HASH_BITS weights

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, weights = sent.value.table()
        for batch in batches:
            total = [float(weights[buckets(t.as_py(), wanted)].sum()) + sent.value.bias for t in batch.column(1)]
            scores = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    chosen = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(scan, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. ``labels`` has doc_id and toxic.

    Labels of held-out documents, and null labels or keys, are not learnt from. Without labels every score is
    that of no evidence. A null or empty text scores as one without n-grams of its own; a text of any length is
    scored whole; repeated rows score alike; an empty table gives an empty result.
    """
    known = labels.select(F.col("doc_id").alias("key"), F.col("toxic").cast("int").alias("label"))
    model = fit(docs.select(F.col("doc_id").alias("key"), "text"), known)
    scored = score_documents(docs, model)
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
