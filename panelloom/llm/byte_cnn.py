"""Language identification by a convolutional network over bytes, in numpy.

A window of bytes is embedded, convolved with filters of several widths, rectified, max-pooled over the window and
classified by softmax. Whole texts are cut into fixed-length windows, and a text's class scores are the mean of
its windows', weighted by their bytes. For scoring, embedding and filters are folded into tables over single
bytes and byte pairs, so a filter of width four costs two lookups.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.labelled import fold, sample

WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 10
WINDOW = 256
#: Bounds of the training sample.
PER_CLASS = 1500
MAX_CHARS = 100_000
UNKNOWN = "und"
_TAIL = max(WIDTHS) - 1
_LETTER = re.compile(r"[^\W\d_]").search
_BLOCK = 256  # windows scored at once


@dataclass
class Network:
    labels: list[str]
    embed: np.ndarray
    filters: list[np.ndarray]  # per width: (width * EMBED, FILTERS)
    shifts: list[np.ndarray]
    dense: np.ndarray
    bias: np.ndarray
    _tables: list = field(default_factory=list)

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, *self.shifts, self.dense, self.bias]

    def tables(self) -> list[list[tuple[int, int, np.ndarray]]]:
        """Per width: (place, bytes, table); a table of two bytes is indexed by the pair."""
        if not self._tables:
            for width, k, shift in zip(WIDTHS, self.filters, self.shifts, strict=True):
                single = [self.embed @ k[j * EMBED : (j + 1) * EMBED] for j in range(width)]
                single[0] = single[0] + shift
                parts = []
                for j in range(0, width, 2):
                    pair = j + 1 < width
                    table = (single[j][:, None] + single[j + 1][None]).reshape(-1, FILTERS) if pair else single[j]
                    parts.append((j, 2 if pair else 1, np.ascontiguousarray(table, np.float32)))
                self._tables.append(parts)
        return self._tables

    def windows(self, data: np.ndarray) -> np.ndarray:
        """Class scores of each window of ``data``: whole windows, and the bytes after the last."""
        n = (len(data) - _TAIL) // WINDOW
        pairs = data[:-1].astype(np.uint16) << 8 | data[1:]
        out = np.empty((n, len(WIDTHS) * FILTERS), np.float32)
        for lo in range(0, n, _BLOCK):
            hi = min(n, lo + _BLOCK)
            a, b = lo * WINDOW, hi * WINDOW
            for w, parts in enumerate(self.tables()):
                total = None
                for j, size, table in parts:
                    got = table.take((pairs if size == 2 else data)[a + j : b + j], axis=0)
                    total = got if total is None else np.add(total, got, out=total)
                out[lo:hi, w * FILTERS : (w + 1) * FILTERS] = total.reshape(hi - lo, WINDOW, FILTERS).max(1)
        return np.maximum(out, 0) @ self.dense + self.bias


def _laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts side by side, each filled up with zeros to whole windows: bytes, windows per text, bytes per window."""
    counts = np.array([-(-(len(t) + _TAIL) // WINDOW) for t in texts])
    data = b"".join(t.ljust(n * WINDOW, b"\0") for t, n in zip(texts, counts.tolist(), strict=True)) + bytes(_TAIL)
    ends = np.cumsum(counts)
    within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
    sizes = np.clip(np.repeat([len(t) for t in texts], counts) - within * WINDOW, 0, WINDOW)
    return np.frombuffer(data, np.uint8), counts, sizes.astype(np.float64)


def train(texts: list[str], labels: list[str], steps: int = 900, batch: int = 64, rate: float = 3e-3, seed: int = 7) -> Network:
    """Fit by Adam on random windows of the texts, every class as often as any other."""
    rng, names = np.random.default_rng(seed), sorted(set(labels))
    by_class = [[t.encode() for t, x in zip(texts, labels, strict=True) if x == name and t] for name in names]
    by_class = [c or [b" "] for c in by_class]
    net = Network(
        names, rng.normal(0, 0.3, (256, EMBED)),
        [rng.normal(0, 1 / np.sqrt(w * EMBED), (w * EMBED, FILTERS)) for w in WIDTHS],
        [np.zeros(FILTERS) for _ in WIDTHS],
        rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(names))), np.zeros(len(names)),
    )
    if len(names) < 2:
        return net
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    for step in range(1, steps + 1):
        y = rng.integers(len(names), size=batch)
        rows = np.zeros((batch, WINDOW + _TAIL), np.uint8)
        for i, c in enumerate(y):
            t = by_class[c][rng.integers(len(by_class[c]))]
            size = int(rng.integers(24, WINDOW + 1))
            at = int(rng.integers(max(1, len(t) - size + 1)))
            part = t[at : at + size]
            rows[i, : len(part)] = np.frombuffer(part, np.uint8)
        slopes = _slopes(net, rows, y)
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, (m, v) in zip(net.parameters(), slopes, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def _slopes(net: Network, rows: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross-entropy, in the order of the parameters."""
    n = len(rows)
    embedded = net.embed[rows]
    pooled, tops = [], []
    for width, k, shift in zip(WIDTHS, net.filters, net.shifts, strict=True):
        patches = np.lib.stride_tricks.sliding_window_view(embedded, width, axis=1)[:, :WINDOW]
        flat = patches.transpose(0, 1, 3, 2).reshape(n * WINDOW, width * EMBED)
        out = (flat @ k + shift).reshape(n, WINDOW, FILTERS)
        tops.append(out.argmax(1))
        pooled.append(out.max(1))
    hidden = np.concatenate(pooled, 1)
    active = np.maximum(hidden, 0)
    logits = active @ net.dense + net.bias
    p = np.exp(logits - logits.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    p[np.arange(n), y] -= 1
    p /= n
    back = (p @ net.dense.T) * (hidden > 0)
    d_embed, d_filters, d_shifts = np.zeros_like(net.embed), [], []
    for i, (width, k, top) in enumerate(zip(WIDTHS, net.filters, tops, strict=True)):
        g = back[:, i * FILTERS : (i + 1) * FILTERS]
        at = top[:, :, None] + np.arange(width)  # bytes under each filter's best place
        seen = rows[np.arange(n)[:, None, None], at]
        patch = net.embed[seen].reshape(n, FILTERS, width * EMBED)
        d_filters.append(np.einsum("nf,nfk->kf", g, patch))
        d_shifts.append(g.sum(0))
        to_bytes = (g[:, :, None] * k.T[None]).reshape(n, FILTERS, width, EMBED)
        np.add.at(d_embed, seen.reshape(-1), to_bytes.reshape(-1, EMBED))
    return [d_embed, *d_filters, *d_shifts, active.T @ p, p.sum(0)]


def classify(net: Network, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Label and probability of each text; UNKNOWN and 0 for a null one or one without a letter."""
    spoken = [i for i, t in enumerate(texts) if t and _LETTER(t)]
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if spoken and net.labels:
        data, counts, sizes = _laid_out([texts[i].encode() for i in spoken])
        logits = net.windows(data) * sizes[:, None]
        starts = np.cumsum(counts) - counts
        mean = np.add.reduceat(logits, starts) / np.add.reduceat(sizes, starts)[:, None]
        p = np.exp(mean - mean.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        for i, best, row in zip(spoken, p.argmax(1), p, strict=True):
            names[i], scores[i] = net.labels[best], float(min(1.0, row[best]))
    return names, scores


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Network:
    """Train on a bounded sample; ``labels`` has key and label, ``docs`` key and text."""
    found = sample(labels, docs, per_class, max_chars)
    return train(found["text"].tolist(), found["label"].tolist())


def identify(docs: DataFrame, net: Network, text: str = "text", key: str = "doc_id", group: int = 1 << 20) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` per row; repeated rows are predicted alike.

    Texts are scored in groups of about ``group`` bytes, a longer text by itself. If nothing was learnt every
    text is UNKNOWN.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net)  # the parameters, a few thousand numbers

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, held, size = [], [], [], 0
            for t in batch.column(1):
                held.append(t.as_py())
                size += len(held[-1] or "")
                if size >= group:
                    a, b = classify(sent.value, held)
                    names, scores, held, size = names + a, scores + b, [], 0
            a, b = classify(sent.value, held)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names + a, pa.string()), pa.array(scores + b, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    chosen = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(scan, "doc_id long, lang_pred string, score double")


def languages(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score. ``docs`` has doc_id, text and lang.

    Only texts and languages outside fold 0 of 5 are learnt from.
    """
    learnt = docs.filter(fold(F.col("doc_id"), 5) != 0)
    net = fit(
        docs.select(F.col("doc_id").alias("key"), "text"),
        learnt.select(F.col("doc_id").alias("key"), F.col("lang").alias("label")),
    )
    found = identify(docs, net)
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")
