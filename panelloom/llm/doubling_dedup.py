"""Substring dedup by level-wise doubling over word windows.

A window of the full length can repeat only if the shorter windows inside it do. Round by round, windows of the
base length, then of twice that length, and so on up to the full length are looked up over all documents, and only
where both halves repeated is a longer one asked about. At the base length one window stands for all full windows
that share it as their smallest hash, so a tenth to a fifth of the positions ask. Short windows travel as 32 bits
beside their bucket: a false match costs a question in the next round. The last round takes windows with equal 64-bit
hashes for equal, and tells whether a smaller document has the window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelloom.llm import chunks as C
from panelloom.session import materialize

WINDOW = 13
BASE = 4
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def levels(window: int, base: int) -> list[int]:
    out = [min(base, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


class Words:
    """The words of a chunk: a hash, a document and a byte range each."""

    def __init__(self, row: dict):
        blobs = [(t or "").encode() for t in row["texts"]]
        data = np.frombuffer(b"\n".join([b"", *blobs, b""]), np.uint8)
        word = ~_BLANK[data]
        edges = np.diff(word.view(np.int8))
        starts, ends = np.flatnonzero(edges == 1) + 1, np.flatnonzero(edges == -1) + 1
        # A value per byte that is never zero, so that a longer word cannot look like a shorter one.
        self.hashes = C.range_hashes(C.prefix_hashes(data.astype(np.uint64) + np.uint64(1)), starts, ends)
        self.sums = C.prefix_hashes(self.hashes)
        firsts = np.cumsum([1, *[len(b) + 1 for b in blobs]])
        self.doc = np.searchsorted(firsts, starts, side="right") - 1
        self.ids = np.array([C.NO_ID if i is None else i for i in row["doc_ids"]], np.int64)
        self.n_docs = len(blobs)

    def windows(self, length: int) -> np.ndarray:
        """Starts of the windows that lie in one document."""
        n = len(self.doc) - length + 1
        return np.flatnonzero(self.doc[:n] == self.doc[length - 1 :]) if n > 0 else np.zeros(0, np.int64)

    def hash_at(self, starts: np.ndarray, length: int) -> np.ndarray:
        return C.range_hashes(self.sums, starts, starts + length)


def _asked(words: Words, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes at ``places``, where each place finds its own, and the first and last document."""
    distinct, back = np.unique(words.hash_at(places, length), return_inverse=True)
    low = np.full(len(distinct), C.NO_ID)
    high = np.full(len(distinct), np.iinfo(np.int64).min)
    np.minimum.at(low, back, words.ids[words.doc[places]])
    np.maximum.at(high, back, words.ids[words.doc[places]])
    return distinct, back, low, high


def _candidates(words: Words, answers: list, window: int, base: int, n_buckets: int):
    """Full windows left after the rounds answered so far, and the places the next round asks about."""
    sizes = levels(window, base)
    full = words.windows(window)
    if len(sizes) == 1:
        return full, full
    small = words.hash_at(np.arange(max(0, len(words.doc) - sizes[0] + 1)), sizes[0])
    anchor = C.windowed_min(small, window - sizes[0] + 1)[full] if len(full) else full
    places = np.unique(anchor)
    for k, reply in enumerate(answers):
        distinct, back, _, _ = _asked(words, places, sizes[k])
        good = np.zeros(len(words.doc) + 1, bool)
        good[places] = C.answers_for(distinct, reply, n_buckets)[back] > 0
        if k == 0:
            full = full[good[anchor]]
        else:
            full = full[good[full] & good[full + window - sizes[k]]]
        last = k + 1 == len(sizes) - 1
        ahead = window - sizes[k + 1]
        places = full if last else np.unique(np.concatenate((full, full + ahead)))
    return full, places


def _repeats(arrays: list[np.ndarray], owners: np.ndarray) -> np.ndarray:
    """Whether a hash occurs in more than one document."""
    _, back, count = np.unique(arrays[0], return_inverse=True, return_counts=True)
    several = (count > 1) | (np.bincount(back, arrays[1], len(count)) > 0)
    return several[back]


def _smaller(arrays: list[np.ndarray], owners: np.ndarray) -> np.ndarray:
    """Whether another chunk has the window in a document smaller than any of the asker's."""
    distinct, back = np.unique(arrays[0], return_inverse=True)
    low = np.full(len(distinct), C.NO_ID)
    np.minimum.at(low, back, arrays[1])
    return low[back] < arrays[1]


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, base: int = BASE, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Per input row: doc_id, n_words, n_removed and ``kept``, the words left, joined by one space.

    A word goes if a window over it also starts in a document with a smaller id. Rows with equal ids are one
    document in this: they do not remove each other's words. A null id is larger than any other, and of null
    ids none is smaller. A null or empty text has no words and an empty ``kept``; a text of fewer words than
    a window loses none. An empty table gives an empty result.
    """
    stored = C.store_chunks(docs, text, key)
    n_buckets, sizes = C.buckets_of(docs), levels(window, base)
    rows = stored
    for k in range(len(sizes)):
        final = k == len(sizes) - 1

        def question(row, k=k, final=final):
            words = Words(row)
            _, places = _candidates(words, [row[f"answers_{i}"] or [] for i in range(k)], window, base, n_buckets)
            distinct, _, low, high = _asked(words, places, sizes[k])
            return distinct, ([low] if final else [low != high])

        if final:
            columns = {"hash": np.dtype("<u8"), "low": np.dtype("<i8")}
        else:
            columns = {"hash": np.dtype("<u4"), "several": np.dtype("<u1")}
        replies = materialize(C.ask(rows, question, _smaller if final else _repeats, columns, n_buckets), "answers")
        rows = rows.join(replies.withColumnRenamed("answers", f"answers_{k}"), "chunk", "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = Words(row)
                replies = [row[f"answers_{i}"] or [] for i in range(len(sizes))]
                full, _ = _candidates(words, replies[:-1], window, base, n_buckets)
                distinct, back, low, _ = _asked(words, full, window)
                elsewhere = C.answers_for(distinct, replies[-1], n_buckets)[back] > 0
                gone = full[elsewhere | (words.ids[words.doc[full]] > low[back])]
                cover = np.zeros(len(words.doc) + 1, np.int64)
                np.add.at(cover, gone, 1)
                np.add.at(cover, gone + window, -1)
                keep = np.cumsum(cover[:-1]) == 0
                counts = np.bincount(words.doc, minlength=words.n_docs)
                removed = np.bincount(words.doc, ~keep, words.n_docs).astype(np.int64)
                ends = np.cumsum(counts)
                kept = []
                for t, lo, hi, n in zip(row["texts"], ends - counts, ends, removed, strict=True):
                    parts = (t or "").encode().split()
                    if n:
                        parts = [p for p, k in zip(parts, keep[lo:hi].tolist(), strict=True) if k]
                    kept.append(b" ".join(parts).decode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(counts, pa.int64()), pa.array(removed), pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                )

    return rows.mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept string")

