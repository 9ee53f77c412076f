"""Repeated byte strings by suffix sorting, of those stretches of text alone that can hold one.

A string of the full length contains an anchor: the ``ANCHOR``-byte piece with the smallest hash. Equal strings
have equal anchors, so texts are compared in four rounds over stored chunks:

1. which anchors occur more than once;
2. consecutive strings with one such anchor form a segment: which segments occur more than once as they are, and
   which share their anchor with another text;
3. of the latter, one copy of each goes to the shard of its anchor, where an external induced sort puts all
   suffixes in order; a string that occurs twice shares its length with a neighbour;
4. the bytes under all strings found are removed.

Copies, however many, are one segment in one shard, so what is sorted is what differs between similar texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm import chunks as C
from panelloom.llm.induced_sort import shared_prefix, suffix_order
from panelloom.session import materialize

LENGTH = 200
ANCHOR = 64
#: Verdicts on a segment, added up: repeated as it is, to be sorted, this asker stands for all that have it.
ALL, SEND, FIRST = 1, 2, 4
#: An anchor with more occurrences is hot: the strings around it are asked about one by one, under their own hashes.
HOT = 2000
SHARD_BYTES = 4 << 20
#: Strings whose anchors are looked for together: what that takes stays in the processor's cache.
_BLOCK = 1 << 15
_SENT = "anchor long, chunk long, segment long, alone boolean, bytes binary"
_VERDICT = "chunk long, segment long, found binary"


class Bytes:
    """The bytes of a chunk, and its runs of consecutive full-length strings with one anchor."""

    def __init__(self, row: dict, length: int, anchor: int):
        self.blobs = [(t or "").encode() for t in row["texts"]]
        self.data = np.frombuffer(b"".join(self.blobs), np.uint8)
        self.length = length
        sizes = np.array([len(b) for b in self.blobs], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.sums = C.prefix_hashes(self.data + np.uint64(1))
        long = sizes >= length
        first, stop = self.starts[long], self.ends[long] - length + 1  # starts of full-length strings
        at, hashes = self._changes(anchor) if len(first) else (first, np.zeros(0, np.uint64))
        # A run also ends with its text; anchors differ from text to text.
        self.run_start = np.union1d(at, first)
        self.run_hash = hashes[np.searchsorted(at, self.run_start, "right") - 1]
        text = np.searchsorted(first, self.run_start, "right") - 1
        inside = (text >= 0) & (self.run_start < stop[text])
        self.run_stop = np.minimum(np.append(self.run_start[1:], len(self.data)), stop[text])[inside]
        self.run_start, self.run_hash = self.run_start[inside], self.run_hash[inside]

    def _changes(self, anchor: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the anchor of a string differs from that of the string before, whatever texts they cross; its hash."""
        width, inverse = self.length - anchor + 1, C.powers(len(self.sums), True)
        places, hashes, now = [], [], -1
        for lo in range(0, len(self.data) - self.length + 1, _BLOCK):
            hi = min(lo + _BLOCK + width - 1, len(self.data) - anchor + 1)
            h = self.sums[lo + anchor : hi + anchor] - self.sums[lo:hi]
            h *= inverse[lo:hi]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            best = C.windowed_min(h, width)
            new = np.flatnonzero(np.append(best[0] + lo != now, best[1:] != best[:-1]))
            places.append(new + lo)
            hashes.append(h[best[new]])
            now = int(best[-1]) + lo
        return np.concatenate(places), np.concatenate(hashes)

    def asked_anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchor hashes, where each run finds its own, and how often each occurs."""
        return np.unique(self.run_hash, return_inverse=True, return_counts=True)

    def segments(self, anchor_answers: list, n_buckets: int) -> None:
        """Take the runs whose anchor repeats as segments: the text under consecutive strings with the same anchor."""
        distinct, back, _ = self.asked_anchors()
        told = C.answers_for(distinct, anchor_answers, n_buckets)[back]
        held = told > 0
        self.seg_start, self.seg_end = self.run_start[held], self.run_stop[held] - 1 + self.length
        self.seg_route, self.seg_hot = self.run_hash[held], told[held] == 2
        # Two starts, or one start and two anchors, are two segments; a text and its place in it make one.
        texts = C.range_hashes(self.sums, self.seg_start, self.seg_end)
        self.seg_hash = C.mix(texts ^ C.mix(self.seg_route))
        # Segments of a hot anchor are spread by their own hash, so none of them shares an anchor there.
        self.seg_route = np.where(self.seg_hot, self.seg_hash, self.seg_route)

    def asked_segments(self):
        """Distinct segments: hash, anchor, where each segment finds its own, an index of one, how often."""
        distinct, index, back, count = np.unique(self.seg_hash, return_index=True, return_inverse=True, return_counts=True)
        return distinct, self.seg_route[index], back, index, count


    def hot_strings(self, told: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the strings in the hot segments for which this chunk stands."""
        chosen = index[self.seg_hot[index] & ((told & FIRST) > 0)]
        first, size = self.seg_start[chosen], self.seg_end[chosen] - self.seg_start[chosen] - self.length + 1
        at = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
        return at, C.range_hashes(self.sums, at, at + self.length)


def _occurrences(arrays: list[np.ndarray], owners: np.ndarray, hot: int) -> np.ndarray:
    """Per anchor: 0 if it occurs once, 2 if more than ``hot`` times, else 1."""
    _, back = np.unique(arrays[0], return_inverse=True)
    total = np.bincount(back, arrays[1])
    return ((total > 1).astype(np.int64) + (total > hot))[back]


def _repeats(arrays: list[np.ndarray], owners: np.ndarray) -> np.ndarray:
    _, back, count = np.unique(arrays[0], return_inverse=True, return_counts=True)
    return ((count > 1) | (np.bincount(back, arrays[1], len(count)) > 0))[back]


def _judge(arrays: list[np.ndarray], owners: np.ndarray) -> np.ndarray:
    """Per segment and asker: ``ALL``, ``SEND`` and ``FIRST`` where they hold."""
    segment, anchor, several = arrays
    distinct, index, back, count = np.unique(segment, return_index=True, return_inverse=True, return_counts=True)
    repeated = (count > 1) | (np.bincount(back, several, len(count)) > 0)
    _, group, sharing = np.unique(anchor[index], return_inverse=True, return_counts=True)
    contested = sharing[group] > 1  # another text has this anchor
    first = np.zeros(len(segment), bool)
    first[index] = True
    send = contested[back] & first
    return ALL * repeated[back] + SEND * send + FIRST * first


def _sorted_finds(texts: list[bytes], length: int, memory: int) -> list[np.ndarray]:
    """For each text, which of its full-length strings start anywhere else in ``texts``."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    # Symbol 1 ends each text, bytes follow from 2.
    data = np.frombuffer(b"\0".join([*texts, b""]), np.uint8).astype(np.uint16) + 2
    data[starts + sizes] = 1
    order = suffix_order(data, memory)
    close = shared_prefix(data, order, length)
    found = np.zeros(len(data), bool)
    found[order[1:][close]] = True
    found[order[:-1][close]] = True
    return [found[s : s + n - length + 1] for s, n in zip(starts, sizes, strict=True)]


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, text: str = "text", key: str = "doc_id",
    memory: int = 1 << 22, hot: int = HOT,
) -> DataFrame:
    """Per input row: doc_id, n_bytes, n_removed, n_spans and ``kept``, the bytes left.

    A byte goes if a string of ``length`` bytes over it also starts anywhere else, in the same document or
    another; repeated rows are documents of their own, so a row repeated goes wherever it is long enough. A null
    or empty text has no bytes; one shorter than ``length`` loses none; a null key stays null; an empty table
    gives an empty result. ``memory`` is the number of places a sort's queue holds before it spills.
    Strings around an anchor that occurs more than ``hot`` times are compared by 64-bit hash instead of sorted.
    """
    stored = C.store_chunks(docs, text, key)
    n_buckets = C.buckets_of(docs)
    hot = max(1, hot)

    def anchors(row):
        distinct, _, count = Bytes(row, length, anchor).asked_anchors()
        return distinct, [count]

    def with_segments(row) -> Bytes:
        b = Bytes(row, length, anchor)
        b.segments(row["answers_0"] or [], n_buckets)
        return b

    def segments(row):
        distinct, route, _, _, count = with_segments(row).asked_segments()
        return distinct, [route, count > 1], route

    counted = {"hash": np.dtype("<u4"), "count": np.dtype("<u4")}
    first = C.ask(stored, anchors, lambda a, o: _occurrences(a, o, hot), counted, n_buckets)
    rows = stored.join(materialize(first, "answers").withColumnRenamed("answers", "answers_0"), "chunk", "left")
    second = C.ask(
        rows, segments, _judge, {"hash": np.dtype("<u8"), "anchor": np.dtype("<u8"), "several": np.dtype("<u1")}, n_buckets
    )
    rows = rows.join(materialize(second, "answers").withColumnRenamed("answers", "answers_1"), "chunk", "left")

    def strings(row):
        b = with_segments(row)
        distinct, route, _, index, _ = b.asked_segments()
        told = C.answers_for(distinct, row["answers_1"] or [], n_buckets, route)
        found, count = np.unique(b.hot_strings(told, index)[1], return_counts=True)
        return found, [count > 1]

    some_hot = rows.filter("exists(answers_0, a -> contains(a.answer, X'02'))")
    third = C.ask(some_hot, strings, _repeats, {"hash": np.dtype("<u8"), "several": np.dtype("<u1")}, n_buckets)
    rows = rows.join(materialize(third, "answers").withColumnRenamed("answers", "answers_2"), "chunk", "left")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if not row["answers_1"]:
                    continue
                b = with_segments(row)
                distinct, route, _, index, _ = b.asked_segments()
                told = C.answers_for(distinct, row["answers_1"], n_buckets, route)
                sent = np.flatnonzero((told & SEND) > 0)
                texts = [b.data[b.seg_start[i] : b.seg_end[i]].tobytes() for i in index[sent]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(route[sent].view(np.int64)), pa.array([row["chunk"]] * len(sent), pa.int64()),
                        pa.array(distinct[sent].view(np.int64)), pa.array((told[sent] & ALL) == 0), pa.array(texts, pa.binary()),
                    ],
                    names=["anchor", "chunk", "segment", "alone", "bytes"],
                )

    def sort_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def verdicts() -> pa.RecordBatch:
            finds = _sorted_finds([h[3] for h in held], length, memory)
            mine = [(h[0], h[1], np.packbits(f).tobytes()) for h, f in zip(held, finds, strict=True) if h[2]]
            columns = list(zip(*mine, strict=True)) or [[], [], []]
            kinds = [pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["chunk", "segment", "found"]
            )

        for batch in batches:
            for r in batch.to_pylist():
                if held and r["shard"] != now:
                    yield verdicts()
                    held = []
                now = r["shard"]
                held.append((r["chunk"], r["segment"], r["alone"], r["bytes"]))
        if held:
            yield verdicts()

    # Rows of a shard lie together; what a task holds is one shard, not its partition.
    sent = materialize(rows.mapInArrow(send, _SENT), "sent")
    size = sent.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    n_shards = max(1, n_buckets // 4, -(-size // SHARD_BYTES))
    sent = sent.select(F.pmod(F.xxhash64("anchor"), F.lit(n_shards)).alias("shard"), "chunk", "segment", "alone", "bytes")
    sharded = sent.repartition(n_shards, "shard").sortWithinPartitions("shard")
    verdict = sharded.mapInArrow(sort_shards, _VERDICT).groupBy("chunk").agg(
        F.collect_list(F.struct("segment", "found")).alias("verdicts")
    )
    rows = rows.join(materialize(verdict, "verdicts"), "chunk", "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = with_segments(row)
                distinct, route, back, index, _ = b.asked_segments()
                asked = C.answers_for(distinct, row["answers_1"] or [], n_buckets, route)
                told = asked[back]
                cover = np.zeros(len(b.data) + 1, np.int32)
                whole = (told & ALL) > 0
                np.add.at(cover, b.seg_start[whole], 1)
                np.add.at(cover, b.seg_end[whole], -1)
                verdicts = row["verdicts"] or []
                place = {h: i for i, h in enumerate(b.seg_hash.view(np.int64).tolist())} if verdicts else {}
                for v in verdicts:
                    i = place[v["segment"]]
                    n = int(b.seg_end[i] - b.seg_start[i]) - length + 1
                    at = np.flatnonzero(np.unpackbits(np.frombuffer(v["found"], np.uint8), count=n)) + b.seg_start[i]
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + length, -1)
                if row["answers_2"]:
                    at, hashes = b.hot_strings(asked, index)
                    each, where = np.unique(hashes, return_inverse=True)
                    at = at[C.answers_for(each, row["answers_2"], n_buckets)[where] > 0]
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + length, -1)
                gone = np.cumsum(cover[:-1]) > 0
                removed, spans, kept = [], [], []
                for blob, lo, hi in zip(b.blobs, b.starts.tolist(), b.ends.tolist(), strict=True):
                    g = gone[lo:hi]
                    n = int(g.sum())
                    removed.append(n)
                    spans.append(int(np.count_nonzero(np.diff(np.concatenate(([0], g.view(np.int8)))) == 1)) if n else 0)
                    kept.append(b.data[lo:hi][~g].tobytes() if n else blob)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()), pa.array(b.ends - b.starts), pa.array(removed, pa.int64()),
                        pa.array(spans, pa.int64()), pa.array(kept, pa.binary()),
                    ],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return rows.mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
