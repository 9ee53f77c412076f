"""Benchmark decontamination: training words streamed through a suffix automaton of the test items.

Items are cut into parts and dealt into blocks of about ``BLOCK_WORDS`` words; each block's automaton is built in a task
and stored. The driver hands one stored automaton at a time to the tasks as a broadcast, whose size the block bounds.
Documents run through each: what all blocks but the last find is a row per distinct text with a passage, and meets
the texts again by digest in the last pass, so no text is stored or, while that table is small, shuffled. Most words
occur in no item and end any match, so only runs of item words long enough to hold a window are streamed.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.llm.automaton import SuffixAutomaton
from panelloom.llm.workers import tidy
from panelloom.session import materialize

WINDOW = 10
#: Words of items in one automaton; it bounds what is broadcast and the memory of a task.
BLOCK_WORDS = 100_000
#: Word bytes are digits, letters and everything beyond ASCII; A-Z count as a-z.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOUND = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDS).split()


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that touch or overlap become one."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


class Block:
    """The automaton of some items, with their vocabulary."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        coded = [(i, [number(w, len(self.vocabulary) + 1) for w in words]) for i, (_, words) in enumerate(items)]
        self.names = [name for name, _ in items]
        self.shortest = min([window, *(len(w) for _, w in coded if w)])
        self.automaton = SuffixAutomaton(window)
        for _, words in coded:
            self.automaton.add(words)
        self.automaton.finish(coded)

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        get = self.vocabulary.get
        coded = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], coded != 0, [0]))))
        spans, names = [], set()
        for lo, hi in zip(edges[::2], edges[1::2], strict=True):
            if hi - lo < self.shortest:
                continue
            found, items = self.automaton.stream(coded[lo:hi].tolist())
            spans += [(int(lo) + s, int(lo) + e) for s, e in found]
            names.update(self.names[i] for i in items if self.names[i] is not None)
        return spans, names


def _automata(items: DataFrame, window: int, block_words: int, text: str, key: str) -> tuple[DataFrame, int]:
    """``(block, automaton)`` as a stored table, and the number of blocks. Equal rows of items count once."""
    cut = items.select(F.col(key).cast("string").alias("item"), F.col(text).alias("text")).distinct()

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Items as words joined by a blank; one longer than a block in parts that lose no window."""
        step = max(1, block_words - window + 1)
        for batch in batches:
            names, texts, sizes = [], [], []
            for item, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = words_of(t.as_py())
                starts = range(0, max(1, len(words) - window + 1), step) if len(words) > block_words else [0]
                for at in starts:
                    part = words[at : at + block_words] if len(words) > block_words else words
                    names.append(item)
                    texts.append(b" ".join(part))
                    sizes.append(len(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(texts, pa.binary()), pa.array(sizes, pa.int64())], names=["item", "words", "size"]
            )

    stored = materialize(cut.mapInArrow(parts, "item string, words binary, size long").filter("size > 0"), "item-parts")
    blocks = -(-(stored.agg(F.sum("size")).first()[0] or 0) // block_words)

    def build(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values(["item", "words"])
        names = [None if pd.isna(i) else i for i in ordered["item"]]
        block = Block([(i, w.split()) for i, w in zip(names, ordered["words"], strict=True)], window)
        return pd.DataFrame({"block": [int(group["block"].iloc[0])], "automaton": [pickle.dumps(block)]})

    dealt = stored.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(max(1, blocks))).cast("int"))
    return materialize(dealt.groupBy("block").applyInPandas(build, "block int, automaton binary"), "automata"), blocks


def _sent(automata: DataFrame, block: int):
    """One automaton as a broadcast; an empty one if the block got no items."""
    row = automata.filter(F.col("block") == block).select("automaton").first()
    return automata.sparkSession.sparkContext.broadcast(pickle.loads(row[0]) if row else Block([], WINDOW))


_DIGESTED = "digest binary, spans array<struct<start:long,end:long>>, items array<string>"


def _hits(docs: DataFrame, sent, text: str) -> DataFrame:
    """``(digest, spans, items)`` of the texts in which one block finds something."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = sent.value.search
        for batch in batches:
            rows = [(d, *search(words_of(t.as_py()))) for d, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)]
            rows = [r for r in rows if r[1]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([d for d, _, _ in rows], pa.binary()), pa.array([_spans(s) for _, s, _ in rows], _SPANS),
                    pa.array([sorted(i) for _, _, i in rows], pa.list_(pa.string())),
                ],
                names=["digest", "spans", "items"],
            )

    return docs.select(_digest(text).alias("digest"), F.col(text).alias("text")).mapInArrow(tidy(scan), _DIGESTED)


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(F.col(text), 256))


def _spans(found: list[tuple[int, int]]) -> list[dict]:
    return [{"start": a, "end": b} for a, b in found]


def _pass(docs: DataFrame, items: DataFrame, window: int, block_words: int, text: str, item_key: str, item_text: str, judge) -> DataFrame:
    """The input rows as structs with what ``judge(text, words, spans, items)`` says of each; rows it gives None go."""
    automata, blocks = _automata(items, window, block_words, item_text, item_key)
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    earlier = None
    for block in range(blocks - 1):
        found = _hits(docs, _sent(automata, block), text)
        earlier = materialize(found if earlier is None else earlier.unionByName(found), "passages")
    if earlier is None:
        rows = rows.select("row", "text", F.lit(None).cast("array<struct<start:long,end:long>>").alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    else:
        merged = earlier.groupBy("digest").agg(
            F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
        )
        known = materialize(merged, "passages-by-text")
        rows = rows.withColumn("_digest", _digest("text")).join(known, F.col("_digest") == F.col("digest"), "left")
        rows = rows.select("row", "text", "spans", "items")
    sent = _sent(automata, blocks - 1)
    names, kinds, fields = judge.names, judge.kinds, judge.fields

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = sent.value.search
        for batch in batches:
            keep, out = [], []
            for t, s, i in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                value = t.as_py()
                words = words_of(value)
                found, items_ = search(words)
                spans = merge([(x["start"], x["end"]) for x in s.as_py() or []] + found)
                said = judge(value, words, spans, {*(i.as_py() or []), *items_})
                keep.append(said is not None)
                if said is not None:
                    out.append(said)
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            kept = batch.column(0).filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept, *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=["row", *names])

    return rows.mapInArrow(tidy(scan), f"row {rows.schema['row'].dataType.simpleString()}, {fields}")


class _Found:
    """All a row holds of the items."""

    names, fields = ("n_words", "spans", "items"), FOUND
    kinds = (pa.int64(), _SPANS, pa.list_(pa.string()))

    def __call__(self, text, words, spans, items):
        return len(words), _spans(spans), sorted(items)


class _Cut:
    """The text less its passages; None if too much of it is one."""

    names, fields, kinds = ("_clean",), "_clean string", (pa.string(),)

    def __init__(self, min_words: int, max_coverage: float):
        self.min_words, self.max_coverage = min_words, max_coverage

    def __call__(self, text, words, spans, items):
        if sum(e - s for s, e in spans) > len(words) * self.max_coverage:
            return None
        spans = [(s, e) for s, e in spans if e - s >= self.min_words]
        return (cut_words(text, spans) if spans else text,)


def find_passages(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, text: str = "text",
    item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``(row, n_words, spans, items)``: the input row as a struct, and word spans of item passages.

    Spans are merged and in word numbers, end exclusive; ``items`` are the ids, as sorted text, of items with a
    window in the document. A null or empty text has no words and no spans; a null item id is not listed,
    its passages are found; an item without words has no window; an item of fewer than ``window`` words is
    one window. Rows are judged alone, so repeated rows and keys do not matter. Without items nothing is hit.
    """
    return _pass(docs, items, window, block_words, text, item_key, item_text, _Found())


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, key: str = "doc_id") -> DataFrame:
    """Per document: key, n_words, n_hit, n_items, the ids and the spans."""
    found = find_passages(docs.select(F.col(key).alias("doc_id"), "text"), items, window)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        F.col("row.doc_id").alias(key), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items", "spans"
    )


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and what stands between them inside a span."""
    places = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for start, end in spans:
        out.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return "".join([*out, text[at:]])


def remove_passages(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, min_words: int = 1, max_coverage: float = 0.5, text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Documents less item passages of ``min_words`` or more; those covered beyond ``max_coverage`` go whole.

    Columns are those of the input; a document without passages keeps its text as it was, null included.
    """
    cleaned = _pass(docs, items, window, block_words, text, "item_id", "text", _Cut(min_words, max_coverage))
    return cleaned.select(*[F.col("_clean").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])
