"""Secret scan: sure finds by pattern, weak ones only where the parts of a credential meet.

Sure kinds (``assign``, ``access``, ``hex``) are reported wherever they match. An identifier, a piece of key
material or an endpoint alone is ordinary text; it is reported when the parts that complete it lie in the same
scope (a block of lines without an empty one), however far apart:

* ``ident`` beside key material, weak or sure;
* ``material`` beside an identifier or an endpoint;
* ``endpoint`` beside both an identifier and key material.

The parts are linked by an interval join with the scopes they start in. Scopes of a text are disjoint, so the number
of a scope stands for its interval and the join is on (row, scope). A scope is one row with the roles it holds,
aggregated before the shuffle: a part meets one row, and no pairs within a scope arise.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.llm.workers import tidy
from panelloom.session import materialize

#: Fixed values of the contract: the sure kinds, in the order of the list, and how long a match must be.
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so those of 24 and more
BASE = ("assign", "access", "hex")

IDENT = re.compile(r"""(?:access_?key_?id|client_?id|account_?id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}""", re.I | re.A)
MATERIAL = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
ENDPOINT = re.compile(r"""[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s"'<>]+""")
WEAK = ("ident", "material", "endpoint")
KINDS = BASE + WEAK
#: A text without a match of this has no span of any kind; the test runs over whole columns.
_ANY = (
    r"(?i)password|passwd|secret|token|api_?key|akia|[0-9a-f]{24}|access_?key_?id|client_?id|account_?id|user_?name"
    r"|login|://|[a-z0-9+/_-]{20}"
)
_SPAN = "struct<start:long,kind:int,end:long>"
_SCAN = f"row_id long, doc_id long, base array<{_SPAN}>, parts array<struct<start:long,kind:int,end:long,scope:long>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the sure finds, by start, then kind as listed; code points, end exclusive."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that need a complement: ``(start, kind, end)``, none inside a sure find."""
    found = [(m.start(), 3, m.end()) for m in IDENT.finditer(text)]
    for m in MATERIAL.finditer(text):
        kinds = {"u" if c.isupper() else "l" if c.islower() else "d" if c.isdigit() else "o" for c in set(m[0])}
        if {"u", "l", "d"} <= kinds:
            found.append((m.start(), 4, m.end()))
    found += [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    last, ends, starts = 0, [], []  # the furthest end of the sure finds up to each start
    for s, _, e in base:
        last = max(last, e)
        starts.append(s)
        ends.append(last)

    def inside(start: int, end: int) -> bool:
        i = bisect_left(starts, end)
        return i > 0 and ends[i - 1] > start

    return sorted(w for w in found if not inside(w[0], w[2]))


def _scopes(text: str) -> list[int]:
    """Starts of the empty lines; a scope ends there."""
    return [m.start() for m in re.finditer(r"\n[ \t\r]*\n", text)]


def parts_of(text: str) -> tuple[list[tuple[int, int, int]], list[dict]]:
    """The sure finds of a text, and sure and weak finds with their scopes; none of the latter if no find is weak."""
    base = base_spans(text)
    weak = weak_spans(text, base)
    scopes = _scopes(text) if weak else []
    near = sorted(base + weak) if weak else []
    return base, [{"start": s, "kind": k, "end": e, "scope": bisect_right(scopes, s)} for s, k, e in near]


_PART = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("scope", pa.int64())]))
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))


def scan_texts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: a number of its own, sure finds and parts. The numbers are fixed once the result is stored."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            hits = pc.match_substring_regex(batch.column(1), _ANY).to_pylist()
            bases, parts = [], []
            for t, hit in zip(batch.column(1), hits, strict=True):
                base, near = parts_of(t.as_py()) if hit else ([], [])
                bases.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
                parts.append(near)
            n = batch.num_rows
            out = [pa.array(range(number, number + n), pa.int64()), batch.column(0), pa.array(bases, _SPANS), pa.array(parts, _PART)]
            number += n
            yield pa.RecordBatch.from_arrays(out, names=["row_id", "doc_id", "base", "parts"])

    chosen = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return chosen.mapInArrow(tidy(scan), _SCAN)


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def scan_distinct(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(row_id, parts)`` of the texts that have weak parts, named by their SHA-256: copies have the same parts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = pc.match_substring_regex(batch.column(1), _ANY).to_pylist()
            parts = [parts_of(t.as_py())[1] if hit else [] for t, hit in zip(batch.column(1), hits, strict=True)]
            full = pa.array([bool(p) for p in parts], pa.bool_())
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, _PART)], names=["row_id", "parts"])
            yield out.filter(full)

    chosen = docs.select(_digest(F.col(text)).alias("row_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(tidy(scan), "row_id binary, parts array<struct<start:long,kind:int,end:long,scope:long>>")


def link_parts(scanned: DataFrame) -> DataFrame:
    """``(row_id, start, kind, end)`` of the weak parts whose complements lie in their scope."""
    parts = scanned.filter(F.size("parts") > 0).select("row_id", F.explode("parts").alias("p")).select("row_id", "p.*")
    kind = F.col("kind")
    # Access identifiers and secrets among the sure finds complete weak parts too.
    roles = {"ident": kind.isin(1, 3), "material": kind.isin(0, 2, 4), "endpoint": kind == 5}
    scopes = parts.groupBy("row_id", "scope").agg(*[F.bool_or(test).alias(role) for role, test in roles.items()])
    complete = (
        F.when(kind == 3, F.col("material")).when(kind == 4, F.col("ident") | F.col("endpoint")).otherwise(F.col("ident") & F.col("material"))
    )
    met = parts.filter(kind >= len(BASE)).join(scopes, ["row_id", "scope"]).filter(complete)
    return met.select("row_id", "start", "kind", "end").distinct()


def find_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, ``base`` and ``spans`` as arrays of (start, kind, end), by start, then kind.

    ``kind`` is a position in KINDS. A null or empty text has no spans; repeated rows and keys are told apart
    by a number of their own; a null key stays null; an empty table gives an empty result.
    """
    scanned = materialize(scan_texts(docs, text, key), "secret-scan")
    linked = link_parts(scanned).groupBy("row_id").agg(F.collect_list(F.struct("start", "kind", "end")).alias("weak"))
    spans = F.array_sort(F.concat("base", F.coalesce("weak", F.array().cast(f"array<{_SPAN}>"))))
    return scanned.select("row_id", "doc_id", "base").join(linked, "row_id", "left").select("doc_id", "base", spans.alias("spans"))


def spans_text(spans: str):
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def blank_out(text: str, starts, ends, mask: str) -> str:
    out, at = [], 0
    for s, e in sorted(zip(starts, ends, strict=True)):
        if s > at or not out:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, mask: str = "[secret]", text: str = "text") -> DataFrame:
    """The input rows with every span replaced by ``mask``; spans that touch or overlap are replaced as one.

    All other columns, and texts without a span, stay as they were; so do null and empty texts and repeated rows,
    each for itself; an empty table gives an empty result. Texts are read twice and not stored: the weak spans are
    found first, one row per distinct text that has any, and meet the texts again by digest. That table is written,
    so its size decides for a broadcast. ``docs`` should be a stored table.
    """
    found = link_parts(scan_distinct(docs, text)).groupBy("row_id").agg(
        F.collect_list("start").alias("_starts"), F.collect_list("end").alias("_ends")
    )
    linked = materialize(found, "linked-parts")

    @F.pandas_udf("string")
    def cover(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        hits = pc.match_substring_regex(pa.array(texts, pa.string()), _ANY).to_pylist()
        done = []
        for t, hit, a, b in zip(texts, hits, starts, ends, strict=True):
            spans = [(s, e) for s, _, e in base_spans(t)] if hit else []
            spans += zip(a, b, strict=True) if a is not None else []
            done.append(blank_out(t, [s for s, _ in spans], [e for _, e in spans], mask) if spans else t)
        return pd.Series(done, dtype=object)

    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("_text"), _digest(F.col(text)).alias("_digest"))
    met = rows.join(linked, F.col("_digest") == F.col("row_id"), "left")
    cleaned = met.select("row", cover("_text", "_starts", "_ends").alias("_clean"))
    return cleaned.select(*[F.col("_clean").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])
