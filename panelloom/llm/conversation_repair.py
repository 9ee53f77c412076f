"""Conversation structure repair: the cheapest edits that give (system) (user assistant)*, by auction shortest paths.

1. Rows are range-partitioned by (conversation, turn, digest of role and text, row), so a conversation that holds a
   third of all rows lies in many tasks, and sorted. A task streams its rows into segments of at most
   ``SEGMENT_ROWS`` rows and about ``SEGMENT_BYTES`` of text; one stored row per segment holds its turns.
2. A conversation of one segment, as nearly all are, is repaired where the segment is read.
3. Of the others, rows that repeat an earlier segment's are found by a join on digests. A segment then becomes the 16
   cheapest costs from each state to each, these are folded from the last segment back (a stream of 16 numbers per
   segment, nothing is gathered), every segment is traced from each state, and a stream forward picks the state in
   which each is entered.

:mod:`auction_path` has the path search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.llm import auction_path as ap
from panelloom.operators.joins import match_nulls
from panelloom.session import materialize

SEGMENT_ROWS = 4096
SEGMENT_BYTES = 4 << 20
_BLANKS = " \t\n\x0b\x0c\r"
_ROLES = {"s": ap.SYSTEM_ROLE, "u": ap.USER_ROLE, "a": ap.ASSISTANT_ROLE}
_LEGAL = {"su", "ua", "au"}
NAMES = {ap.USER: "user", ap.ASSISTANT: "assistant"}
_SEGMENT = pa.schema([
    ("segment", pa.int64()), ("conv_id", pa.int64()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
    ("codes", pa.binary()), ("digests", pa.list_(pa.binary())), ("illegal", pa.int64()), ("edges", pa.string()),
    ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()),
])
_SEGMENT_DDL = (
    "segment long, conv_id long, roles array<string>, texts array<string>, codes binary, digests array<binary>, illegal long, "
    "edges string, first_turn long, last_turn long, turns long"
)
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
TURNS = "conv_id long, segment long, roles array<string>, texts array<string>"
REPORT = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage: conv_id, turn, role, text and ``there``, which is false for a row that was dropped.

    A null role or text is one space, and so is a null id or turn in the key of the damage.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    role, text = blank("role"), blank("text")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), kind.alias("kind"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
    )
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    there = F.col("kind") != 0
    return rows.select(
        "conv_id", F.when(there, F.col("turn")).alias("turn"), F.when(there, F.col("role")).alias("role"),
        F.when(there, F.col("text")).alias("text"), there.alias("there"), F.explode(times).alias("_copy"),
    ).drop("_copy")


def intact(conversations: DataFrame) -> DataFrame:
    """The rows as they are, in the shape of :func:`damaged`: what the operator repairs outside the exercise."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), blank("role"), blank("text"),
        F.lit(True).alias("there"),
    )


class _Segment:
    """Turns of one conversation, gathered in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.roles, self.texts, self.digests = conv_id, [], [], []
        self.codes, self.seen, self.bytes = bytearray(), set(), 0
        self.illegal, self.turns, self.first, self.last = 0, 0, None, None

    def add(self, turn: int | None, role: str, text: str, digest: bytes) -> None:
        bare = text.rstrip(_BLANKS)
        fault = ap.GONE if not bare or digest in self.seen else ap.SOUND if bare[-1] in ".!?" else ap.CUT
        if self.roles and self.roles[-1][:1] + role[:1] not in _LEGAL:
            self.illegal += 1
        self.seen.add(digest)
        self.digests.append(digest)
        self.roles.append(role)
        self.texts.append(text)
        self.codes.append(_ROLES.get(role[:1], ap.OTHER_ROLE) + 4 * fault)
        self.bytes += len(text)
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn

    def row(self, number: int) -> dict:
        ends = self.roles[0][:1] + "\n" + self.roles[-1][:1] if self.roles else None
        return {
            "segment": number, "conv_id": self.conv_id, "roles": self.roles, "texts": self.texts, "codes": bytes(self.codes),
            "digests": self.digests, "illegal": self.illegal, "edges": ends, "first_turn": self.first,
            "last_turn": self.last, "turns": self.turns,
        }


def segments(rows: DataFrame, segment_rows: int = SEGMENT_ROWS, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """One stored row per segment; numbers rise along a conversation. Every conversation has a segment, if an empty one."""
    marked = rows.select(
        "conv_id", "turn", "role", "text", "there",
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("row"),  # rows that agree in all else may part at any place
    )
    order = ["conv_id", "turn", "digest", "row"]
    placed = marked.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, now = TaskContext.get().partitionId() << 33, None
        for batch in batches:
            done = []
            for conv, turn, role, text, there, digest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or conv != now.conv_id or len(now.roles) >= segment_rows or now.bytes >= segment_bytes:
                    if now is not None:
                        done.append(now.row(number))
                        number += 1
                    now = _Segment(conv)
                if there:
                    now.add(turn, role, text, digest)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=_SEGMENT)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.row(number)], schema=_SEGMENT)

    return materialize(placed.mapInArrow(cut, _SEGMENT_DDL), "conversation-segments")


def apply_edits(labels: str, state: int, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str]]:
    """The turns after the edits, entered in ``state``."""
    at = 0
    for label in labels:
        if label == "I":
            state = ap.NEXT[state]
            yield NAMES[state], ""
            continue
        if label == "K":
            state = ap.KEEP[state][_ROLES.get(roles[at][:1], ap.OTHER_ROLE)]
            yield roles[at], texts[at]
        elif label == "R":
            state = ap.NEXT[state]
            yield NAMES[state], texts[at]
        at += 1


def _faults(codes: bytes, texts_gone: int) -> tuple[int, int, int]:
    """(blank, duplicate, truncated) of a segment's codes, given how many of the gone ones are blank."""
    gone = sum(c >> 2 == ap.GONE for c in codes)
    return texts_gone, gone - texts_gone, sum(c >> 2 == ap.CUT for c in codes)


def _blank(texts: list[str]) -> int:
    return sum(not t.strip(_BLANKS) for t in texts)


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


_SEGMENT_KEYS = [("segment", pa.int64()), ("conv_id", pa.int64())]
_REPORT = pa.schema(
    [("conv_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())]
)
_TURNS = pa.schema([*_SEGMENT_KEYS[::-1], ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])


def _traced_whole(single: DataFrame) -> DataFrame:
    """Segments that are whole conversations, with their edits, in the columns of :func:`_traced_parts`."""

    def solve(codes: bytes) -> tuple[int, str]:
        price = ap.prices(codes)
        return price[ap.START], ap.trace(codes, price, ap.START)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [solve(c.as_py()) for c in batch.column("codes")]
            zeros = pa.array([0] * batch.num_rows, pa.int32())
            extra = {
                "cost": pa.array([c for c, _ in found], pa.int64()), "labels": pa.array([a for _, a in found], pa.string()),
                "state": zeros, "border": zeros, "shared": zeros,
            }
            columns = {n: batch.column(n) for n in _FACTS} | extra
            yield pa.RecordBatch.from_arrays([columns[n] for n in _TRACED], names=list(_TRACED))

    kinds = {f.name: f.dataType.simpleString() for f in single.schema if f.name in _FACTS}
    kinds |= {"cost": "bigint", "labels": "string", "state": "int", "border": "int", "shared": "int"}
    return single.select(*_FACTS).mapInArrow(run, ", ".join(f"{n} {kinds[n]}" for n in _TRACED))


_FACTS = ("conv_id", "segment", "roles", "texts", "codes", "illegal", "first_turn", "last_turn", "turns")
_TRACED = (*_FACTS, "cost", "labels", "state", "border", "shared")


def _reports(rows: Iterator[dict]) -> Iterator[dict]:
    """Per conversation the report, from its segments in order; one segment is held at a time."""
    now = None
    for row in rows:
        if now is None or row["conv_id"] != now.conv_id:
            if now is not None:
                yield now.row()
            now = _Report(row["conv_id"], row["cost"])
        now.add(row)
    if now is not None:
        yield now.row()


def _each(df: DataFrame, rows, schema: str, out: pa.Schema) -> DataFrame:
    """``df`` through ``rows``, a generator function over dicts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for row in rows(chain.from_iterable(b.to_pylist() for b in batches)):
            held.append(row)
            if len(held) == 256:
                yield _batch(held, out)
                held = []
        if held:
            yield _batch(held, out)

    return df.mapInArrow(run, schema)


def _stream(df: DataFrame, order: list[Column], rows, schema: str, out: pa.Schema) -> DataFrame:
    """The same with the rows of each conversation together and in order."""
    return _each(df.repartition("conv_id").sortWithinPartitions("conv_id", *order), rows, schema, out)


def _later_copies(parts: DataFrame) -> DataFrame:
    """Segments with the places of turns that an earlier segment of the conversation has: ``(segment, again)``."""
    turns = parts.select("conv_id", "segment", F.posexplode("digests").alias("at", "digest"))
    first = turns.groupBy("conv_id", "digest").agg(F.min("segment").alias("first"), F.max("segment").alias("last"))
    first = materialize(first.filter("first < last").drop("last"), "repeated-turns")
    met = match_nulls(turns, first, ["conv_id", "digest"]).filter("segment > first")
    return met.groupBy("segment").agg(F.collect_list("at").alias("again"))


def _costs_after(rows: Iterator[dict]) -> Iterator[dict]:
    """Per segment, last to first, the cost from each state at its end; only four numbers are carried."""
    conv, leaving, fresh = None, list(ap.END), True
    for row in rows:
        if fresh or row["conv_id"] != conv:
            conv, leaving, fresh, last = row["conv_id"], list(ap.END), False, True
        yield {"segment": row["segment"], "leaving": leaving, "final": last}
        leaving, last = ap.through(row["matrix"], leaving), False


def _entries(rows: Iterator[dict]) -> Iterator[dict]:
    """Per segment, first to last, the state it is entered in and what its border adds to the counts."""
    conv, fresh = None, True
    for row in rows:
        if fresh or row["conv_id"] != conv:
            conv, fresh, state, edge, turn = row["conv_id"], False, ap.START, None, None
        first, last = row["edges"].split("\n") if row["edges"] is not None else (None, None)
        broken = edge is not None and first is not None and edge + first not in _LEGAL
        same = turn is not None and row["first_turn"] == turn
        yield {"segment": row["segment"], "state": state, "border": int(broken), "shared": int(same)}
        state = row["exits"][state]
        edge = last if last is not None else edge
        turn = row["last_turn"] if row["last_turn"] is not None else turn


def _traced_parts(parts: DataFrame) -> DataFrame:
    """The segments of conversations that have several, each with its edits, the state it is entered in, and the costs."""
    again = materialize(_later_copies(parts.select("conv_id", "segment", "digests")), "again")
    narrow = parts.select("conv_id", "segment", "codes", "illegal", "edges", "first_turn", "last_turn", "turns")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for segment, conv, codes, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                codes = bytearray(codes)
                for at in places or []:
                    codes[at] = (codes[at] & 3) + 4 * ap.GONE
                out.append({"segment": segment, "conv_id": conv, "codes": bytes(codes), "matrix": ap.transfer(bytes(codes))})
            if out:
                yield _batch(out, pa.schema([*_SEGMENT_KEYS, ("codes", pa.binary()), ("matrix", pa.list_(pa.int64()))]))

    marked = narrow.join(again, "segment", "left").select("segment", "conv_id", "codes", "again")
    coded = materialize(marked.mapInArrow(mark, "segment long, conv_id long, codes binary, matrix array<long>"), "segment-costs")
    after = materialize(
        _stream(
            coded.select("conv_id", "segment", "matrix"), [F.col("segment").desc()], _costs_after,
            "segment long, leaving array<long>, final boolean",
            pa.schema([("segment", pa.int64()), ("leaving", pa.list_(pa.int64())), ("final", pa.bool_())]),
        ),
        "segment-ends",
    )

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            *_SEGMENT_KEYS, ("codes", pa.binary()), ("labels", pa.list_(pa.string())), ("exits", pa.list_(pa.int32())),
            ("costs", pa.list_(pa.int64())),
        ])
        for batch in batches:
            out = []
            for segment, conv, codes, leaving, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                price = ap.prices(codes, leaving)
                traced = [ap.trace(codes, price, q, leaving, last) if price[q] < ap.NONE else ("", q) for q in range(4)]
                out.append({
                    "segment": segment, "conv_id": conv, "codes": codes, "labels": [t for t, _ in traced],
                    "exits": [q for _, q in traced], "costs": price[:4],
                })
            if out:
                yield _batch(out, schema)

    met = coded.join(after, "segment").select("segment", "conv_id", "codes", "leaving", "final")
    traced = materialize(
        met.mapInArrow(follow, "segment long, conv_id long, codes binary, labels array<string>, exits array<int>, costs array<long>"),
        "segment-traces",
    )
    facts = narrow.drop("codes", "conv_id")
    entered = materialize(
        _stream(
            traced.select("conv_id", "segment", "exits").join(facts.select("segment", "edges", "first_turn", "last_turn"), "segment"),
            [F.col("segment")], _entries, "segment long, state int, border int, shared int",
            pa.schema([("segment", pa.int64()), ("state", pa.int32()), ("border", pa.int32()), ("shared", pa.int32())]),
        ),
        "segment-entries",
    )
    chosen = traced.join(entered, "segment").join(facts.drop("edges"), "segment").select(
        "conv_id", "segment", "codes", F.get("labels", F.col("state")).alias("labels"), "state", "border", "shared", "illegal",
        "first_turn", "last_turn", "turns", F.when(F.col("state") == ap.START, F.get("costs", F.lit(0))).alias("cost"),
    )
    return chosen.join(parts.select("segment", "roles", "texts"), "segment").select(*_TRACED)


class _Report:
    """The report of a conversation, segment by segment."""

    def __init__(self, conv_id: int | None, cost: int):
        self.out = {"conv_id": conv_id, "cost": cost, **dict.fromkeys(COUNTS[:-1], 0)}
        self.conv_id, self.labels = conv_id, []
        self.first, self.last, self.turns = None, None, 0
        self.hash, self.empty = hashlib.sha256(), True

    def add(self, row: dict) -> None:
        blank, duplicate, truncated = _faults(row["codes"], _blank(row["texts"]))
        for name, value in (("blank", blank), ("duplicate", duplicate), ("truncated", truncated), ("illegal", row["illegal"] + row["border"])):
            self.out[name] += value
        self.labels.append(row["labels"])
        self.turns += row["turns"] - row["shared"]
        if row["first_turn"] is not None:
            self.first = row["first_turn"] if self.first is None else self.first
            self.last = row["last_turn"]
        for role, text in apply_edits(row["labels"], row["state"], row["roles"], row["texts"]):
            self.hash.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
            self.empty = False

    def row(self) -> dict:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return {**self.out, "gaps": gaps, "audit": "".join(self.labels), "repaired_sha256": self.hash.hexdigest()}


def _traced(rows: DataFrame, segment_rows: int, segment_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """Segments with their edits: of whole conversations, and of parted ones if there are any."""
    stored = segments(rows, segment_rows, segment_bytes)
    counts = stored.groupBy("conv_id").count()
    several = materialize(counts.filter("count > 1").select("conv_id", F.lit(True).alias("_parted")), "parted")
    if not several.limit(1).count():
        return _traced_whole(stored), None
    flagged = match_nulls(stored, several, ["conv_id"])
    parts = materialize(flagged.filter("_parted").drop("_parted"), "parted-segments")
    return _traced_whole(flagged.filter("_parted IS NULL")), _traced_parts(parts)


def repair_report(rows: DataFrame, segment_rows: int = SEGMENT_ROWS, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """One row per conversation of ``rows``, as :func:`damaged` or :func:`intact` give them.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, and the SHA-256 of the repaired ``role:text``
    lines. Turns sort nulls first; rows of one turn by the SHA-256 of role and text, so repeated rows lie side by
    side. A null id is a conversation of its own. A conversation without rows has zeros and no turns; an empty
    table gives an empty result. Other columns of the table are not read. A text longer than a segment is a
    segment of its own. The digest and the audit of a parted conversation are made in one stream, as a SHA-256 must
    be; all else of it is spread over tasks.
    """
    whole, parts = _traced(rows, segment_rows, segment_bytes)
    report = _each(whole, _reports, REPORT, _REPORT)
    return report if parts is None else report.unionByName(_stream(parts, [F.col("segment")], _reports, REPORT, _REPORT))


def repaired_turns(rows: DataFrame, segment_rows: int = SEGMENT_ROWS, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The turns after repair: conv_id, ``segment`` and ``at`` (their order), role, text. Inserted turns are empty."""

    def edited(segments_: Iterator[dict]) -> Iterator[dict]:
        for s in segments_:
            out = list(apply_edits(s["labels"], s["state"], s["roles"], s["texts"]))
            yield {"conv_id": s["conv_id"], "segment": s["segment"], "roles": [r for r, _ in out], "texts": [t for _, t in out]}

    whole, parts = _traced(rows, segment_rows, segment_bytes)
    both = whole if parts is None else whole.unionByName(parts)
    turns = _each(both.select("conv_id", "segment", "labels", "state", "roles", "texts"), edited, TURNS, _TURNS)
    spread = turns.select("conv_id", "segment", F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "turn"))
    return spread.select("conv_id", "segment", "at", F.col("turn.roles").alias("role"), F.col("turn.texts").alias("text"))
