"""Conversation repair against a dynamic program over whole strings, on edge rows and cut into small segments."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from panelloom.llm import auction_path as ap
from panelloom.llm import conversation_repair as cr

BLANKS = " \t\n\x0b\x0c\r"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
KEEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """``rows`` of (role, text, fault): (cost, edits, turns), by brute force over (row, last initial)."""
    def put_in(found):
        for _ in range(4):
            for last, (cost, edits, turns) in list(found.items()):
                to = NEXT[last]
                one = (cost + 5, edits + "I", (*turns, ({"u": "user", "a": "assistant"}[to], "")))
                if to not in found or one[:2] < found[to][:2]:
                    found[to] = one
        return found

    now = put_in({"": (0, "", ())})
    for role, text, fault in rows:
        after = {}
        for last, (cost, edits, turns) in now.items():
            more = 5 if fault == "truncated" else 0
            ways = [(last, (cost + 2, edits + "D", turns))]
            if fault not in ("blank", "duplicate"):
                to = NEXT[last]
                ways.append((to, (cost + 1 + more, edits + "R", (*turns, ({"u": "user", "a": "assistant"}[to], text)))))
                if (last, role[:1]) in KEEP:
                    ways.append((KEEP[last, role[:1]], (cost + more, edits + "K", (*turns, (role, text)))))
            for to, one in ways:
                if to not in after or one[:2] < after[to][:2]:
                    after[to] = one
        now = put_in(after)
    return min((v for k, v in now.items() if k in ("", "a")), key=lambda v: v[:2])


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if kind == 4:
            role = "user"
        for _ in range({0: 0, 3: 2}.get(kind, 1)):
            yield conv, turn, role, text


def expected(rows, damaged=True):
    out = {}
    for conv in {r[0] for r in rows}:
        own = [r for r in (damage(rows) if damaged else rows) if r[0] == conv]
        digest = lambda r: hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, digest(r)))
        seen, marked, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, _, role, text in own:
            bare = text.rstrip(BLANKS)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
            if fault:
                counts[fault] += 1
        turns = {r[1] for r in own} - {None}
        initials = [r[2][:1] for r in own]
        cost, edits, repaired = cheapest(marked)
        out[conv] = {
            "conv_id": conv, "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **counts,
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), "cost": cost,
            "audit": edits, "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
        }
    return out


def conversations(seed=3):
    pick = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "well", "", " \t", "Long text. " * 40, "naïve 東京。", "No! \n", " "]
    rows = []
    for conv in range(60):
        for turn in range(pick.randint(0, 12)):
            rows.append((conv, pick.choice([turn, turn, turn, turn + 3, None]), pick.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), pick.choice(texts)))
    rows += [(7, 1, "user", "Yes."), (7, 1, "user", "Yes."), (None, 0, "user", "A."), (None, 1, "assistant", None), (None, None, None, None)]
    return rows + [(900, t, ("user", "assistant")[t % 2], f"turn {t % 50}.") for t in range(300)]


@pytest.fixture(scope="module")
def table(spark):
    rows = conversations()
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("size", [4096, 3])
def test_report_against_brute_force(table, size, rows):
    data, df = table
    shadowed = df.selectExpr("*", "'x' AS segment", "'x' AS row", "'x' AS there", "'x' AS kind", "'x' AS digest")
    report = rows(cr.repair_report(cr.damaged(shadowed), segment_rows=size), "conv_id")
    want = expected(data)
    assert {r["conv_id"]: r for r in report} == want and len(report) == len(want)


def test_undamaged_turns(table):
    data, df = table
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in data]
    want = expected(plain, damaged=False)
    turns = cr.repaired_turns(cr.intact(df), segment_rows=5).orderBy("conv_id", "segment", "at").collect()
    lines = {}
    for t in turns:
        lines.setdefault(t["conv_id"], []).append(f"{t['role']}:{t['text']}")
    got = {c: hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() for c in want}
    assert got == {c: w["repaired_sha256"] for c, w in want.items()}


def test_long_text_is_a_segment_of_its_own(spark, rows):
    data = [(1, 0, "user", "x" * (1 << 21) + "."), (1, 1, "assistant", "y" * (1 << 21)), (1, 2, "assistant", "z.")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    report = rows(cr.repair_report(cr.intact(df), segment_bytes=1 << 20))
    assert report == list(expected(data, damaged=False).values())


def test_empty_table(table):
    _, df = table
    assert cr.repair_report(cr.damaged(df.limit(0))).collect() == []
    assert cr.repaired_turns(cr.intact(df.limit(0))).collect() == []


def test_one_hot_conversation_is_cut_in_tasks(spark):
    hot = spark.range(20_000).select(
        F.lit(5).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), (F.col("id") % 9000).cast("string"), F.lit(".")).alias("text"),
    )
    stored = cr.segments(cr.intact(hot), segment_rows=1000)
    assert stored.count() >= 20
    report = cr.repair_report(cr.intact(hot), segment_rows=1000).first()
    assert report["duplicate"] == 11_000 and report["cost"] == 22_000 and len(report["audit"]) == 20_000


def test_paths_against_brute_force():
    pick = random.Random(5)
    roles = {ap.OTHER_ROLE: "tool", ap.SYSTEM_ROLE: "system", ap.USER_ROLE: "user", ap.ASSISTANT_ROLE: "assistant"}
    faults = {ap.SOUND: "", ap.GONE: "blank", ap.CUT: "truncated"}
    for _ in range(2000):
        codes = bytes(pick.choices(range(12), k=pick.randint(0, 10)))
        want = cheapest([(roles[c & 3], "", faults[c >> 2]) for c in codes])
        price = ap.prices(codes)
        assert (price[ap.START], ap.trace(codes, price, ap.START)[0]) == want[:2]
        # no price exceeds an arc plus the price at its end
        for row, code in enumerate(codes):
            for state in range(4):
                assert all(price[4 * row + state] <= cost + price[4 * (row + ahead) + to] for _, ahead, to, cost in ap.ARCS[code][state])
