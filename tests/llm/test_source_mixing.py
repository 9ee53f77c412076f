"""Mixing against a plain loop: targets by repeated sharing, copies by the coin."""

import hashlib
import math
import re
from collections import Counter

from panelloom.llm import source_mixing as sm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string"


def expected_targets(docs, weights=sm.WEIGHTS, share=1.5, most=2):
    words = Counter()
    for _, text, source in docs:
        words[source] += len(WORD.findall(text or ""))
    names = sorted(words, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal, held = {}, {}
    rest = share * sum(words.values())
    free = set(names)
    while free:
        goal = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if goal[s] > most * words[s]}
        if not over:
            break
        for s in over:
            held[s] = most * words[s]
        free -= over
        rest = share * sum(words.values()) - sum(held.values())
        goal = {}
    return words, {**held, **goal}


def test_plan_against_loop(spark):
    docs = [(i, "word " * (i % 37), f"s{i % 5}") for i in range(600)] + [(i, "a b c", None) for i in range(600, 640)]
    docs += [(1, "word ", "s1"), (None, None, "s0"), (None, "x y z \x1f w", ""), (7, "", "empty"), (700, "long " * 100_000, "s2")]
    docs += [(701, "p q", "s4")] * 2
    df = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS size", "'x' AS target", "'x' AS coin", "'x' AS place", "'x' AS _row")
    words, goal = expected_targets(docs)
    rows = sm.mix_plan(df).collect()
    assert len(rows) == len(docs)
    want = Counter()
    for k, text, source in docs:
        size, rate = len(WORD.findall(text or "")), goal[source] / words[source] if words[source] else 0
        coin = int(hashlib.md5(f"{sm.SEED}:{'' if k is None else k}:{text or ''}".encode()).hexdigest()[:13], 16) / 16**13
        copies = math.floor(rate + 1e-12) + (coin < rate + 1e-12 - math.floor(rate + 1e-12))
        want[k, source, size, words[source], copies, size * copies] += 1
    assert Counter((r["doc_id"], r["source"], r["size"], r["source_size"], r["copies"], r["taken"]) for r in rows) == want
    for r in rows:
        assert math.isclose(r["target"], goal[r["source"]], rel_tol=1e-12, abs_tol=1e-9) and r["taken"] <= 2 * r["size"]
    mixed = Counter((r["doc_id"], r["text"], r["source"], r["target"]) for r in sm.mix(df).collect())
    assert sum(mixed.values()) == sum(r["copies"] for r in rows)
    assert sum(len(WORD.findall(k[1] or "")) * n for k, n in mixed.items()) == sum(r["taken"] for r in rows)


def test_taken_words_come_near_the_targets_and_reruns_agree(spark):
    docs = [(i, "word " * (20 + i % 60), "hot" if i % 3 else f"s{i % 7}") for i in range(20_000)]
    df = spark.createDataFrame(docs, DOCS)
    first = sm.mix_plan(df)
    taken = first.groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert all(abs(r["sum(taken)"] / r["max(target)"] - 1) < 0.06 for r in taken)
    again = sm.mix_plan(df.repartition(13))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))


def test_no_words_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, " ", None), (3, "", "b")], DOCS)
    rows = sm.mix_plan(df).collect()
    assert [(r["size"], r["source_size"], r["target"], r["taken"]) for r in rows] == [(0, 0, 0.0, 0)] * 3
    assert sm.mix_plan(df.limit(0)).collect() == [] and sm.mix(df.limit(0)).collect() == []
    same = spark.createDataFrame([(5, "a b", "x")], DOCS)
    assert sm.mix_plan(same, share=5).first()["target"] == 4.0  # every source at its limit
