"""The filter audit against a plain loop over documents and orders."""

import re
from collections import Counter
from itertools import permutations

from panelloom.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string"


def expected(docs, labels):
    good = {k for k, q, _ in labels if q == 1}
    toxic = {k for k, _, t in labels if t == 1}
    masks = []
    for k, text, lang in docs:
        text = text or ""
        words = WORD.findall(text)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
            fails.add("C")
        if re.search("[#$%&*|]", text):
            fails.add("D")
        if k is not None and any(o is not None and o < k and (t or "") == text for o, t, _ in docs):
            fails.add("E")
        masks.append((lang or "", fails, k in good if k is not None else False, k in toxic if k is not None else False))
    out = {}
    for part in {m[0] for m in masks}:
        shares = Counter()
        for order in permutations("ABCDE"):
            for step, f in enumerate(order):
                row = Counter()
                for p, fails, is_good, is_toxic in masks:
                    if p != part:
                        continue
                    gone = bool(fails & set(order[:step]))
                    row["kept"] += not gone and f not in fails
                    removed = not gone and f in fails
                    row["removed"] += removed
                    row["redundant"] += gone and f in fails
                    row["unique_fails"] += fails == {f}
                    row["good_lost"] += removed and is_good
                    row["toxic_lost"] += removed and is_toxic
                shares[f] += row["removed"]
                out[part, "".join(order), step + 1] = row
        for (p, order, step), row in out.items():
            if p == part:
                row["shapley"] = shares[order[step - 1]]
    return out


def check(spark, docs, labels):
    extra = "'x' AS mask", "'x' AS own", "'x' AS id", "'x' AS part", "'x' AS n", "'x' AS digest"
    df = spark.createDataFrame(docs, DOCS).selectExpr("*", *extra)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS good", "'x' AS text")
    names = (*filter_audit.COUNTS, "shapley")
    got = {(r["part"], r["filter_order"], r["step"]): {n: r[n] for n in names} for r in filter_audit.audit(df, marks).collect()}
    assert got == {k: {n: v[n] for n in names} for k, v in expected(docs, labels).items()}


def test_against_loop(spark):
    long = " ".join(f"w{i}" for i in range(250))
    docs = [
        (1, long, "en"), (2, long, "de"), (3, long + " Copy #1", "en"), (3, long, "en"), (None, long, "en"), (None, None, None),
        (4, None, "en"), (5, "", ""), (6, "same " * 300, "en"), (7, "SHOUT " * 250, "de"), (8, "short & sweet", None),
        (1, long, "en"), (9, "Ä" + "é " * 220 + " x", "fr"), (10, " ".join(f"W{i} A" for i in range(400)), "fr"),
        (11, "x" * 200_000, "fr"), (12, "same " * 300, "fr"),
    ]
    labels = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (3, 0, 0), (3, 1, 1), (None, 1, 1), (7, None, 1), (12, 1, None), (99, 1, 1)]
    check(spark, docs, labels)


def test_hot_text(spark):
    docs = [(i, "one text that all share", "en" if i % 3 else "de") for i in range(500, 0, -1)]
    check(spark, docs, [(i, i % 2, i % 5 == 0 and 1 or 0) for i in range(500)])


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).collect() == []
    check(spark, [(1, "a b", "en"), (2, "a b", "en")], [(5, 1, 1)])


def test_plan_has_no_python_and_no_cross_join(spark):
    docs = spark.createDataFrame([(1, "a", "en")], DOCS)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    plan = filter_audit.audit(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
