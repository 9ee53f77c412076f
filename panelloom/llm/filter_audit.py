"""Filter interaction audit: what each filter removes, in every order in which the filters could run.

A document is reduced to the mask of the filters it fails, and the table to one cell per part and mask with its
number of documents. Each cell is folded across the array of all orders: ``aggregate`` walks the filters of an
order and says at each step whether the cell is kept, removed or already gone, ``transform`` does so for all
orders. That gives 600 structs weighted by the cell, and a part's cells (32 at most) are merged by elementwise sums.

The filter on copies is the only one that needs other documents. Rows are first aggregated by (digest, part, mask,
id) and then by (digest, part, mask, labels), so a text that a third of all rows share is a few rows when its
smallest id is looked for.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.session import materialize

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
BLANKS = r"[ \t\n\x0B\f\r]+"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_COPY = 1 << FILTERS.index("E")


def own_mask(text: Column) -> Column:
    """Bits of the filters A to D that ``text`` fails (few words, few distinct words, capitals, symbols)."""
    words = F.array_remove(F.split(text, BLANKS), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = [n < 200, 100 * distinct < 50 * n, 100 * capitals > 3 * F.length(text), text.rlike("[#$%&*|]")]
    return sum((f.cast("int") * F.lit(1 << i) for i, f in enumerate(fails)), F.lit(0)).cast("int")


def cells(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", part: str = "lang") -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by the filters they fail, and how many carry each label.

    Equality of texts is that of their SHA-256. A row without an id has no smaller one and is smaller than
    none. Several label rows of one id count once: a label is set if any of them sets it.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(key).cast("long").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole.alias("_t")
    ).select("id", "part", own_mask(F.col("_t")).alias("own"), F.unhex(F.sha2(F.col("_t"), 256)).alias("digest"))
    rows = materialize(narrow.groupBy("digest", "part", "own", "id").agg(F.count("*").alias("n")), "audit-rows")
    marks = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    none = F.lit(0)
    known = rows.filter("id IS NOT NULL").join(marks, "id", "left").withColumns(
        {"good": F.coalesce("good", none), "toxic": F.coalesce("toxic", none)}
    )
    labelled = known.unionByName(rows.filter("id IS NULL").withColumns({"good": none, "toxic": none}))
    merged = labelled.groupBy("digest", "part", "own", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first"),
    )
    least = F.min("first.id").over(Window.partitionBy("digest"))  # a digest has 4 rows per part at most here
    passing = F.col("nameless") + F.coalesce(F.when(F.col("first.id") == F.col("least"), F.col("first.n")), none)
    split = merged.withColumn("least", least).withColumn("passing", passing)
    both = F.array(
        F.struct(F.col("own").alias("mask"), F.col("passing").alias("n")),
        F.struct(F.col("own").bitwiseOR(F.lit(_COPY)).alias("mask"), (F.col("n") - F.col("passing")).alias("n")),
    )
    each = split.select("part", "good", "toxic", F.inline(both)).filter("n > 0")
    return each.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


def _walk(order: Column, mask: Column, n: Column, good: Column, toxic: Column) -> Column:
    """The structs of one cell along one order, a step each."""
    zero = F.lit(0).cast("long")

    def step(state: Column, f: Column) -> Column:
        fails = F.get(F.array(*[mask.bitwiseAND(F.lit(1 << i)) != 0 for i in range(len(FILTERS))]), f)
        bit = F.get(F.array(*[F.lit(1 << i) for i in range(len(FILTERS))]), f)
        out, alive = state["alive"] & fails, state["alive"]
        at = F.struct(
            f.alias("filter"),
            F.when(alive & ~fails, n).otherwise(zero).alias("kept"), F.when(out, n).otherwise(zero).alias("removed"),
            F.when(~alive & fails, n).otherwise(zero).alias("redundant"), F.when(mask == bit, n).otherwise(zero).alias("unique_fails"),
            F.when(out, good).otherwise(zero).alias("good_lost"), F.when(out, toxic).otherwise(zero).alias("toxic_lost"),
        )
        return F.struct((alive & ~fails).alias("alive"), F.concat(state["steps"], F.array(at)).alias("steps"))

    shape = "array<struct<filter:int," + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"
    start = F.struct(F.lit(True).alias("alive"), F.array().cast(shape).alias("steps"))
    return F.aggregate(order, start, step, lambda state: state["steps"])


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", part: str = "lang") -> DataFrame:
    """Per part, order and step (600 rows a part): the counts of COUNTS and ``shapley``, zeros included.

    A null part is the empty text, together with empty ones. A null text is empty: it fails A alone, and E if
    a smaller id has an empty text. Repeated rows count each; rows of equal id are no copies of one another.
    Empty tables give an empty result; documents without labels have none. Other columns are not read.
    """
    orders = F.array(*[F.array(*[F.lit(FILTERS.index(f)) for f in order]) for order in ORDERS])
    folded = cells(docs, labels, text, key, part).select(
        "part", F.flatten(F.transform(orders, lambda o: _walk(o, *map(F.col, ("mask", "n", "good", "toxic"))))).alias("steps")
    )
    add = lambda a, b: F.struct(a["filter"].alias("filter"), *[(a[c] + b[c]).alias(c) for c in COUNTS])
    lists = folded.groupBy("part").agg(F.collect_list("steps").alias("cells"))  # 32 at most, 600 structs each
    merged = lists.select(
        "part",
        F.aggregate(
            F.slice("cells", 2, F.size("cells")), F.get("cells", 0), lambda total, cell: F.zip_with(total, cell, add)
        ).alias("steps"),
    )
    zeros = F.array(*[F.lit(0).cast("long") for _ in FILTERS])
    by_filter = F.aggregate(
        "steps", zeros, lambda sums, s: F.transform(sums, lambda v, i: v + F.when(s["filter"] == i, s["removed"]).otherwise(0))
    )
    names = F.array(*[F.lit(o) for o in ORDERS])
    spread = merged.select("part", by_filter.alias("shares"), F.posexplode("steps").alias("at", "s"))
    return spread.select(
        "part", F.get(names, F.floor(F.col("at") / len(FILTERS)).cast("int")).alias("filter_order"),
        (F.col("at") % len(FILTERS) + 1).cast("int").alias("step"), *[F.col(f"s.{c}").alias(c) for c in COUNTS],
        F.get("shares", F.col("s.filter")).alias("shapley"),
    )
