"""Quality rules: a table of thresholds compiled into one projection of text ratios.

All measures are built-in column functions, so the plan is a scan and projections: no shuffle, no
Python, and a row is judged alone. Within a row everything is linear in the text but for one sort of
its word windows, and that only where some window repeats.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the contract: what separates words, and what counts as a symbol.
BLANKS = r" \t\n\x0B\f\r"
SYMBOLS = "#*$%&|<>"

STOP_WORDS = (
    "the of and to in is that for with on as at by be this it was are an or from have "
    "de la le les des et un une du que en pour qui dans par sur au avec est "
    "der die das und ein eine zu von mit nicht den dem im ist sich auf für "
    "el los las del se y con para al su lo como por"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes if ``low <= measure <= high``; a missing bound is not tested."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        value, tests = F.col(self.measure), [F.lit(True)]
        if self.low is not None:
            tests.append(value >= F.lit(float(self.low)))
        if self.high is not None:
            tests.append(value <= F.lit(float(self.high)))
        return reduce(lambda a, b: a & b, tests)


#: The default table. Ratios are per word, but for the last two, which are per line with a word.
#: The stop words are English, French, German and Spanish: texts in other languages need a table of their own.
RULES = (
    Rule("word_length", "mean_word_chars", 3.0, 12.0),
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("stop_words", "stop_word_ratio", low=0.06),
    Rule("repeated_lines", "dup_line_ratio", high=0.4),
    Rule("words_per_line", "words_per_line", high=5000.0),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "mean_word_chars", "symbol_ratio", "stop_word_ratio", "dup_line_ratio", "words_per_line",
)


def _measures(df: DataFrame, text: str, keep: Sequence[Column]) -> DataFrame:
    """``keep`` plus the measures of ``text`` as flat columns named as in MEASURES."""
    first = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    names = first.columns[:-1]
    cut = first.select(
        *names,
        "_text",
        F.array_remove(F.split("_text", f"[{BLANKS}]+"), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike(f"[^{BLANKS}]")).alias("_lines"),
    )
    # Most texts repeat no window: equal windows have equal hashes, so distinct hashes settle them.
    windows = F.transform(
        F.slice("_words", 1, F.greatest(F.size("_words") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)),
    )
    cut = cut.select("*", windows.alias("_hashes"))
    # In the others equal windows lie side by side once sorted; their words decide, not the hash.
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    ranked = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    cut = cut.select("*", F.when(repeats, ranked).alias("_ranked"))

    def same(x: Column, k: Column) -> Column:
        other = F.get("_ranked", k)
        words = [F.get("_words", other["i"] + d) == F.get("_words", x["i"] + d) for d in range(3)]
        return F.coalesce((other["h"] == x["h"]) & words[0] & words[1] & words[2], F.lit(False))

    twice = F.filter(
        F.transform("_ranked", lambda x, k: F.when(same(x, k + 1) | same(x, k - 1), x["i"])), lambda i: i.isNotNull()
    )
    cut = cut.select("*", twice.alias("_twice"))
    covered = F.array_distinct(
        F.concat("_twice", F.transform("_twice", lambda i: i + 1), F.transform("_twice", lambda i: i + 2))
    )
    counted = cut.select(
        *names,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.size(covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("_stop"),
    )
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return counted.select(
        *names, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
        ratio("word_chars", "n_words").alias("mean_word_chars"),
        ratio("n_symbols", "n_words").alias("symbol_ratio"),
        ratio("_stop", "n_words").alias("stop_word_ratio"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        ratio("n_words", "n_lines").alias("words_per_line"),
    )


def quality_report(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: key, measures, ``base_failed``, ``kept`` and ``failed_rules``.

    Only ``key`` and ``text`` are read, so other columns, whatever their names, cannot clash. A null text
    has no words and fails; a null key stays null; repeated rows are judged alike, each for itself; an
    empty table gives an empty report. ``failed_rules`` lists the rules that failed, in table order.
    """
    measured = _measures(df, text, [F.col(key).alias("_key")])
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    failed = F.filter(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in rules]), lambda n: n.isNotNull())
    return measured.select(
        F.col("_key").alias(key), *MEASURES, base.alias("base_failed"),
        (~base & reduce(lambda a, b: a & b, [r.passes() for r in rules], F.lit(True))).alias("kept"),
        (failed if rules else F.array().cast("array<string>")).alias("failed_rules"),
    )


def keep_good(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The input rows that pass, with all their columns as they were.

    The row travels as one struct beside its measures, so no column name can clash. A row that passes is
    exploded out of an array of one: a filter would be pushed below the steps and repeat their work.
    """
    measured = _measures(df.select(F.struct("*").alias("_row")), f"_row.{text}", [F.col("_row")])
    good = (F.col("n_words") >= MIN_WORDS) & (100 * F.col("n_repeat_words") <= MAX_REPEAT_PERCENT * F.col("n_words"))
    good = reduce(lambda a, b: a & b, [r.passes() for r in rules], good)
    return measured.select(F.explode(F.when(good, F.array("_row"))).alias("_row")).select("_row.*")
