"""First-match rules over the rows of a column profile."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Gives ``label`` to the rows where ``when`` holds; ``labels`` gives one per name instead."""

    when: Column
    label: str | None = None
    labels: Mapping[str, str] | None = None

    def value(self, name: Column) -> Column:
        if self.labels is None:
            return F.lit(self.label).cast("string")
        pairs = [F.lit(part) for item in self.labels.items() for part in item]
        return F.create_map(*pairs)[name]


def named(name: Column, names: Iterable[str], prefixes: Sequence[str] = (), contains: Sequence[str] = ()) -> Column:
    """The name is listed, starts with one of ``prefixes`` or contains one of ``contains``."""
    test = name.isin(list(names)) if names else F.lit(False)
    for p in prefixes:
        test = test | name.startswith(p)
    for c in contains:
        test = test | name.contains(c)
    return test


def names_rule(name: Column, labels: Mapping[str, str]) -> Rule:
    return Rule(name.isin(list(labels)), labels=labels)


def first_match(df: DataFrame, name: str, rules: Sequence[Rule], output: str, default: str | None) -> DataFrame:
    """Label of the first rule that holds for each row."""
    key = F.col(name)
    chain = F
    for rule in rules:
        chain = chain.when(rule.when, rule.value(key))
    return df.withColumn(output, chain.otherwise(F.lit(default).cast("string")))
