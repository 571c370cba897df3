"""Numeric and label expressions shared by the operators."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F


def mean_of_integers(total: Column, n: Column) -> Column:
    """``total / n`` to two decimals, half away from zero, decided in exact integers."""
    hundredths = F.call_function("div", F.lit(200) * F.abs(total) + n, F.lit(2) * n)
    return F.when(total < 0, -hundredths).otherwise(hundredths) / F.lit(100.0)


def labelled(column: str, rules: list[tuple[str, str]], otherwise: str) -> str:
    """CASE text from (label, condition) rules; the first match wins, NULL falls through."""
    branches = " ".join(f"when {column} {test} then '{label}'" for label, test in rules)
    return f"case {branches} else '{otherwise}' end"


def literal_map(entries: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(entries.items())])


def lookup(entries: dict, key: Column) -> Column:
    """Value of a small fixed table, NULL for an unknown key."""
    return F.try_element_at(literal_map(entries), key)
