"""Configured columns that a table doesn't have.

A missing amount is not a zero amount: reading it as 0 gives false totals,
residuals and empty-filer tests.  Every operator that reads configured columns
therefore raises when one is absent, unless the caller lists it as optional (an
older form lacks it, say); an optional absent amount counts as 0.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class AbsentColumns(ValueError):
    """Configured columns that are neither in the table nor optional."""

    def __init__(self, what: str, names: Iterable[str]):
        self.names = sorted(set(names))
        super().__init__(f"{what}: no column {', '.join(self.names)}; list it as optional if the "
                         "table isn't meant to have it")


def check_present(df: DataFrame, names: Iterable[str], what: str,
                  optional: Collection[str] = ()) -> list[str]:
    """The names that ``df`` has, once all others are known to be optional."""
    names = list(dict.fromkeys(names))
    have = set(df.columns)
    absent = [n for n in names if n not in have and n not in set(optional)]
    if absent:
        raise AbsentColumns(what, absent)
    return [n for n in names if n in have]


def amount(have: Collection[str], name: str) -> Column:
    """An amount, or 0 for an optional column that is absent."""
    return F.col(name) if name in have else F.lit(0.0)
