"""Row filters.

Null handling follows the source tool: a row is an empty filer only when
every listed value is literally ``N`` or ``0``; a null keeps the row.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import source_kind
from .absent import check_present

# Values that mark a field as "not filled in" (C1).
EMPTY_MARKERS = ["N", "0"]
# Review states.
UNREVIEWED, FIXED, IGNORED, CHECKED = 0, 1, 2, 3


def drop_list_names(drop_list: Sequence[str], crosswalk: Mapping[str, str]) -> list[str]:
    """Names in a drop list pass through the crosswalk when they can."""
    return [crosswalk.get(n.strip().upper(), n.strip().upper()) for n in drop_list if n.strip()]


def empty_filer(columns: Sequence[str]) -> Column:
    """True iff every listed value is 'N' or '0' (null/'' -> not empty)."""
    parts = [F.coalesce(F.col(c).cast("string").isin(EMPTY_MARKERS), F.lit(False))
             for c in columns]
    return reduce(lambda a, b: a & b, parts)


def drop_empty_filers(df: DataFrame, columns: Sequence[str],
                      optional: Collection[str] = ()) -> DataFrame:
    """An empty list drops nothing.  A listed column that the table lacks
    would shorten the test and drop filings that are not empty, so it raises
    unless it is ``optional``."""
    cols = check_present(df, columns, "empty-filer test", optional)
    if not cols:
        return df
    return df.filter(~empty_filer(cols))


def drop_value(df: DataFrame, column: str, value: str) -> DataFrame:
    """Remove rows equal to ``value``; nulls stay."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def with_source_kind(df: DataFrame, source: str = "SOURCE") -> DataFrame:
    """C4: SOURCE_KIND column (EZ, FULL, PF, null for prior-release rows)."""
    return df.withColumn("SOURCE_KIND", source_kind(source))


def split_release(df: DataFrame, subsection: str = "SUBSECCD",
                  charity_code: str = "03") -> tuple[DataFrame, DataFrame]:
    """(PC, CO); a null code goes to CO."""
    pc = F.col(subsection).eqNullSafe(F.lit(charity_code))
    return df.filter(pc), df.filter(~pc)


def release_name(subsection: str = "SUBSECCD", charity_code: str = "03") -> Column:
    return F.when(F.col(subsection).eqNullSafe(F.lit(charity_code)), "PC").otherwise("CO")


def recent_only(df: DataFrame, release_year: int, depth: int = 2,
                fisyr: str = "FISYR") -> DataFrame:
    """Keep FISYR >= Y - depth (null out)."""
    return df.filter(F.col(fisyr) >= release_year - depth)


def not_in_states(states: Sequence[int], state: str = "VALIDATION_STATE") -> Column:
    """State outside ``states`` (state is an int column)."""
    return ~F.col(state).cast("int").isin(list(states))


def any_over(columns: Sequence[str], tolerance: float) -> Column:
    """Any |residual| > tolerance (null residuals never fail)."""
    if not columns:
        return F.lit(False)
    parts = [F.coalesce(F.abs(F.col(c)) > tolerance, F.lit(False)) for c in columns]
    return reduce(lambda a, b: a | b, parts)


def touched_rows(state: str = "VALIDATION_STATE", explanation: str = "EXPLANATION") -> Column:
    """C11: rows a reviewer changed or explained."""
    return (F.col(state).cast("int") > 0) | F.coalesce(F.col(explanation) != "", F.lit(False))
