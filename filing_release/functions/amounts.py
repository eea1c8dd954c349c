"""Amount parsing (I1, B8, B10) and null fills.

Raw extracts arrive as text.  An amount is a plain decimal number with an
optional exponent; anything else (``abc``, ``1d``, ``0x1A``, ``NaN``,
``inf``, ``1,000``, empty) is unparsable and becomes 0.  A regular
expression guard keeps Java-only number spellings such as ``1d``/``1f``
out, then ``try_cast`` parses the text to the nearest double, the same
value a Python float parser gives.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

# Fixed value: the accepted number shape (sign, digits with optional point,
# optional exponent, surrounding blanks).
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def parse_amount(c: Column | str, fill_zero: bool = True) -> Column:
    """Text -> double; unparsable -> 0 (or null when ``fill_zero`` is off)."""
    c = F.col(c) if isinstance(c, str) else c
    s = c.cast("string")
    parsed = F.when(s.rlike(NUMBER_PATTERN), F.trim(s).try_cast("double"))
    return F.coalesce(parsed, F.lit(0.0)) if fill_zero else parsed


def make_numeric(df: DataFrame, columns: Iterable[str], fill_zero: bool = True) -> DataFrame:
    """Cast every present amount column in one projection.

    Columns already numeric are only null-filled; absent names are skipped
    (the reference coerces the intersection of its list with the table).
    """
    wanted = {c.upper() for c in columns}
    out = []
    for f in df.schema.fields:
        if f.name.upper() in wanted:
            if isinstance(f.dataType, NumericType):
                e = F.col(f.name).cast("double")
                e = F.coalesce(e, F.lit(0.0)) if fill_zero else e
            else:
                e = parse_amount(f.name, fill_zero)
            out.append(e.alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def fill_by_type(df: DataFrame) -> DataFrame:
    """Numeric null -> 0, string null -> '' (after a union of forms)."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    txt = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if num:
        df = df.na.fill(0, subset=num)
    if txt:
        df = df.na.fill("", subset=txt)
    return df
