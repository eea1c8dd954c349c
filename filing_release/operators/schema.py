"""Projection and schema operators.

Renames, final projections and fills are single ``select``s built on the
driver from small configuration lists; no data passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Accepted spellings of the tax-period column (B1).
TAX_PERIOD_NAMES = ["TAX_PRD", "TAX_PD", "A_TAX_PRD", "TAXPRD"]

# Review-tracking columns and their starting values.
STATE_COL = "VALIDATION_STATE"
FIXED_COL = "MANUALLY_FIXED"
REASON_COL = "VALIDATION_REASON"

# Prior-year fields carried into the current release.
PRIOR_FIELDS = ["ASS_EOY", "BOND_EOY", "MRTG_EOY", "LIAB_EOY", "TAXPER", "FISYR",
                "PROGREV", "INVINC", "NETRENT", "SALESECN", "SALEOTHN", "FUNDINC",
                "GRPROF", "OTHINC", "TOTREV", "EXPS", "NETINC", "COMPENS", "OTHSAL",
                "PAYTAX", "FUNDFEES", "CONT", "RETEARN", "FUNDBAL", "SOURCE"]


def upper_headers(df: DataFrame) -> DataFrame:
    """B2."""
    return df.toDF(*[c.upper() for c in df.columns])


def check_one_tax_period(columns: Iterable[str]) -> str:
    """B1: exactly one tax-period spelling (or the release name itself) must be
    present; returns it."""
    present = [c for c in columns if c.upper() in (*TAX_PERIOD_NAMES, "TAXPER")]
    if len(present) != 1:
        raise ValueError(f"expected exactly one tax-period column, found {present}")
    return present[0]


def crosswalk_map(pairs: Sequence[tuple[str, str]]) -> dict[str, str]:
    """Source (upper-cased) -> release name; a later pair for the same source
    replaces an earlier one."""
    out: dict[str, str] = {}
    for target, source in pairs:
        out[source.upper()] = target.upper()
    return out


def apply_crosswalk(df: DataFrame, pairs: Sequence[tuple[str, str]],
                    key: str = "EIN") -> tuple[DataFrame, list[str]]:
    """B2 + B3 + B4: upper-case headers and rename source -> release names.

    Returns the renamed frame and the release names the map expected but the
    table lacks (targets with several possible sources count once).
    """
    df = upper_headers(df)
    m = crosswalk_map(pairs)
    cols = []
    for c in df.columns:
        new = m.get(c, c) if c != key else c
        cols.append(F.col(f"`{c}`").alias(new))
    out = df.select(*cols)
    missing = sorted({t for t in m.values()} - set(out.columns))
    return out, missing


def final_projection(df: DataFrame, wanted: Sequence[str],
                     extra: Sequence[str] = (STATE_COL, FIXED_COL),
                     source_names: Mapping[str, str] | None = None) -> tuple[DataFrame, list[str], list[str]]:
    """Keep listed columns (list de-duplicated, order kept) plus review
    columns; report dropped and missing names.

    ``source_names`` (a crosswalk map source -> release name) resolves list
    entries spelled with their source name (M13, the ``_full`` lists): the
    release column is emitted under the listed name."""
    want = list(dict.fromkeys([*wanted, *extra]))
    src = {k.upper(): v for k, v in (source_names or {}).items()}
    cols, used = [], set()
    for c in want:
        if c in df.columns:
            cols.append(F.col(f"`{c}`"))
            used.add(c)
        elif c.upper() in src and src[c.upper()] in df.columns:
            cols.append(F.col(f"`{src[c.upper()]}`").alias(c))
            used.add(src[c.upper()])
    dropped = [c for c in df.columns if c not in used]
    missing = [c for c in want if c not in df.columns
               and not (c.upper() in src and src[c.upper()] in df.columns)]
    return df.select(*cols), dropped, missing


def add_review_columns(df: DataFrame) -> DataFrame:
    """State 0 and empty fixed-field list, only where absent."""
    add = {}
    if STATE_COL not in df.columns:
        add[STATE_COL] = F.lit(0)
    if FIXED_COL not in df.columns:
        add[FIXED_COL] = F.lit("")
    return df.withColumns(add) if add else df


# Current column -> its name in the prior-year columns.
PRIOR_NAMES = {
    "ASS_EOY": "ASS_BOY",
    "BOND_EOY": "BOND_BOY",
    "MRTG_EOY": "MRTG_BOY",
    "LIAB_EOY": "LIAB_BOY",
    "TAXPER": "TAXPERP",
    "FISYR": "FISYRP",
    "PROGREV": "PROGREVP",
    "INVINC": "INVINCP",
    "NETRENT": "NETRENTP",
    "SALESECN": "SALESECNP",
    "SALEOTHN": "SALEOTHNP",
    "FUNDINC": "FUNDINCP",
    "GRPROF": "GRPROFP",
    "OTHINC": "OTHINCP",
    "TOTREV": "TOTREVP",
    "EXPS": "EXPSP",
    "NETINC": "NETINCP",
    "COMPENS": "COMPENSP",
    "OTHSAL": "OTHSALP",
    "PAYTAX": "PAYTAXP",
    "FUNDFEES": "FUNDFEESP",
    "CONT": "CONTP",
    "RETEARN": "RETE_BOY",
    "FUNDBAL": "NETA_BOY",
    "SOURCE": "INPRIORSRC",
}


def prior_name(c: str) -> str:
    """The fixed prior-year name."""
    return PRIOR_NAMES[c]


def prior_renames(fields: Sequence[str] = PRIOR_FIELDS) -> dict[str, str]:
    return {c: prior_name(c) for c in fields}


def align_to(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep only columns the current table knows."""
    known = set(columns)
    return df.select(*[c for c in df.columns if c in known])


def drop_temp(df: DataFrame, names: Iterable[str] = ("val", "rnd")) -> DataFrame:
    """B12."""
    names = list(names)
    return df.drop(*[c for c in df.columns if c in names or c.endswith("_max")])


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """H1: union by name, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tagged_union(frames: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """H2: union with the source name as a column."""
    return union_by_name([df.withColumn(tag, F.lit(k)) for k, df in frames.items()])


def column_differences(df: DataFrame, wanted: Sequence[str]) -> tuple[list[str], list[str]]:
    """H4: (present but not wanted, wanted but not present)."""
    w = set(wanted)
    return [c for c in df.columns if c not in w], [c for c in wanted if c not in df.columns]
