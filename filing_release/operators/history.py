"""Prior-year join (D6, B7, B10) and cascading backfill.

Both join on EIN only.  Prior releases are one row per EIN by construction
(they are published, de-duplicated releases), so the prior-year join is
N:1 and never multiplies rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.amounts import parse_amount
from .schema import FIXED_COL, PRIOR_FIELDS, STATE_COL, align_to, prior_renames, union_by_name

# Prior columns made numeric after the join.
PRIOR_NUMERIC = ["TOTREVP", "EXPSP", "ASS_BOY"]


def prior_year_join(df: DataFrame, prior: DataFrame, fields: Sequence[str] = PRIOR_FIELDS,
                    fisyr: str = "FISYR", key: str | Sequence[str] = "EIN",
                    unique_prior: bool = False) -> DataFrame:
    """Attach release Y-1 fields, renamed by B7.

    When FISYR <> FISYRP + 1, or either is null, every joined column is
    nulled and INPRIOR is '0'; otherwise INPRIOR is '1'.

    A published release is unique per key; the build asserts that (D9)
    before joining.  ``unique_prior=True`` instead reduces the prior to one
    deterministic row per key - no fan-out even on damaged input, but the
    aggregate then sits between the shuffle and the join, which stops AQE
    from splitting a hot current key, so it is off by default.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ren = {k: v for k, v in prior_renames(fields).items() if k in prior.columns}
    p = prior.select(*keys, *[F.col(k).alias(v) for k, v in ren.items()])
    if unique_prior:
        rest = [c for c in p.columns if c not in keys]
        p = p.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_p")).select(*keys, "_p.*")
    j = df.join(p, keys, "left")
    ok = F.col(fisyr).cast("double") == (F.col("FISYRP").cast("double") + 1)
    okc = F.coalesce(ok, F.lit(False))
    out = {}
    for v in ren.values():
        e = F.when(okc, F.col(v))
        if v in PRIOR_NUMERIC:
            e = parse_amount(e, fill_zero=False) if dict(p.dtypes)[v] == "string" \
                else e.cast("double")
        out[v] = e
    out["INPRIOR"] = F.when(okc, "1").otherwise("0")
    return j.withColumns(out)


def backfill(current: DataFrame, priors: Mapping[int, DataFrame], form: str | Column,
             key: str | Sequence[str] = "EIN") -> DataFrame:
    """D7 in one pass.

    Rows of release y (newest first) whose EIN is missing from the current
    table and from every newer release are appended; all rows of such an
    EIN in that release are kept.  SOURCE becomes ``core<y><form>``.
    """
    if not priors:
        return current
    cur_cols = current.columns
    cur_types = dict(current.dtypes)
    parts = []
    for y, df in priors.items():
        stamp = F.lit(f"core{y}{form.lower()}") if isinstance(form, str) else \
            F.concat(F.lit(f"core{y}"), F.lower(form))
        d = df.withColumn("SOURCE", stamp)
        d = _conform(align_to(d, cur_cols), cur_types).withColumn("_yr", F.lit(int(y)))
        num = {c: F.coalesce(parse_amount(F.col(c), fill_zero=False)
                             if dict(d.dtypes)[c] == "string" else F.col(c).cast("double"),
                             F.lit(0.0))
               for c in PRIOR_NUMERIC if c in d.columns}
        parts.append(d.withColumns(num) if num else d)
    cand = union_by_name(parts)
    keys = [key] if isinstance(key, str) else list(key)
    # partial aggregation collapses a hot current key before the shuffle
    have = current.select(*keys).distinct()
    cand = cand.join(have, keys, "left_anti")
    # newest release per key: a key has at most one row per prior release
    # (releases are unique per key; the build asserts it), so this window's
    # groups hold at most ``len(priors)`` rows, and it reuses the anti join's
    # key partitioning - no further shuffle
    w = Window.partitionBy(*keys)
    back = cand.withColumn("_newest", F.max("_yr").over(w)) \
        .filter(F.col("_yr") == F.col("_newest")).drop("_yr", "_newest")
    out = union_by_name([current, back])
    fills = {}
    if STATE_COL in out.columns:
        fills[STATE_COL] = F.coalesce(F.col(STATE_COL), F.lit(0))
    if FIXED_COL in out.columns:
        fills[FIXED_COL] = F.coalesce(F.col(FIXED_COL), F.lit(""))
    return out.withColumns(fills) if fills else out


def _conform(df: DataFrame, types: dict) -> DataFrame:
    """A7 for prior releases: each column takes the current table's type
    (text amounts are parsed; unparsable -> 0, as the source tool's loader)."""
    out = []
    for c, t in df.dtypes:
        want = types.get(c, t)
        if want == t:
            out.append(F.col(c))
        elif t == "string" and want in ("double", "float", "int", "bigint"):
            out.append(parse_amount(F.col(c)).cast(want).alias(c))
        else:
            out.append(F.col(c).cast(want).alias(c))
    return df.select(*out)


def backfill_years(release_year: int, depth: int) -> list[int]:
    return [release_year - k for k in range(1, depth + 1)]
