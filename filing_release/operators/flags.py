"""Review extraction: largest (L), changed (C), failing (F) and the reason
letters per organisation (E1, E4, K1-K4, D12, H2).

E1 needs an exact interpolated quantile over a whole table.  Spark's exact
``percentile`` keeps a count per distinct value on one reducer, which does
not survive 100 TB.  ``exact_quantiles`` instead narrows a value bracket
around the target rank with distributed counts (approximate quantile,
then equal-width histograms) until the bracket holds few enough values to
read; every pass is a map-side-combined aggregate and only bucket counts
reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import CHECKED, IGNORED, any_over
from .rules import residual_columns

# Extraction defaults (quantile, relative change, revenue
# cutoff) and the tolerance for residuals.
QUANTILE = 0.999
CHANGE = 0.5
REVENUE_CUTOFF = 10_000_000
TOLERANCE = 1000.0
# Canonical reason-letter order.
REASON_ORDER = ["C", "F", "L"]

CO_PC_CURRENT = ("TOTREV2", "EXPS", "ASS_EOY")
CO_PC_PRIOR = ("TOTREVP", "EXPSP", "ASS_BOY")
PF_CURRENT = ("P1TOTREV", "P1TOTEXP", "P2TOTAST")


# --- E1 -------------------------------------------------------------------------
def _interp(lo: float, hi: float, frac: float) -> float:
    return lo + (hi - lo) * frac


def exact_quantiles(df: DataFrame, columns: Sequence[str], q: float,
                    accuracy: int = 10_000, max_read: int = 100_000,
                    buckets: int = 2048) -> dict[str, float | None]:
    """Exact linear-interpolated quantile (nulls skipped) per column."""
    return grouped_exact_quantiles(df, columns, q, None, accuracy, max_read, buckets)[None]


def grouped_exact_quantiles(df: DataFrame, columns: Sequence[str], q: float,
                            group: str | None = None, accuracy: int = 10_000,
                            max_read: int = 100_000, buckets: int = 2048) -> dict:
    """Exact quantiles per (group value, column).

    Pass 1 (one aggregate, grouped): count, min, max and an approximate
    bracket [q - m, q + m] per target.  Then every round is one aggregate
    over all still-open targets at once: rows below the bracket, rows in
    it, and the bracket's min/max.  A target closes when its bracket holds
    the needed ranks and few enough values to read in order; otherwise an
    equal-width histogram of the bracket (count, min and max per bucket reach
    the driver) narrows it to the bucket of both ranks.  Ranks in two buckets
    are that bucket's max and the next one's min, so nothing is left to read.
    A bracket's ends lie in different buckets, so every round drops values and
    heavily repeated ones close too.  NaN has no rank and is an error.
    """
    g = F.col(group) if group else F.lit(None).cast("string")
    base = df.select(g.alias("_g"), *[F.col(c).cast("double").alias(c) for c in columns])
    margin = 3.0 / accuracy
    first = base.groupBy("_g").agg(*[x for c in columns for x in (
        F.count(c).alias(f"{c}__n"), F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"),
        F.percentile_approx(c, [max(q - margin, 0.0), min(q + margin, 1.0)], accuracy)
         .alias(f"{c}__ap"))]).collect()
    out: dict = {}
    open_t = {}
    for r in first:
        out[r["_g"]] = {}
        for c in columns:
            n = r[f"{c}__n"]
            if not n:
                out[r["_g"]][c] = None
                continue
            pos = (n - 1) * q
            lo, hi = r[f"{c}__ap"]
            open_t[(r["_g"], c)] = dict(pos=pos, k_lo=math.floor(pos), k_hi=math.ceil(pos),
                                        lo=lo, hi=hi, gmin=r[f"{c}__min"], gmax=r[f"{c}__max"])
    while open_t:
        aggs, keys = [], list(open_t)
        for i, (gv, c) in enumerate(keys):
            t = open_t[(gv, c)]
            x = F.col(c)
            in_g = F.col("_g").eqNullSafe(F.lit(gv))
            inside = in_g & (x >= t["lo"]) & (x <= t["hi"])
            aggs += [F.count_if(in_g & (x < t["lo"])).alias(f"b{i}"), F.count_if(inside).alias(f"i{i}"),
                     F.min(F.when(inside, x)).alias(f"mn{i}"), F.max(F.when(inside, x)).alias(f"mx{i}")]
        r = base.agg(*aggs).collect()[0]
        to_read = []
        for i, key in enumerate(keys):
            t = open_t[key]
            below, cnt, mn, mx = r[f"b{i}"], r[f"i{i}"], r[f"mn{i}"], r[f"mx{i}"]
            gv, c = key
            if mx is not None and math.isnan(mx):
                raise ValueError(f"NaN in {c}: no exact quantile")
            if below > t["k_lo"]:
                t["lo"] = t["gmin"]
            elif below + cnt <= t["k_hi"]:
                t["hi"] = t["gmax"]
            elif mn == mx:
                out[gv][c] = mn
                del open_t[key]
            elif cnt <= max_read:
                t["below"] = below
                to_read.append(key)
            else:
                ends = _narrow(base, gv, c, t, below, mn, mx, buckets)
                if ends:
                    out[gv][c] = _interp(*ends, t["pos"] - t["k_lo"])
                    del open_t[key]
        if to_read:
            # one job reads the (small) brackets of every closing target
            picks = []
            for j, (gv, c) in enumerate(to_read):
                t = open_t[(gv, c)]
                x = F.col(c)
                cond = F.col("_g").eqNullSafe(F.lit(gv)) & (x >= t["lo"]) & (x <= t["hi"])
                picks.append(F.when(cond, F.struct(F.lit(j).alias("t"), x.alias("v"))))
            rows = base.select(F.explode(F.array(*picks)).alias("p")).filter(F.col("p").isNotNull()) \
                .select("p.t", "p.v").collect()
            got: dict[int, list] = {}
            for row in rows:
                got.setdefault(row[0], []).append(row[1])
            for j, key in enumerate(to_read):
                t = open_t.pop(key)
                v = sorted(got.get(j, []))
                lo_v, hi_v = v[t["k_lo"] - t["below"]], v[t["k_hi"] - t["below"]]
                out[key[0]][key[1]] = _interp(lo_v, hi_v, t["pos"] - t["k_lo"])
    return out


def _narrow(base: DataFrame, gv, c: str, t: dict, below: int, mn: float, mx: float,
            buckets: int) -> tuple[float, float] | None:
    """Set the bracket of ``t`` to the bucket holding both ranks, or return the
    two values when the ranks lie in different buckets."""
    x = F.col(c)
    width = (mx - mn) / buckets
    if 0 < width < math.inf:
        b = F.least(F.floor((x - F.lit(mn)) / F.lit(width)).cast("int"), F.lit(buckets - 1))
    else:   # too narrow or too wide for steps: the smallest value, and the rest
        b = F.when(x > mn, 1).otherwise(0)
    sel = base.filter(F.col("_g").eqNullSafe(F.lit(gv)) & (x >= mn) & (x <= mx))
    hist = sel.groupBy(b.alias("b")).agg(F.count("*").alias("n"), F.min(x).alias("lo"),
                                         F.max(x).alias("hi")).collect()
    seen, first = below, None
    for r in sorted(hist, key=lambda r: r["b"]):
        seen += r["n"]
        if first is None and seen > t["k_lo"]:
            first = r
        if seen > t["k_hi"]:
            if r["b"] != first["b"]:
                return first["hi"], r["lo"]
            break
    t["lo"], t["hi"] = first["lo"], first["hi"]
    return None



# --- K1 / K2 / K3 ---------------------------------------------------------------
def reviewable(state: str = "VALIDATION_STATE") -> Column:
    return ~F.col(state).cast("int").isin(IGNORED, CHECKED)


def largest_flag(cuts: dict[str, float | None], state: str = "VALIDATION_STATE") -> Column:
    """K1: any amount >= its quantile cut, state not ignored/checked."""
    cond = F.lit(False)
    for c, v in cuts.items():
        if v is not None:
            cond = cond | F.coalesce(F.col(c) >= F.lit(v), F.lit(False))
    return cond & reviewable(state)


def changed_flag(current: Sequence[str] = CO_PC_CURRENT, prior: Sequence[str] = CO_PC_PRIOR,
                 change: float = CHANGE, cutoff: float = REVENUE_CUTOFF,
                 state: str = "VALIDATION_STATE") -> Column:
    """K2 without division: |c - p| / p >= change  <=>  p > 0 and
    |c - p| >= change * p, or p = 0 and c <> 0 (an infinite change).  A
    negative prior never qualifies; null -> no."""
    def big(c, p):
        c, p = F.col(c), F.col(p)
        e = ((p > 0) & (F.abs(c - p) >= p * change)) | ((p == 0) & (c != 0))
        return F.coalesce(e, F.lit(False))
    moved = big(current[0], prior[0]) | big(current[1], prior[1]) | big(current[2], prior[2])
    size = F.coalesce(F.col(current[0]) >= cutoff, F.lit(False)) \
        | F.coalesce(F.col(prior[0]) >= cutoff, F.lit(False))
    return moved & size & reviewable(state)


def failing_flag(df: DataFrame, tolerance: float = TOLERANCE,
                 state: str = "VALIDATION_STATE") -> Column:
    """C10 + K3: any residual over tolerance on a row that is not ignored."""
    return any_over(residual_columns(df), tolerance) & \
        (F.col(state).cast("int") != IGNORED)


def reason_letters(flags: dict[str, Column]) -> Column:
    """K4/E4 per row: letters of the raised flags in canonical order."""
    parts = [F.when(flags[k], F.lit(k)).otherwise(F.lit("")) for k in REASON_ORDER if k in flags]
    return F.concat(*parts)


def flag_rows(df: DataFrame, flags: dict[str, Column], reason: str = "VALIDATION_REASON") -> DataFrame:
    """K4 on a table with one row per EIN (after de-dup): rows with at
    least one flag, with their reason letters - no shuffle."""
    return df.withColumn(reason, reason_letters(flags)).filter(F.col(reason) != "")


def flag_rows_grouped(df: DataFrame, flags: dict[str, Column], order: Sequence[str],
                      key: str | Sequence[str] = "EIN", reason: str = "VALIDATION_REASON") -> DataFrame:
    """K4/E4/E7 when a key can repeat: letters are OR-ed per key and one
    representative row (smallest ``order`` tuple) is kept - one aggregation
    with map-side combine, so a hot key is never gathered in one task."""
    letters = {k: F.max(v.cast("int")).alias(f"_f{k}") for k, v in flags.items()}
    rep = F.min(F.struct(F.struct(*[F.col(o) for o in order]).alias("k"),
                         F.struct(*df.columns).alias("r")))
    keys = [key] if isinstance(key, str) else list(key)
    g = df.groupBy(*keys).agg(*letters.values(), rep.alias("_rep"))
    reason_col = reason_letters({k: F.col(f"_f{k}") == 1 for k in flags})
    return g.select("_rep.r.*", reason_col.alias(reason)).filter(F.col(reason) != "")
