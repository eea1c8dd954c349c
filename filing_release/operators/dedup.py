"""Best row per organisation.

The winner of each EIN is the lexicographic maximum of its criteria
(FISYR, size score, start year, tie-break).  It is computed as one
aggregation ``max(struct(criteria..., row))`` instead of a window:

* partial aggregation runs before the shuffle, so a hot EIN (a placeholder
  key holding a third of all rows) leaves each map task as one row and is
  never sorted in one task;
* the fiscal-year-shift test (F4) needs facts about the whole group; the
  same aggregation computes them, plus the best row restricted to the
  release year, and the final projection picks one - still one shuffle.

``max`` over a struct compares field by field with nulls lowest, i.e. the
``DESC NULLS LAST`` order of the equivalent ``row_number()`` query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import start_year


def size_score(rev="TOTREV", assets="ASS_EOY", exps="EXPS") -> Column:
    """|revenue| + |assets| + |expenses|."""
    return F.abs(F.col(rev)) + F.abs(F.col(assets)) + F.abs(F.col(exps))


def pf_size_score() -> Column:
    """|P1TOTREV| + |P1TOTEXP| + max(|P2TASFMV|, |P2TOTAST|) (greatest
    skips a null, like a row-wise max)."""
    return (F.abs(F.col("P1TOTREV")) + F.abs(F.col("P1TOTEXP"))
            + F.greatest(F.abs(F.col("P2TASFMV")), F.abs(F.col("P2TOTAST"))))


def hash_tiebreak(columns: Sequence[str]) -> Column:
    """Deterministic stand-in for a random tie-break (stable across
    recomputation, partition count and executor loss)."""
    return F.xxhash64(*[F.col(c) for c in columns])


def unit_random(columns: Sequence[str], seed: int = 42) -> Column:
    """I5 RANDNUM: seeded uniform [0, 1) from the row identity."""
    h = F.xxhash64(F.lit(seed), *[F.col(c) for c in columns])
    return F.pmod(h, F.lit(1 << 53)).cast("double") / float(1 << 53)


def best_per_key(df: DataFrame, key: str, criteria: Sequence[Column]) -> DataFrame:
    """Generic top-1 per key by descending criteria, as one aggregation."""
    cols = df.columns
    best = F.max(F.struct(F.struct(*criteria).alias("k"), F.struct(*cols).alias("r")))
    return df.groupBy(key).agg(best.alias("_b")).select("_b.r.*")


def deduplicate(df: DataFrame, release_year: int, score: Column | None = None,
                tiebreak: Column | None = None, key: str | Sequence[str] = "EIN", fisyr: str = "FISYR",
                fisyr_prior: str | None = "FISYRP", year_shift: bool = True,
                depth: int = 2, styear: Column | None = None, literal: bool = False) -> DataFrame:
    """F1 with C6, F2/F3, F4, F5, F6.

    * C6: rows with FISYR < Y - depth are dropped first (null too);
    * order: FISYR, size score, STYEAR, tie-break - all descending;
    * F4 (not PF): when an EIN has a row for Y with a prior at Y-1 *and* a
      row for Y+1 without a prior, and its newest year is Y+1, the Y row
      wins so year Y is not lost.
    """
    keys = [key] if isinstance(key, str) else list(key)
    df = df.filter(F.col(fisyr) >= release_year - depth)
    score = size_score() if score is None else score
    sty = (F.col("STYEAR") if "STYEAR" in df.columns else start_year()) if styear is None else styear
    tie = hash_tiebreak([c for c in ("EIN", "TAXPER", "SOURCE") if c in df.columns]) \
        if tiebreak is None else tiebreak
    cols = df.columns
    crit = F.struct(F.col(fisyr), score, sty, tie)
    row = F.struct(*cols)
    best_all = F.max(F.struct(crit.alias("k"), row.alias("r")))
    if not (year_shift and fisyr_prior and fisyr_prior in cols):
        return df.groupBy(*keys).agg(best_all.alias("_b")).select("_b.r.*")
    if literal:
        return _literal_year_shift(df, keys, release_year, fisyr, fisyr_prior, crit, row)

    y = F.col(fisyr)
    has_prior_y = F.max(((y == release_year) & (F.col(fisyr_prior) == release_year - 1))
                        .cast("int"))
    next_no_prior = F.max(((y == release_year + 1) & F.col(fisyr_prior).isNull()).cast("int"))
    best_y = F.max(F.when(y == release_year, F.struct(crit.alias("k"), row.alias("r"))))
    agg = df.groupBy(*keys).agg(
        best_all.alias("_all"), best_y.alias("_y"), F.max(y).alias("_maxy"),
        has_prior_y.alias("_a"), next_no_prior.alias("_b"))
    shift = (F.col("_a") == 1) & (F.col("_b") == 1) & (F.col("_maxy") == release_year + 1)
    return agg.select(F.when(shift, F.col("_y")).otherwise(F.col("_all")).alias("_w")) \
              .select("_w.r.*")


def _literal_year_shift(df: DataFrame, keys: list[str], y: int, fisyr: str, fisyr_prior: str,
                        crit: Column, row: Column) -> DataFrame:
    """M1 literal mode (for comparing with releases built by the published
    tool): the year target is max(FISYR) - 1 when *exactly two* rows of the
    EIN match either shift pattern, and rows not at the target are dropped
    - which can drop an EIN entirely.  Two aggregations and a join."""
    q = ((F.col(fisyr) == y) & (F.col(fisyr_prior) == y - 1)) | \
        ((F.col(fisyr) == y + 1) & F.col(fisyr_prior).isNull())
    stats = df.groupBy(*keys).agg(F.count_if(F.coalesce(q, F.lit(False))).alias("_q"),
                                  F.max(fisyr).alias("_m"))
    target = F.col("_m") - F.when(F.col("_q") == 2, 1).otherwise(0)
    kept = df.join(stats, keys).filter(F.col(fisyr) == target)
    best = F.max(F.struct(crit.alias("k"), row.alias("r")))
    return kept.groupBy(*keys).agg(best.alias("_b")).select("_b.r.*")


def duplicated_rows(df: DataFrame, key: str = "EIN") -> DataFrame:
    """rows whose key occurs more than once (count per key by partial
    aggregation, then a semi join)."""
    dups = df.groupBy(key).count().filter(F.col("count") > 1).select(key)
    return df.join(dups, key, "left_semi")
