"""Recorded corrections and reviewers' fixes.

The one-off manual fixes of the source tool become rows of a corrections
table ``(EIN, action, match_source, match_name, new_ein)``, so any number
of them apply in one join.  Reviewed rows come back as a fixes table that
overwrites whole release rows by EIN (update only).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import parse_amount
from .rules import residual_columns
from .schema import STATE_COL

CORRECTIONS_SCHEMA = ("EIN string, action string, match_source string, "
                      "match_name string, new_ein string")


def _match(df: DataFrame, c: DataFrame):
    cond = df["EIN"] == c["c_ein"]
    if "SOURCE" in df.columns:
        cond = cond & (c["match_source"].isNull() | (df["SOURCE"] == c["match_source"]))
    if "NAME" in df.columns:
        cond = cond & (c["match_name"].isNull() | (df["NAME"] == c["match_name"]))
    return cond


def drop_recorded(df: DataFrame, corrections: DataFrame) -> DataFrame:
    """Remove rows named by ``drop`` corrections (EIN plus optional
    SOURCE / NAME match; a null match column matches anything)."""
    c = corrections.filter(F.col("action") == "drop").select(
        F.col("EIN").alias("c_ein"), "match_source", "match_name")
    return df.join(c, _match(df, c), "left_anti")


def rekey_recorded(df: DataFrame, corrections: DataFrame) -> DataFrame:
    """Replace the EIN of rows named by ``rekey`` corrections.

    One join row per filing: the corrections of an EIN come as one array, and
    those that match a filing are picked from it, so no filing is doubled.  Two
    different new EINs for one filing stop the job; the same one twice is one.
    (The array holds the corrections recorded for one EIN, a handful by hand.)
    """
    c = corrections.filter(F.col("action") == "rekey").groupBy(F.col("EIN").alias("c_ein")).agg(
        F.collect_set(F.struct("match_source", "match_name", "new_ein")).alias("_rekeys"))
    j = df.join(c, df["EIN"] == c["c_ein"], "left")

    def applies(r):
        ok = F.lit(True)
        for column, given in (("SOURCE", r["match_source"]), ("NAME", r["match_name"])):
            if column in df.columns:
                ok = ok & (given.isNull() | F.coalesce(df[column] == given, F.lit(False)))
        return ok

    new = F.array_distinct(F.transform(F.filter(F.col("_rekeys"), applies), lambda r: r["new_ein"]))
    several = F.concat(F.lit("several new EINs for EIN "), df["EIN"], F.lit(": "),
                       F.array_join(new, ", ", "null"))
    ein = (F.when(F.coalesce(F.size(new), F.lit(0)) > 1, F.raise_error(several).cast("string"))
           .otherwise(F.coalesce(F.get(new, F.lit(0)), df["EIN"])))
    return j.select(*[ein.alias("EIN") if x == "EIN" else df[x] for x in df.columns])


def apply_corrections(df: DataFrame, corrections: DataFrame) -> DataFrame:
    return rekey_recorded(drop_recorded(df, corrections), corrections)


def integrate_fixes(release: DataFrame, fixes: DataFrame,
                    numeric_columns: Iterable[str] = ()) -> DataFrame:
    """Overwrite whole rows by EIN from ``fixes``.

    * residual (``validate_*``) columns of the fixes are dropped first;
    * amount columns are parsed without a zero fill;
    * EINs unknown to the release are ignored (update only);
    * a release column the fixes table lacks becomes null on fixed rows;
    * applying the same fixes twice gives the same table as once.
    """
    f = fixes.drop(*residual_columns(fixes))
    num = {c for c in numeric_columns}
    types = dict(release.dtypes)
    ftypes = dict(f.dtypes)
    cast = []
    for c in f.columns:
        if c == "EIN":
            cast.append(F.col("EIN"))
        elif c in num and ftypes[c] == "string":
            cast.append(parse_amount(c, fill_zero=False).alias(c))
        elif c in types:
            # fixes files are text: a value that does not parse becomes null
            e = F.col(c).try_cast(types[c]) if ftypes[c] == "string" else F.col(c).cast(types[c])
            cast.append(e.alias(c))
    f = f.select(*cast)
    # one fix row per EIN (max over the row keeps this deterministic)
    f = f.groupBy("EIN").agg(F.max(F.struct(*[c for c in f.columns if c != "EIN"])).alias("_f")) \
         .withColumn("_hit", F.lit(True))
    j = release.join(f, "EIN", "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    fixed_cols = set(f.select("_f.*").columns)
    out = []
    for c in release.columns:
        if c == "EIN":
            out.append(F.col("EIN"))
            continue
        new = F.col(f"_f.{c}") if c in fixed_cols else F.lit(None).cast(types[c])
        out.append(F.when(hit, new).otherwise(release[c]).alias(c))
    return j.select(*out)


def fix_count(fixes: DataFrame, state: str = STATE_COL) -> DataFrame:
    """Rows of a fixes table with a non-zero state (state parsed once)."""
    return fixes.agg(F.count_if(F.col(state).cast("string").try_cast("int") != 0)
                     .cast("bigint").alias("n_fixes"))
