"""Derived money columns per source form.

Each form's columns are one ordered list of (name, expression) pairs; later
entries may read earlier ones, so they are applied in sequence inside a
single projection chain that Catalyst collapses into one ``Project``.
A table that lacks an input raises, unless the input is listed as optional
(then it counts as 0, the value an unparsable amount gets).
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.absent import amount, check_present


#: Columns that each form's money columns are derived from.
INPUTS = {
    "EZ": ["EXPS", "NETINC", "SALEOTHG", "DIREXP", "GOODS", "DUESASSESMNTS", "PRGMSERVREV",
           "GRSINCFNDRSNG", "GRSINCGAMING", "SALEOTHN"],
    "FULL": ["GRSRNTSREAL", "GRSRNTSPRSNL", "RNTLEXPNSREAL", "RNTLEXPNSPRSNL", "GRSINCFNDRSNG",
             "GRSINCGAMING", "LESSDIRFNDRSNG", "LESSDIRGAMING", "NETINCFNDRSNG", "NETINCGAMING",
             "TOTREV2", "EXPS", "SALESEXP", "SALEOTHE", "GOODS"],
    "PF": ["P6ESTTX", "P6TXWTH", "P6TXINV", "P6TXWERR", "P6TEXCTX", "P6TXPNLT", "TOTEXCAPLS",
           "TOTEXCAPGN", "TAXDUE", "OVERPAY"],
}


def _amt(df: DataFrame, name: str) -> Column:
    return amount(df.columns, name)


def _sum(df: DataFrame, *names: str) -> Column:
    out = _amt(df, names[0])
    for n in names[1:]:
        out = out + _amt(df, n)
    return out


def ez_money(df: DataFrame, optional: Collection[str] = ()) -> DataFrame:
    """I25 (EZ): TOTREV, GRREC, PROGREV, SPEVTG, NETGNLS."""
    check_present(df, INPUTS["EZ"], "EZ money columns", optional)
    df = df.withColumn("TOTREV", _sum(df, "EXPS", "NETINC"))
    df = df.withColumns({
        "GRREC": _sum(df, "TOTREV", "SALEOTHG", "DIREXP", "GOODS"),
        "PROGREV": _sum(df, "DUESASSESMNTS", "PRGMSERVREV"),
        "SPEVTG": _sum(df, "GRSINCFNDRSNG", "GRSINCGAMING"),
        "NETGNLS": _amt(df, "SALEOTHN"),
    })
    return df


def full_money(df: DataFrame, optional: Collection[str] = ()) -> DataFrame:
    """I26 (Full): order NETINC -> TOTREV -> GRREC matters."""
    check_present(df, INPUTS["FULL"], "Full money columns", optional)
    df = df.withColumns({
        "RENTINC": _sum(df, "GRSRNTSREAL", "GRSRNTSPRSNL"),
        "RENTEXP": _sum(df, "RNTLEXPNSREAL", "RNTLEXPNSPRSNL"),
        "SPEVTG": _sum(df, "GRSINCFNDRSNG", "GRSINCGAMING"),
        "DIREXP": _sum(df, "LESSDIRFNDRSNG", "LESSDIRGAMING"),
        "FUNDINC": _sum(df, "NETINCFNDRSNG", "NETINCGAMING"),
        "NETINC": _amt(df, "TOTREV2") - _amt(df, "EXPS"),
    })
    df = df.withColumn("TOTREV", _sum(df, "EXPS", "NETINC"))
    df = df.withColumn("GRREC", _sum(df, "TOTREV", "RNTLEXPNSREAL", "RNTLEXPNSPRSNL",
                                     "SALESEXP", "SALEOTHE", "LESSDIRFNDRSNG",
                                     "LESSDIRGAMING", "GOODS"))
    return df


def pf_money(df: DataFrame, optional: Collection[str] = ()) -> DataFrame:
    """I27 (PF): P6TXRFD (floored at 0), P1NGASTS, TFLD."""
    check_present(df, INPUTS["PF"], "PF money columns", optional)
    refund = (_amt(df, "P6ESTTX") + _amt(df, "P6TXWTH") + _amt(df, "P6TXINV")
              + _amt(df, "P6TXWERR") - _amt(df, "P6TEXCTX") + _amt(df, "P6TXPNLT"))
    return df.withColumns({
        "P6TXRFD": F.greatest(refund, F.lit(0.0)),
        "P1NGASTS": _sum(df, "TOTEXCAPLS", "TOTEXCAPGN"),
        "TFLD": _amt(df, "TAXDUE") - _amt(df, "OVERPAY"),
    })


def pf_balance_due(df: DataFrame) -> DataFrame:
    """I28 (defined but unused upstream): OVERPAY if it exceeds TAXDUE,
    else -TAXDUE; an existing BALDUOPT value is kept."""
    new = F.when(_amt(df, "OVERPAY") > _amt(df, "TAXDUE"), _amt(df, "OVERPAY")) \
           .otherwise(-_amt(df, "TAXDUE"))
    cur = F.col("BALDUOPT") if "BALDUOPT" in df.columns else F.lit(None).cast("double")
    return df.withColumn("BALDUOPT", F.coalesce(cur, new))


MONEY_BY_FORM = {"EZ": ez_money, "FULL": full_money, "PF": pf_money}
