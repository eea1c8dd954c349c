"""Arithmetic validation rules (J1-J32), failure summary (E2, E3, E10) and
rule cross-references (L4, L5).

Rules are data: a catalogue of ``total - (part +/- part ...)`` formulas per
source form, compiled into one projection of residual columns.  A residual
is null on rows of another source kind (C4); PF rules apply to every PF row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .absent import amount, check_present
from .filters import IGNORED


@dataclass(frozen=True)
class Rule:
    name: str            # residual column is ``validate_<name>``
    form: str            # EZ, FULL or PF
    total: str
    parts: tuple[tuple[int, str], ...]
    active: bool = True

    @property
    def column(self) -> str:
        return f"validate_{self.name}"

    @property
    def fields(self) -> list[str]:
        return [self.total] + [f for _, f in self.parts]

    @property
    def formula(self) -> str:
        body = " ".join(("+ " if s > 0 else "- ") + f for s, f in self.parts)[2:]
        return f"{self.total} - ({body})"


def _rule(name: str, form: str, formula: str, active: bool = True) -> Rule:
    total, rest = formula.split("-", 1)
    rest = rest.strip()
    assert rest.startswith("(") and rest.endswith(")"), formula
    tokens = re.findall(r"[+-]|[A-Z0-9_]+", rest[1:-1])
    parts, sign = [], 1
    for t in tokens:
        if t in "+-":
            sign = 1 if t == "+" else -1
        else:
            parts.append((sign, t))
            sign = 1
    return Rule(name, form, total.strip(), tuple(parts), active)


# ---------------------------------------------------------------------------
# The validation rule catalogue (residual = stated total minus
# the sum of its parts).  ``False`` marks rules defined but switched off.
# ---------------------------------------------------------------------------
CATALOGUE_TEXT = [
    ("ez_saleothn", "EZ", "SALEOTHN - (SALEOTHG - SALEOTHE)", True),
    ("ez_netincfndrsng", "EZ", "NETINCFNDRSNG - (GRSINCGAMING + GRSINCFNDRSNG - DIREXP)", True),
    ("ez_grprof", "EZ", "GRPROF - (INVENTG - GOODS)", True),
    ("ez_totrev", "EZ", "TOTREV - (CONT + PRGMSERVREV + DUESASSESMNTS + INVINC + SALEOTHN + NETINCFNDRSNG + GRPROF + OTHINC)", True),
    ("ez_netinc", "EZ", "NETINC - (TOTREV - EXPS)", True),
    ("ez_ass_eoy", "EZ", "ASS_EOY - (LIAB_EOY + FUNDBAL)", True),
    ("fu_exps", "FULL", "EXPS - (GRNTSTOGOVT + GRNSTTOINDIV + GRNTSTOFRGNGOVT + BENIFITSMEMBRS + COMPENS + COMPNSATNANDOTHR + OTHSAL + PENSIONPLANCONTRB + OTHREMPLYEEBENEF + PAYTAX + FEESFORSRVCMGMT + LEGALFEES + ACCNTINGFEES + FEESFORSRVCLOBBY + FUNDFEES + FEESFORSRVCINVSTMGMT + FEESFORSRVCOTHR + ADVRTPROMO + OFFICEXPNS + INFOTECH + ROYALTSEXPNS + OCCUPANCY + TRAVEL + TRAVELOFPUBLICOFFCL + CONVERCONVENTMTNG + INTERESTAMT + PYMTOAFFILIATES + DEPRCATNDEPLETN + INSURANCE + OTHREXPNSA + OTHREXPNSB + OTHREXPNSC + OTHREXPNSD + OTHREXPNSE + OTHREXPNSF)", False),
    ("fu_netrent", "FULL", "NETRENT - (RNTLINCREAL + RNTLINCPRSNL)", True),
    ("fu_netgnls", "FULL", "NETGNLS - (SALESECN + SALEOTHN)", True),
    ("fu_netincfndrsng", "FULL", "NETINCFNDRSNG - (GRSINCFNDRSNG - LESSDIRFNDRSNG)", True),
    ("fu_netincgaming", "FULL", "NETINCGAMING - (GRSINCGAMING - LESSDIRGAMING)", True),
    ("fu_grprof", "FULL", "GRPROF - (INVENTG - GOODS)", True),
    ("fu_othinc", "FULL", "OTHINC - (MISCREVTOTA + MISCREVTOT11B + MISCREVTOT11C + MISCREVTOT11D)", False),
    ("fu_totrev2", "FULL", "TOTREV2 - (CONT + PROGREV + INVINC + TXEXMPTBNDSPROCEEDS + ROYALTSINC + NETRENT + NETGNLS + NETINCFNDRSNG + NETINCGAMING + GRPROF + OTHINC)", True),
    ("fu_progrev", "FULL", "PROGREV - (TOTREV2ACOLA + TOTREV2BCOLA + TOTREV2CCOLA + TOTREV2DCOLA + TOTREV2ECOLA + TOTREV2FCOLA)", False),
    ("fu_fundbal", "FULL", "FUNDBAL - (ASS_EOY - LIAB_EOY)", True),
    ("fu_ass_eoy", "FULL", "ASS_EOY - (NONINTCASHEND + SVNGSTEMPINVEND + PLDGEGRNTRCVBLEND + ACCNTSRCVBLEND + CURRFRMRCVBLEND + RCVBLDISQUALEND + NOTESLOANSRCVBLEND + INVNTRIESALESEND + PREPAIDEXPNSEND + LNDBLDGSEQUIPEND + INVSTMNTSEND + INVSTMNTSOTHREND + INVSTMNTSPRGMEND + INTANGIBLEASSETSEND + OTHRASSETSEND)", False),
    ("fu_liab_eoy", "FULL", "LIAB_EOY - (ACCNTSPAYABLEEND + GRNTSPAYABLEEND + DEFEREDREVNUEND + BOND_EOY + ESCRWACCNTLIABEND + PAYBLETOFFCRSEND + MRTG_EOY + UNSECUREDNOTESEND + OTHRLIABEND)", False),
    ("fu_totnetliabastend", "FULL", "TOTNETLIABASTEND - (LIAB_EOY + FUNDBAL)", False),
    ("pf_p1totrev", "PF", "P1TOTREV - (P1TCONT + P1INTREV + P1DIVID + P1GRENTS + P1NGASTS + P1GINVPF + P1OTHINC)", True),
    ("pf_p1totexp", "PF", "P1TOTEXP - (P1ADMEXP + P1CONTPD)", True),
    ("pf_p1excrev", "PF", "P1EXCREV - (P1TOTREV - P1TOTEXP)", True),
    ("pf_p2tinvsc", "PF", "P2TINVSC - (P2GVTINV + P2CRPSTK + P2CRPBND)", True),
    ("pf_p14tnadj", "PF", "P14TNADJ - (P14NADJA + P14NADJB + P14NADJC + P14NADJD)", True),
    ("pf_p14tqdis", "PF", "P14TQDIS - (P14QDISA + P14QDISB + P14QDISC + P14QDISD)", True),
    ("pf_p14tasvl", "PF", "P14TASVL - (P14ASVLA + P14ASVLB + P14ASVLC + P14ASVLD)", True),
    ("pf_p14t4942", "PF", "P14T4942 - (P14A4942 + P14B4942 + P14C4942 + P14D4942)", True),
    ("pf_p14tendw", "PF", "P14TENDW - (P14ENDWA + P14ENDWB + P14ENDWC + P14ENDWD)", True),
    ("pf_p14ttsup", "PF", "P14TTSUP - (P14TSUPA + P14TSUPB + P14TSUPC + P14TSUPD)", True),
    ("pf_p14tpsup", "PF", "P14TPSUP - (P14PSUPA + P14PSUPB + P14PSUPC + P14PSUPD)", True),
    ("pf_p14tginv", "PF", "P14TGINV - (P14GINVA + P14GINVB + P14GINVC + P14GINVD)", True),
]
# ---------------------------------------------------------------------------

CATALOGUE: list[Rule] = [_rule(n, f, t, a) for n, f, t, a in CATALOGUE_TEXT]


def rules_for(form: str, include_inactive: bool = False) -> list[Rule]:
    return [r for r in CATALOGUE if r.form == form.upper() and (r.active or include_inactive)]


def rule_fields(forms: Sequence[str], include_inactive: bool = False) -> list[str]:
    """All fields that the rules of ``forms`` read."""
    return sorted({f for form in forms for r in rules_for(form, include_inactive)
                   for f in r.fields})


def residual_expr(rule: Rule, columns: Sequence[str]) -> Column:
    """``total - (p1 +/- p2 ...)``, evaluated left to right; a field that is
    not among ``columns`` counts as 0 (see ``add_residuals``)."""
    return residual_of(rule, lambda n: amount(columns, n))


def residual_of(rule: Rule, amt: Callable[[str], Column]) -> Column:
    """The rule's residual over amounts that ``amt`` names."""
    body = None
    for s, f in rule.parts:
        term = amt(f)
        body = (term if s > 0 else -term) if body is None else (body + term if s > 0 else body - term)
    return amt(rule.total) - body


def add_residuals(df: DataFrame, forms: Sequence[str] = ("EZ", "FULL"),
                  kind_col: str | None = "SOURCE_KIND", optional: Collection[str] = (),
                  include_inactive: bool = False) -> DataFrame:
    """J + C4: one residual column per active rule of ``forms``.  A field that
    the table lacks raises unless it is ``optional`` (then it counts as 0).

    With ``kind_col`` a rule applies only to rows of its form (others get
    null); ``kind_col=None`` applies every rule to every row (PF tables).
    """
    cols = df.columns
    check_present(df, rule_fields(forms, include_inactive), "rules", optional)
    out = {}
    for form in forms:
        for r in rules_for(form, include_inactive):
            e = residual_expr(r, cols)
            out[r.column] = F.when(F.col(kind_col) == r.form, e) if kind_col else e
    return df.withColumns(out)


def residual_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("validate_")]


def failure_summary(df: DataFrame, tolerance: float = 1000.0,
                    state: str = "VALIDATION_STATE", table: str | None = None) -> DataFrame:
    """E2 + E3 + E10 in one aggregate pass.

    Per table (``table`` names the column holding the release table, e.g.
    RELEASE) and rule: failures (|residual| > tolerance, ignored rows
    excluded, null residual not counted), n = all non-ignored rows of the
    table, and the failure percentage rounded half-up to one place with
    integer arithmetic (exact, no float rounding).  Long output: one row per
    (table, rule).
    """
    rcols = residual_columns(df)
    live = F.col(state).cast("int") != IGNORED
    aggs = [F.count_if(live).alias("_n")]
    aggs += [F.count_if(live & (F.abs(F.col(c)) > tolerance)).alias(c) for c in rcols]
    wide = df.groupBy(table).agg(*aggs) if table else df.agg(*aggs)
    stack = ", ".join(f"'{c[len('validate_'):].upper()}', `{c}`" for c in rcols)
    keep = [F.col(table).alias("table_name")] if table else []
    long = wide.select(*keep, F.col("_n").alias("n_rows"),
                       F.expr(f"stack({len(rcols)}, {stack}) as (rule, n_failed)"))
    pct = F.when(F.col("n_rows") > 0,
                 F.expr("cast((2000 * n_failed + n_rows) div (2 * n_rows) as double) / 10"))
    out = long.select(*([F.col("table_name")] if table else []), "rule",
                      F.col("n_failed").cast("bigint").alias("n_failed"),
                      F.col("n_rows").cast("bigint").alias("n_rows"), pct.alias("fail_pct"))
    # Any rule failing in the table (over the few summary rows only)
    from pyspark.sql import Window
    w = Window.partitionBy("table_name") if table else Window.partitionBy()
    return out.withColumn("table_failed", F.max(F.col("n_failed") > 0).over(w))


# --- L4 / L5 ------------------------------------------------------------------
def catalogue_frame(spark: SparkSession, include_inactive: bool = False) -> DataFrame:
    """The catalogue as a tiny table (rule, form, field, role)."""
    rows = []
    for r in CATALOGUE:
        if r.active or include_inactive:
            rows.append((r.name.upper(), r.form, r.total, "total"))
            rows += [(r.name.upper(), r.form, f, "part") for _, f in r.parts]
    return spark.createDataFrame(rows, "rule string, form string, field string, role string")


def cross_reference(catalogue: DataFrame) -> DataFrame:
    """L4: per form, fields used in more than one rule, with those rules."""
    per_field = catalogue.groupBy("form", "field").agg(
        F.array_sort(F.collect_set("rule")).alias("rules"))
    return per_field.filter(F.size("rules") > 1)


# --- failing rules as a bit mask ------------------------------------------------
#: Every active rule has a bit; a row's failing rules are one long.
BITS = {r.column: 1 << i for i, r in enumerate(r for r in CATALOGUE if r.active)}
MASK = "_failing"


def active_in(df: DataFrame, form: str | None = None) -> list[Rule]:
    """Active rules whose residual the table has, in catalogue order."""
    return [r for r in CATALOGUE if r.column in BITS and r.column in df.columns
            and form in (None, r.form)]


def failing_mask(df: DataFrame, threshold: float = 1000.0, form: str | None = None) -> Column:
    """The bits of the rules whose |residual| exceeds ``threshold`` (null: not)."""
    out = F.lit(0).cast("long")
    for r in active_in(df, form):
        out = out + F.when(F.abs(F.col(r.column)) > threshold, F.lit(BITS[r.column])) \
            .otherwise(0).cast("long")
    return out


def fails(rule: Rule) -> Column:
    return F.col(MASK).bitwiseAND(F.lit(BITS[rule.column]).cast("long")) != 0


def related_rules(df: DataFrame, threshold: float = 1000.0,
                  id_cols: Sequence[str] = ("EIN",)) -> DataFrame:
    """For every failing (id, rule), the other rules of its form that share
    a field with it and are not failing themselves.

    All of it stands on the row: its failing rules are a mask, and the rules
    that share a field are constant pairs of bits, so nothing is joined or
    shuffled."""
    rules = active_in(df)
    pairs = [F.struct(F.lit(a.form).alias("form"), F.lit(a.name.upper()).alias("rule"),
                      F.lit(b.name.upper()).alias("related_rule"),
                      F.lit(BITS[a.column]).cast("long").alias("own"),
                      F.lit(BITS[b.column]).cast("long").alias("other"))
             for a in rules for b in rules
             if a is not b and a.form == b.form and set(a.fields) & set(b.fields)]
    if not pairs:
        return df.select(*id_cols, *[F.lit("").alias(c) for c in ("form", "rule", "related_rule")]) \
            .limit(0)
    mask = F.col(MASK)
    hit = F.filter(F.array(*pairs), lambda p: (mask.bitwiseAND(p["own"]) != 0)
                   & (mask.bitwiseAND(p["other"]) == 0))
    return (df.select(*id_cols, failing_mask(df, threshold).alias(MASK)).filter(mask != 0)
            .select(*id_cols, F.inline(hit)).drop("own", "other"))
