"""Review work as set-at-a-time table jobs.

The source tool edited one row at a time at a terminal.  Here reviewers'
edits arrive as an adjustments table ``(EIN, field, action, amount, user,
explanation, ts)`` and every step - applying edits, re-running rules,
state transitions, the work queue and the ledger export - is a join or an
aggregate over whole tables.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .absent import amount
from .filters import CHECKED, FIXED, IGNORED, UNREVIEWED
from .rules import (CATALOGUE, MASK, active_in, add_residuals, failing_mask, fails,
                    residual_columns)
from .schema import FIXED_COL, REASON_COL, STATE_COL

ADJUSTMENTS_SCHEMA = ("EIN string, field string, action string, amount double, "
                      "user string, explanation string, ts timestamp, seq long")

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# Review order of reason letter sets (canonical letters): failing rows first.
REASON_RANK = {"CFL": 1, "FL": 2, "CF": 3, "F": 4, "CL": 5, "L": 6, "C": 7}
# Explanation codes offered to reviewers.
EXPLANATIONS = {
    "1": "Error on form: fields do not sum to total",
    "2": "Error in data: fields not as represented on form",
    "3": "Unable to fix: 990 image missing",
    "4": "Unable to fix: fields missing",
    "5": "Form OK, no change",
}
# Where each release field sits on the full form.
FULL_FORM_LINES = {
    "CONT": "Part VIII Line 1h", "PROGREV": "Part VIII Line 2g (A)",
    "INVINC": "Part VIII Line 3A", "TXEXMPTBNDSPROCEEDS": "Part VIII Line 4A",
    "ROYALTSINC": "Part VIII Line 5A", "GRSRNTSREAL": "Part VIII Line 6a (i)",
    "GRSRNTSPRSNL": "Part VIII Line 6a (ii)", "RENTINC": "Sum of Part VIII Line 6a (i) and (ii)",
    "RNTLEXPNSREAL": "Part VIII Line 6b (i)", "RNTLEXPNSPRSNL": "Part VIII Line 6b (ii)",
    "RENTEXP": "Sum of Part VIII Line 6b (i) and (ii)", "RNTLINCREAL": "Part VIII Line 6c (i)",
    "RNTLINCPRSNL": "Part VIII Line 6c (ii)", "NETRENT": "Part VIII Line 6d (A)",
    "SECUR": "Part VIII Line 7a (i)", "SALESEXP": "Part VIII Line 7b (i)",
    "SALESECN": "Part VIII Line 7c (i)", "SALEOTHG": "Part VIII Line 7a (ii)",
    "SALEOTHE": "Part VIII Line 7b (ii)", "SALEOTHN": "Part VIII Line 7c (ii)",
    "NETGNLS": "Part VIII Line 7d", "GRSINCFNDRSNG": "Part VIII Line 8a",
    "LESSDIRFNDRSNG": "Part VIII Line 8b", "NETINCFNDRSNG": "Part VIII Line 8c",
    "GRSINCGAMING": "Part VIII Line 9a", "LESSDIRGAMING": "Part VIII Line 9b",
    "NETINCGAMING": "Part VIII Line 9c", "SPEVTG": "Sum of Part VIII Line 8a and 9a",
    "DIREXP": "Sum of Part VIII Line 8b and 9b", "FUNDINC": "Sum of Part VIII Line 8c (A) and 9c (A)",
    "INVENTG": "Part VIII Line 10a", "GOODS": "Part VIII Line 10b",
    "GRPROF": "Part VIII Line 10c (A)", "OTHINC": "Part VIII Line 11e (A)",
    "TOTREV2": "Part VIII Line 12 (A)", "COMPENS": "Part IX Line 5 (A)",
    "OTHSAL": "Part IX Line 7 (A)", "PAYTAX": "Part IX Line 10 (A)",
    "FUNDFEES": "Part IX Line 11e (A)", "EXPS": "Part IX Line 25 (A)",
    "ASS_BOY": "Part X Line 16 (A)", "ASS_EOY": "Part X Line 16 (B)",
    "BOND_EOY": "Part X Line 20 (B)", "MRTG_EOY": "Part X Line 23 (B)",
    "UNSECUREDNOTESEND": "Part X Line 24 (B)", "LIAB_BOY": "Part X Line 26 (A)",
    "LIAB_EOY": "Part X Line 26 (B)", "RETEARN": "Part X Line 32 (B)",
    "FUNDBAL": "Part X Line 33 (B)",
}
# Display groups of full-form fields for reviewers: revenue, expenses, assets.
FIELD_GROUPS = {
    "revenue": ["CONT", "PROGREV", "INVINC", "TXEXMPTBNDSPROCEEDS", "ROYALTSINC", "GRSRNTSREAL",
                "GRSRNTSPRSNL", "RENTINC", "RNTLEXPNSREAL", "RNTLEXPNSPRSNL", "RENTEXP",
                "RNTLINCREAL", "RNTLINCPRSNL", "NETRENT", "SECUR", "SALESEXP", "SALESECN",
                "SALEOTHG", "SALEOTHE", "SALEOTHN", "NETGNLS", "GRSINCFNDRSNG", "LESSDIRFNDRSNG",
                "NETINCFNDRSNG", "GRSINCGAMING", "LESSDIRGAMING", "NETINCGAMING", "SPEVTG",
                "DIREXP", "FUNDINC", "INVENTG", "GOODS", "GRPROF", "OTHINC", "TOTREV2"],
    "expenses": ["COMPENS", "OTHSAL", "PAYTAX", "FUNDFEES", "EXPS"],
    "assets": ["ASS_BOY", "ASS_EOY", "BOND_EOY", "MRTG_EOY", "UNSECUREDNOTESEND", "LIAB_BOY",
               "LIAB_EOY", "RETEARN", "FUNDBAL"],
}
# ---------------------------------------------------------------------------

ACTIONS = ("fix", "fix_ignore", "check", "ignore", "skip", "reset")


def reason_rank(reason: str = REASON_COL) -> Column:
    """G1 rank of a reason-letter set."""
    e = None
    for k, v in REASON_RANK.items():
        e = F.when(F.col(reason) == k, v) if e is None else e.when(F.col(reason) == k, v)
    return e.otherwise(len(REASON_RANK) + 1)


def review_revenue(form: str) -> str:
    return "P1TOTREV" if form.upper() == "PF" else "TOTREV2"


def rules_of_table(df: DataFrame) -> tuple[tuple[str, ...], str | None]:
    """Rule forms and kind column of a reviewed table: a PF table has the PF
    rules on every row, CO and PC tables those of each row's source kind."""
    if any(c.startswith("validate_pf_") for c in df.columns) or review_revenue("PF") in df.columns:
        return ("PF",), None
    return ("EZ", "FULL"), "SOURCE_KIND"


# --- L7 + G1 ----------------------------------------------------------------------
def work_queue(flagged: DataFrame, form: str, threshold: float = 1000.0,
               fields: Sequence[str] = ()) -> DataFrame:
    """Rows still to review - not ignored, and either a residual over the
    threshold or a state other than fixed/checked.  Ledger columns start at
    0 / ''; null residuals read as 0.  Adds REASON_RANK for the G1 order."""
    rcols = residual_columns(flagged)
    df = flagged.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in rcols})
    st = F.col(STATE_COL).cast("int")
    over = F.lit(False)
    for c in rcols:
        over = over | (F.abs(F.col(c)) > threshold)
    df = df.filter((st != IGNORED) & (over | ~st.isin(FIXED, CHECKED)))
    init = {f"{f.lower()}_adjusted_by": F.lit(0.0) for f in fields}
    init.update({"validated_by": F.lit(""), "EXPLANATION": F.lit("")})
    return df.withColumns(init).withColumn("REASON_RANK", reason_rank())


def queue_order(queue: DataFrame, form: str) -> DataFrame:
    """G1 as a distributed sort (range-partitioned, no single task)."""
    return queue.orderBy(F.col("REASON_RANK").asc(), F.col(review_revenue(form)).desc(),
                         F.col("EIN").asc())


def queue_progress(queue: DataFrame) -> DataFrame:
    """L7 progress: rows per state."""
    return queue.groupBy(STATE_COL).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


# --- L1 + L2 ------------------------------------------------------------------------
def net_adjustments(adjustments: DataFrame, money_places: int = 6) -> DataFrame:
    """Per (EIN, field): the last ``level`` set (by ts, seq), the sum of
    ``delta`` edits after it (all deltas when no level was set), the first
    edit and the last edit (with its user and explanation).

    One aggregation per (EIN, field) plus the delta sum, joined on the same
    key partitioning; no window, so a key with very many edits never lands
    in one task unaggregated.
    """
    k = ["EIN", "field"]
    per = adjustments.groupBy(*k).agg(
        F.max(F.when(F.col("action") == "level", F.struct("ts", "seq", "amount"))).alias("_lv"),
        F.min(F.struct("ts", "seq")).alias("_first"),
        F.max(F.struct("ts", "seq", "user", "explanation")).alias("_last"))
    d = adjustments.filter(F.col("action") == "delta").join(per.select(*k, "_lv"), k)
    after = F.col("_lv").isNull() | (F.struct("ts", "seq") > F.struct("_lv.ts", "_lv.seq"))
    # summed deltas are rounded past the last real money digit so the
    # result does not depend on the order partial sums were combined in
    deltas = d.filter(after).groupBy(*k).agg(F.round(F.sum("amount"), money_places).alias("_delta"))
    return (per.join(deltas, k, "left")
            .select(*k, F.col("_lv.amount").alias("level"),
                    F.coalesce(F.col("_delta"), F.lit(0.0)).alias("delta"),
                    F.col("_first.ts").alias("first_ts"), F.col("_first.seq").alias("first_seq"),
                    F.struct(F.col("_last.ts").alias("ts"), F.col("_last.seq").alias("seq"),
                             F.col("_last.user").alias("user"),
                             F.col("_last.explanation").alias("explanation")).alias("last")))


def apply_adjustments(rows: DataFrame, adjustments: DataFrame, fields: Sequence[str],
                      rule_forms: Sequence[str] | None = None,
                      kind_col: str | None = "SOURCE_KIND",
                      optional: Collection[str] = ()) -> DataFrame:
    """L1 + L2: new value = (last level, else current) + later deltas; the
    change is accumulated in ``<field lower-cased>_adjusted_by``; each changed field is
    appended once to MANUALLY_FIXED, in the order fields were first edited;
    residuals are recomputed."""
    net = net_adjustments(adjustments.filter(F.col("field").isin(list(fields))))
    # fixed field list -> conditional aggregation (pivot without a values pass)
    per_ein = net.groupBy("EIN").agg(
        *[F.max(F.when(F.col("field") == f, F.struct("level", "delta"))).alias(f"_a_{f}")
          for f in fields],
        # fields in first-edit order (bounded by the field list)
        F.transform(F.array_sort(F.collect_list(F.struct("first_ts", "first_seq", "field"))),
                    lambda x: x["field"]).alias("_changed"),
        # the last edit over all fields names the reviewer
        F.max("last").alias("_who"))
    j = rows.join(per_ein, "EIN", "left")
    new_vals, adj = {}, {}
    for f in fields:
        a = F.col(f"_a_{f}")
        new = F.when(a.isNull(), F.col(f)).otherwise(
            F.coalesce(a["level"], F.col(f)) + a["delta"])
        adj[f"{f.lower()}_adjusted_by"] = F.coalesce(new - F.col(f), F.lit(0.0))
        new_vals[f] = new
    prev = F.filter(F.split(F.coalesce(F.col(FIXED_COL), F.lit("")), " "), lambda x: x != "")
    fixed = F.array_join(F.array_distinct(F.concat(prev, F.coalesce(F.col("_changed"),
                                                                    F.array().cast("array<string>")))), " ")
    out = j.withColumns({**adj, "_FIXED_BEFORE": F.coalesce(F.col(FIXED_COL), F.lit("")),
                         "validated_by": F.coalesce(F.col("_who.user"), F.lit("")),
                         "EXPLANATION": F.coalesce(explanation_text(F.col("_who.explanation")),
                                                   F.lit("")),
                         FIXED_COL: fixed, "ADJUSTED": F.col("_changed").isNotNull()})
    out = out.withColumns(new_vals).drop(*[f"_a_{f}" for f in fields], "_who", "_changed")
    forms, kind = (rule_forms, kind_col) if rule_forms else rules_of_table(out)
    return add_residuals(out.drop(*residual_columns(out)), forms, kind, optional)


# --- L3 ---------------------------------------------------------------------------------
def review_state(df: DataFrame, action: str = "action", threshold: float = 1000.0,
                 changed: str = "ADJUSTED", fields: Sequence[str] = (),
                 rule_forms: Sequence[str] | None = None,
                 kind_col: str | None = "SOURCE_KIND",
                 optional: Collection[str] = ()) -> DataFrame:
    """L3: next VALIDATION_STATE per row from the reviewer's action.

    fix        -> 1 if something changed, else rejected
    fix_ignore -> 2 if something changed and residuals remain, else as fix
    check      -> 3 if nothing changed and no residual over threshold
    ignore     -> 2;  skip / reset -> 0 with the original values
    Rejected actions keep the old state and say why.  For skip / reset the
    round's edits of ``fields`` are undone (value minus its adjustment),
    the adjustment, reviewer and explanation are cleared, the fixed-field
    list is restored and the residuals are recomputed.
    """
    rcols = residual_columns(df)
    worst = F.greatest(*[F.abs(F.coalesce(F.col(c), F.lit(0.0))) for c in rcols]) \
        if len(rcols) > 1 else (F.abs(F.coalesce(F.col(rcols[0]), F.lit(0.0))) if rcols else F.lit(0.0))
    clean = worst <= threshold
    ch = F.coalesce(F.col(changed), F.lit(False))
    a = F.col(action)
    old = F.col(STATE_COL).cast("int")
    new = (F.when(a == "ignore", IGNORED)
            .when(a.isin("skip", "reset"), UNREVIEWED)
            .when(a == "fix_ignore", F.when(ch & ~clean, IGNORED).when(ch, FIXED))
            .when(a == "fix", F.when(ch, FIXED))
            .when(a == "check", F.when(~ch & clean, CHECKED)))
    why = (F.when(new.isNotNull(), F.lit(""))
            .when(a.isin("fix", "fix_ignore") & ~ch, "no change made")
            .when((a == "check") & ch, "changes made")
            .when(a == "check", "residual over threshold")
            .otherwise("unknown action"))
    out = df.withColumns({"NEW_STATE": F.coalesce(new, old), "ACCEPTED": new.isNotNull(),
                          "REJECT_REASON": why})
    undo = F.coalesce(a.isin("skip", "reset"), F.lit(False))
    rev = {}
    for f in fields:
        adj = f"{f.lower()}_adjusted_by"
        if adj in out.columns:
            rev[f] = F.when(undo, F.col(f) - F.col(adj)).otherwise(F.col(f))
            rev[adj] = F.when(undo, F.lit(0.0)).otherwise(F.col(adj))
    for c in ("validated_by", "EXPLANATION"):
        if c in out.columns:
            rev[c] = F.when(undo, F.lit("")).otherwise(F.col(c))
    if "_FIXED_BEFORE" in out.columns:
        rev[FIXED_COL] = F.when(undo, F.col("_FIXED_BEFORE")).otherwise(F.col(FIXED_COL))
    if changed in out.columns:
        rev[changed] = F.when(undo, F.lit(False)).otherwise(F.col(changed))
    out = out.withColumns(rev) if rev else out
    if fields and rcols:
        forms, kind = (rule_forms, kind_col) if rule_forms else rules_of_table(out)
        out = add_residuals(out.drop(*rcols), forms, kind, optional)
    return out


# --- L4/L5 helpers, L6, L8, L9, L11 ---------------------------------------------------
def shared_fields(form: str) -> set[str]:
    """Fields used by more than one active rule of a form (marked '*')."""
    from collections import Counter
    c = Counter(f for r in CATALOGUE if r.active and r.form == form for f in set(r.fields))
    return {f for f, n in c.items() if n > 1}


def _on_failing_rows(df: DataFrame, threshold: float, form: str | None) -> DataFrame:
    return df.withColumn(MASK, failing_mask(df, threshold, form)).filter(F.col(MASK) != 0)


def failure_text(df: DataFrame, threshold: float = 1000.0,
                 id_cols: Sequence[str] = ("EIN",)) -> DataFrame:
    """One line per failing (id, rule): ``$<residual> = TOTAL [v] -
    (PART [v] + PART* [v] ...)`` with values formatted like ``1,234`` and
    fields shared with other rules starred; an absent field shows 0.

    Every rule's text is an expression over its own row and only computed where
    the rule fails; nothing is joined or shuffled."""
    def token(f, starred):
        value = F.coalesce(amount(df.columns, f).cast("double"), F.lit(0.0))
        return F.concat(F.lit(f + ("*" if starred else "") + " ["), F.format_number(value, 0),
                        F.lit("]"))

    lines = []
    for r in active_in(df):
        shared = shared_fields(r.form)
        parts = []
        for i, (sign, f) in enumerate(r.parts):
            parts += [F.lit("" if i == 0 else " + " if sign > 0 else " - "), token(f, f in shared)]
        # the residual is truncated to whole units, field values are rounded
        text = F.concat(F.lit("$"), F.format_number(F.col(r.column).cast("bigint"), 0), F.lit(" = "),
                        token(r.total, r.total in shared), F.lit(" - ("), *parts, F.lit(")"))
        lines.append(F.when(fails(r), F.struct(F.lit(r.name.upper()).alias("rule"),
                                               text.alias("text"))))
    return _on_failing_rows(df, threshold, None).select(
        *id_cols, F.inline(F.filter(F.array(*lines), lambda x: x.isNotNull())))


def field_lines(df: DataFrame, form: str = "FULL", threshold: float = 1000.0,
                id_cols: Sequence[str] = ("EIN",)) -> DataFrame:
    """For every field of a failing rule its value, form line, display group
    and the rule's formula with its residual; from the row alone."""
    group = {f: g for g, fs in FIELD_GROUPS.items() for f in fs}
    out = []
    for r in active_in(df, form):
        text = F.concat(F.lit(f"{r.formula} = "),
                        F.round(F.col(r.column)).cast("bigint").cast("string"))
        fields = [F.struct(
            F.lit(r.name.upper()).alias("rule"), F.lit(f).alias("field"),
            (F.col(f) if f in df.columns else F.lit(None)).cast("double").alias("value"),
            F.lit(FULL_FORM_LINES.get(f)).cast("string").alias("form_line"),
            F.lit(group.get(f)).cast("string").alias("display_group"),
            text.alias("explanation")) for f in r.fields]
        out.append(F.when(fails(r), F.array(*fields)))
    return _on_failing_rows(df, threshold, form).select(
        *id_cols, F.inline(F.flatten(F.filter(F.array(*out), lambda x: x.isNotNull()))))


def explanation_text(code: Column) -> Column:
    """Known code -> text, anything else is free text."""
    e = None
    for k, v in EXPLANATIONS.items():
        e = F.when(code == k, v) if e is None else e.when(code == k, v)
    return e.otherwise(code)


def current_vs_prior(df: DataFrame, form: str) -> DataFrame:
    """Revenue / expenses / assets now and in the prior year."""
    if form.upper() == "PF":
        cur, pri = ("P1TOTREV", "P1TOTEXP", "P2TOTAST"), (None, None, None)
    else:
        cur, pri = ("TOTREV2", "EXPS", "ASS_EOY"), ("TOTREVP", "EXPSP", "ASS_BOY")
    cols = [F.col("EIN")]
    for name, c, p in zip(("revenue", "expenses", "assets"), cur, pri):
        cols.append(F.col(c).alias(f"{name}_now"))
        cols.append((F.col(p) if p and p in df.columns else F.lit(None).cast("double"))
                    .alias(f"{name}_prior"))
    return df.select(*cols)


# --- A12, D10, D11 -------------------------------------------------------------------
def ledger_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith("_adjusted_by")] + \
        [c for c in ("validated_by", "EXPLANATION") if c in df.columns]


def export_review(df: DataFrame, changes_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """A12 + C11: split one reviewed table into (fixes, ledger); optionally
    only rows a reviewer touched.  Persist ``df`` before writing both."""
    if changes_only:
        df = df.filter((F.col(STATE_COL).cast("int") > 0)
                       | F.coalesce(F.col("EXPLANATION") != "", F.lit(False)))
    led = ledger_columns(df)
    fixes = df.select(*[c for c in df.columns if c not in set(led) and not c.startswith("_")])
    ledger = df.select("EIN", *led)
    return fixes, ledger


def reconcile_saved(fixes: DataFrame, ledger: DataFrame) -> DataFrame:
    """Full outer join of saved fixes and ledger with side markers."""
    a = fixes.select("EIN").distinct().withColumn("in_fixes", F.lit(True))
    b = ledger.select("EIN").distinct().withColumn("in_ledger", F.lit(True))
    return a.join(b, "EIN", "full_outer").select(
        "EIN", F.coalesce("in_fixes", F.lit(False)).alias("in_fixes"),
        F.coalesce("in_ledger", F.lit(False)).alias("in_ledger"))


def restore_saved(rows: DataFrame, saved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Overwrite review rows by EIN with saved ones; report saved keys
    that no longer exist."""
    from .corrections import integrate_fixes
    restored = integrate_fixes(rows, saved.select(*[c for c in saved.columns if c in rows.columns]))
    gone = saved.select("EIN").join(rows.select("EIN"), "EIN", "left_anti")
    return restored, gone
