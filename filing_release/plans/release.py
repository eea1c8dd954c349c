"""Release build plans.

``prior_joined`` -> ``backfilled`` -> ``deduped`` -> ``validated`` build the
release over the benchmark tables (used by the registered queries and the
benchmark); ``build_release`` is the same chain over real extracts, lookups
and prior releases.  Order facts kept from the source tool: prior-year join
before backfill (backfilled rows keep their own prior fields), backfill
before de-dup (older rows compete, then the recency filter trims), de-dup
before the rules (one row per EIN), and the type fill right after the union
of forms.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import codes
from ..functions.amounts import fill_by_type, make_numeric
from ..functions.money import MONEY_BY_FORM
from ..operators import corrections as corr
from ..operators import enrich, filters, flags, rules, schema
from ..operators.dedup import deduplicate, pf_size_score, size_score, unit_random
from ..operators.history import backfill, prior_year_join
from ..operators.schema import REASON_COL
from ..sources import driver_tables as dt
from .materialize import stage, stage_once

KEY = ["RELEASE", "EIN"]


# --- benchmark-table stages ------------------------------------------------------------
def current_reviewed(spark: SparkSession, d: str, y: int = dt.RELEASE_YEAR) -> DataFrame:
    return dt.reviewed_states(dt.current(spark, d, y))


def prior_joined(spark: SparkSession, d: str, y: int = dt.RELEASE_YEAR) -> DataFrame:
    """D6 on the current rows (CO and PC in one pass, keyed by RELEASE+EIN)."""
    return prior_year_join(current_reviewed(spark, d, y), dt.prior_release(spark, d, y - 1), key=KEY)


def backfilled(spark: SparkSession, d: str, y: int = dt.RELEASE_YEAR, depth: int = 2) -> DataFrame:
    """D7 from releases Y-1 .. Y-depth."""
    priors = {y - k: dt.prior_release(spark, d, y - k) for k in range(1, depth + 1)}
    return backfill(prior_joined(spark, d, y), priors, F.col("RELEASE"), key=KEY)


def deduped(spark: SparkSession, d: str, y: int = dt.RELEASE_YEAR) -> DataFrame:
    """F1 with the fiscal-year shift; one row per (RELEASE, EIN)."""
    return deduplicate(backfilled(spark, d, y), y, score=size_score(),
                       tiebreak=F.col("FILING_ID"), key=KEY)


def validated(spark: SparkSession, d: str, y: int = dt.RELEASE_YEAR) -> DataFrame:
    """J: residuals of the EZ and Full rules, by source kind."""
    dd = deduped(spark, d, y)
    return rules.add_residuals(dd, ("EZ", "FULL"), optional=absent_amounts(dd))


def absent_amounts(df: DataFrame, forms: Sequence[str] = ("EZ", "FULL")) -> list[str]:
    """Rule fields that the benchmark's filings don't have; they count as 0."""
    return [f for f in rules.rule_fields(forms) if f not in df.columns]


def validated_staged(spark: SparkSession, d: str, y: int = dt.RELEASE_YEAR) -> DataFrame:
    """The validated release written once per session: the review outputs
    (flags, queue, adjustments, audit) all read this table."""
    return stage_once(lambda: validated(spark, d, y), spark, (d, y), "validated")


def table_failed(df: DataFrame, tolerance: float = flags.TOLERANCE) -> dict[str, bool]:
    """E10 per release table (one small aggregate, one row per table)."""
    live = F.col("VALIDATION_STATE").cast("int") != filters.IGNORED
    cond = flags.any_over(rules.residual_columns(df), tolerance) & live
    rows = df.groupBy("RELEASE").agg(F.max(cond.cast("int")).alias("f")).collect()
    return {r["RELEASE"]: bool(r["f"]) for r in rows}


def release_cuts(df: DataFrame, columns: Sequence[str] = flags.CO_PC_CURRENT,
                 q: float = flags.QUANTILE, table: str = "RELEASE") -> dict[str, dict]:
    """E1 per release table, all tables and columns in the same passes."""
    return flags.grouped_exact_quantiles(df, columns, q, group=table)


def flagged(df: DataFrame, cutoff: float = flags.REVENUE_CUTOFF, partial: bool = False,
            fixes_applied: Mapping[str, int] | None = None, materialize: bool = True) -> DataFrame:
    """K1-K4 on a validated table: rows with reason letters (one row per
    key already, so no grouping).  The table is materialised first: the
    table-level facts (failed tables, quantile cuts) and the flag pass
    then read it instead of re-running the pipeline."""
    if materialize:
        df = stage(df, "validated")
    failed = table_failed(df)
    fixes_applied = fixes_applied or {}
    emit_f = [t for t, f in failed.items() if f and (not partial or fixes_applied.get(t, 0) == 0)]
    cuts = release_cuts(df)
    large = F.lit(False)
    for t, c in cuts.items():
        large = large | ((F.col("RELEASE") == t) & flags.largest_flag(c))
    fl = {"F": flags.failing_flag(df) & F.col("RELEASE").isin(emit_f) if emit_f else F.lit(False),
          "L": large,
          "C": flags.changed_flag(cutoff=cutoff)}
    return flags.flag_rows(df, fl)


# --- the same pipeline over real inputs -------------------------------------------------
@dataclass
class ReleaseInputs:
    extracts: Mapping[str, DataFrame]                  # form (EZ/FULL/PF) -> raw extract
    classification: DataFrame | None = None
    place: DataFrame | None = None
    postcard: DataFrame | None = None
    registry: DataFrame | None = None                  # raw registry (A3)
    corrections: DataFrame | None = None
    priors: Mapping[str, Mapping[int, DataFrame]] = field(default_factory=dict)  # table -> year -> df
    fixes: Mapping[str, DataFrame] = field(default_factory=dict)
    drop_lists: Mapping[str, Sequence[str]] = field(default_factory=lambda: dict(config.DROP_LISTS))
    crosswalks: Mapping[str, Sequence[tuple[str, str]]] = field(
        default_factory=lambda: dict(config.CROSSWALKS))
    numeric_columns: Sequence[str] = field(default_factory=lambda: list(config.AMOUNT_COLUMNS))
    final_lists: Mapping[str, Sequence[str]] = field(default_factory=dict)
    unique_classification: bool = True
    # configured columns the extracts may lack; any other absent one stops the build
    optional_columns: Collection[str] = ()


@dataclass
class ReleaseOptions:
    year: int
    backfill_depth: int = 2
    tolerance: float = flags.TOLERANCE
    partial_validation: bool = False
    output_full: bool = True
    quantile: float = flags.QUANTILE
    change: float = flags.CHANGE
    cutoff: float = flags.REVENUE_CUTOFF


def _observe(df: DataFrame, audit: dict | None, name: str, *extra) -> DataFrame:
    """Row counts per step, gathered while the stage writes run (no
    extra pass)."""
    if audit is None:
        return df
    from pyspark.sql import Observation
    obs = Observation(name)
    audit[name] = obs
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra)


def prepare_form(df: DataFrame, form: str, inp: ReleaseInputs,
                 audit: dict | None = None, classification: DataFrame | None = None,
                 registry: DataFrame | None = None,
                 reports: list[tuple[str, str, list[str]]] | None = None) -> DataFrame:
    """Steps 2-7 of the build for one source form."""
    cw = inp.crosswalks.get(form, [])
    # B1: checked on the raw names, also where the crosswalk makes a TAXPER of one of them
    spelling = schema.check_one_tax_period(df.columns).upper()
    df, missing = schema.apply_crosswalk(df, cw)
    if reports is not None:
        reports.append((form, "not in extract", missing))
    if "TAXPER" not in df.columns:
        df = df.withColumnRenamed(spelling, "TAXPER")
    drop = filters.drop_list_names(inp.drop_lists.get(form, []), schema.crosswalk_map(cw))
    df = _observe(df, audit, f"{form}_read")
    df = filters.drop_empty_filers(df, drop, inp.optional_columns)
    if form == "PF":
        df = filters.drop_value(df, "SUBSECCD", "92")
    df = _observe(df, audit, f"{form}_after_drops")
    df = schema.add_review_columns(df)
    if classification is not None:          # prepared lookup (see build_release)
        df = enrich.left_enrich(df, classification, "EIN", on_collision="left")
    elif inp.classification is not None:
        df = enrich.enrich_classification(df, inp.classification, on_collision="left",
                                          unique=inp.unique_classification)
    if inp.place is not None and "FIPS" in df.columns:
        df = enrich.enrich_place(df, inp.place)
    # An extract column of the same name as a lookup column wins
    if inp.postcard is not None and form in ("EZ", "FULL"):
        df = enrich.enrich_postcard(df, inp.postcard, on_collision="left")
    if registry is not None or inp.registry is not None:
        shaped = registry if registry is not None else enrich.registry_shape(inp.registry)
        df = enrich.enrich_registry(df, shaped, form, on_collision="left")
    df = make_numeric(df, inp.numeric_columns)
    k1, k2 = codes.filing_keys()
    df = df.withColumn("FISYR", codes.fiscal_year())
    df = df.withColumns({"ACCPER": codes.accounting_period(), "NCCSKEY": k1, "NCCSKEY2": k2,
                         "RANDNUM": unit_random([c for c in ("EIN", "TAXPER", "SOURCE")
                                                 if c in df.columns]),
                         **(codes.classification_columns() if "NTEEFINAL" in df.columns else {})})
    df = MONEY_BY_FORM[form](df, inp.optional_columns)
    extra = {"FILENAME": codes.file_name(form)}
    if form in ("EZ", "FULL"):
        extra.update({"STYEAR": codes.start_year(), "SOIYR": codes.soi_year()})
        if "SUBSECCD" in df.columns:
            extra["SUBCD"] = F.col("SUBSECCD")
        if "EPOSTCARD" in df.columns:
            extra["EPOSTCARD"] = enrich.postcard_flag()
    df = df.withColumns(extra)
    if inp.corrections is not None:
        df = corr.apply_corrections(df, inp.corrections)
    return df


@dataclass
class ReleaseResult:
    tables: dict[str, DataFrame]
    flagged: dict[str, DataFrame]
    summary: DataFrame | None
    failed: bool            # any flagged row (F, L or C)
    publish: bool           # K6: nothing flagged, or a partial build with integrated fixes
    audit: dict = field(default_factory=dict)   # E8: step -> observed counts
    reports: list = field(default_factory=list)  # B4, B5: (table, kind, column names)

    def schema_report(self, spark: SparkSession) -> DataFrame:
        """One row per name: crosswalk targets an extract lacks, columns a final
        list drops, names on a final list that the table lacks."""
        return spark.createDataFrame(
            [(t, kind, name) for t, kind, names in self.reports for name in names],
            "table_name string, kind string, column_name string")

    def audit_counts(self) -> dict[str, dict]:
        return {k: o.get for k, o in self.audit.items()}


def build_release(spark: SparkSession, inp: ReleaseInputs, opt: ReleaseOptions,
                  validate: Mapping[str, bool] | None = None) -> ReleaseResult:
    """Entry 1 + 2 over real extracts: release tables CO, PC, PF (+ _full),
    their residuals, the flagged rows per table and the publication gate.

    ``validate`` is the per-table switch (J32); L/C extraction runs even
    for tables whose rule checks are switched off.  The result carries the
    flagged rows and the gate; the caller writes the review extract, then
    calls ``check_hard_stop`` (K5), and writes the release only when
    ``result.publish`` (K6).
    """
    from ..session import apply_defaults
    apply_defaults(spark)
    y = opt.year
    validate = dict(validate or {})
    # Lookups that must be unique per EIN are checked up front (one
    # partially aggregated pass each; at most five offending keys collected)
    if inp.postcard is not None:
        enrich.assert_unique(inp.postcard, "EIN", "postcard list")
    if inp.registry is not None:
        enrich.assert_unique(inp.registry, "EIN", "registry")
    for t, years in inp.priors.items():
        for yy, pdf in years.items():
            if 0 < y - yy <= max(opt.backfill_depth, 1):
                enrich.assert_unique(pdf, "EIN", f"prior release {t} {yy}")
    # the classification master (large, not unique by contract) is reduced
    # to one row per EIN once and staged: every form's join then reads a
    # plain scan, so AQE can still split a hot extract key in that join
    cls = None
    if inp.classification is not None:
        lk = enrich.classification_lookup(inp.classification)
        cls = stage(enrich.one_row_per_key(lk) if inp.unique_classification else lk,
                    "classification")
    # the shaped registry is written once and read by every form's join
    reg = stage(enrich.registry_shape(inp.registry), "registry") if inp.registry is not None else None
    audit: dict = {}
    reports: list[tuple[str, str, list[str]]] = []  # B4, B5: table, kind, column names
    forms = {f: prepare_form(df, f, inp, audit, cls, reg, reports)
             for f, df in inp.extracts.items()}
    out: dict[str, DataFrame] = {}
    if "EZ" in forms and "FULL" not in forms:
        raise ValueError("EZ without Full cannot form the CO or PC tables")
    if "PF" in forms:
        out["PF"] = forms["PF"]
    if "EZ" in forms:
        # K8: every extract and its lookup joins run once; CO and PC read the staged union
        both = stage(fill_by_type(schema.union_by_name([forms["EZ"], forms["FULL"]]))
                     .withColumn("_TABLE", filters.release_name()), "forms")
        for t in ("PC", "CO"):
            out[t] = both.filter(F.col("_TABLE") == t).drop("_TABLE")
        for t in ("CO", "PC"):
            if y - 1 in inp.priors.get(t, {}):
                out[t] = prior_year_join(out[t], inp.priors[t][y - 1])
                out[t] = _observe(out[t], audit, f"{t}_prior_joined",
                                  F.count_if(F.col("INPRIOR") == "1").alias("matched"))
    fixes_applied: dict[str, int] = {}
    for t in list(out):
        pri = {yy: df for yy, df in inp.priors.get(t, {}).items() if 0 < y - yy <= opt.backfill_depth}
        out[t] = backfill(out[t], pri, t)
        out[t] = _observe(out[t], audit, f"{t}_backfilled",
                          F.count_if(F.col("SOURCE").startswith("core")).alias("backfilled"))
        score = pf_size_score() if t == "PF" else size_score()
        out[t] = deduplicate(out[t], y, score=score, year_shift=(t != "PF"))
        out[t] = _observe(out[t], audit, f"{t}_deduplicated")
        if t in inp.fixes:
            fixes_applied[t] = corr.fix_count(inp.fixes[t]).first()[0]
            out[t] = corr.integrate_fixes(out[t], inp.fixes[t], inp.numeric_columns)
        out[t] = filters.with_source_kind(out[t])
        if validate.get(t, True):
            out[t] = rules.add_residuals(out[t], ("PF",), None, inp.optional_columns) \
                if t == "PF" else rules.add_residuals(out[t], ("EZ", "FULL"),
                                                      optional=inp.optional_columns)
        out[t] = stage(out[t], f"release_{t.lower()}")
    flagged_tables: dict[str, DataFrame] = {}
    summaries = []
    for t, df in out.items():
        rcols = rules.residual_columns(df)
        if rcols:
            summaries.append(rules.failure_summary(df, opt.tolerance).withColumn("table_name", F.lit(t)))
        failed = bool(rcols) and df.agg(F.max(
            (flags.failing_flag(df, opt.tolerance)).cast("int"))).first()[0] == 1
        emit_f = failed and (not opt.partial_validation or fixes_applied.get(t, 0) == 0)
        cur = flags.PF_CURRENT if t == "PF" else flags.CO_PC_CURRENT
        cuts = flags.exact_quantiles(df, [c for c in cur if c in df.columns], opt.quantile)
        fl = {"L": flags.largest_flag(cuts),
              "F": flags.failing_flag(df, opt.tolerance) if emit_f else F.lit(False)}
        if t != "PF" and all(c in df.columns for c in flags.CO_PC_PRIOR):
            fl["C"] = flags.changed_flag(change=opt.change, cutoff=opt.cutoff)
        # The reason letters stay on the release rows ('' when none)
        out[t] = df.withColumn(REASON_COL, flags.reason_letters(fl))
        flagged_tables[t] = out[t].filter(F.col(REASON_COL) != "")
    any_flag = any(f.limit(1).count() > 0 for f in flagged_tables.values())
    tables = dict(out)
    if opt.output_full:
        for t in ("CO", "PC"):
            if t in out:
                tables[f"{t}_full"] = out[t].filter(F.col("SOURCE_KIND") == "FULL")
    full_names = schema.crosswalk_map(inp.crosswalks.get("FULL", []))
    for t, cols in inp.final_lists.items():
        if t in tables:
            tables[t], dropped, missing = schema.final_projection(
                tables[t], cols, source_names=full_names if t.endswith("_full") else None)
            reports += [(t, "dropped", dropped), (t, "missing", missing)]
    summary = schema.union_by_name(summaries) if summaries else None
    # K5/K6: flagged rows stop a full build (fixes or not); a partial build
    # publishes when fixes were integrated
    publish = (not any_flag) or (opt.partial_validation and bool(inp.fixes))
    return ReleaseResult(tables, flagged_tables, summary, any_flag, publish, audit, reports)


class ReleaseHalted(RuntimeError):
    """K5: flagged rows remain and the build is not partial."""


def check_hard_stop(result: ReleaseResult, opt: ReleaseOptions) -> None:
    if result.failed and not opt.partial_validation:
        raise ReleaseHalted("validation flagged rows; review extract written, release not published")
