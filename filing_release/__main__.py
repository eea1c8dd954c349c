"""Command line for the yearly jobs (spark-submit ``-m filing_release``).

``build``  - read extracts and lookups, build and validate the release, commit
             the review extract, and publish the release when the gate is open.
``review`` - add one round of reviewers' edits and actions to the review log of
             a table, replay the log over the review extract, and commit fixes,
             ledger and the events without effect.

Everything written is a commit (``sources.sinks``): the next job reads the newest
one, and a job that is lost half-way leaves the earlier one in place.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from . import config
from .operators import corrections, review_log
from .operators import review as rv
from .plans import release as rel
from .plans.materialize import remove_stages, stage
from .session import apply_defaults, ensure_checkpoint_dir
from .sources import extracts, sinks
from .sources.scan import reject_counts

TABLES = ("CO", "PC", "PF")


def _prior_tables(spark, root: str | None, year: int, depth: int, tables,
                  without: bool) -> dict:
    """Prior releases published by earlier builds.  A release that the year
    before should have and hasn't stops the build: its prior fields would be
    empty, and INPRIOR 0, without a sign.  ``without`` is for the first year."""
    out: dict = {}
    if not root:
        return out
    years = sinks.published_years(spark, root)
    if year - 1 not in years and not without:
        raise sinks.NotPublished(f"{root}: no release of {year - 1}; --no-prior builds without it")
    for y in range(year - max(depth, 1), year):
        if y in years:
            done = sinks.published(spark, root, y)
            for t in tables:
                if t in done.tables:
                    out.setdefault(t, {})[y] = sinks.read_table(spark, done, t)
                elif y == year - 1 and not without:
                    raise sinks.NotPublished(f"{root}: the release of {y} has no table {t}")
    return out


def _fixes(spark, root: str | None, year: int) -> dict[str, DataFrame]:
    """The newest reviews of the year's tables."""
    out = {}
    for t in TABLES if root else ():
        if sinks.versions(spark, sinks.review_root(root, t), year):
            done = sinks.published(spark, sinks.review_root(root, t), year)
            out[t] = sinks.read_table(spark, done, "FIXES")
    return out


def build(args, spark) -> int:
    rejects: list[DataFrame] = []
    on_bad = "quarantine" if args.quarantine else "raise"
    ex = {}
    for form, path in (("EZ", args.ez), ("FULL", args.full), ("PF", args.pf)):
        if path:
            ex[form] = extracts.read_extract(spark, path, on_bad=on_bad, rejects=rejects)
    opt_lists = {}
    for spec in args.final_list or []:
        table, path = spec.split("=", 1)
        opt_lists[table] = config.read_names(path)
    lookup = {"fmt": args.lookup_format, "options": {"header": "true"}}
    tables = [t for t in TABLES if ("PF" if t == "PF" else "FULL") in ex]
    inp = rel.ReleaseInputs(
        extracts=ex,
        classification=extracts.read_table(spark, args.classification, **lookup)
        if args.classification else None,
        place=extracts.read_table(spark, args.place, **lookup) if args.place else None,
        postcard=extracts.read_postcard(spark, args.postcard, on_bad, rejects)
        if args.postcard else None,
        registry=extracts.read_registry(spark, args.registry, on_bad=on_bad, rejects=rejects)
        if args.registry else None,
        corrections=spark.read.schema(corrections.CORRECTIONS_SCHEMA).parquet(args.corrections)
        if args.corrections else None,
        priors=_prior_tables(spark, args.prior_root, args.year, args.backfill_depth, tables,
                             args.no_prior),
        fixes=_fixes(spark, args.fixes_root, args.year),
        numeric_columns=config.read_names(args.numeric_columns) if args.numeric_columns
        else list(config.AMOUNT_COLUMNS),
        optional_columns=config.read_names(args.optional_columns) if args.optional_columns else (),
        final_lists=opt_lists)
    if args.pf_crosswalk:
        inp.crosswalks = {**inp.crosswalks, "PF": config.read_pairs(args.pf_crosswalk)}
    if args.pf_drop_list:
        inp.drop_lists = {**inp.drop_lists, "PF": config.read_names(args.pf_drop_list, skip_header=True)}
    opt = rel.ReleaseOptions(year=args.year, backfill_depth=args.backfill_depth,
                             tolerance=args.tolerance, partial_validation=args.partial,
                             output_full=not args.no_full_tables)
    res = rel.build_release(spark, inp, opt,
                            validate={t.upper(): False for t in args.skip_validation or []})
    found = dict(res.flagged)
    found["SCHEMA_REPORT"] = res.schema_report(spark)
    if res.summary is not None:
        found["SUMMARY"] = res.summary
    if args.quarantine and rejects:
        bad = rejects[0]
        for more in rejects[1:]:
            bad = bad.unionByName(more)
        found["REJECTS"] = stage(bad, "rejects")
        print({"malformed": {r["file"]: (r["n_short"], r["n_long"])
                             for r in reject_counts(found["REJECTS"]).limit(100).collect()}})
    review = sinks.write_review_extract(spark, found, args.review_out, args.year)
    written = sinks.write_release(spark, res.tables, args.out, args.year, gate_open=res.publish)
    print({"published": written, "flagged": {t: review.tables[t]["rows"] for t in res.flagged},
           "audit": res.audit_counts()})
    if res.failed and not args.partial:
        return 2                       # K5: hard stop, review extract written
    return 0


def review(args, spark) -> int:
    table = args.table.upper()
    extract = sinks.published(spark, args.review_root, args.year)
    flagged = sinks.read_table(spark, extract, table)
    # any amount of the table can be edited unless a list is given
    amounts = [c for c, t in flagged.dtypes if t == "double" and not c.startswith("validate_")]
    fields = config.read_names(args.fields) if args.fields else amounts
    log_path = f"{args.log.rstrip('/')}/{table}/{args.year}"
    if args.adjustments or args.actions:
        edits = spark.read.schema(rv.ADJUSTMENTS_SCHEMA).parquet(args.adjustments) \
            if args.adjustments else None
        actions = spark.read.parquet(args.actions) if args.actions else None
        done = review_log.rounds_on_disk(spark, log_path)
        number = args.round or (done[-1] + 1 if done else 1)
        review_log.append(review_log.events_of(edits, actions, spark), log_path, number)
    optional = config.read_names(args.optional_columns) if args.optional_columns else ()
    got = review_log.replay(flagged, review_log.read(spark, log_path), fields,
                            threshold=args.threshold, optional=optional)
    rows = stage(got.rows, f"reviewed_{table.lower()}")
    fixes, ledger = rv.export_review(rows, changes_only=args.changes_only)
    out = sinks.write_review_outputs(spark, table, args.year, fixes.drop("ROUNDS"),
                                     ledger, got.unapplied, args.fixes_root)
    print({t: out.tables[t]["rows"] for t in out.names})
    return 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="filing_release")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--year", type=int, required=True)
    b.add_argument("--ez"), b.add_argument("--full"), b.add_argument("--pf")
    b.add_argument("--registry", nargs="*"), b.add_argument("--postcard")
    b.add_argument("--classification"), b.add_argument("--place")
    b.add_argument("--lookup-format", default="parquet")
    b.add_argument("--corrections"), b.add_argument("--prior-root"), b.add_argument("--fixes-root")
    b.add_argument("--numeric-columns"), b.add_argument("--pf-crosswalk"), b.add_argument("--pf-drop-list")
    b.add_argument("--final-list", action="append", help="TABLE=path, e.g. CO=co.txt")
    b.add_argument("--backfill-depth", type=int, default=2)
    b.add_argument("--tolerance", type=float, default=1000.0)
    b.add_argument("--partial", action="store_true")
    b.add_argument("--no-prior", action="store_true", help="the year before was never published")
    b.add_argument("--optional-columns", help="names of configured columns the extracts may lack")
    b.add_argument("--quarantine", action="store_true",
                   help="malformed rows go to the REJECTS table instead of stopping the build")
    b.add_argument("--skip-validation", action="append", help="table whose rule checks are off")
    b.add_argument("--no-full-tables", action="store_true")
    b.add_argument("--out", required=True), b.add_argument("--review-out", required=True)
    r = sub.add_parser("review")
    r.add_argument("--year", type=int, required=True), r.add_argument("--table", required=True)
    r.add_argument("--review-root", required=True), r.add_argument("--log", required=True)
    r.add_argument("--adjustments"), r.add_argument("--actions"), r.add_argument("--round", type=int)
    r.add_argument("--fields"), r.add_argument("--optional-columns")
    r.add_argument("--threshold", type=float, default=1000.0)
    r.add_argument("--changes-only", action="store_true")
    r.add_argument("--fixes-root", required=True)
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"filing_release_{args.cmd}").getOrCreate()
    apply_defaults(spark)
    ensure_checkpoint_dir(spark)
    try:
        return build(args, spark) if args.cmd == "build" else review(args, spark)
    finally:
        remove_stages(spark)


if __name__ == "__main__":
    sys.exit(main())
