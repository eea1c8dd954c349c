"""Operator unit tests on hand-written rows (edge cases of FIXTURES §2)."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from filing_release.functions import codes
from filing_release.functions.amounts import fill_by_type, parse_amount
from filing_release.operators import corrections as corr
from filing_release.operators import filters, flags, review, rules, schema
from filing_release.operators.absent import AbsentColumns
from filing_release.operators.dedup import deduplicate, size_score
from filing_release.operators.history import backfill, prior_year_join

# rule fields that the hand-written tables here lack
OTHER_AMOUNTS = [f for f in rules.rule_fields(("EZ", "FULL"))
                 if f not in ("ASS_EOY", "LIAB_EOY", "FUNDBAL")]


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_empty_filer(spark):
    df = spark.createDataFrame(
        [(1, "0", "N"), (2, None, "N"), (3, "", "0"), (4, "0.0", "0"), (5, "N", "0")],
        "id int, a string, b string")
    kept = sorted(r[0] for r in filters.drop_empty_filers(df, ["a", "b"]).collect())
    assert kept == [2, 3, 4]
    assert filters.drop_empty_filers(df, []).count() == 5


def test_amount_cast(spark):
    raw = ["12", " 12 ", "1e3", "abc", "", "1d", "0x1A", "NaN", "1,000", None, "inf", ".5", "-2."]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(parse_amount("v")).collect()]
    assert got == [12.0, 12.0, 1000.0, 0, 0, 0, 0, 0, 0, 0, 0, 0.5, -2.0]


CLASS = [None, "", "A", "T", "T20", "T30", "T70", "T90", "T99", "T60", "B11", "B12", "B82",
         "B40", "B50", "E20", "Y30", "Y40", "Z99", "A11", "A12", "B81", "B811"]


def test_class_codes(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(CLASS)], "i int, NTEEFINAL string")
    out = df.withColumns(codes.classification_columns(subseccd=F.lit(None).cast("string"),
                                                      fndncd=F.lit(None).cast("string")))
    got = {r["NTEEFINAL"]: r for r in out.collect()}
    assert got[None]["NTMAJ10"] == "UN" and got[None]["LEVEL3"] == "-" and got[None]["MAJGRPB"] is None
    assert got[""]["MAJGRPB"] == "" and got[""]["LEVEL3"] == "-" and got[""]["NTMAJ10"] == "UN"
    assert got["T"]["LEVEL3"] == "PB"
    assert [got[c]["LEVEL3"] for c in ["T20", "T30", "T70", "T90", "T99", "T60"]] == \
        ["ZC", "ZD", "ZE", "ZF", "ZF", "ZF"]
    assert got["B11"]["LEVEL3"] == "ZA" and got["B12"]["LEVEL3"] == "ZB"
    assert got["B82"]["LEVEL3"] == "ED" and got["A11"]["LEVEL3"] == "ZA"
    assert got["B40"]["MAJGRPB"] == "BH" and got["B50"]["NTMAJ12"] == "BH"
    assert got["E20"]["MAJGRPB"] == "EH" and got["E20"]["NTMAJ12"] == "EH"
    assert got["Y30"]["LEVEL3"] == "MR" and got["Y40"]["LEVEL3"] == "MO"
    assert got["Y40"]["LEVEL2"] == "M" and got["T20"]["LEVEL2"] == "S"
    assert got["Z99"]["NTMAJ10"] == "UN" and got["Z99"]["LEVEL3"] == "UN"
    assert got["Z99"]["NTMAJ5"] == "OT" and got["A11"]["NTMAJ5"] == "AR"


@pytest.mark.parametrize("s,f,want", [
    (None, None, "U"), ("0", "0", "U"), ("1", None, "O"), ("2", "9", "O"), ("4", "3", "O"),
    ("92", None, "O"), ("3", "2", "PF"), ("3", "4", "PF"), ("3", "15", "PC"), ("3", None, "PC"),
    (None, "15", "PC"), ("0", "17", "PC"), (None, "3", "PF"), ("0", "9", "U"), (None, "0", "U"),
])
def test_level1(spark, s, f, want):
    df = spark.createDataFrame([(s, f)], "SUBSECCD string, FNDNCD string")
    assert df.select(codes.level1()).first()[0] == want


def test_level2_supporting(spark):
    df = spark.createDataFrame([("3", "4", "A11"), ("3", "17", "B20"), ("3", "15", "B20")],
                               "SUBSECCD string, FNDNCD string, NTEEFINAL string")
    assert [r[0] for r in df.select(codes.level2()).collect()] == ["S", "S", "O"]


def test_tax_period(spark):
    df = spark.createDataFrame([("201501",), ("201506",), ("201511",), ("201512",)], "TAXPER string")
    got = rows(df, codes.fiscal_year(), codes.accounting_period(), codes.start_year(),
               codes.soi_year())
    assert got == [(2015, "01", 2015, "2015"), (2015, "06", 2014, "2014"),
                   (2015, "11", 2014, "2014"), (2015, "12", 2015, "2015")]


def test_prior_year(spark):
    cur = spark.createDataFrame([("a", 2015), ("b", 2015), ("c", None), ("d", 2015)],
                                "EIN string, FISYR int")
    pri = spark.createDataFrame([("a", 2014, 10.0), ("b", 2013, 20.0), ("c", 2014, 30.0)],
                                "EIN string, FISYR int, TOTREV double")
    out = {r["EIN"]: r for r in prior_year_join(cur, pri).collect()}
    assert out["a"]["FISYRP"] == 2014 and out["a"]["TOTREVP"] == 10.0 and out["a"]["INPRIOR"] == "1"
    assert out["b"]["FISYRP"] is None and out["b"]["TOTREVP"] is None and out["b"]["INPRIOR"] == "0"
    assert out["c"]["INPRIOR"] == "0" and out["d"]["INPRIOR"] == "0"


def test_backfill(spark):
    cur = spark.createDataFrame([("x", 2015, "cur")], "EIN string, FISYR int, SOURCE string")
    y1 = spark.createDataFrame([("a", 2014, "s"), ("c", 2014, "s"), ("d", 2014, "s"),
                                ("d", 2014, "t"), ("x", 2014, "s")], "EIN string, FISYR int, SOURCE string")
    y2 = spark.createDataFrame([("b", 2013, "s"), ("c", 2013, "s")], "EIN string, FISYR int, SOURCE string")
    out = sorted(rows(backfill(cur, {2014: y1, 2013: y2}, "co"), "EIN", "SOURCE"))
    assert out == [("a", "core2014co"), ("b", "core2013co"), ("c", "core2014co"),
                   ("d", "core2014co"), ("d", "core2014co"), ("x", "cur")]


def _dedup_input(spark):
    data = [
        # EIN, FISYR, FISYRP, TAXPER, TOTREV, ASS_EOY, EXPS, id
        ("old", 2010, None, "201012", 1.0, 1.0, 1.0, 1),             # dropped by recency
        ("tie", 2015, None, "201512", 5.0, 0.0, 0.0, 2),
        ("tie", 2015, None, "201506", 5.0, 0.0, 0.0, 3),            # same size, older start year
        ("tie2", 2015, None, "201512", 5.0, 0.0, 0.0, 4),
        ("tie2", 2015, None, "201512", 5.0, 0.0, 0.0, 5),           # full tie -> tie-break
        ("shift", 2015, 2014, "201512", 1.0, 0.0, 0.0, 6),
        ("shift", 2016, None, "201612", 9.0, 0.0, 0.0, 7),          # Y wins over Y+1
        ("twoY", 2015, 2014, "201512", 1.0, 0.0, 0.0, 8),
        ("twoY", 2015, 2014, "201512", 2.0, 0.0, 0.0, 9),           # one survives
        ("single", 2014, None, "201412", 1.0, 0.0, 0.0, 10),
    ]
    return spark.createDataFrame(data, "EIN string, FISYR int, FISYRP int, TAXPER string, "
                                       "TOTREV double, ASS_EOY double, EXPS double, id int")


def test_dedup_cases(spark):
    out = dict(rows(deduplicate(_dedup_input(spark), 2015, tiebreak=F.col("id")), "EIN", "id"))
    assert out == {"tie": 2, "tie2": 5, "shift": 6, "twoY": 9, "single": 10}


def test_dedup_partition_independent(spark):
    df = _dedup_input(spark)
    base = sorted(rows(deduplicate(df, 2015, tiebreak=F.col("id")), "EIN", "id"))
    for n in (1, 3, 7):
        shuffled = df.repartition(n, F.rand(seed=n))
        assert sorted(rows(deduplicate(shuffled, 2015, tiebreak=F.col("id")), "EIN", "id")) == base


@pytest.mark.parametrize("c,p,rev,revp,want", [
    (0.0, 0.0, 2e7, 0.0, False), (5.0, 0.0, 2e7, 0.0, True), (5.0, None, 2e7, 0.0, False),
    (5.0, -10.0, 2e7, 0.0, False), (150.0, 100.0, 2e7, 0.0, True), (149.0, 100.0, 2e7, 0.0, False),
    (150.0, 100.0, 9_999_999.0, 0.0, False), (150.0, 100.0, 10_000_000.0, 0.0, True),
])
def test_changed(spark, c, p, rev, revp, want):
    # revenue unchanged (prior = current) so only the expense pair can move
    df = spark.createDataFrame([(rev, rev if revp is not None else None, c, p, 0.0, 0.0, 0)],
                               "TOTREV2 double, TOTREVP double, EXPS double, EXPSP double, "
                               "ASS_EOY double, ASS_BOY double, VALIDATION_STATE int")
    assert df.select(flags.changed_flag()).first()[0] is want


@pytest.mark.parametrize("state,want_l,want_f", [(0, True, True), (1, True, True),
                                                   (2, False, False), (3, False, True)])
def test_review_states(spark, state, want_l, want_f):
    df = spark.createDataFrame([(100.0, 5000.0, state)],
                               "TOTREV2 double, validate_x double, VALIDATION_STATE int")
    r = df.select(flags.largest_flag({"TOTREV2": 50.0}), flags.failing_flag(df)).first()
    assert (r[0], r[1]) == (want_l, want_f)


def test_reason_letters(spark):
    df = spark.createDataFrame([(True, True, True), (False, True, False), (True, False, True),
                                (False, False, False)], "c boolean, f boolean, l boolean")
    out = flags.flag_rows(df, {"L": F.col("l"), "F": F.col("f"), "C": F.col("c")})
    assert sorted(r["VALIDATION_REASON"] for r in out.collect()) == ["CFL", "CL", "F"]


def test_fixes(spark):
    rel = spark.createDataFrame([("a", 1.0, "x", 0), ("b", 2.0, "y", 0)],
                                "EIN string, FUNDBAL double, NTEEFINAL string, VALIDATION_STATE int")
    fixes = spark.createDataFrame([("a", "10", "1", 5.0), ("zz", "3", "1", 1.0)],
                                  "EIN string, FUNDBAL string, VALIDATION_STATE string, validate_q double")
    once = corr.integrate_fixes(rel, fixes, ["FUNDBAL"])
    twice = corr.integrate_fixes(once, fixes, ["FUNDBAL"])
    got = sorted(rows(once, "EIN", "FUNDBAL", "NTEEFINAL", "VALIDATION_STATE"))
    assert got == [("a", 10.0, None, 1), ("b", 2.0, "y", 0)]
    assert sorted(rows(twice, *once.columns)) == sorted(rows(once, *once.columns))


def test_corrections(spark):
    df = spark.createDataFrame([("1", "ez.dat", "A"), ("1", "full.dat", "A"), ("2", "ez.dat", "B"),
                                ("3", "x", "C")], "EIN string, SOURCE string, NAME string")
    c = spark.createDataFrame([("1", "drop", "ez.dat", None, None), ("2", "rekey", None, "B", "9"),
                               ("3", "rekey", None, "other", "8")], corr.CORRECTIONS_SCHEMA)
    assert sorted(rows(corr.apply_corrections(df, c), "EIN", "SOURCE")) == \
        [("1", "full.dat"), ("3", "x"), ("9", "ez.dat")]


def test_two_rekeys_never_double_a_filing(spark):
    df = spark.createDataFrame([("1", "ez.dat", "A"), ("2", "ez.dat", "B")],
                               "EIN string, SOURCE string, NAME string")
    same = spark.createDataFrame([("1", "rekey", None, "A", "9"), ("1", "rekey", "ez.dat", None, "9"),
                                  ("1", "rekey", None, "other", "8")], corr.CORRECTIONS_SCHEMA)
    assert sorted(rows(corr.rekey_recorded(df, same), "EIN", "NAME")) == [("2", "B"), ("9", "A")]
    two = spark.createDataFrame([("1", "rekey", None, "A", "9"), ("1", "rekey", "ez.dat", None, "8")],
                                corr.CORRECTIONS_SCHEMA)
    with pytest.raises(Exception, match="several new EINs for EIN 1"):
        corr.rekey_recorded(df, two).collect()


def test_absent_configured_columns_raise(spark):
    from filing_release.functions import money
    df = spark.createDataFrame([("0", 1.0)], "A string, EXPS double")
    with pytest.raises(AbsentColumns, match="empty-filer test: no column C"):
        filters.drop_empty_filers(df, ["A", "C"])
    assert filters.drop_empty_filers(df, ["A", "C"], optional=["C"]).count() == 0
    for form, fn in money.MONEY_BY_FORM.items():
        with pytest.raises(AbsentColumns, match="money columns: no column"):
            fn(df)
        assert fn(df, optional=money.INPUTS[form]).count() == 1


def test_failing_rules_stay_on_the_row(spark):
    df = spark.createDataFrame(
        [("a", "EZ", 5000.0, 0.0, 0.0), ("b", "FULL", 0.0, 0.0, -2500.5), ("c", "EZ", 1.0, 1.0, 0.0)],
        "EIN string, SOURCE_KIND string, ASS_EOY double, LIAB_EOY double, FUNDBAL double")
    df = rules.add_residuals(df, optional=OTHER_AMOUNTS)
    text = review.failure_text(df)
    assert sorted(rows(text, "EIN", "rule", "text")) == [
        ("a", "EZ_ASS_EOY", "$5,000 = ASS_EOY [5,000] - (LIAB_EOY [0] + FUNDBAL [0])"),
        ("b", "FU_FUNDBAL", "$-2,500 = FUNDBAL [-2,500] - (ASS_EOY [0] - LIAB_EOY [0])")]
    lines = review.field_lines(df)
    assert sorted(rows(lines, "field", "value", "display_group")) == [
        ("ASS_EOY", 0.0, "assets"), ("FUNDBAL", -2500.5, "assets"), ("LIAB_EOY", 0.0, "assets")]
    related = rules.related_rules(df)
    for out in (text, lines, related):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert len(rules.BITS) <= 62 and len(set(rules.BITS.values())) == len(rules.BITS)


def test_crosswalk_last_wins(spark):
    from filing_release import config
    df = spark.createDataFrame([("1", "201512", 5.0)], "ein string, Tax_Prd string, grsincmembers double")
    out, missing = schema.apply_crosswalk(df, config.CROSSWALK_FULL)
    assert out.columns == ["EIN", "TAXPER", "GRRECMEM"]
    assert "GRRECPUB" not in out.columns and "CONT" in missing


def test_final_projection_dedups_list(spark):
    df = spark.createDataFrame([(1, 2, 0, "")], "A int, B int, VALIDATION_STATE int, MANUALLY_FIXED string")
    out, dropped, missing = schema.final_projection(df, ["A", "C", "A"])
    assert out.columns == ["A", "VALIDATION_STATE", "MANUALLY_FIXED"]
    assert dropped == ["B"] and missing == ["C"]


def test_fill_by_type(spark):
    df = spark.createDataFrame([(None, None, 1)], "a double, b string, c int")
    assert fill_by_type(df).first() == (0.0, "", 1)


def test_residuals_and_summary(spark):
    df = spark.createDataFrame(
        [("EZ", 100.0, 40.0, 50.0, 0), ("EZ", 100.0, 40.0, 60.0, 2), ("FULL", 100.0, 40.0, 50.0, 0)],
        "SOURCE_KIND string, ASS_EOY double, LIAB_EOY double, FUNDBAL double, VALIDATION_STATE int")
    with pytest.raises(AbsentColumns, match="rules: no column CONT"):
        rules.add_residuals(df, ("EZ", "FULL"))
    out = rules.add_residuals(df, ("EZ", "FULL"), optional=OTHER_AMOUNTS)
    r = [x for x in out.select("validate_ez_ass_eoy", "validate_fu_fundbal").collect()]
    assert r[0] == (10.0, None) and r[2] == (None, -10.0)
    summ = rules.failure_summary(out, tolerance=5.0)
    got = {x["rule"]: (x["n_failed"], x["n_rows"], x["fail_pct"]) for x in summ.collect()}
    assert got["EZ_ASS_EOY"] == (1, 2, 50.0) and got["FU_FUNDBAL"] == (1, 2, 50.0)


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(7)
    vals = [rnd.choice([rnd.gauss(0, 1e6), rnd.randint(0, 50) * 1.0, None]) for _ in range(20000)]
    groups = [rnd.choice(["CO", "PC"]) for _ in vals]
    df = spark.createDataFrame(list(zip(groups, vals)), "g string, v double")
    for max_read in (100_000, 50):        # direct read and the histogram path
        got = flags.grouped_exact_quantiles(df, ["v"], 0.999, group="g", max_read=max_read)
        for g in ("CO", "PC"):
            xs = np.array([v for v, gg in zip(vals, groups) if gg == g and v is not None])
            assert got[g]["v"] == pytest.approx(np.quantile(xs, 0.999), rel=1e-12)


def test_exact_quantiles_of_repeated_values(spark):
    """The ranks lie on two values that both repeat more often than a read allows,
    with close neighbours that no equal-width step can part."""
    heavy = [0.0] * 300 + [1e-9] * 300 + [1e9] * 300 + [1e9 + 1] * 300
    tiny = [5e-324] * 400 + [1e-323] * 400
    for vals in (heavy, tiny, [7.0] * 500, [0.0] * 300 + [1.0] * 300):
        df = spark.createDataFrame([(v,) for v in vals], "v double")
        for q in (0.0, 0.25, 0.4, 0.5, 0.75, 0.999, 1.0):
            got = flags.exact_quantiles(df, ["v"], q, max_read=50)["v"]
            pos = (len(vals) - 1) * q
            lo, hi = vals[math.floor(pos)], vals[math.ceil(pos)]
            assert got == pytest.approx(lo + (hi - lo) * (pos - math.floor(pos)), rel=1e-12, abs=0)


def test_quantile_of_nan_is_an_error(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "v double")
    with pytest.raises(ValueError, match="NaN"):
        flags.exact_quantiles(df, ["v"], 0.999)


def test_adjustments_level_then_delta(spark):
    from datetime import datetime as dt
    rows_ = spark.createDataFrame([("a", "EZ", 100.0, 50.0, 40.0, "")],
                                  "EIN string, SOURCE_KIND string, ASS_EOY double, LIAB_EOY double, "
                                  "FUNDBAL double, MANUALLY_FIXED string")
    adj = spark.createDataFrame([
        ("a", "FUNDBAL", "delta", 1.0, "u1", "1", dt(2020, 1, 1), 1),
        ("a", "FUNDBAL", "level", 45.0, "u1", "1", dt(2020, 1, 2), 2),
        ("a", "FUNDBAL", "delta", 5.0, "u2", "5", dt(2020, 1, 3), 3),
    ], review.ADJUSTMENTS_SCHEMA)
    out = review.apply_adjustments(rows_, adj, ["FUNDBAL"], optional=OTHER_AMOUNTS).first()
    assert out["FUNDBAL"] == 50.0 and out["fundbal_adjusted_by"] == 10.0
    assert out["MANUALLY_FIXED"] == "FUNDBAL" and out["validated_by"] == "u2"
    assert out["EXPLANATION"] == review.EXPLANATIONS["5"] and out["validate_ez_ass_eoy"] == 0.0


def test_no_python_udfs_in_plans(spark):
    from filing_release.plans.queries import QUERIES
    for name in ("dedup_best", "residuals_wide", "classify_level3", "enrich_left_join"):
        plan = QUERIES[name][0](spark, "/root/testdata/sf0.001")._jdf.queryExecution() \
            .executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        assert "CartesianProduct" not in plan, name


def test_classification_unique_option(spark):
    from filing_release.operators import enrich
    f = spark.createDataFrame([("1", 10.0), ("2", 20.0)], "EIN string, TOTREV2 double")
    m = spark.createDataFrame([("0-1", "A11"), ("01", "B20"), ("2", "C30")], "EIN string, NteeFinal string")
    m = m.withColumn("EIN", F.regexp_replace("EIN", "^0-?", ""))
    fan = enrich.enrich_classification(f, m)
    one = enrich.enrich_classification(f, m, unique=True)
    assert fan.count() == 3 and one.count() == 2
    assert dict(rows(one, "EIN", "NTEEFINAL")) == {"1": "B20", "2": "C30"}


def test_pushdown_and_pruning(spark):
    from filing_release.plans.queries import QUERIES
    df = QUERIES["dedup_best"][0](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "o_orderpriority" not in plan and "c_name" not in plan


def test_unique_guards_never_fan_out(spark):
    from filing_release.operators import enrich
    cur = spark.createDataFrame([("a", 2015), ("b", 2015)], "EIN string, FISYR int")
    pri = spark.createDataFrame([("a", 2014, 1.0), ("a", 2014, 2.0)], "EIN string, FISYR int, TOTREV double")
    out = prior_year_join(cur, pri, unique_prior=True)
    assert out.count() == 2 and out.filter("EIN = 'a'").first()["TOTREVP"] == 2.0
    pc = spark.createDataFrame([("a", "2015"), ("a", "2014")], "EIN string, EPOSTCARD string")
    assert enrich.enrich_postcard(cur, pc, unique=True).count() == 2
    assert enrich.enrich_postcard(cur, pc).count() == 3
    import pytest as _pytest
    with _pytest.raises(AssertionError):
        enrich.assert_unique(pc, "EIN", "postcard")


def test_skip_restores_original_row(spark):
    from datetime import datetime as dt
    rows_ = spark.createDataFrame([("a", "EZ", 100.0, 50.0, 40.0, "CONT", 0),
                                   ("b", "EZ", 100.0, 50.0, 40.0, "", 0)],
                                  "EIN string, SOURCE_KIND string, ASS_EOY double, LIAB_EOY double, "
                                  "FUNDBAL double, MANUALLY_FIXED string, VALIDATION_STATE int")
    adj = spark.createDataFrame([(e, "FUNDBAL", "delta", 10.0, "u1", "2", dt(2020, 1, 1), 1)
                                 for e in ("a", "b")], review.ADJUSTMENTS_SCHEMA)
    done = review.apply_adjustments(rows_, adj, ["FUNDBAL"], optional=OTHER_AMOUNTS)
    acts = spark.createDataFrame([("a", "skip"), ("b", "fix")], "EIN string, action string")
    out = {r["EIN"]: r for r in review.review_state(
        done.join(acts, "EIN"), fields=["FUNDBAL"], optional=OTHER_AMOUNTS).collect()}
    a, b = out["a"], out["b"]
    assert (a["FUNDBAL"], a["fundbal_adjusted_by"], a["EXPLANATION"], a["validated_by"]) == (40.0, 0.0, "", "")
    assert a["MANUALLY_FIXED"] == "CONT" and a["NEW_STATE"] == 0 and a["validate_ez_ass_eoy"] == 10.0
    assert (b["FUNDBAL"], b["NEW_STATE"], b["MANUALLY_FIXED"]) == (50.0, 1, "FUNDBAL")
    assert b["validate_ez_ass_eoy"] == 0.0


def test_dedup_literal_year_shift(spark):
    df = spark.createDataFrame([
        ("both", 2015, 2014, "201512", 1.0, 1), ("both", 2015, 2014, "201512", 2.0, 2),   # M1: vanishes
        ("ok", 2015, 2014, "201512", 1.0, 3), ("ok", 2016, None, "201612", 9.0, 4),       # shift to Y
        ("one", 2016, None, "201612", 1.0, 5)],
        "EIN string, FISYR int, FISYRP int, TAXPER string, TOTREV double, id int") \
        .withColumns({"ASS_EOY": F.lit(0.0), "EXPS": F.lit(0.0)})
    lit_ = dict(rows(deduplicate(df, 2015, tiebreak=F.col("id"), literal=True), "EIN", "id"))
    assert lit_ == {"ok": 3, "one": 5}
    intended = dict(rows(deduplicate(df, 2015, tiebreak=F.col("id")), "EIN", "id"))
    assert intended == {"both": 2, "ok": 3, "one": 5}


def test_collision_policy(spark):
    from filing_release.operators import enrich
    df = spark.createDataFrame([("1", "X")], "EIN string, ZIP string")
    reg = spark.createDataFrame([("1", "Y")], "EIN string, ZIP string")
    with pytest.raises(ValueError):
        enrich.left_enrich(df, reg, "EIN")
    assert enrich.left_enrich(df, reg, "EIN", on_collision="left").first()["ZIP"] == "X"
