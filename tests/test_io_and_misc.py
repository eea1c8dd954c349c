"""Readers, small schema operators, literal modes and review helpers."""

import os
import tempfile

from pyspark.sql import functions as F

from filing_release.functions import codes
from filing_release.functions.money import pf_balance_due
from filing_release.operators import enrich, flags, review, rules, schema
from filing_release.operators.dedup import unit_random
from filing_release.sources import extracts


def _write(text: str, name: str) -> str:
    d = tempfile.mkdtemp(prefix="io-", dir="/tmp")
    p = os.path.join(d, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_read_extract_and_nulls(spark):
    p = _write("ein tax_pd totrevnue\n000000001 201512 12\n000000002 NA abc\n", "16extractez.dat")
    df = extracts.read_extract(spark, p)
    assert df.columns == ["EIN", "TAX_PD", "TOTREVNUE", "SOURCE"]
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("000000001", "201512", "12", "16extractez.dat"),
                   ("000000002", None, "abc", "16extractez.dat")]


def test_read_postcard(spark):
    p = _write("000000001|2015|x\n000000002||y\n000000003|2014|z\n", "postcard.txt")
    got = sorted(tuple(r) for r in extracts.read_postcard(spark, p).collect())
    # the empty year is read as null by the CSV reader and kept (only '' is dropped)
    assert ("000000001", "2015") in got and ("000000003", "2014") in got
    df = spark.createDataFrame([("1", ""), ("2", None), ("3", "2015")], "EIN string, EPOSTCARD string")
    assert sorted(r[0] for r in extracts.postcard_clean(df).collect()) == ["2", "3"]


def test_read_registry_and_shape(spark):
    hdr = "EIN,ORGANIZATION,ZIP,ACTIVITY,AFFILIATION,DEDUCTIBILITY,ICO,SORT_NAME,FILING_REQ_CD," \
          "PF_FILING_REQ_CD,ASSET_CD,INCOME_CD,STATUS\n"
    a = _write(hdr + "1,1,12345,123456789,3,1,%% JANE DOE,X,1,0,2,3,1\n", "r1.csv")
    b = _write(hdr + "2,1,54321,987654321,3,1,% JOHN,Y,0,1,2,3,1\n", "r2.csv")
    shaped = enrich.registry_shape(extracts.read_registry(spark, [a, b]))
    got = {r["EIN"]: r for r in shaped.collect()}
    assert got["1"]["CONTACT"] == "JANE DOE" and got["1"]["FRCD"] == "10"
    assert (got["2"]["ACTIV1"], got["2"]["ACTIV2"], got["2"]["ACTIV3"]) == ("987", "654", "321")


def test_read_table_and_conform(spark):
    d = tempfile.mkdtemp(prefix="tbl-", dir="/tmp")
    spark.createDataFrame([("1", "12", "x")], "ein string, totrev string, note string") \
        .write.mode("overwrite").parquet(d)
    t = extracts.read_table(spark, d, columns=["EIN", "TOTREV"])
    assert t.columns == ["EIN", "TOTREV"]
    target = spark.createDataFrame([("a", 1.0)], "EIN string, TOTREV double")
    c = extracts.conform_types(t, target)
    assert dict(c.dtypes) == {"EIN": "string", "TOTREV": "double"} and c.first()["TOTREV"] == 12.0
    assert extracts.read_optional(spark, d + "_missing") is None
    assert extracts.read_optional(spark, d, fmt="parquet").count() == 1


def test_review_columns_and_temp_drop(spark):
    df = spark.createDataFrame([(1, 2.0, 0.5)], "id int, val double, P1_max double")
    out = schema.drop_temp(schema.add_review_columns(df))
    assert out.columns == ["id", "VALIDATION_STATE", "MANUALLY_FIXED"]
    again = schema.add_review_columns(out.withColumn("VALIDATION_STATE", F.lit(3)))
    assert again.first()["VALIDATION_STATE"] == 3


def test_literal_modes(spark):
    df = spark.createDataFrame([("201506", 2015, "2015"), ("201511", 2015, "2015")],
                               "TAXPER string, FISYR int, EPOSTCARD string")
    got = [tuple(r) for r in df.select(codes.start_year(literal=True), codes.soi_year(literal=True),
                                       enrich.postcard_flag(literal=True),
                                       enrich.postcard_flag()).collect()]
    assert got == [(20149, "20149.0", "0", "1"), (20151, "20151", "0", "1")]


def test_unit_random_and_balance(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "2")], "EIN string, TAXPER string")
    r1 = [x[0] for x in df.select(unit_random(["EIN", "TAXPER"])).collect()]
    r2 = [x[0] for x in df.repartition(3).orderBy("EIN").select(unit_random(["EIN", "TAXPER"])).collect()]
    assert r1 == r2 and all(0 <= x < 1 for x in r1)
    pf = spark.createDataFrame([(10.0, 5.0, None), (1.0, 5.0, None), (1.0, 5.0, 7.0)],
                               "OVERPAY double, TAXDUE double, BALDUOPT double")
    assert [r[0] for r in pf_balance_due(pf).select("BALDUOPT").collect()] == [10.0, -5.0, 7.0]


def test_grouped_flags_and_touched(spark):
    df = spark.createDataFrame([("a", 1, True, False), ("a", 2, False, True), ("b", 3, False, False)],
                               "EIN string, id int, l boolean, c boolean")
    out = flags.flag_rows_grouped(df, {"L": F.col("l"), "C": F.col("c")}, order=["id"])
    assert [(r["EIN"], r["id"], r["VALIDATION_REASON"]) for r in out.collect()] == [("a", 1, "CL")]
    t = spark.createDataFrame([(0, ""), (1, ""), (0, "note"), (0, None)],
                              "VALIDATION_STATE int, EXPLANATION string")
    from filing_release.operators.filters import touched_rows
    assert [r[0] for r in t.select(touched_rows()).collect()] == [False, True, True, False]


def test_restore_and_reconcile(spark):
    rows = spark.createDataFrame([("a", 1.0, 0), ("b", 2.0, 0)],
                                 "EIN string, FUNDBAL double, VALIDATION_STATE int")
    saved = spark.createDataFrame([("a", 5.0, 1), ("gone", 1.0, 1)],
                                  "EIN string, FUNDBAL double, VALIDATION_STATE int")
    restored, gone = review.restore_saved(rows, saved)
    assert sorted(tuple(r) for r in restored.collect()) == [("a", 5.0, 1), ("b", 2.0, 0)]
    assert [r[0] for r in gone.collect()] == ["gone"]
    led = spark.createDataFrame([("a",), ("c",)], "EIN string")
    rec = sorted(tuple(r) for r in review.reconcile_saved(saved, led).collect())
    assert rec == [("a", True, True), ("c", False, True), ("gone", True, False)]


def test_cross_reference_and_header(spark):
    xref = {(r["form"], r["field"]): r["rules"]
            for r in rules.cross_reference(rules.catalogue_frame(spark)).collect()}
    assert xref[("EZ", "GRPROF")] == ["EZ_GRPROF", "EZ_TOTREV"]
    assert ("FULL", "SALEOTHN") not in xref or "FU_NETGNLS" in xref[("FULL", "SALEOTHN")]
    df = spark.createDataFrame([("a", 1.0, 2.0, 3.0, 0.5, None, 1.5)],
                               "EIN string, TOTREV2 double, EXPS double, ASS_EOY double, "
                               "TOTREVP double, EXPSP double, ASS_BOY double")
    h = review.current_vs_prior(df, "CO").first()
    assert (h["revenue_now"], h["revenue_prior"], h["assets_prior"]) == (1.0, 0.5, 1.5)
    q = spark.createDataFrame([(0,), (0,), (1,)], "VALIDATION_STATE int")
    assert sorted(tuple(r) for r in review.queue_progress(q).collect()) == [(0, 2), (1, 1)]


def test_duplicated_rows_and_review_extract(spark):
    from filing_release.operators.dedup import duplicated_rows
    from filing_release.sources.sinks import published, read_table, write_review_extract
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "EIN string, id int")
    assert sorted(r["id"] for r in duplicated_rows(df).collect()) == [1, 2]
    root = tempfile.mkdtemp(prefix="review-", dir="/tmp")
    write_review_extract(spark, {"CO": df.withColumn("VALIDATION_REASON", F.lit("L"))}, root, 2015)
    assert read_table(spark, published(spark, root, 2015), "CO").count() == 3


def test_inactive_rules_compile(spark):
    off = [r for f in ("FULL",) for r in rules.rules_for(f, include_inactive=True) if not r.active]
    assert {r.name for r in off} == {"fu_exps", "fu_othinc", "fu_progrev", "fu_ass_eoy",
                                     "fu_liab_eoy", "fu_totnetliabastend"}
    assert len(off[0].parts) == 35
    df = spark.createDataFrame([(10.0, 4.0, 6.0)], "TOTNETLIABASTEND double, LIAB_EOY double, FUNDBAL double")
    r = [x for x in off if x.name == "fu_totnetliabastend"][0]
    assert df.select(rules.residual_expr(r, df.columns)).first()[0] == 0.0
