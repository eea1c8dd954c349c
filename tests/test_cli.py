"""The command-line jobs end to end: build, two rounds of review, build again
with the fixes, published release, on folder extracts of EZ, Full and PF."""

import tempfile

import pytest
from pyspark.sql import functions as F

from filing_release.__main__ import main
from filing_release.sources import driver_tables as dt
from filing_release.sources import sinks
from test_release_build import every_known_column

SF = "/root/testdata/sf0.001"
ADJ = "EIN string, field string, action string, amount double, user string, " \
      "explanation string, ts timestamp, seq long"


def text(name, alias):
    return F.col(name).cast("string").alias(alias)


@pytest.fixture(scope="module")
def landed(spark):
    root = tempfile.mkdtemp(prefix="cli-", dir="/tmp")
    b = dt.base(spark, SF, min_year=2000)
    full = b.filter(F.col("SOURCE_KIND") == "FULL").select(
        "EIN", F.col("TAXPER").alias("tax_prd"), F.col("SUBSECCD").alias("subcd"),
        text("TOTREV2", "totrevenue"), text("EXPS", "totfuncexpns"), text("ASS_EOY", "totassetsend"),
        text("LIAB_EOY", "totliabend"), text("FUNDBAL", "totnetassetend"))
    ez = b.filter(F.col("SOURCE_KIND") == "EZ").select(
        "EIN", F.col("TAXPER").alias("tax_pd"), "SUBSECCD",
        text("TOTREV2", "totrevnue"), text("EXPS", "totexpns"))
    pf = b.select("EIN", F.col("TAXPER").alias("tax_prd"), "SUBSECCD", text("TOTREV2", "P1TOTREV"),
                  text("EXPS", "P1TOTEXP"), text("FUNDBAL", "P2TASFMV"), text("ASS_EOY", "P2TOTAST"))
    for df, name in ((full, "16extract990.dat"), (ez, "16extractez.dat"), (pf, "16extractpf.dat")):
        df.repartition(3).write.option("header", True).option("sep", " ").csv(f"{root}/{name}")
    dt.classification_master(spark, SF).write.parquet(f"{root}/cls")
    dt.place_lookup(spark, SF).write.parquet(f"{root}/place")
    dt.registry_raw(spark, SF).write.option("header", True).csv(f"{root}/registry")
    with open(f"{root}/numeric.txt", "w") as f:
        f.write("\n".join(["TOTREV2", "EXPS", "ASS_EOY", "LIAB_EOY", "FUNDBAL", "P1TOTREV",
                           "P1TOTEXP", "P2TASFMV", "P2TOTAST"]))
    with open(f"{root}/optional.txt", "w") as f:
        f.write("\n".join(every_known_column()))
    for y in (1999, 1998):
        p = dt.prior_release(spark, SF, y)
        tables = {t: p.filter(F.col("RELEASE") == t).drop("RELEASE", "SOURCE_KIND")
                  for t in ("CO", "PC")}
        pf_prior = tables["CO"].withColumns({"P1TOTREV": F.col("TOTREV2"), "P1TOTEXP": F.col("EXPS"),
                                             "P2TASFMV": F.col("FUNDBAL"),
                                             "P2TOTAST": F.col("ASS_EOY")})
        sinks.write_release(spark, {**tables, "PF": pf_prior}, f"{root}/releases", y)
    return root


def build(root, *more):
    return main(["build", "--year", "2000", "--full", f"{root}/16extract990.dat",
                 "--ez", f"{root}/16extractez.dat", "--pf", f"{root}/16extractpf.dat",
                 "--classification", f"{root}/cls", "--place", f"{root}/place",
                 "--registry", f"{root}/registry", "--numeric-columns", f"{root}/numeric.txt",
                 "--optional-columns", f"{root}/optional.txt",
                 "--prior-root", f"{root}/releases", "--out", f"{root}/releases",
                 "--review-out", f"{root}/review", *more])


def review(root, table, *more):
    return main(["review", "--year", "2000", "--table", table, "--review-root", f"{root}/review",
                 "--log", f"{root}/log", "--optional-columns", f"{root}/optional.txt",
                 "--fixes-root", f"{root}/fixes", *more])


def reviewed(spark, root, table, part):
    return sinks.read_table(spark, sinks.published(spark, sinks.review_root(f"{root}/fixes", table),
                                                   2000), part)


def test_build_review_build(spark, landed):
    root = landed
    assert build(root) == 2                                    # flagged rows: hard stop
    assert 2000 not in sinks.published_years(spark, f"{root}/releases")
    extract = sinks.published(spark, f"{root}/review", 2000)
    assert set(extract.names) == {"CO", "PC", "PF", "SUMMARY", "SCHEMA_REPORT"}
    flagged = {t: sinks.read_table(spark, extract, t) for t in ("CO", "PC", "PF")}
    for t, df in flagged.items():
        assert df.count() > 0 and df.filter("SOURCE like 'part-%'").count() == 0
        assert df.filter(F.col("VALIDATION_REASON").contains("F")).count() > 0, t   # F by rule

    # PC, round 1: reviewers balance FUNDBAL of the full forms
    pc = flagged["PC"]
    one = pc.filter("SOURCE_KIND = 'FULL'")
    edits = one.select("EIN", F.lit(" fundbal").alias("field"), F.lit("level").alias("action"),
                       (F.col("ASS_EOY") - F.col("LIAB_EOY")).alias("amount"),
                       F.lit("rev1").alias("user"), F.lit("1").alias("explanation"),
                       F.current_timestamp().alias("ts"), F.lit(1).cast("long").alias("seq"))
    lost = spark.createDataFrame([("nobody", "EXPS", "delta", 1.0, "rev1", "1")],
                                 "EIN string, field string, action string, amount double, "
                                 "user string, explanation string") \
        .withColumn("ts", F.current_timestamp()).withColumn("seq", F.lit(1).cast("long"))
    edits.unionByName(lost).write.parquet(f"{root}/edits1")
    one.select("EIN", F.lit("fix").alias("action")).write.parquet(f"{root}/actions1")
    assert review(root, "PC", "--adjustments", f"{root}/edits1", "--actions", f"{root}/actions1") == 0
    first = {r.EIN: r for r in reviewed(spark, root, "PC", "LEDGER").collect()}
    assert len(first) == pc.count()
    assert [(r.EIN, r.outcome) for r in reviewed(spark, root, "PC", "UNAPPLIED").collect()] == [
        ("nobody", "EIN not in the extract")]

    # round 2 adds to round 1: nothing saved but the log
    some = one.limit(3).select("EIN").collect()
    e2 = [(r.EIN, "FUNDBAL", "delta", 10.0, "rev2", "2") for r in some]
    spark.createDataFrame(e2, "EIN string, field string, action string, amount double, "
                              "user string, explanation string") \
        .withColumn("ts", F.current_timestamp()).withColumn("seq", F.lit(1).cast("long")) \
        .write.parquet(f"{root}/edits2")
    spark.createDataFrame([(r.EIN, "fix") for r in some], "EIN string, action string") \
        .write.parquet(f"{root}/actions2")
    assert review(root, "PC", "--adjustments", f"{root}/edits2", "--actions", f"{root}/actions2") == 0
    second = {r.EIN: r for r in reviewed(spark, root, "PC", "LEDGER").collect()}
    for r in some:
        assert abs(second[r.EIN].fundbal_adjusted_by - first[r.EIN].fundbal_adjusted_by - 10) < 1e-6
        assert second[r.EIN].validated_by == "rev2"
    fixes = reviewed(spark, root, "PC", "FIXES")
    assert fixes.filter("VALIDATION_STATE = 1").count() == one.count()
    assert "fundbal_adjusted_by" not in fixes.columns and "ROUNDS" not in fixes.columns

    # PF has its own rules and residuals
    pf = flagged["PF"]
    pf.select("EIN", F.lit("ignore").alias("action")).write.parquet(f"{root}/actions_pf")
    assert review(root, "PF", "--actions", f"{root}/actions_pf") == 0
    pf_fixes = reviewed(spark, root, "PF", "FIXES")
    assert "validate_pf_p1totrev" in pf_fixes.columns
    assert not [c for c in pf_fixes.columns if c.startswith("validate_ez")]
    assert pf_fixes.filter("VALIDATION_STATE = 2").count() == pf.count()

    # the fixes come back and a partial build publishes
    assert build(root, "--fixes-root", f"{root}/fixes", "--partial") == 0
    done = sinks.published(spark, f"{root}/releases", 2000)
    assert {"CO", "PC", "PF", "CO_FULL", "PC_FULL"} == set(done.names)
    got = {r.EIN: r for r in sinks.read_table(spark, done, "PC").collect()}
    for r in fixes.filter("VALIDATION_STATE = 1").collect():
        assert abs(got[r.EIN].FUNDBAL - r.FUNDBAL) < 1e-6 and got[r.EIN].VALIDATION_STATE == 1
        assert got[r.EIN].MANUALLY_FIXED == "FUNDBAL"
    assert sinks.read_table(spark, done, "PF").filter("VALIDATION_STATE = 2").count() == pf.count()


def test_build_stops_without_the_prior_year(spark, landed):
    with pytest.raises(sinks.NotPublished, match="no release of 2010"):
        main(["build", "--year", "2011", "--full", f"{landed}/16extract990.dat",
              "--ez", f"{landed}/16extractez.dat", "--prior-root", f"{landed}/releases",
              "--out", f"{landed}/out", "--review-out", f"{landed}/out2"])
