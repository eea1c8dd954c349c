"""End-to-end build over raw text extracts written from the benchmark data."""

import tempfile

import pytest
from pyspark.sql import functions as F

from filing_release import config
from filing_release.functions import money
from filing_release.operators import filters, rules, schema
from filing_release.operators.absent import AbsentColumns
from filing_release.operators.enrich import assert_unique
from filing_release.plans import release as rel
from filing_release.sources import driver_tables as dt
from filing_release.sources.extracts import read_extract
from filing_release.sources.sinks import published, read_table, write_release

SF = "/root/testdata/sf0.001"
AMOUNTS = ["TOTREV2", "CONT", "EXPS", "ASS_EOY", "LIAB_EOY", "FUNDBAL", "DIREXP", "NETINC"]


@pytest.fixture(scope="module")
def raw_paths(spark):
    root = tempfile.mkdtemp(prefix="extracts-", dir="/tmp")
    b = dt.base(spark, SF, min_year=2000)
    full = b.filter(F.col("SOURCE_KIND") == "FULL").select(
        F.col("EIN"), F.col("TAXPER").alias("tax_prd"), F.col("SUBSECCD").alias("subcd"),
        F.col("TOTREV2").cast("string").alias("totrevenue"),
        F.col("CONT").cast("string").alias("totcntrbgfts"),
        F.col("EXPS").cast("string").alias("totfuncexpns"),
        F.col("ASS_EOY").cast("string").alias("totassetsend"),
        F.col("LIAB_EOY").cast("string").alias("totliabend"),
        F.col("FUNDBAL").cast("string").alias("totnetassetend"))
    ez = b.filter(F.col("SOURCE_KIND") == "EZ").select(
        F.col("EIN").alias("ein"), F.col("TAXPER").alias("tax_pd"), "SUBSECCD",
        F.col("TOTREV2").cast("string").alias("totrevnue"),
        F.col("EXPS").cast("string").alias("totexpns"),
        F.col("NETINC").cast("string").alias("totexcessyr"),
        F.col("ASS_EOY").cast("string").alias("totassetsend"),
        F.col("LIAB_EOY").cast("string").alias("totliabend"),
        F.col("FUNDBAL").cast("string").alias("totnetassetsend"))
    pf = b.select(F.col("EIN"), F.col("TAXPER").alias("tax_prd"), "SUBSECCD",
                  F.col("TOTREV2").cast("string").alias("P1TOTREV"),
                  F.col("EXPS").cast("string").alias("P1TOTEXP"),
                  F.col("FUNDBAL").cast("string").alias("P2TASFMV"),
                  F.col("ASS_EOY").cast("string").alias("P2TOTAST"))
    paths = {"FULL": f"{root}/16extract990.dat", "EZ": f"{root}/16extractez.dat",
             "PF": f"{root}/16extractpf.dat"}
    full.write.option("header", True).option("sep", " ").csv(paths["FULL"])
    ez.write.option("header", True).option("sep", " ").csv(paths["EZ"])
    pf.write.option("header", True).option("sep", " ").csv(paths["PF"])
    return paths


def test_build_release(spark, raw_paths):
    extracts = {f: read_extract(spark, p, source_name=p.rsplit("/", 1)[1])
                for f, p in raw_paths.items()}
    priors = {}
    for t in ("CO", "PC"):
        priors[t] = {y: dt.prior_release(spark, SF, y).filter(F.col("RELEASE") == t)
                     .drop("RELEASE", "SOURCE_KIND") for y in (1999, 1998)}
    inp = rel.ReleaseInputs(extracts=extracts, classification=dt.classification_master(spark, SF),
                            place=dt.place_lookup(spark, SF), postcard=dt.postcard(spark, SF),
                            priors=priors, optional_columns=every_known_column(),
                            numeric_columns=AMOUNTS + ["P1TOTREV", "P1TOTEXP", "P2TASFMV", "P2TOTAST"],
                            final_lists={"CO": ["EIN", "TAXPER", "TOTREV2", "NTEEFINAL", "LEVEL1"],
                                         "CO_full": ["EIN", "TOTCNTRBGFTS", "VALIDATION_REASON"]})
    opt = rel.ReleaseOptions(year=2000, cutoff=300_000)
    res = rel.build_release(spark, inp, opt)
    assert set(res.tables) == {"CO", "PC", "PF", "CO_full", "PC_full"}
    pf = res.tables["PF"]
    assert pf.filter(F.col("SUBSECCD") == "92").count() == 0              # C2
    assert {"validate_pf_p1totrev", "P6TXRFD", "TFLD", "FILENAME"} <= set(pf.columns)
    assert pf.filter(F.col("FILENAME").endswith("_990PF")).count() == pf.count()
    assert "C" not in "".join(r[0] for r in res.flagged["PF"].select("VALIDATION_REASON").collect())
    for t in ("CO", "PC", "PF"):
        assert_unique(res.tables[t], "EIN", t)
        assert res.tables[t].count() > 0
    assert res.tables["CO"].columns == ["EIN", "TAXPER", "TOTREV2", "NTEEFINAL", "LEVEL1",
                                        "VALIDATION_STATE", "MANUALLY_FIXED"]
    # The _full list names a source column; M11: reasons are on the release
    assert res.tables["CO_full"].columns == ["EIN", "TOTCNTRBGFTS", "VALIDATION_REASON",
                                             "VALIDATION_STATE", "MANUALLY_FIXED"]
    assert res.tables["PC"].filter(F.col("VALIDATION_REASON") != "").count() == \
        res.flagged["PC"].count() > 0
    pc = res.tables["PC"]
    assert pc.filter(F.col("SOURCE").startswith("core")).count() > 0          # backfilled
    assert pc.filter(F.col("INPRIOR") == "1").count() > 0                     # prior matched
    assert "validate_fu_fundbal" in pc.columns and pc.select("LEVEL3", "PMSA").count() > 0
    # no row older than the recency window survives
    assert pc.filter(F.col("FISYR") < 1998).count() == 0
    counts = res.audit_counts()
    assert counts["CO_deduplicated"]["rows"] == res.tables["CO"].count()
    assert counts["PC_backfilled"]["backfilled"] > 0 and counts["PC_prior_joined"]["matched"] > 0
    assert counts["FULL_read"]["rows"] >= counts["FULL_after_drops"]["rows"]
    assert res.failed and not res.publish
    with pytest.raises(rel.ReleaseHalted):
        rel.check_hard_stop(res, opt)
    out = tempfile.mkdtemp(prefix="release-", dir="/tmp")
    assert write_release(spark, res.tables, out, 2000, gate_open=res.publish) == []
    assert write_release(spark, {"CO": res.tables["CO"]}, out, 2000) == ["core2000co"]
    back = read_table(spark, published(spark, out, 2000), "CO")
    assert back.count() == res.tables["CO"].count() and back.columns == res.tables["CO"].columns
    # What the extracts lack and the final lists drop is reported
    report = {tuple(r) for r in res.schema_report(spark).collect()}
    assert ("CO", "dropped", "LIAB_EOY") in report
    assert any(t == "EZ" and kind == "not in extract" for t, kind, _ in report)


def test_absent_columns_stop_the_build(spark, raw_paths):
    full = {"FULL": read_extract(spark, raw_paths["FULL"], source_name="16extract990.dat")}
    inp = rel.ReleaseInputs(extracts=full, numeric_columns=AMOUNTS, drop_lists={})
    with pytest.raises(AbsentColumns, match="Full money columns: no column .*GRSRNTSREAL"):
        rel.build_release(spark, inp, rel.ReleaseOptions(year=2000))
    inp.drop_lists = {"FULL": ["TOTREV2", "NOSUCH"]}
    with pytest.raises(AbsentColumns, match="empty-filer test: no column NOSUCH"):
        rel.build_release(spark, inp, rel.ReleaseOptions(year=2000))
    two = full["FULL"].withColumn("TAX_PD", F.lit("201512"))
    with pytest.raises(ValueError, match="exactly one tax-period"):
        rel.build_release(spark, rel.ReleaseInputs(extracts={"FULL": two}),
                          rel.ReleaseOptions(year=2000))


def every_known_column():
    """Configured columns that the extracts of these tests lack."""
    names = {c for form, v in config.DROP_LISTS.items() for c in filters.drop_list_names(
        v, schema.crosswalk_map(config.CROSSWALKS.get(form, [])))}
    names |= {t for pairs in config.CROSSWALKS.values() for t, _ in pairs}
    names |= {c for v in money.INPUTS.values() for c in v}
    return sorted(names | set(rules.rule_fields(("EZ", "FULL", "PF"))))
