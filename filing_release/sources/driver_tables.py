"""Filing-shaped views over the benchmark tables.

The benchmark ships a TPC-H-like star schema.  ``filings`` turns it into
one row per order standing for a filing and a customer for an
organisation; lookups, prior releases, postcard filers, corrections,
fixes and reviewers' adjustments are all derived from the same tables, so
every query's work grows with the data.  Each builder has a DuckDB twin
in ``plans.oracle`` with the same definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import source_kind, start_year
from ..operators.dedup import deduplicate, size_score

# Release year the benchmark data is built for (orders cover 1995-2001).
RELEASE_YEAR = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filings(spark: SparkSession, sf_dir: str, min_year: int | None = None,
            year: int | None = None) -> DataFrame:
    """One row per order; year limits are applied to ``o_orderdate`` so the
    parquet scan prunes row groups."""
    o = table(spark, sf_dir, "orders")
    if year is not None:
        o = o.filter((F.col("o_orderdate") >= F.expr(f"timestamp_ntz'{year}-01-01 00:00:00'"))
                     & (F.col("o_orderdate") < F.expr(f"timestamp_ntz'{year + 1}-01-01 00:00:00'")))
    elif min_year is not None:
        o = o.filter(F.col("o_orderdate") >= F.expr(f"timestamp_ntz'{min_year}-01-01 00:00:00'"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    li = (table(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey")
          .agg(F.sum("l_extendedprice").alias("gross"),
               F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("disc")))
    j = o.join(c, o["o_custkey"] == c["c_custkey"]) \
         .join(li, o["o_orderkey"] == li["l_orderkey"], "left")
    return j.select(
        F.col("o_orderkey").alias("FILING_ID"),
        F.expr("lpad(cast(o_custkey as string), 9, '0')").alias("EIN"),
        F.date_format("o_orderdate", "yyyyMM").alias("TAXPER"),
        F.year("o_orderdate").alias("FISYR"),
        F.expr("case o_orderkey % 3 when 0 then '16extractez.dat' when 1 then '16extract990.dat' "
               "else '15extract990.dat.dat' end").alias("SOURCE"),
        F.expr("case when c_mktsegment in ('BUILDING','MACHINERY') then '03' "
               "when c_mktsegment = 'HOUSEHOLD' then '92' "
               "when c_mktsegment = 'FURNITURE' then '04' end").alias("SUBSECCD"),
        F.expr("nullif(cast(o_custkey % 18 as string), '5')").alias("FNDNCD"),
        F.expr("case when o_custkey % 17 <> 0 then concat(chr(cast(65 + o_custkey % 26 as int)), "
               "lpad(cast(o_custkey % 100 as string), 2, '0')) end").alias("NTEEFINAL"),
        F.col("o_totalprice").alias("TOTREV2"),
        F.expr("round(coalesce(gross, 0), 2)").alias("CONT"),
        F.expr("round(coalesce(disc, 0), 4)").alias("DIREXP"),
        F.expr("round(coalesce(gross, 0) - coalesce(disc, 0), 4)").alias("NETINCFNDRSNG"),
        F.expr("round(o_totalprice * 0.9, 3)").alias("EXPS"),
        (F.col("c_acctbal") * 1000).alias("ASS_EOY"),
        (F.col("c_acctbal") * 400).alias("LIAB_EOY"),
        F.expr("c_acctbal * 600 + (o_orderkey % 7) * 500").alias("FUNDBAL"),
        F.col("o_orderstatus").alias("ORDSTAT"),
        F.col("o_orderpriority").alias("ORDPRI"),
        F.col("c_name").alias("NAME"),
    )


def with_base_columns(df: DataFrame) -> DataFrame:
    """Release-table columns every stage reads: NETINC/TOTREV (full-form
    rule), STYEAR, SOURCE_KIND, RELEASE and the review-tracking pair."""
    df = df.withColumn("NETINC", F.col("TOTREV2") - F.col("EXPS"))
    return df.withColumns({
        "TOTREV": F.col("EXPS") + F.col("NETINC"),
        "STYEAR": start_year("TAXPER"),
        "SOURCE_KIND": source_kind("SOURCE"),
        "RELEASE": F.when(F.col("SUBSECCD").eqNullSafe(F.lit("03")), "PC").otherwise("CO"),
        "VALIDATION_STATE": F.lit(0),
        "MANUALLY_FIXED": F.lit(""),
    })


def base(spark: SparkSession, sf_dir: str, min_year: int | None = None,
         year: int | None = None) -> DataFrame:
    return with_base_columns(filings(spark, sf_dir, min_year=min_year, year=year))


def base_years(spark: SparkSession, sf_dir: str, release_year: int = RELEASE_YEAR,
               depth: int = 2) -> DataFrame:
    """Filings of years Y-depth .. Y+1 built once (one lineitem pass) and
    staged; the current rows and the prior releases are filters of it."""
    from ..plans.materialize import stage_once
    return stage_once(lambda: base(spark, sf_dir, min_year=release_year - depth), spark,
                      (sf_dir, release_year, depth), "base", partition_by=["FISYR"])


def prior_release(spark: SparkSession, sf_dir: str, year: int,
                  release_year: int = RELEASE_YEAR, depth: int = 2) -> DataFrame:
    """Published release of ``year``: the best filing per EIN among that
    year's filings (same criteria as the current de-dup), staged like a
    published table."""
    from ..plans.materialize import stage_once

    def build():
        b = base_years(spark, sf_dir, release_year, depth).filter(F.col("FISYR") == year)
        return deduplicate(b, year, score=size_score(), tiebreak=F.col("FILING_ID"),
                           depth=0, year_shift=False, key=["RELEASE", "EIN"])
    return stage_once(build, spark, (sf_dir, year, release_year, depth), "prior")


def current(spark: SparkSession, sf_dir: str, release_year: int = RELEASE_YEAR) -> DataFrame:
    """Current extract rows: filings with FISYR >= Y."""
    return base_years(spark, sf_dir, release_year).filter(F.col("FISYR") >= release_year)


def reviewed_states(df: DataFrame) -> DataFrame:
    """A release after a review round: states taken from order priority
    (urgent->fixed, medium->ignored, not specified->checked, else 0)."""
    st = (F.when(F.col("ORDPRI") == "1-URGENT", 1).when(F.col("ORDPRI") == "3-MEDIUM", 2)
           .when(F.col("ORDPRI") == "4-NOT SPECIFIED", 3).otherwise(0))
    return df.withColumn("VALIDATION_STATE", st)


# --- lookups -------------------------------------------------------------------------
def registry_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry files: customers and suppliers as two regional files."""
    c = table(spark, sf_dir, "customer").select(
        F.expr("lpad(cast(c_custkey as string), 9, '0')").alias("EIN"),
        F.expr("cast(c_nationkey % 5 as string)").alias("ORGANIZATION"),
        F.expr("lpad(cast(c_nationkey * 1000 + c_custkey % 1000 as string), 5, '0')").alias("ZIP"),
        F.expr("lpad(cast(c_custkey * 7919 % 1000000000 as string), 9, '0')").alias("ACTIVITY"),
        F.expr("cast(c_custkey % 9 as string)").alias("AFFILIATION"),
        F.expr("cast(c_custkey % 2 as string)").alias("DEDUCTIBILITY"),
        F.expr("concat(repeat('%', cast(c_custkey % 3 as int)), repeat(' ', cast(c_custkey % 2 as int)), c_name)").alias("ICO"),
        F.col("c_mktsegment").alias("SORT_NAME"),
        F.expr("cast(c_custkey % 4 as string)").alias("FILING_REQ_CD"),
        F.expr("cast(c_nationkey % 3 as string)").alias("PF_FILING_REQ_CD"),
        F.expr("cast(cast(floor(c_acctbal / 1000) as int) as string)").alias("ASSET_CD"),
        F.expr("cast(c_nationkey % 10 as string)").alias("INCOME_CD"),
        F.expr("case when c_acctbal < 0 then '2' else '1' end").alias("STATUS"),
    )
    s = table(spark, sf_dir, "supplier").select(
        F.expr("lpad(cast(s_suppkey + 500000000 as string), 9, '0')").alias("EIN"),
        F.expr("cast(s_nationkey % 5 as string)").alias("ORGANIZATION"),
        F.expr("lpad(cast(s_nationkey * 1000 as string), 5, '0')").alias("ZIP"),
        F.expr("lpad(cast(s_suppkey * 104729 % 1000000000 as string), 9, '0')").alias("ACTIVITY"),
        F.lit("3").alias("AFFILIATION"),
        F.lit("1").alias("DEDUCTIBILITY"),
        F.expr("concat('% ', s_name)").alias("ICO"),
        F.lit("SUPPLIER").alias("SORT_NAME"),
        F.lit("1").alias("FILING_REQ_CD"),
        F.lit("0").alias("PF_FILING_REQ_CD"),
        F.lit("1").alias("STATUS"),
    )
    return c.unionByName(s, allowMissingColumns=True)


def classification_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification master keyed by EIN with a hyphen after two digits."""
    return table(spark, sf_dir, "customer").select(
        F.expr("concat(substr(lpad(cast(c_custkey as string), 9, '0'), 1, 2), '-', "
               "substr(lpad(cast(c_custkey as string), 9, '0'), 3))").alias("EIN"),
        F.expr("case when c_custkey % 17 <> 0 then concat(chr(cast(65 + c_custkey % 26 as int)), "
               "lpad(cast(c_custkey % 100 as string), 2, '0')) end").alias("NteeFinal"),
        F.expr("lpad(cast(c_nationkey as string), 5, '0')").alias("Fips"),
        F.expr("nullif(cast(c_custkey % 18 as string), '5')").alias("FndnCd"),
        F.col("c_name").alias("Name"),
        F.col("c_mktsegment").alias("ClassCd"),
    )


def place_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        F.expr("lpad(cast(n_nationkey as string), 5, '0')").alias("FIPS"),
        F.col("n_name").alias("PMSA"), F.col("r_name").alias("MSA_NECH"))


def postcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short-form filers: one row per event user, year shifted into the
    filing era (EIN unique)."""
    e = table(spark, sf_dir, "events")
    return e.groupBy("user_id").agg(F.min("ts").alias("t")).select(
        F.expr("lpad(cast(user_id as string), 9, '0')").alias("EIN"),
        F.expr("cast(year(t) - 24 as string)").alias("EPOSTCARD"))


def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections table: drop the EZ filings of customers with a negative
    balance; re-key customers with a balance above 9,900 when the name
    matches."""
    c = table(spark, sf_dir, "customer")
    ein = F.expr("lpad(cast(c_custkey as string), 9, '0')")
    drops = c.filter(F.col("c_acctbal") < 0).select(
        ein.alias("EIN"), F.lit("drop").alias("action"),
        F.lit("16extractez.dat").alias("match_source"),
        F.lit(None).cast("string").alias("match_name"), F.lit(None).cast("string").alias("new_ein"))
    rekeys = c.filter(F.col("c_acctbal") > 9900).select(
        ein.alias("EIN"), F.lit("rekey").alias("action"), F.lit(None).cast("string").alias("match_source"),
        F.col("c_name").alias("match_name"),
        F.expr("concat('9', substr(lpad(cast(c_custkey as string), 9, '0'), 2))").alias("new_ein"))
    return drops.unionByName(rekeys)


def adjustments(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Reviewers' edits: every line item of a release row's order is one edit -
    FUNDBAL for returned (R), EXPS for accepted (A), CONT for the others (N);
    the first line of a finished order sets a level, the others add a delta."""
    li = table(spark, sf_dir, "lineitem")
    r = rows.select("FILING_ID", "EIN")
    j = li.join(r, li["l_orderkey"] == r["FILING_ID"])
    level = (F.col("l_linenumber") == 1) & (F.col("l_linestatus") == "F")
    return j.select(
        "EIN",
        F.when(F.col("l_returnflag") == "R", "FUNDBAL").when(F.col("l_returnflag") == "A", "EXPS")
         .otherwise("CONT").alias("field"),
        F.when(level, "level").otherwise("delta").alias("action"),
        F.when(level, F.col("l_extendedprice"))
         .otherwise(F.col("l_extendedprice") * F.col("l_discount") - F.col("l_tax") * 100)
         .alias("amount"),
        F.concat(F.lit("reviewer"), (F.col("l_suppkey") % 10).cast("string")).alias("user"),
        (F.col("l_linenumber") % 6).cast("string").alias("explanation"),
        F.col("l_shipdate").alias("ts"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))


# Reviewer action per row for the state-transition job (by order priority).
ACTION_BY_PRIORITY = {"1-URGENT": "fix", "2-HIGH": "check", "3-MEDIUM": "ignore",
                      "4-NOT SPECIFIED": "fix_ignore", "5-LOW": "skip"}


def reviewer_action():
    e = None
    for k, v in ACTION_BY_PRIORITY.items():
        e = F.when(F.col("ORDPRI") == k, v) if e is None else e.when(F.col("ORDPRI") == k, v)
    return e
