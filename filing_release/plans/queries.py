"""Registered queries: each is (Spark plan, DuckDB oracle) over the
benchmark tables.  Spark plans use only the library's operators; oracles
are hand-written SQL over the same views (``plans.oracle``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import codes
from ..functions.amounts import NUMBER_PATTERN, parse_amount
from ..functions.money import ez_money, full_money, pf_money
from ..operators import filters, schema
from ..operators.dedup import deduplicate, pf_size_score, size_score
from ..sources import driver_tables as dt
from . import oracle as o

Y = dt.RELEASE_YEAR
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


# --- F1, F2, F5, C6 ------------------------------------------------------------------
@register("dedup_best", o.with_ctes(o.FILINGS, o.base()) + f"""
SELECT RELEASE, EIN, FILING_ID, FISYR, TAXPER, STYEAR, TOTREV, ASS_EOY, EXPS FROM (
  SELECT *, row_number() OVER (PARTITION BY RELEASE, EIN ORDER BY FISYR DESC, {o.SCORE} DESC,
         STYEAR DESC, FILING_ID DESC) AS rn
  FROM base WHERE FISYR >= {Y - 2}) WHERE rn = 1""")
def dedup_best(spark: SparkSession, d: str) -> DataFrame:
    # C6 as a date range on the scan (pushed to parquet); project before the
    # top-1 so only needed columns travel through the shuffle
    b = dt.base(spark, d, min_year=Y - 2).select(
        "RELEASE", "EIN", "FILING_ID", "FISYR", "TAXPER", "STYEAR", "TOTREV", "ASS_EOY", "EXPS")
    return deduplicate(b, Y, score=size_score(), tiebreak=F.col("FILING_ID"),
                       key=["RELEASE", "EIN"], year_shift=False)


# --- B2, B3 --------------------------------------------------------------------------
@register("crosswalk_project", o.with_ctes(o.FILINGS) + """
SELECT EIN, TAXPER, SUBSECCD, TOTREV2, CONT, EXPS, ASS_EOY, LIAB_EOY, FUNDBAL, FILING_ID,
       SOURCE FROM filings""")
def crosswalk_project(spark: SparkSession, d: str) -> DataFrame:
    f = dt.filings(spark, d)
    raw = f.select(F.col("EIN").alias("ein"), F.col("TAXPER").alias("tax_pd"),
                   F.col("SUBSECCD").alias("subcd"), F.col("TOTREV2").alias("totrevenue"),
                   F.col("CONT").alias("TotCntrbGfts"), F.col("EXPS").alias("totfuncexpns"),
                   F.col("ASS_EOY").alias("totassetsend"), F.col("LIAB_EOY").alias("totliabend"),
                   F.col("FUNDBAL").alias("totnetassetend"), F.col("FILING_ID").alias("filing_id"),
                   F.col("SOURCE").alias("source"))
    schema.check_one_tax_period(raw.columns)
    out, _missing = schema.apply_crosswalk(raw, config.CROSSWALK_FULL)
    return out


# --- C1 ------------------------------------------------------------------------------
_ZERO_RAW = ("CASE WHEN ORDSTAT = 'O' THEN 'Y' ELSE 'N' END AS Q78A, "
             "cast(FILING_ID % 2 AS {t}) AS ODDFLAG")


@register("zero_filer_drop", o.with_ctes(o.FILINGS) + f"""
SELECT FILING_ID, EIN, FNDNCD, Q78A, ODDFLAG FROM (
  SELECT FILING_ID, EIN, FNDNCD, {_ZERO_RAW.format(t='varchar')} FROM filings)
WHERE NOT (coalesce(FNDNCD IN ('N', '0'), false) AND coalesce(Q78A IN ('N', '0'), false)
           AND coalesce(ODDFLAG IN ('N', '0'), false))""")
def zero_filer_drop(spark: SparkSession, d: str) -> DataFrame:
    f = dt.filings(spark, d).selectExpr("FILING_ID", "EIN", "FNDNCD",
                                        *_ZERO_RAW.format(t="string").split(", "))
    return filters.drop_empty_filers(f, ["FNDNCD", "Q78A", "ODDFLAG"])


# --- C2, C5 --------------------------------------------------------------------------
@register("value_drop_nullsafe", o.with_ctes(o.FILINGS) + """
SELECT FILING_ID, EIN, SUBSECCD,
       CASE WHEN SUBSECCD = '03' THEN 'PC' ELSE 'CO' END AS RELEASE
FROM filings WHERE SUBSECCD IS DISTINCT FROM '92'""")
def value_drop_nullsafe(spark: SparkSession, d: str) -> DataFrame:
    f = dt.filings(spark, d).select("FILING_ID", "EIN", "SUBSECCD")
    f = filters.drop_value(f, "SUBSECCD", "92")
    return f.withColumn("RELEASE", filters.release_name())


# --- I1, B8 --------------------------------------------------------------------------
_RAW_AMOUNT = """CASE FILING_ID % 8
  WHEN 0 THEN substr(EIN, 6)
  WHEN 1 THEN concat(' ', TAXPER, ' ')
  WHEN 2 THEN concat(substr(TAXPER, 6, 1), 'e', substr(TAXPER, 4, 1))
  WHEN 3 THEN concat(substr(TAXPER, 1, 4), 'd')
  WHEN 4 THEN ORDPRI
  WHEN 5 THEN concat(substr(TAXPER, 1, 1), ',', substr(TAXPER, 2, 3))
  WHEN 6 THEN concat('.', substr(EIN, 8))
  ELSE CASE WHEN ORDSTAT = 'F' THEN 'NaN' ELSE '' END END"""


@register("amount_cast", o.with_ctes(o.FILINGS) + f"""
SELECT FILING_ID, RAW, coalesce(CASE WHEN regexp_full_match(RAW, '{NUMBER_PATTERN}')
       THEN try_cast(trim(RAW) AS double) END, 0.0) AS AMOUNT
FROM (SELECT FILING_ID, {_RAW_AMOUNT} AS RAW FROM filings)""")
def amount_cast(spark: SparkSession, d: str) -> DataFrame:
    f = dt.filings(spark, d).select("FILING_ID", F.expr(_RAW_AMOUNT).alias("RAW"))
    return f.withColumn("AMOUNT", parse_amount("RAW"))


# --- I2-I4, I6, I7, I19 ----------------------------------------------------------------
@register("derive_keys", o.with_ctes(o.FILINGS, o.base()) + """
SELECT FILING_ID, EIN, TAXPER, cast(substr(TAXPER, 1, 4) AS int) AS FISYR,
       substr(TAXPER, 5, 2) AS ACCPER, EIN || TAXPER AS NCCSKEY,
       EIN || cast(cast(substr(TAXPER, 1, 4) AS int) AS varchar) AS NCCSKEY2,
       substr(NTEEFINAL, 1, 4) AS NTEECC, substr(NTEEFINAL, 1, 1) AS NTEE1,
       substr(NTEEFINAL, 1, 1) AS NTEEFINAL1, substr(NTEEFINAL, 1, 1) AS LEVEL4,
       EIN || '_' || TAXPER || '_' || CASE SOURCE_KIND WHEN 'EZ' THEN '990EZ'
         WHEN 'FULL' THEN '990O' WHEN 'PF' THEN '990PF' END AS FILENAME
FROM base""")
def derive_keys(spark: SparkSession, d: str) -> DataFrame:
    b = dt.base(spark, d).select("FILING_ID", "EIN", "TAXPER", "NTEEFINAL", "SOURCE_KIND")
    b = b.withColumn("FISYR", codes.fiscal_year())
    k1, k2 = codes.filing_keys()
    b = b.withColumns({"ACCPER": codes.accounting_period(), "NCCSKEY": k1, "NCCSKEY2": k2,
                       **codes.class_prefixes(),
                       "FILENAME": codes.file_name(F.col("SOURCE_KIND"))})
    return b.drop("NTEEFINAL", "SOURCE_KIND")


# --- I9, I10, I13, I14 -----------------------------------------------------------------
def _sql_first_map(col: str, mapping: dict, default: str) -> str:
    whens = []
    for out in dict.fromkeys(mapping.values()):
        keys = ", ".join(f"'{k}'" for k, v in mapping.items() if v == out)
        whens.append(f"WHEN substr({col}, 1, 1) IN ({keys}) THEN '{out}'")
    return "CASE " + " ".join(whens) + f" ELSE '{default}' END"


_NTMAJ10_SQL = _sql_first_map("NTEEFINAL", codes.MAJOR10, "UN")


@register("classify_major_groups", o.with_ctes(o.FILINGS) + f"""
SELECT FILING_ID, NTEEFINAL, NTMAJ10,
  CASE WHEN NTEEFINAL IS NULL OR NTEEFINAL = '' THEN NTEEFINAL
       WHEN substr(NTEEFINAL, 1, 2) IN ('B4', 'B5') THEN 'BH'
       WHEN substr(NTEEFINAL, 1, 2) = 'E2' THEN 'EH' ELSE substr(NTEEFINAL, 1, 1) END AS MAJGRPB,
  CASE WHEN substr(NTEEFINAL, 1, 2) IN ('B4', 'B5') THEN 'BH'
       WHEN substr(NTEEFINAL, 1, 2) = 'E2' THEN 'EH' ELSE NTMAJ10 END AS NTMAJ12,
  CASE WHEN NTMAJ10 IN ('IN', 'EN', 'PU', 'RE', 'MU', 'UN') THEN 'OT' ELSE NTMAJ10 END AS NTMAJ5
FROM (SELECT FILING_ID, NTEEFINAL, {_NTMAJ10_SQL} AS NTMAJ10 FROM filings)""")
def classify_major_groups(spark: SparkSession, d: str) -> DataFrame:
    f = dt.filings(spark, d).select("FILING_ID", "NTEEFINAL")
    m10 = codes.major10()
    return f.withColumns({"NTMAJ10": m10, "MAJGRPB": codes.major_group_b(),
                          "NTMAJ12": codes.major12("NTEEFINAL", m10), "NTMAJ5": codes.major5(m10)})


# --- I11 -----------------------------------------------------------------------------
_LEVEL3_SQL = """CASE WHEN NTEEFINAL IS NULL OR NTEEFINAL = '' THEN '-'
  WHEN substr(NTEEFINAL, 1, 2) <> 'B8' AND substr(NTEEFINAL, 2, 2) = '11' THEN 'ZA'
  WHEN substr(NTEEFINAL, 1, 2) <> 'B8' AND substr(NTEEFINAL, 2, 2) = '12' THEN 'ZB'
  WHEN substr(NTEEFINAL, 1, 1) = 'T' AND substr(NTEEFINAL, 2, 1) = '2' THEN 'ZC'
  WHEN substr(NTEEFINAL, 1, 1) = 'T' AND substr(NTEEFINAL, 2, 1) = '3' THEN 'ZD'
  WHEN substr(NTEEFINAL, 1, 1) = 'T' AND substr(NTEEFINAL, 2, 1) = '7' THEN 'ZE'
  WHEN substr(NTEEFINAL, 1, 1) = 'T' AND substr(NTEEFINAL, 2, 2) IN ('90', '99') THEN 'ZF'
  WHEN substr(NTEEFINAL, 1, 1) = 'T' AND substr(NTEEFINAL, 2, 1) = '6' THEN 'ZF'
  WHEN substr(NTEEFINAL, 1, 3) = 'Y30' THEN 'MR'
  WHEN substr(NTEEFINAL, 1, 1) = 'Y' THEN 'MO'
  WHEN substr(NTEEFINAL, 1, 1) = 'A' THEN 'AR' WHEN substr(NTEEFINAL, 1, 1) = 'B' THEN 'ED'
  WHEN substr(NTEEFINAL, 1, 1) IN ('C', 'D') THEN 'EN'
  WHEN substr(NTEEFINAL, 1, 1) IN ('E', 'F', 'G', 'H') THEN 'HE'
  WHEN substr(NTEEFINAL, 1, 1) IN ('I', 'J', 'K', 'L', 'M', 'N', 'O', 'P') THEN 'HS'
  WHEN substr(NTEEFINAL, 1, 1) = 'Q' THEN 'IN'
  WHEN substr(NTEEFINAL, 1, 1) IN ('R', 'S', 'T', 'U', 'V', 'W') THEN 'PB'
  WHEN substr(NTEEFINAL, 1, 1) = 'X' THEN 'RE' WHEN substr(NTEEFINAL, 1, 1) = 'Z' THEN 'UN'
  ELSE '-' END"""


@register("classify_level3", o.with_ctes(o.FILINGS) + f"""
SELECT FILING_ID, NTEEFINAL, {_LEVEL3_SQL} AS LEVEL3 FROM filings""")
def classify_level3(spark: SparkSession, d: str) -> DataFrame:
    return dt.filings(spark, d).select("FILING_ID", "NTEEFINAL", codes.level3().alias("LEVEL3"))


# --- I8, I12 -------------------------------------------------------------------------
@register("classify_levels_1_2", o.with_ctes(o.FILINGS) + f"""
SELECT FILING_ID, SUBSECCD, FNDNCD,
  CASE WHEN s > 3 OR s IN (1, 2) THEN 'O'
       WHEN s = 3 AND f IN (2, 3, 4) THEN 'PF'
       WHEN s = 3 THEN 'PC'
       WHEN s < 0 AND (f IS NULL OR f = 0) THEN 'O'
       WHEN (s IS NULL OR s = 0) AND f IS NOT NULL AND f NOT IN (0, 2, 3, 4, 9) THEN 'PC'
       WHEN (s IS NULL OR s = 0) AND f IN (2, 3, 4) THEN 'PF'
       ELSE 'U' END AS LEVEL1,
  CASE WHEN s = 3 AND f IN (4, 17) THEN 'S'
       WHEN substr(LEVEL3, 1, 1) = 'Z' THEN 'S'
       WHEN substr(NTEEFINAL, 1, 1) = 'Y' THEN 'M' ELSE 'O' END AS LEVEL2
FROM (SELECT *, try_cast(SUBSECCD AS double) AS s, try_cast(FNDNCD AS double) AS f,
             {_LEVEL3_SQL} AS LEVEL3 FROM filings)""")
def classify_levels_1_2(spark: SparkSession, d: str) -> DataFrame:
    f = dt.filings(spark, d)
    return f.select("FILING_ID", "SUBSECCD", "FNDNCD", codes.level1().alias("LEVEL1"),
                    codes.level2().alias("LEVEL2"))


# --- I16, I17 ------------------------------------------------------------------------
@register("fiscal_start_year", o.with_ctes(o.FILINGS) + """
SELECT FILING_ID, TAXPER, STYEAR, cast(STYEAR AS varchar) AS SOIYR FROM (
  SELECT FILING_ID, TAXPER, CASE WHEN substr(TAXPER, 5, 2) IN ('12', '01')
    THEN cast(substr(TAXPER, 1, 4) AS int) ELSE cast(substr(TAXPER, 1, 4) AS int) - 1 END AS STYEAR
  FROM filings)""")
def fiscal_start_year(spark: SparkSession, d: str) -> DataFrame:
    return dt.filings(spark, d).select("FILING_ID", "TAXPER", codes.start_year().alias("STYEAR"),
                                       codes.soi_year().alias("SOIYR"))


# --- I25, I26, I27 -------------------------------------------------------------------
def _gen(names: list[str], base_col: str) -> list[tuple[str, float]]:
    """Extract amounts the benchmark lacks: fixed fractions of one amount."""
    return [(n, (i + 1) / 64) for i, n in enumerate(names)]


_FULL_IN = _gen(["GRSRNTSREAL", "GRSRNTSPRSNL", "RNTLEXPNSREAL", "RNTLEXPNSPRSNL",
                 "GRSINCFNDRSNG", "GRSINCGAMING", "LESSDIRFNDRSNG", "LESSDIRGAMING",
                 "NETINCGAMING", "SALESEXP", "SALEOTHE", "GOODS"], "TOTREV2")
_EZ_IN = _gen(["NETINC", "SALEOTHG", "GOODS", "DUESASSESMNTS", "PRGMSERVREV",
               "GRSINCFNDRSNG", "GRSINCGAMING", "SALEOTHN"], "TOTREV2")
_PF_IN = _gen(["P6ESTTX", "P6TXWTH", "P6TXINV", "P6TXWERR", "P6TEXCTX", "P6TXPNLT",
               "TOTEXCAPLS", "TOTEXCAPGN", "TAXDUE", "OVERPAY"], "ASS_EOY")


def _spark_inputs(df: DataFrame, gen, base_col: str) -> DataFrame:
    return df.withColumns({n: F.col(base_col) * F.lit(k) for n, k in gen})


def _sql_inputs(gen, base_col: str) -> str:
    return ", ".join(f"{base_col} * cast({k!r} AS double) AS {n}" for n, k in gen)


@register("money_full", o.with_ctes(o.FILINGS) + f"""
SELECT FILING_ID, RENTINC, RENTEXP, SPEVTG, DIREXP, FUNDINC, NETINC, TOTREV,
  TOTREV + RNTLEXPNSREAL + RNTLEXPNSPRSNL + SALESEXP + SALEOTHE + LESSDIRFNDRSNG
    + LESSDIRGAMING + GOODS AS GRREC
FROM (SELECT *, EXPS + NETINC AS TOTREV FROM (
  SELECT FILING_ID, EXPS, RNTLEXPNSREAL, RNTLEXPNSPRSNL, SALESEXP, SALEOTHE, LESSDIRFNDRSNG,
    LESSDIRGAMING, GOODS,
    GRSRNTSREAL + GRSRNTSPRSNL AS RENTINC, RNTLEXPNSREAL + RNTLEXPNSPRSNL AS RENTEXP,
    GRSINCFNDRSNG + GRSINCGAMING AS SPEVTG, LESSDIRFNDRSNG + LESSDIRGAMING AS DIREXP,
    NETINCFNDRSNG + NETINCGAMING AS FUNDINC, TOTREV2 - EXPS AS NETINC
  FROM (SELECT *, {_sql_inputs(_FULL_IN, 'TOTREV2')} FROM filings)))""")
def money_full(spark: SparkSession, d: str) -> DataFrame:
    f = _spark_inputs(dt.filings(spark, d), _FULL_IN, "TOTREV2")
    return full_money(f).select("FILING_ID", "RENTINC", "RENTEXP", "SPEVTG", "DIREXP",
                                "FUNDINC", "NETINC", "TOTREV", "GRREC")


@register("money_ez", o.with_ctes(o.FILINGS) + f"""
SELECT FILING_ID, TOTREV, TOTREV + SALEOTHG + DIREXP + GOODS AS GRREC,
  DUESASSESMNTS + PRGMSERVREV AS PROGREV, GRSINCFNDRSNG + GRSINCGAMING AS SPEVTG,
  SALEOTHN AS NETGNLS
FROM (SELECT *, EXPS + NETINC AS TOTREV FROM (
  SELECT *, {_sql_inputs(_EZ_IN, 'TOTREV2')} FROM filings))""")
def money_ez(spark: SparkSession, d: str) -> DataFrame:
    f = _spark_inputs(dt.filings(spark, d), _EZ_IN, "TOTREV2")
    return ez_money(f).select("FILING_ID", "TOTREV", "GRREC", "PROGREV", "SPEVTG", "NETGNLS")


@register("money_pf", o.with_ctes(o.FILINGS) + f"""
SELECT FILING_ID,
  greatest(P6ESTTX + P6TXWTH + P6TXINV + P6TXWERR - P6TEXCTX + P6TXPNLT, 0.0) AS P6TXRFD,
  TOTEXCAPLS + TOTEXCAPGN AS P1NGASTS, TAXDUE - OVERPAY AS TFLD,
  CASE WHEN OVERPAY > TAXDUE THEN OVERPAY ELSE -TAXDUE END AS BALDUOPT
FROM (SELECT *, {_sql_inputs(_PF_IN, 'ASS_EOY')} FROM filings)""")
def money_pf(spark: SparkSession, d: str) -> DataFrame:
    from ..functions.money import pf_balance_due
    f = _spark_inputs(dt.filings(spark, d), _PF_IN, "ASS_EOY")
    return pf_balance_due(pf_money(f)).select("FILING_ID", "P6TXRFD", "P1NGASTS", "TFLD", "BALDUOPT")


# =============================================================================
# Batch 2: lookups, corrections, union/split, history, de-dup variants
# =============================================================================
from ..operators import corrections as corr  # noqa: E402
from ..operators import enrich  # noqa: E402
from . import release as rel  # noqa: E402

_REGISTRY_SQL = """reg_raw AS (
 SELECT lpad(cast(c_custkey AS varchar), 9, '0') AS EIN, cast(c_nationkey % 5 AS varchar) AS ORGANIZATION,
  lpad(cast(c_nationkey * 1000 + c_custkey % 1000 AS varchar), 5, '0') AS ZIP,
  lpad(cast(c_custkey * 7919 % 1000000000 AS varchar), 9, '0') AS ACTIVITY,
  cast(c_custkey % 9 AS varchar) AS AFFILIATION, cast(c_custkey % 2 AS varchar) AS DEDUCTIBILITY,
  concat(repeat('%', cast(c_custkey % 3 AS int)), repeat(' ', cast(c_custkey % 2 AS int)), c_name) AS ICO,
  c_mktsegment AS SORT_NAME, cast(c_custkey % 4 AS varchar) AS FILING_REQ_CD,
  cast(c_nationkey % 3 AS varchar) AS PF_FILING_REQ_CD,
  cast(cast(floor(c_acctbal / 1000) AS int) AS varchar) AS ASSET_CD,
  cast(c_nationkey % 10 AS varchar) AS INCOME_CD,
  CASE WHEN c_acctbal < 0 THEN '2' ELSE '1' END AS STATUS
 FROM customer
 UNION ALL BY NAME
 SELECT lpad(cast(s_suppkey + 500000000 AS varchar), 9, '0') AS EIN, cast(s_nationkey % 5 AS varchar) AS ORGANIZATION,
  lpad(cast(s_nationkey * 1000 AS varchar), 5, '0') AS ZIP,
  lpad(cast(s_suppkey * 104729 % 1000000000 AS varchar), 9, '0') AS ACTIVITY,
  '3' AS AFFILIATION, '1' AS DEDUCTIBILITY, concat('% ', s_name) AS ICO, 'SUPPLIER' AS SORT_NAME,
  '1' AS FILING_REQ_CD, '0' AS PF_FILING_REQ_CD, '1' AS STATUS
 FROM supplier),
reg AS (SELECT EIN, ORGANIZATION AS ORGCD, ZIP, AFFILIATION AS AFCD, DEDUCTIBILITY AS DEDUCTCD,
  ltrim(regexp_replace(ICO, '^%+', '')) AS CONTACT, SORT_NAME AS SEC_NAME,
  FILING_REQ_CD || PF_FILING_REQ_CD AS FRCD, substr(ACTIVITY, 1, 3) AS ACTIV1,
  substr(ACTIVITY, 4, 3) AS ACTIV2, substr(ACTIVITY, 7, 3) AS ACTIV3, STATUS AS EOSTATUS,
  ASSET_CD AS ASS_CODE, INCOME_CD AS INC_CODE FROM reg_raw)"""


@register("registry_shape", o.with_ctes(_REGISTRY_SQL) + "SELECT * FROM reg")
def registry_shape(spark: SparkSession, d: str) -> DataFrame:
    return enrich.registry_shape(dt.registry_raw(spark, d))


_CLASS_SQL = """cls AS (SELECT replace(concat(substr(lpad(cast(c_custkey AS varchar), 9, '0'), 1, 2), '-',
   substr(lpad(cast(c_custkey AS varchar), 9, '0'), 3)), '-', '') AS EIN,
  CASE WHEN c_custkey % 17 <> 0 THEN concat(chr(cast(65 + c_custkey % 26 AS int)),
    lpad(cast(c_custkey % 100 AS varchar), 2, '0')) END AS NTEEFINAL,
  lpad(cast(c_nationkey AS varchar), 5, '0') AS FIPS,
  nullif(cast(c_custkey % 18 AS varchar), '5') AS FNDNCD, c_name AS NAME, c_mktsegment AS CLASSCD
 FROM customer)"""


def _d1(spark: SparkSession, d: str) -> DataFrame:
    f = dt.filings(spark, d).select("FILING_ID", "EIN", "TOTREV2")
    return enrich.enrich_classification(f, dt.classification_master(spark, d))


@register("enrich_left_join", o.with_ctes(o.FILINGS, _CLASS_SQL) + """
SELECT f.FILING_ID, f.EIN, f.TOTREV2, c.NTEEFINAL, c.FIPS, c.FNDNCD, c.NAME, c.CLASSCD
FROM filings f LEFT JOIN cls c ON f.EIN = c.EIN""")
def enrich_left_join(spark: SparkSession, d: str) -> DataFrame:
    return _d1(spark, d)


@register("enrich_broadcast", o.with_ctes(o.FILINGS, _CLASS_SQL) + """,
place AS (SELECT lpad(cast(n_nationkey AS varchar), 5, '0') AS FIPS, n_name AS PMSA, r_name AS MSA_NECH
          FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT f.FILING_ID, f.EIN, c.FIPS, p.PMSA, p.MSA_NECH
FROM filings f LEFT JOIN cls c ON f.EIN = c.EIN LEFT JOIN place p ON c.FIPS = p.FIPS""")
def enrich_broadcast(spark: SparkSession, d: str) -> DataFrame:
    return enrich.enrich_place(_d1(spark, d), dt.place_lookup(spark, d)) \
        .select("FILING_ID", "EIN", "FIPS", "PMSA", "MSA_NECH")


_POSTCARD_SQL = """pc AS (SELECT lpad(cast(user_id AS varchar), 9, '0') AS EIN,
  cast(year(min(ts)) - 24 AS varchar) AS EPOSTCARD FROM events GROUP BY user_id)"""


@register("efile_flag", o.with_ctes(o.FILINGS, _POSTCARD_SQL) + """
SELECT f.FILING_ID, f.EIN, f.FISYR,
  CASE WHEN try_cast(p.EPOSTCARD AS int) = f.FISYR THEN '1' ELSE '0' END AS EPOSTCARD
FROM filings f LEFT JOIN pc p ON f.EIN = p.EIN""")
def efile_flag(spark: SparkSession, d: str) -> DataFrame:
    f = dt.filings(spark, d).select("FILING_ID", "EIN", "FISYR")
    j = enrich.enrich_postcard(f, dt.postcard(spark, d))
    return j.withColumn("EPOSTCARD", enrich.postcard_flag())


@register("enrich_registry", o.with_ctes(o.FILINGS, _REGISTRY_SQL) + """
SELECT f.FILING_ID, f.EIN, r.ORGCD, r.ZIP, r.AFCD, r.DEDUCTCD, r.CONTACT, r.SEC_NAME, r.FRCD,
  r.ACTIV1, r.ACTIV2, r.ACTIV3, r.EOSTATUS
FROM filings f LEFT JOIN reg r ON f.EIN = r.EIN""")
def enrich_registry(spark: SparkSession, d: str) -> DataFrame:
    f = dt.filings(spark, d).select("FILING_ID", "EIN")
    return enrich.enrich_registry(f, enrich.registry_shape(dt.registry_raw(spark, d)), "FULL")


_CORR_SQL = """corr AS (
 SELECT lpad(cast(c_custkey AS varchar), 9, '0') AS EIN, 'drop' AS action,
   '16extractez.dat' AS match_source, NULL::varchar AS match_name, NULL::varchar AS new_ein
 FROM customer WHERE c_acctbal < 0
 UNION ALL
 SELECT lpad(cast(c_custkey AS varchar), 9, '0'), 'rekey', NULL, c_name,
   concat('9', substr(lpad(cast(c_custkey AS varchar), 9, '0'), 2))
 FROM customer WHERE c_acctbal > 9900)"""


@register("corrections", o.with_ctes(o.FILINGS, _CORR_SQL) + """,
kept AS (SELECT * FROM filings f WHERE NOT EXISTS (SELECT 1 FROM corr c WHERE c.action = 'drop'
  AND c.EIN = f.EIN AND (c.match_source IS NULL OR f.SOURCE = c.match_source)
  AND (c.match_name IS NULL OR f.NAME = c.match_name)))
SELECT k.FILING_ID, coalesce(r.new_ein, k.EIN) AS EIN, k.SOURCE, k.NAME
FROM kept k LEFT JOIN corr r ON r.action = 'rekey' AND r.EIN = k.EIN
  AND (r.match_source IS NULL OR k.SOURCE = r.match_source)
  AND (r.match_name IS NULL OR k.NAME = r.match_name)""")
def corrections(spark: SparkSession, d: str) -> DataFrame:
    f = dt.filings(spark, d).select("FILING_ID", "EIN", "SOURCE", "NAME")
    return corr.apply_corrections(f, dt.corrections(spark, d))


@register("form_union_split", o.with_ctes(o.FILINGS, o.base()) + """
SELECT coalesce(FILING_ID, 0) AS FILING_ID, coalesce(EIN, '') AS EIN, coalesce(SUBSECCD, '') AS SUBSECCD,
  coalesce(TOTREV2, 0) AS TOTREV2, coalesce(EXPS, 0) AS EXPS,
  coalesce(NETINCFNDRSNG, 0) AS NETINCFNDRSNG, coalesce(REASON, '') AS REASON,
  coalesce(DIREXP, 0) AS DIREXP, coalesce(Q78A, '') AS Q78A, coalesce(RELEASE, '') AS RELEASE FROM (
  SELECT FILING_ID, EIN, SUBSECCD, TOTREV2, EXPS, NETINCFNDRSNG, ORDPRI AS REASON, RELEASE
  FROM base WHERE SOURCE_KIND = 'EZ'
  UNION ALL BY NAME
  SELECT FILING_ID, EIN, SUBSECCD, TOTREV2, EXPS, DIREXP, ORDSTAT AS Q78A, RELEASE
  FROM base WHERE SOURCE_KIND = 'FULL')""")
def form_union_split(spark: SparkSession, d: str) -> DataFrame:
    """K8: both forms in one pass over the filings; the table a row goes to is a
    column, not another read."""
    from ..functions.amounts import fill_by_type
    b = dt.base(spark, d).filter(F.col("SOURCE_KIND").isin("EZ", "FULL"))
    ez = F.col("SOURCE_KIND") == "EZ"
    return fill_by_type(b.select(
        "FILING_ID", "EIN", "SUBSECCD", "TOTREV2", "EXPS",
        F.when(ez, F.col("NETINCFNDRSNG")).alias("NETINCFNDRSNG"),
        F.when(ez, F.col("ORDPRI")).alias("REASON"),
        F.when(~ez, F.col("DIREXP")).alias("DIREXP"),
        F.when(~ez, F.col("ORDSTAT")).alias("Q78A"),
        filters.release_name().alias("RELEASE")))


@register("prior_year", o.with_ctes(*o.stages_until("py")) + """
SELECT * EXCLUDE (ORDSTAT, ORDPRI, NAME) FROM py""")
def prior_year(spark: SparkSession, d: str) -> DataFrame:
    return rel.prior_joined(spark, d).drop("ORDSTAT", "ORDPRI", "NAME")


@register("backfill_cascade", o.with_ctes(*o.stages_until("bf")) + """
SELECT RELEASE, EIN, FILING_ID, FISYR, SOURCE, VALIDATION_STATE, MANUALLY_FIXED, INPRIOR FROM bf""")
def backfill_cascade(spark: SparkSession, d: str) -> DataFrame:
    return rel.backfilled(spark, d).select("RELEASE", "EIN", "FILING_ID", "FISYR", "SOURCE",
                                           "VALIDATION_STATE", "MANUALLY_FIXED", "INPRIOR")


@register("dedup_year_shift", o.with_ctes(*o.stages_until("dd")) + """
SELECT RELEASE, EIN, FILING_ID, FISYR, FISYRP, SOURCE FROM dd""")
def dedup_year_shift(spark: SparkSession, d: str) -> DataFrame:
    return rel.deduped(spark, d).select("RELEASE", "EIN", "FILING_ID", "FISYR", "FISYRP", "SOURCE")


_PF_VIEW = "TOTREV2 AS P1TOTREV, EXPS AS P1TOTEXP, FUNDBAL AS P2TASFMV, ASS_EOY AS P2TOTAST"


@register("dedup_pf_score", o.with_ctes(o.FILINGS, o.base()) + f"""
SELECT EIN, FILING_ID, FISYR, P1TOTREV, P1TOTEXP, P2TASFMV, P2TOTAST FROM (
  SELECT *, row_number() OVER (PARTITION BY EIN ORDER BY FISYR DESC,
    abs(P1TOTREV) + abs(P1TOTEXP) + greatest(abs(P2TASFMV), abs(P2TOTAST)) DESC,
    STYEAR DESC, FILING_ID DESC) AS rn
  FROM (SELECT EIN, FILING_ID, FISYR, STYEAR, {_PF_VIEW} FROM base WHERE FISYR >= {Y - 2}))
WHERE rn = 1""")
def dedup_pf_score(spark: SparkSession, d: str) -> DataFrame:
    pf = dt.base(spark, d, min_year=Y - 2).selectExpr("EIN", "FILING_ID", "FISYR", "STYEAR",
                                                        *_PF_VIEW.split(", "))
    best = deduplicate(pf, Y, score=pf_size_score(), tiebreak=F.col("FILING_ID"),
                       year_shift=False)
    return best.drop("STYEAR")


# =============================================================================
# Batch 3: rules, flags, fixes, review jobs, links, audit
# =============================================================================
from ..operators import flags as fl  # noqa: E402
from ..operators import review as rv  # noqa: E402
from ..operators import rules  # noqa: E402

TOL = 1000
CHANGE_CUTOFF = 300_000   # revenue cutoff for this data scale (orders top out near 500k)
_RES = [n for n, _ in o.residual_sql()]
_RES_SQL = ", ".join(_RES)


@register("residuals_wide", o.with_ctes(*o.stages_until("res")) + f"""
SELECT RELEASE, EIN, FILING_ID, SOURCE_KIND, {_RES_SQL} FROM res""")
def residuals_wide(spark: SparkSession, d: str) -> DataFrame:
    return rel.validated(spark, d).select("RELEASE", "EIN", "FILING_ID", "SOURCE_KIND", *_RES)


@register("rule_failure_summary", o.with_ctes(*o.stages_until("res")) + f""",
agg AS (SELECT RELEASE, count_if(VALIDATION_STATE <> 2) AS n_rows,
  {", ".join(f"count_if(VALIDATION_STATE <> 2 AND abs({c}) > {TOL}) AS {c}" for c in _RES)}
  FROM res GROUP BY RELEASE)
SELECT RELEASE AS table_name, upper(substr(name, 10)) AS rule, cast(n_failed AS bigint) AS n_failed,
  cast(n_rows AS bigint) AS n_rows,
  CASE WHEN n_rows > 0 THEN cast((2000 * n_failed + n_rows) // (2 * n_rows) AS double) / 10 END AS fail_pct,
  max(n_failed > 0) OVER (PARTITION BY RELEASE) AS table_failed
FROM agg UNPIVOT (n_failed FOR name IN ({_RES_SQL}))""")
def rule_failure_summary(spark: SparkSession, d: str) -> DataFrame:
    return rules.failure_summary(rel.validated_staged(spark, d), TOL, table="RELEASE")


@register("failing_rows", o.with_ctes(*o.stages_until("res")) + f"""
SELECT RELEASE, EIN, FILING_ID, VALIDATION_STATE FROM res
WHERE {o.any_over_sql(_RES, TOL)} AND VALIDATION_STATE <> 2""")
def failing_rows(spark: SparkSession, d: str) -> DataFrame:
    v = rel.validated_staged(spark, d)
    return v.filter(fl.failing_flag(v, TOL)).select("RELEASE", "EIN", "FILING_ID", "VALIDATION_STATE")


@register("largest_rows", o.with_ctes(*o.stages_until("dd")) + """,
cuts AS (SELECT RELEASE, quantile_cont(TOTREV2, 0.999) AS c1, quantile_cont(EXPS, 0.999) AS c2,
  quantile_cont(ASS_EOY, 0.999) AS c3 FROM dd GROUP BY RELEASE)
SELECT d.RELEASE, d.EIN, d.FILING_ID, d.TOTREV2, d.EXPS, d.ASS_EOY FROM dd d JOIN cuts c ON d.RELEASE = c.RELEASE
WHERE (d.TOTREV2 >= c.c1 OR d.EXPS >= c.c2 OR d.ASS_EOY >= c.c3) AND d.VALIDATION_STATE NOT IN (2, 3)""")
def largest_rows(spark: SparkSession, d: str) -> DataFrame:
    dd = rel.validated_staged(spark, d).select("RELEASE", "EIN", "FILING_ID", "TOTREV2", "EXPS",
                                               "ASS_EOY", "VALIDATION_STATE")
    cuts = rel.release_cuts(dd)
    cond = F.lit(False)
    for t, c in cuts.items():
        cond = cond | ((F.col("RELEASE") == t) & fl.largest_flag(c))
    return dd.filter(cond).drop("VALIDATION_STATE")


def _changed_sql(c, p):
    return (f"coalesce(({p} > 0 AND abs({c} - {p}) >= {p} * 0.5) OR ({p} = 0 AND {c} <> 0), false)")


_CHANGED_SQL = (f"({_changed_sql('TOTREV2', 'TOTREVP')} OR {_changed_sql('EXPS', 'EXPSP')} "
                f"OR {_changed_sql('ASS_EOY', 'ASS_BOY')}) AND (coalesce(TOTREV2 >= {CHANGE_CUTOFF}, false) "
                f"OR coalesce(TOTREVP >= {CHANGE_CUTOFF}, false)) AND VALIDATION_STATE NOT IN (2, 3)")


@register("changed_rows", o.with_ctes(*o.stages_until("dd")) + f"""
SELECT RELEASE, EIN, FILING_ID, TOTREV2, TOTREVP, EXPS, EXPSP, ASS_EOY, ASS_BOY FROM dd
WHERE {_CHANGED_SQL}""")
def changed_rows(spark: SparkSession, d: str) -> DataFrame:
    dd = rel.validated_staged(spark, d)
    return dd.filter(fl.changed_flag(cutoff=CHANGE_CUTOFF)).select(
        "RELEASE", "EIN", "FILING_ID", "TOTREV2", "TOTREVP", "EXPS", "EXPSP", "ASS_EOY", "ASS_BOY")


_FAILING_SQL = f"({o.any_over_sql(_RES, TOL)} AND VALIDATION_STATE <> 2)"
_FLAGS_CTE = f""",
cuts AS (SELECT RELEASE, quantile_cont(TOTREV2, 0.999) AS c1, quantile_cont(EXPS, 0.999) AS c2,
  quantile_cont(ASS_EOY, 0.999) AS c3 FROM res GROUP BY RELEASE),
failed AS (SELECT DISTINCT RELEASE FROM res WHERE {_FAILING_SQL}),
fl AS (SELECT r.*, concat(
   CASE WHEN {_CHANGED_SQL} THEN 'C' ELSE '' END,
   CASE WHEN {_FAILING_SQL} AND r.RELEASE IN (SELECT RELEASE FROM failed) THEN 'F' ELSE '' END,
   CASE WHEN (TOTREV2 >= c1 OR EXPS >= c2 OR ASS_EOY >= c3) AND VALIDATION_STATE NOT IN (2, 3)
        THEN 'L' ELSE '' END) AS VALIDATION_REASON
  FROM res r JOIN cuts c ON r.RELEASE = c.RELEASE),
flagged AS (SELECT * FROM fl WHERE VALIDATION_REASON <> '')"""


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    return rel.flagged(rel.validated_staged(spark, d), cutoff=CHANGE_CUTOFF, materialize=False)


@register("review_reasons", o.with_ctes(*o.stages_until("res")) + _FLAGS_CTE + """
SELECT RELEASE, EIN, FILING_ID, VALIDATION_REASON FROM flagged""")
def review_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _flagged(spark, d).select("RELEASE", "EIN", "FILING_ID", "VALIDATION_REASON")


def _released(spark: SparkSession, d: str) -> DataFrame:
    """The de-duplicated release as staged once per session (residual
    columns dropped): operators downstream of de-dup read this table."""
    v = rel.validated_staged(spark, d)
    return v.drop(*rules.residual_columns(v))


def _fixes(spark: SparkSession, d: str, dd: DataFrame) -> DataFrame:
    """Reviewers' fixes: rows of fulfilled orders come back with FUNDBAL
    recomputed (as text, like a saved review file), state 1 and the field
    noted; the class code column is missing from the file.  Supplier keys
    stand for fixes of organisations not in the release."""
    fx = dd.filter(F.col("ORDSTAT") == "F").drop("NTEEFINAL").withColumns({
        "FUNDBAL": (F.col("ASS_EOY") - F.col("LIAB_EOY")).cast("string"),
        "VALIDATION_STATE": F.lit("1"), "MANUALLY_FIXED": F.lit("FUNDBAL")})
    unknown = dt.table(spark, d, "supplier").select(
        F.expr("lpad(cast(s_suppkey + 500000000 as string), 9, '0')").alias("EIN"),
        F.lit("1").alias("FUNDBAL"), F.lit("1").alias("VALIDATION_STATE"))
    return schema.union_by_name([fx, unknown])


@register("apply_fixes", o.with_ctes(*o.stages_until("dd")) + """,
fx AS (SELECT EIN, ASS_EOY - LIAB_EOY AS FUNDBAL FROM dd WHERE ORDSTAT = 'F')
SELECT d.RELEASE, d.EIN, d.FILING_ID, d.TOTREV2,
  CASE WHEN fx.EIN IS NOT NULL THEN fx.FUNDBAL ELSE d.FUNDBAL END AS FUNDBAL,
  CASE WHEN fx.EIN IS NOT NULL THEN NULL ELSE d.NTEEFINAL END AS NTEEFINAL,
  CASE WHEN fx.EIN IS NOT NULL THEN 1 ELSE d.VALIDATION_STATE END AS VALIDATION_STATE,
  CASE WHEN fx.EIN IS NOT NULL THEN 'FUNDBAL' ELSE d.MANUALLY_FIXED END AS MANUALLY_FIXED
FROM dd d LEFT JOIN fx ON d.EIN = fx.EIN""")
def apply_fixes(spark: SparkSession, d: str) -> DataFrame:
    dd = _released(spark, d)
    out = corr.integrate_fixes(dd, _fixes(spark, d, dd), numeric_columns=["FUNDBAL"])
    return out.select("RELEASE", "EIN", "FILING_ID", "TOTREV2", "FUNDBAL", "NTEEFINAL",
                      "VALIDATION_STATE", "MANUALLY_FIXED")


_FINAL_LIST = ["EIN", "FILING_ID", "TAXPER", "FISYR", "TOTREV2", "EXPS", "ASS_EOY", "RELEASE",
               "SOURCE", "NOT_IN_TABLE", "FISYR"]


@register("full_only_release", o.with_ctes(*o.stages_until("dd")) + """
SELECT EIN, FILING_ID, TAXPER, FISYR, TOTREV2, EXPS, ASS_EOY, RELEASE, SOURCE, VALIDATION_STATE,
  MANUALLY_FIXED FROM dd WHERE SOURCE_KIND = 'FULL'""")
def full_only_release(spark: SparkSession, d: str) -> DataFrame:
    dd = _released(spark, d)
    return schema.final_projection(dd.filter(F.col("SOURCE_KIND") == "FULL"), _FINAL_LIST)[0]


_QUEUE_FIELDS = ["FUNDBAL", "EXPS", "CONT"]
_RANK_SQL = "CASE VALIDATION_REASON " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in rv.REASON_RANK.items()) + f" ELSE {len(rv.REASON_RANK) + 1} END"


@register("review_queue", o.with_ctes(*o.stages_until("res")) + _FLAGS_CTE + f"""
SELECT RELEASE, EIN, VALIDATION_REASON, {_RANK_SQL} AS REASON_RANK, TOTREV2, VALIDATION_STATE,
  0.0::double AS fundbal_adjusted_by, '' AS validated_by, '' AS EXPLANATION
FROM flagged WHERE VALIDATION_STATE <> 2 AND (
  {" OR ".join(f"abs(coalesce({c}, 0)) > {TOL}" for c in _RES)} OR VALIDATION_STATE NOT IN (1, 3))""")
def review_queue(spark: SparkSession, d: str) -> DataFrame:
    q = rv.work_queue(_flagged(spark, d), "CO", TOL, fields=["FUNDBAL"])
    return rv.queue_order(q, "CO").select(
        "RELEASE", "EIN", "VALIDATION_REASON", "REASON_RANK", "TOTREV2", "VALIDATION_STATE",
        "fundbal_adjusted_by", "validated_by", "EXPLANATION")


def _pairs_sql() -> str:
    rows = []
    for form in ("EZ", "FULL"):
        rs = rules.rules_for(form)
        for a in rs:
            for b in rs:
                if a.name != b.name and set(a.fields) & set(b.fields):
                    rows.append(f"('{form}', '{a.name.upper()}', '{b.name.upper()}')")
    return "pairs(form, rule, related_rule) AS (VALUES " + ", ".join(rows) + ")"


_FAILS_SQL = f""",
fails AS (SELECT RELEASE, EIN, upper(substr(name, 10)) AS rule, residual,
  CASE WHEN name LIKE 'validate_ez%' THEN 'EZ' WHEN name LIKE 'validate_fu%' THEN 'FULL' ELSE 'PF' END AS form
  FROM (SELECT RELEASE, EIN, {_RES_SQL} FROM res) UNPIVOT (residual FOR name IN ({_RES_SQL}))
  WHERE abs(residual) > {TOL})"""


@register("related_rules", o.with_ctes(*o.stages_until("res")) + _FAILS_SQL + ",\n" + _pairs_sql() + """
SELECT f.RELEASE, f.EIN, f.form, f.rule, p.related_rule FROM fails f
JOIN pairs p ON f.form = p.form AND f.rule = p.rule
WHERE NOT EXISTS (SELECT 1 FROM fails g WHERE g.RELEASE = f.RELEASE AND g.EIN = f.EIN
                  AND g.rule = p.related_rule)""")
def related_rules(spark: SparkSession, d: str) -> DataFrame:
    return rules.related_rules(rel.validated_staged(spark, d), TOL, id_cols=["RELEASE", "EIN"])


# --- L1, L2, L3, L8, A12, C11, D10 ------------------------------------------------------
_ADJ_FIELDS = ["FUNDBAL", "EXPS", "CONT"]
_EXPL_SQL = "CASE expl " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rv.EXPLANATIONS.items()) \
    + " ELSE expl END"


def _adj_sql() -> str:
    rep, extra = [], []
    for f in _ADJ_FIELDS:
        a = f"n_{f}"
        new = f"CASE WHEN {a}.EIN IS NULL THEN r.{f} ELSE coalesce({a}.level, r.{f}) + {a}.delta END"
        rep.append(f"{new} AS {f}")
        extra.append(f"coalesce(({new}) - r.{f}, 0.0) AS {f.lower()}_adjusted_by")
    joins = " ".join(f"LEFT JOIN net n_{f} ON n_{f}.EIN = r.EIN AND n_{f}.field = '{f}'"
                     for f in _ADJ_FIELDS)
    res2 = ", ".join(f"{e} AS {n}" for n, e in o.residual_sql())
    return f""",
adj AS (SELECT d.EIN, CASE l_returnflag WHEN 'R' THEN 'FUNDBAL' WHEN 'A' THEN 'EXPS' ELSE 'CONT' END AS field,
  CASE WHEN l_linenumber = 1 AND l_linestatus = 'F' THEN 'level' ELSE 'delta' END AS action,
  CASE WHEN l_linenumber = 1 AND l_linestatus = 'F' THEN l_extendedprice
       ELSE l_extendedprice * l_discount - l_tax * 100 END AS amount,
  'reviewer' || cast(l_suppkey % 10 AS varchar) AS usr, cast(l_linenumber % 6 AS varchar) AS expl,
  l_shipdate AS ts, l_orderkey * 10 + l_linenumber AS seq
  FROM lineitem JOIN res d ON l_orderkey = d.FILING_ID),
lv AS (SELECT EIN, field, amount AS level, ts AS lts, seq AS lseq FROM (SELECT *, row_number() OVER (
  PARTITION BY EIN, field ORDER BY ts DESC, seq DESC) AS rn FROM adj WHERE action = 'level') WHERE rn = 1),
dl AS (SELECT a.EIN, a.field, round(sum(a.amount), 6) AS delta FROM adj a
  LEFT JOIN lv ON a.EIN = lv.EIN AND a.field = lv.field
  WHERE a.action = 'delta' AND (lv.lts IS NULL OR a.ts > lv.lts OR (a.ts = lv.lts AND a.seq > lv.lseq))
  GROUP BY a.EIN, a.field),
net AS (SELECT k.EIN, k.field, lv.level, coalesce(dl.delta, 0.0) AS delta
  FROM (SELECT DISTINCT EIN, field FROM adj) k LEFT JOIN lv ON k.EIN = lv.EIN AND k.field = lv.field
  LEFT JOIN dl ON k.EIN = dl.EIN AND k.field = dl.field),
who AS (SELECT EIN, usr, expl FROM (SELECT *, row_number() OVER (PARTITION BY EIN ORDER BY ts DESC, seq DESC)
  AS rn FROM adj) WHERE rn = 1),
fe AS (SELECT EIN, field, ts AS fts, seq AS fseq FROM (SELECT *, row_number() OVER (
  PARTITION BY EIN, field ORDER BY ts, seq) AS rn FROM adj) WHERE rn = 1),
chg AS (SELECT EIN, array_to_string(list(field ORDER BY fts, fseq), ' ') AS fixed FROM fe GROUP BY EIN),
adjd AS (SELECT r.* EXCLUDE ({_RES_SQL}) REPLACE ({", ".join(rep)},
    coalesce(chg.fixed, '') AS MANUALLY_FIXED), {", ".join(extra)},
  coalesce(who.usr, '') AS validated_by, coalesce({_EXPL_SQL.replace('expl', 'who.expl')}, '') AS EXPLANATION,
  chg.EIN IS NOT NULL AS ADJUSTED
  FROM res r {joins} LEFT JOIN who ON who.EIN = r.EIN LEFT JOIN chg ON chg.EIN = r.EIN),
res2 AS (SELECT *, {res2} FROM adjd)"""


_ADJ_OUT = ["RELEASE", "EIN", *_ADJ_FIELDS, *[f"{f.lower()}_adjusted_by" for f in _ADJ_FIELDS],
            "MANUALLY_FIXED", "validated_by", "EXPLANATION", "ADJUSTED",
            "validate_ez_ass_eoy", "validate_ez_netinc", "validate_fu_fundbal", "validate_fu_totrev2"]


def _adjusted_plan(spark: SparkSession, d: str) -> DataFrame:
    v = rel.validated_staged(spark, d)
    return rv.apply_adjustments(v, dt.adjustments(spark, d, v), _ADJ_FIELDS,
                                optional=rel.absent_amounts(v))


def _adjusted(spark: SparkSession, d: str) -> DataFrame:
    """The reviewed table, written once per session: state transitions,
    ledger export and reconciliation all read it."""
    from .materialize import stage_once
    return stage_once(lambda: _adjusted_plan(spark, d), spark, (d,), "adjusted")


@register("apply_adjustments", o.with_ctes(*o.stages_until("res")) + _adj_sql() + f"""
SELECT {", ".join(_ADJ_OUT)} FROM res2""")
def apply_adjustments(spark: SparkSession, d: str) -> DataFrame:
    # the reviewed table is written once per session (the first caller pays
    # for the adjustment plan); state transitions and exports read it too
    return _adjusted(spark, d).select(*_ADJ_OUT)


_UNDO = "action IN ('skip', 'reset')"
_UNDO_SQL = ", ".join(
    [f"CASE WHEN {_UNDO} THEN {f} - {f.lower()}_adjusted_by ELSE {f} END AS {f}" for f in _ADJ_FIELDS]
    + [f"CASE WHEN {_UNDO} THEN 0.0 ELSE {f.lower()}_adjusted_by END AS {f.lower()}_adjusted_by"
       for f in _ADJ_FIELDS]
    + [f"CASE WHEN {_UNDO} THEN '' ELSE {c} END AS {c}" for c in ("validated_by", "EXPLANATION")])
_ACTION_SQL = "CASE ORDPRI " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in
                                          dt.ACTION_BY_PRIORITY.items()) + " END"
_WORST_SQL = "greatest(" + ", ".join(f"abs(coalesce({c}, 0))" for c in _RES) + ")"
_STATE_CTE = f""",
st0 AS (SELECT *, {_ACTION_SQL} AS action, {_WORST_SQL} <= {TOL} AS clean, coalesce(ADJUSTED, false) AS ch
  FROM res2),
st1 AS (SELECT *, CASE WHEN action = 'ignore' THEN 2 WHEN action IN ('skip', 'reset') THEN 0
    WHEN action = 'fix_ignore' THEN CASE WHEN ch AND NOT clean THEN 2 WHEN ch THEN 1 END
    WHEN action = 'fix' THEN CASE WHEN ch THEN 1 END
    WHEN action = 'check' THEN CASE WHEN NOT ch AND clean THEN 3 END END AS new FROM st0),
st AS (SELECT * REPLACE ({_UNDO_SQL}), coalesce(new, VALIDATION_STATE) AS NEW_STATE,
  new IS NOT NULL AS ACCEPTED,
  CASE WHEN new IS NOT NULL THEN '' WHEN action IN ('fix', 'fix_ignore') AND NOT ch THEN 'no change made'
       WHEN action = 'check' AND ch THEN 'changes made' WHEN action = 'check' THEN 'residual over threshold'
       ELSE 'unknown action' END AS REJECT_REASON FROM st1)"""


def _states(spark: SparkSession, d: str) -> DataFrame:
    a = _adjusted(spark, d).withColumn("action", dt.reviewer_action())
    return rv.review_state(a, threshold=TOL, fields=_ADJ_FIELDS,
                           optional=rel.absent_amounts(a))


@register("review_state", o.with_ctes(*o.stages_until("res")) + _adj_sql() + _STATE_CTE + """
SELECT RELEASE, EIN, action, NEW_STATE, ACCEPTED, REJECT_REASON FROM st""")
def review_state(spark: SparkSession, d: str) -> DataFrame:
    return _states(spark, d).select("RELEASE", "EIN", "action", "NEW_STATE", "ACCEPTED",
                                    "REJECT_REASON")


@register("ledger_export", o.with_ctes(*o.stages_until("res")) + _adj_sql() + _STATE_CTE + f"""
SELECT EIN, {", ".join(f"{f.lower()}_adjusted_by" for f in _ADJ_FIELDS)}, validated_by, EXPLANATION FROM st
WHERE NEW_STATE > 0 OR coalesce(EXPLANATION <> '', false)""")
def ledger_export(spark: SparkSession, d: str) -> DataFrame:
    s = _states(spark, d).withColumn("VALIDATION_STATE", F.col("NEW_STATE"))
    _fixes_part, ledger = rv.export_review(s, changes_only=True)
    return ledger


@register("saved_work_reconcile", o.with_ctes(*o.stages_until("res")) + _adj_sql() + _STATE_CTE + """,
a AS (SELECT DISTINCT EIN FROM st WHERE NEW_STATE IN (1, 3)),
b AS (SELECT DISTINCT EIN FROM st WHERE EXPLANATION <> '')
SELECT coalesce(a.EIN, b.EIN) AS EIN, a.EIN IS NOT NULL AS in_fixes, b.EIN IS NOT NULL AS in_ledger
FROM a FULL OUTER JOIN b ON a.EIN = b.EIN""")
def saved_work_reconcile(spark: SparkSession, d: str) -> DataFrame:
    s = _states(spark, d).withColumn("VALIDATION_STATE", F.col("NEW_STATE"))
    fixes, _ = rv.export_review(s.filter(F.col("NEW_STATE").isin(1, 3)))
    _, ledger = rv.export_review(s.filter(F.col("EXPLANATION") != ""))
    return rv.reconcile_saved(fixes, ledger)


# --- L9, L6 -----------------------------------------------------------------------------------
def _rule_fields_sql() -> str:
    rows = []
    for r in rules.rules_for("FULL"):
        for f in r.fields:
            rows.append(f"('FULL', '{r.name.upper()}', '{f}', '{r.formula}')")
    return "rf(form, rule, field, formula) AS (VALUES " + ", ".join(rows) + ")"


def _lines_sql() -> str:
    group = {f: g for g, fs in rv.FIELD_GROUPS.items() for f in fs}
    rows = ", ".join(f"('{k}', '{v}', '{group[k]}')" for k, v in rv.FULL_FORM_LINES.items())
    return f"lines(field, form_line, display_group) AS (VALUES {rows})"


_FULL_FIELDS = sorted({f for r in rules.rules_for("FULL") for f in r.fields} & set(o.BASE_NAMES))


@register("field_line_lookup", o.with_ctes(*o.stages_until("res")) + _FAILS_SQL + ",\n"
          + _rule_fields_sql() + ",\n" + _lines_sql() + f""",
vals AS (SELECT RELEASE, EIN, field, value FROM (SELECT RELEASE, EIN, {", ".join(_FULL_FIELDS)} FROM res)
  UNPIVOT (value FOR field IN ({", ".join(_FULL_FIELDS)})))
SELECT f.RELEASE, f.EIN, f.rule, rf.field, v.value, l.form_line, l.display_group,
  rf.formula || ' = ' || cast(cast(round(f.residual) AS bigint) AS varchar) AS explanation
FROM fails f JOIN rf ON f.form = rf.form AND f.rule = rf.rule
LEFT JOIN vals v ON v.RELEASE = f.RELEASE AND v.EIN = f.EIN AND v.field = rf.field
LEFT JOIN lines l ON l.field = rf.field""")
def field_line_lookup(spark: SparkSession, d: str) -> DataFrame:
    return rv.field_lines(rel.validated_staged(spark, d), "FULL", TOL, id_cols=["RELEASE", "EIN"])


# --- I29 ----------------------------------------------------------------------------------------
LINK_BASE = "https://example.org/filings/"


@register("document_links", o.with_ctes(*o.stages_until("dd")) + f"""
SELECT RELEASE, EIN, FILENAME,
  '{LINK_BASE}' || CASE WHEN RELEASE = 'PF' THEN '990pf_pdf_archive' ELSE '990_pdf_archive' END || '/'
    || substr(FILENAME, 1, 3) || '/' || split_part(FILENAME, '_', 1) || '/' || FILENAME || '.pdf' AS LINK,
  '{LINK_BASE}' || CASE WHEN RELEASE = 'PF' THEN '990pf_pdf_archive' ELSE '990_pdf_archive' END || '/'
    || substr(PFN, 1, 3) || '/' || split_part(PFN, '_', 1) || '/' || PFN || '.pdf' AS PRIOR_LINK
FROM (SELECT *, split_part(FILENAME, '_', 1) || '_' || regexp_replace(TAXPERP, '\\.0$', '') || '_'
        || split_part(FILENAME, '_', 3) AS PFN
  FROM (SELECT *, EIN || '_' || TAXPER || '_' || CASE SOURCE_KIND WHEN 'EZ' THEN '990EZ'
          WHEN 'FULL' THEN '990O' WHEN 'PF' THEN '990PF' END AS FILENAME FROM dd))""")
def document_links(spark: SparkSession, d: str) -> DataFrame:
    dd = _released(spark, d).withColumn("FILENAME", codes.file_name(F.col("SOURCE_KIND")))
    return dd.select("RELEASE", "EIN", "FILENAME",
                     codes.document_link(LINK_BASE, F.col("RELEASE")).alias("LINK"),
                     codes.document_link(LINK_BASE, F.col("RELEASE"),
                                         prior_taxper=F.col("TAXPERP")).alias("PRIOR_LINK"))


# --- E8, D9, K5, K6, E9 ----------------------------------------------------------------------
@register("audit_counts", o.with_ctes(*o.stages_until("res")) + _FLAGS_CTE + """,
fx AS (SELECT EIN FROM dd WHERE ORDSTAT = 'F'
       UNION ALL SELECT lpad(cast(s_suppkey + 500000000 AS varchar), 9, '0') FROM supplier),
m AS (
  SELECT 'rows_current' AS metric, count(*) AS value FROM cur_r
  UNION ALL SELECT 'prior_matched', count_if(INPRIOR = '1') FROM py
  UNION ALL SELECT 'rows_backfilled', count_if(SOURCE LIKE 'core%') FROM bf
  UNION ALL SELECT 'rows_after_dedup', count(*) FROM dd
  UNION ALL SELECT 'duplicate_keys_after_dedup', count(*) FROM (
    SELECT RELEASE, EIN FROM dd GROUP BY ALL HAVING count(*) > 1)
  UNION ALL SELECT 'rows_flagged', count(*) FROM flagged
  UNION ALL SELECT 'fixes_with_state', count(*) FROM fx),
f AS (SELECT max(CASE WHEN metric = 'rows_flagged' THEN value END) AS nf,
             max(CASE WHEN metric = 'fixes_with_state' THEN value END) AS nx FROM m)
SELECT metric, cast(value AS bigint) AS value FROM m
UNION ALL SELECT 'hard_stop', CAST(CASE WHEN nf > 0 THEN 1 ELSE 0 END AS bigint) FROM f
UNION ALL SELECT 'publish', CAST(CASE WHEN nf = 0 THEN 1 ELSE 0 END AS bigint) FROM f
UNION ALL SELECT 'publish_partial', CAST(CASE WHEN nf = 0 OR nx > 0 THEN 1 ELSE 0 END AS bigint) FROM f""")
def audit_counts(spark: SparkSession, d: str) -> DataFrame:
    """Row counts per step (E8), the uniqueness check (D9), the fix count
    (E9) and the hard-stop / publication decisions (K5, K6) as one small
    table; every count is an aggregate, nothing is collected row-wise."""
    from functools import reduce
    bf = rel.backfilled(spark, d)
    dd = _released(spark, d)
    flagged = _flagged(spark, d)
    fixes = _fixes(spark, d, dd)

    def one(name, df):
        return df.select(F.lit(name).alias("metric"), F.col("v").cast("bigint").alias("value"))
    # current, matched and backfilled rows in one pass over the backfilled
    # table (backfilled rows carry a core<y> source and no INPRIOR)
    steps = bf.agg(F.count_if(~F.col("SOURCE").startswith("core")).alias("rows_current"),
                   F.count_if(F.col("INPRIOR") == "1").alias("prior_matched"),
                   F.count_if(F.col("SOURCE").startswith("core")).alias("rows_backfilled"))
    steps = steps.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("bigint").alias("value"))
        for n in ("rows_current", "prior_matched", "rows_backfilled")])).alias("s")).select("s.*")
    parts = [
        steps,
        one("rows_after_dedup", dd.agg(F.count(F.lit(1)).alias("v"))),
        one("duplicate_keys_after_dedup",
            dd.groupBy("RELEASE", "EIN").count().filter("count > 1").agg(F.count(F.lit(1)).alias("v"))),
        one("rows_flagged", flagged.agg(F.count(F.lit(1)).alias("v"))),
        one("fixes_with_state", corr.fix_count(fixes).select(F.col("n_fixes").alias("v"))),
    ]
    m = reduce(lambda a, b: a.unionByName(b), parts)
    f = m.agg(F.max(F.when(F.col("metric") == "rows_flagged", F.col("value"))).alias("nf"),
              F.max(F.when(F.col("metric") == "fixes_with_state", F.col("value"))).alias("nx"))
    gates = f.select(F.explode(F.array(
        F.struct(F.lit("hard_stop").alias("metric"),
                 F.when(F.col("nf") > 0, 1).otherwise(0).cast("bigint").alias("value")),
        # K6: a full build publishes without flagged rows, a partial one also with fixes
        F.struct(F.lit("publish").alias("metric"),
                 F.when(F.col("nf") == 0, 1).otherwise(0).cast("bigint").alias("value")),
        F.struct(F.lit("publish_partial").alias("metric"),
                 F.when((F.col("nf") == 0) | (F.col("nx") > 0), 1).otherwise(0).cast("bigint")
                  .alias("value")))).alias("g")).select("g.*")
    return m.unionByName(gates)


# --- J14-J25 (PF rules, applied to every PF row) ----------------------------------------------
_PF_RULE_FIELDS = sorted({f for r in rules.rules_for("PF") for f in r.fields})
_PF_RULE_IN = _gen(_PF_RULE_FIELDS, "TOTREV2")
_PF_RES = [r.column for r in rules.rules_for("PF")]


@register("residuals_pf", o.with_ctes(o.FILINGS) + f"""
SELECT FILING_ID, EIN, {", ".join(f"{e} AS {n}" for n, e in o.residual_sql(("PF",), _PF_RULE_FIELDS, kind=False))}
FROM (SELECT FILING_ID, EIN, {_sql_inputs(_PF_RULE_IN, 'TOTREV2')} FROM filings)""")
def residuals_pf(spark: SparkSession, d: str) -> DataFrame:
    """PF table: every rule applies to every row (no source-kind gate);
    the PF amounts are fixed fractions of the filing's revenue."""
    pf = _spark_inputs(dt.filings(spark, d).select("FILING_ID", "EIN", "TOTREV2"), _PF_RULE_IN,
                       "TOTREV2").drop("TOTREV2")
    return rules.add_residuals(pf, ("PF",), kind_col=None).select("FILING_ID", "EIN", *_PF_RES)


# --- L6 ------------------------------------------------------------------------------------
_ALL_RULE_FIELDS = sorted({f for form in ("EZ", "FULL") for r in rules.rules_for(form)
                           for f in r.fields} & set(o.BASE_NAMES))


def _rule_parts_sql() -> str:
    rows = []
    for form in ("EZ", "FULL"):
        sh = rv.shared_fields(form)
        for r in rules.rules_for(form):
            rows.append(f"('{form}', '{r.name.upper()}', '{r.total}', 0, 1, {str(r.total in sh).lower()})")
            rows += [f"('{form}', '{r.name.upper()}', '{f}', {i + 1}, {sg}, {str(f in sh).lower()})"
                     for i, (sg, f) in enumerate(r.parts)]
    return "rp(form, rule, field, pos, sign, shared) AS (VALUES " + ", ".join(rows) + ")"


@register("failure_text", o.with_ctes(*o.stages_until("res")) + _FAILS_SQL + ",\n" + _rule_parts_sql() + f""",
vals AS (SELECT RELEASE, EIN, field, value FROM (SELECT RELEASE, EIN, {", ".join(_ALL_RULE_FIELDS)} FROM res)
  UNPIVOT (value FOR field IN ({", ".join(_ALL_RULE_FIELDS)}))),
pieces AS (SELECT f.RELEASE, f.EIN, f.rule, f.residual, rp.pos,
  CASE WHEN rp.pos <= 1 THEN '' WHEN rp.sign > 0 THEN ' + ' ELSE ' - ' END || rp.field
    || CASE WHEN rp.shared THEN '*' ELSE '' END || ' [' || format('{{:,.0f}}', coalesce(v.value, 0.0)) || ']' AS piece
  FROM fails f JOIN rp ON f.form = rp.form AND f.rule = rp.rule
  LEFT JOIN vals v ON v.RELEASE = f.RELEASE AND v.EIN = f.EIN AND v.field = rp.field)
SELECT RELEASE, EIN, rule,
  '$' || format('{{:,}}', cast(trunc(residual) AS bigint)) || ' = ' || max(CASE WHEN pos = 0 THEN piece END) || ' - ('
    || coalesce(string_agg(CASE WHEN pos > 0 THEN piece END, '' ORDER BY pos), '') || ')' AS text
FROM pieces GROUP BY RELEASE, EIN, rule, residual""")
def failure_text(spark: SparkSession, d: str) -> DataFrame:
    return rv.failure_text(rel.validated_staged(spark, d), TOL, id_cols=["RELEASE", "EIN"])


# --- L11 -------------------------------------------------------------------------------------
@register("review_header", o.with_ctes(*o.stages_until("res")) + _FLAGS_CTE + """
SELECT EIN, TOTREV2 AS revenue_now, TOTREVP AS revenue_prior, EXPS AS expenses_now,
  EXPSP AS expenses_prior, ASS_EOY AS assets_now, ASS_BOY AS assets_prior FROM flagged""")
def review_header(spark: SparkSession, d: str) -> DataFrame:
    """Now-vs-prior header of every flagged organisation (CO/PC tables)."""
    return rv.current_vs_prior(_flagged(spark, d), "CO")


# --- E7 (+ E4 on a table where keys repeat) ------------------------------------------------------
@register("reasons_grouped", o.with_ctes(*o.stages_until("bf")) + f""",
fl AS (SELECT RELEASE, EIN, FILING_ID,
  {_changed_sql('TOTREV2', 'TOTREVP')} AND VALIDATION_STATE NOT IN (2, 3) AS c,
  coalesce(TOTREV2 >= {CHANGE_CUTOFF}, false) AND VALIDATION_STATE NOT IN (2, 3) AS l FROM bf),
g AS (SELECT RELEASE, EIN, max(c::int) AS fc, max(l::int) AS fl_, min(FILING_ID) AS FILING_ID
  FROM fl GROUP BY RELEASE, EIN)
SELECT RELEASE, EIN, FILING_ID,
  CASE WHEN fc = 1 THEN 'C' ELSE '' END || CASE WHEN fl_ = 1 THEN 'L' ELSE '' END AS VALIDATION_REASON
FROM g WHERE fc = 1 OR fl_ = 1""")
def reasons_grouped(spark: SparkSession, d: str) -> DataFrame:
    """Reason letters OR-ed per key, one representative row (lowest filing
    id) per key, on the backfilled table where an EIN still repeats."""
    bf = rel.backfilled(spark, d)
    big = F.coalesce(F.col("TOTREV2") >= CHANGE_CUTOFF, F.lit(False)) & fl.reviewable()
    out = fl.flag_rows_grouped(bf.select("RELEASE", "EIN", "FILING_ID", "TOTREV2", "TOTREVP",
                                         "VALIDATION_STATE"),
                               {"C": _revenue_change(), "L": big}, order=["FILING_ID"],
                               key=["RELEASE", "EIN"])
    return out.select("RELEASE", "EIN", "FILING_ID", "VALIDATION_REASON")


def _revenue_change():
    p, c = F.col("TOTREVP"), F.col("TOTREV2")
    e = ((p > 0) & (F.abs(c - p) >= p * 0.5)) | ((p == 0) & (c != 0))
    return F.coalesce(e, F.lit(False)) & fl.reviewable()


# --- D11 -------------------------------------------------------------------------------------
@register("restore_saved_rows", o.with_ctes(*o.stages_until("res")) + _FLAGS_CTE + _adj_sql()
          + _STATE_CTE + """,
sv AS (SELECT * FROM st WHERE NEW_STATE IN (1, 3))
SELECT f.RELEASE, f.EIN,
  CASE WHEN sv.EIN IS NOT NULL THEN sv.FUNDBAL ELSE f.FUNDBAL END AS FUNDBAL,
  CASE WHEN sv.EIN IS NOT NULL THEN sv.EXPS ELSE f.EXPS END AS EXPS,
  CASE WHEN sv.EIN IS NOT NULL THEN sv.CONT ELSE f.CONT END AS CONT,
  CASE WHEN sv.EIN IS NOT NULL THEN sv.NEW_STATE ELSE f.VALIDATION_STATE END AS VALIDATION_STATE
FROM flagged f LEFT JOIN sv ON f.EIN = sv.EIN""")
def restore_saved_rows(spark: SparkSession, d: str) -> DataFrame:
    """Resume a review: saved rows (fixed or checked in an earlier session)
    replace the freshly flagged rows by EIN."""
    s = _states(spark, d).withColumn("VALIDATION_STATE", F.col("NEW_STATE"))
    saved, _ledger = rv.export_review(s.filter(F.col("NEW_STATE").isin(1, 3)))
    restored, _gone = rv.restore_saved(_flagged(spark, d), saved)
    return restored.select("RELEASE", "EIN", "FUNDBAL", "EXPS", "CONT", "VALIDATION_STATE")


from . import job_queries  # noqa: E402,F401  (registers the queries of the jobs)
