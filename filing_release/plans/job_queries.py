"""Registered queries of the yearly jobs: checked scans, published releases and
replayed review logs, over files and logs derived from the benchmark tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import review_log, rules
from ..session import ensure_checkpoint_dir
from ..sources import driver_tables as dt
from ..sources.extracts import EXTRACT_DELIMITER
from ..sources.scan import Scan, checked_scan, reject_counts
from . import oracle as o
from . import release as rel
from .queries import register

FILES = 8


def _extract_files(spark: SparkSession, d: str) -> str:
    """A folder of raw extract files, one line per order: even files order the
    columns one way, odd files the other way in lower case; some lines have a
    token too many, some one too few."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/extracts/{uuid.uuid4().hex[:12]}"
    key = F.col("o_orderkey")
    row = dt.table(spark, d, "orders").select(
        (key % FILES).alias("file"), key.alias("n"),
        F.expr("lpad(cast(o_custkey as string), 9, '0')").alias("ein"),
        F.date_format("o_orderdate", "yyyyMM").alias("per"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("rev"),
        F.expr("case when o_custkey % 5 = 0 then 'NA' else "
               "cast(o_custkey % 18 as string) end").alias("sub"))
    even = F.concat_ws(" ", "ein", "per", "rev", "sub")
    odd = F.concat_ws(" ", "sub", "rev", "ein", "per")
    short = F.when(F.col("file") % 2 == 0, F.concat_ws(" ", "ein", "per", "rev")) \
        .otherwise(F.concat_ws(" ", "sub", "rev", "ein"))
    full = F.when(F.col("file") % 2 == 0, even).otherwise(odd)
    n = F.col("n")
    line = F.when(n % 40 == 3, F.concat(full, F.lit(" extra"))) \
        .when(n % 40 == 7, short).otherwise(full)
    lines = row.select("file", "n", line.alias("value"))
    heads = spark.range(FILES).select(
        F.col("id").alias("file"), F.lit(-1).cast("long").alias("n"),
        F.when(F.col("id") % 2 == 0, "EIN TAXPER TOTREV SUBCD")
         .otherwise("subcd totrev ein taxper").alias("value"))
    (lines.unionByName(heads).repartition("file").sortWithinPartitions("file", "n")
     .select("file", "value").write.partitionBy("file").text(path))
    return path


def _scan(spark: SparkSession, d: str) -> Scan:
    return checked_scan(spark, _extract_files(spark, d), EXTRACT_DELIMITER,
                        on_bad="quarantine", required=["EIN"])


_SCAN_SQL = """
SELECT o_orderkey, lpad(cast(o_custkey AS varchar), 9, '0') AS EIN,
  strftime(o_orderdate, '%Y%m') AS TAXPER, cast(cast(o_totalprice AS decimal(18,2)) AS varchar) AS TOTREV,
  CASE WHEN o_custkey % 5 = 0 THEN 'NA' ELSE cast(o_custkey % 18 AS varchar) END AS SUBCD FROM orders"""


@register("extract_scan", f"""SELECT EIN, TAXPER, TOTREV, SUBCD FROM ({_SCAN_SQL})
WHERE o_orderkey % 40 NOT IN (3, 7)""")
def extract_scan(spark: SparkSession, d: str) -> DataFrame:
    return _scan(spark, d).rows.select("EIN", "TAXPER", "TOTREV", "SUBCD")


@register("extract_rejects", f"""
SELECT cast(o_orderkey % {FILES} AS int) AS file_no, count_if(o_orderkey % 40 = 7) AS n_short,
  count_if(o_orderkey % 40 = 3) AS n_long
FROM orders WHERE o_orderkey % 40 IN (3, 7) GROUP BY 1""")
def extract_rejects(spark: SparkSession, d: str) -> DataFrame:
    counts = reject_counts(_scan(spark, d).rejects)
    return counts.select(F.regexp_extract("file", "file=([0-9]+)", 1).cast("int").alias("file_no"),
                         "n_short", "n_long")


# --- L1-L3, L10, D10, D11: a review log replayed ---------------------------------------------
REPLAY_FIELDS = ["FUNDBAL", "CONT"]


def _review_rows(spark: SparkSession, d: str) -> DataFrame:
    """The validated release with the amounts that make most rows add up; every
    fourth row is left with residuals."""
    v = rel.validated_staged(spark, d)
    tidy = F.col("FILING_ID") % 4 != 0
    ez = F.col("SOURCE_KIND") == "EZ"
    v = v.withColumns({
        "GRSINCFNDRSNG": F.when(tidy & ez, F.col("NETINCFNDRSNG") + F.col("DIREXP"))
                          .when(tidy, F.col("NETINCFNDRSNG")).otherwise(0.0),
        "PROGREV": F.when(tidy, F.col("TOTREV2") - F.col("CONT") - F.col("NETINCFNDRSNG"))
                    .otherwise(0.0),
        "PRGMSERVREV": F.when(tidy, F.col("TOTREV") - F.col("CONT") - F.col("NETINCFNDRSNG"))
                        .otherwise(0.0)})
    return v.drop(*[c for c in v.columns if c.startswith("validate_")])


def _review_events(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    """Two rounds: line items are edits and resets, every row may close a round."""
    li = dt.table(spark, d, "lineitem")
    r = rows.select("FILING_ID", "EIN", "ASS_EOY", "LIAB_EOY")
    n, back = F.col("l_linenumber"), F.col("l_returnflag") == "R"
    rnd = F.when(n <= 3, 1).otherwise(2)
    edits = li.join(r, li["l_orderkey"] == r["FILING_ID"]) \
        .where((rnd == 1) & (F.col("FILING_ID") % 3 != 1) | (rnd == 2) & (F.col("FILING_ID") % 3 != 2))
    edits = edits.select(
        "EIN", rnd.alias("round"), F.expr("timestamp'2000-01-01 00:00:00'").alias("ts"),
        n.cast("long").alias("seq"),
        F.when(n.isin(2, 5) & back, "reset").when(n == 7, "mend")
         .when((n == 6) | ((n == 1) & (F.col("l_returnflag") == "A")), "level").otherwise("delta").alias("kind"),
        F.when(n.isin(2, 5, 6), " cont ").otherwise("FundBal").alias("field"),
        F.when(n == 1, F.when(F.col("l_returnflag") == "A", F.col("ASS_EOY") - F.col("LIAB_EOY"))
               .otherwise(F.col("l_tax") * 10000))
         .when(n == 3, F.round(F.col("l_discount") * 1000)).when(n == 4, -F.col("l_quantity"))
         .when(n == 6, F.col("l_extendedprice")).otherwise(F.col("l_quantity") * 10)
         .cast("double").alias("amount"),
        F.lit("reviewer").alias("user"), F.lit("5").alias("explanation"))
    k = F.pmod(F.col("FILING_ID") + 2 * F.col("round"), F.lit(6))
    kinds = F.array(*[F.lit(a) for a in ("fix", "fix_ignore", "check", "ignore", "skip")])
    closing = rows.select("EIN", "FILING_ID", F.explode(F.array(F.lit(1), F.lit(2))).alias("round")) \
        .where(k < 5).select(
            "EIN", "round", F.expr("timestamp'2000-01-02 00:00:00'").alias("ts"),
            F.lit(0).cast("long").alias("seq"), F.get(kinds, k.cast("int")).alias("kind"),
            F.lit(None).cast("string").alias("field"), F.lit(None).cast("double").alias("amount"),
            F.lit(None).cast("string").alias("user"), F.lit(None).cast("string").alias("explanation"))
    return edits.unionByName(closing)


def _replayed(spark: SparkSession, d: str) -> review_log.Review:
    rows = _review_rows(spark, d)
    return review_log.replay(rows, _review_events(spark, d, rows), REPLAY_FIELDS,
                             optional=rel.absent_amounts(rows))


def _replay_sql() -> str:
    """The two rounds one after the other, spelled out."""
    sql = [*o.stages_until("dd"), """
r0 AS (SELECT *, CASE WHEN FILING_ID % 4 = 0 THEN 0.0 WHEN SOURCE_KIND = 'EZ' THEN NETINCFNDRSNG + DIREXP
         ELSE NETINCFNDRSNG END AS GRSINCFNDRSNG,
    CASE WHEN FILING_ID % 4 = 0 THEN 0.0 ELSE TOTREV2 - CONT - NETINCFNDRSNG END AS PROGREV,
    CASE WHEN FILING_ID % 4 = 0 THEN 0.0 ELSE TOTREV - CONT - NETINCFNDRSNG END AS PRGMSERVREV,
    FUNDBAL AS FUNDBAL_0, CONT AS CONT_0, VALIDATION_STATE AS state_0, '' AS fixed_0, 0 AS n_acc_0
  FROM dd)""", """
ev AS (SELECT EIN, CASE WHEN l_linenumber <= 3 THEN 1 ELSE 2 END AS rnd, l_linenumber AS seq,
    CASE WHEN l_linenumber IN (2, 5) AND l_returnflag = 'R' THEN 'reset' WHEN l_linenumber = 7 THEN 'mend'
         WHEN l_linenumber = 6 OR (l_linenumber = 1 AND l_returnflag = 'A') THEN 'level' ELSE 'delta' END AS kind,
    CASE WHEN l_linenumber IN (2, 5, 6) THEN 'CONT' ELSE 'FUNDBAL' END AS field,
    CASE l_linenumber
      WHEN 1 THEN CASE WHEN l_returnflag = 'A' THEN ASS_EOY - LIAB_EOY ELSE l_tax * 10000 END
      WHEN 3 THEN round(l_discount * 1000) WHEN 4 THEN -l_quantity WHEN 6 THEN l_extendedprice
      ELSE l_quantity * 10 END AS amount
  FROM lineitem JOIN r0 ON l_orderkey = FILING_ID
  WHERE (l_linenumber <= 3 AND FILING_ID % 3 <> 1) OR (l_linenumber > 3 AND FILING_ID % 3 <> 2))"""]
    for n in (1, 2):
        p = n - 1
        sql.append(f"""
rs{n} AS (SELECT EIN, max(CASE WHEN kind = 'reset' THEN seq END) AS cut FROM ev WHERE rnd = {n} GROUP BY EIN),
ed{n} AS (SELECT ev.* FROM ev LEFT JOIN rs{n} USING (EIN) WHERE rnd = {n} AND kind IN ('level', 'delta')
  AND seq > coalesce(cut, -1)),
lv{n} AS (SELECT EIN, field, min(seq) AS first, max(CASE WHEN kind = 'level' THEN seq END) AS lseq FROM ed{n}
  GROUP BY EIN, field),
nt{n} AS (SELECT l.EIN, l.field, l.first, max(CASE WHEN e.kind = 'level' AND e.seq = lseq THEN e.amount END) AS level,
  coalesce(round(sum(CASE WHEN e.kind = 'delta' AND e.seq > coalesce(lseq, -1) THEN e.amount END), 6), 0) AS delta
  FROM lv{n} l JOIN ed{n} e ON e.EIN = l.EIN AND e.field = l.field GROUP BY l.EIN, l.field, l.first),
pv{n} AS (SELECT EIN, {", ".join(f"max(CASE WHEN field = '{f}' THEN 1 END) AS has_{f}, max(CASE WHEN field = '{f}' THEN level END) AS lv_{f}, max(CASE WHEN field = '{f}' THEN delta END) AS d_{f}" for f in REPLAY_FIELDS)},
  list(field ORDER BY first, field) AS changed FROM nt{n} GROUP BY EIN),
t{n} AS (SELECT r.*, changed IS NOT NULL AS edited, changed,
    CASE (FILING_ID + {2 * n}) % 6 WHEN 0 THEN 'fix' WHEN 1 THEN 'fix_ignore' WHEN 2 THEN 'check'
      WHEN 3 THEN 'ignore' WHEN 4 THEN 'skip' END AS act,
    {", ".join(f"CASE WHEN has_{f} = 1 THEN coalesce(lv_{f}, {f}_{p}) + d_{f} ELSE {f}_{p} END AS new_{f}" for f in REPLAY_FIELDS)}
  FROM r{p} r LEFT JOIN pv{n} USING (EIN)),
u{n} AS (SELECT *, CASE WHEN SOURCE_KIND = 'FULL' THEN greatest(abs(NETINCFNDRSNG - GRSINCFNDRSNG),
      abs(TOTREV2 - (new_CONT + PROGREV + NETINCFNDRSNG)), abs(new_FUNDBAL - (ASS_EOY - LIAB_EOY)))
    WHEN SOURCE_KIND = 'EZ' THEN greatest(abs(NETINCFNDRSNG - (GRSINCFNDRSNG - DIREXP)),
      abs(TOTREV - (new_CONT + PRGMSERVREV + NETINCFNDRSNG)), abs(NETINC - (TOTREV - EXPS)),
      abs(ASS_EOY - (LIAB_EOY + new_FUNDBAL))) ELSE 0 END <= 1000 AS clean FROM t{n}),
w{n} AS (SELECT *, CASE act WHEN 'ignore' THEN 2 WHEN 'skip' THEN 0 WHEN 'fix' THEN CASE WHEN edited THEN 1 END
    WHEN 'fix_ignore' THEN CASE WHEN edited AND clean THEN 1 WHEN edited THEN 2 END
    WHEN 'check' THEN CASE WHEN clean AND NOT edited THEN 3 END END AS st{n} FROM u{n}),
r{n} AS (SELECT * EXCLUDE (edited, changed, act, clean, new_FUNDBAL, new_CONT),
    act AS act_{n}, edited AS edited_{n}, clean AS clean_{n}, coalesce(st{n}, state_{p}) AS state_{n},
    n_acc_{p} + CASE WHEN st{n} IS NOT NULL THEN 1 ELSE 0 END AS n_acc_{n},
    {", ".join(f"CASE WHEN st{n} IS NOT NULL AND act <> 'skip' THEN new_{f} ELSE {f}_{p} END AS {f}_{n}" for f in REPLAY_FIELDS)},
    CASE WHEN st{n} IS NOT NULL AND act <> 'skip' AND edited
      THEN trim(fixed_{p} || ' ' || array_to_string(list_filter(changed,
           lambda x: NOT list_contains(string_split(fixed_{p}, ' '), x)), ' ')) ELSE fixed_{p} END AS fixed_{n}
  FROM w{n})""")
    return o.with_ctes(*sql)


@register("review_replay", _replay_sql() + """
SELECT RELEASE, EIN, FUNDBAL_2 AS FUNDBAL, CONT_2 AS CONT, FUNDBAL_2 - FUNDBAL AS fundbal_adjusted_by,
  CONT_2 - CONT AS cont_adjusted_by, state_2 AS VALIDATION_STATE, fixed_2 AS MANUALLY_FIXED,
  n_acc_2 AS n_accepted FROM r2""")
def review_replay(spark: SparkSession, d: str) -> DataFrame:
    return _replayed(spark, d).rows.select(
        "RELEASE", "EIN", "FUNDBAL", "CONT", "fundbal_adjusted_by", "cont_adjusted_by",
        "VALIDATION_STATE", "MANUALLY_FIXED",
        F.size(F.filter("ROUNDS", lambda r: r["accepted"])).alias("n_accepted"))


_OUTCOME_SQL = "CASE " + " ".join(f"""
  WHEN rnd = {n} AND act_{n} = 'skip' THEN 'skipped'
  WHEN rnd = {n} AND st{n} IS NULL AND act_{n} IN ('fix', 'fix_ignore') THEN 'rejected: no change made'
  WHEN rnd = {n} AND st{n} IS NULL AND edited_{n} THEN 'rejected: changes made'
  WHEN rnd = {n} AND st{n} IS NULL THEN 'rejected: residual over threshold'""" for n in (1, 2)) + " END"


@register("review_unapplied", _replay_sql() + f""",
e AS (SELECT ev.EIN, ev.rnd, ev.kind, CASE WHEN kind = 'mend' THEN 'unknown kind'
    WHEN (CASE WHEN rnd = 1 THEN act_1 ELSE act_2 END) IS NULL AND kind <> 'reset' THEN 'round not closed'
    WHEN kind <> 'reset' AND seq <= cut THEN 'reset'
    WHEN kind <> 'reset' THEN {_OUTCOME_SQL} END AS outcome
  FROM (SELECT *, max(CASE WHEN kind = 'reset' THEN seq END) OVER (PARTITION BY EIN, rnd) AS cut
        FROM ev) ev JOIN r2 USING (EIN)),
c AS (SELECT EIN, rnd, CASE rnd WHEN 1 THEN act_1 ELSE act_2 END AS kind,
    CASE WHEN (CASE rnd WHEN 1 THEN act_1 ELSE act_2 END) <> 'skip' THEN {_OUTCOME_SQL} END AS outcome
  FROM r2, (VALUES (1), (2)) v(rnd))
SELECT cast(rnd AS int) AS round, kind, outcome, count(*) AS n FROM (SELECT EIN, rnd, kind, outcome FROM e
  UNION ALL SELECT EIN, rnd, kind, outcome FROM c WHERE kind IS NOT NULL)
WHERE outcome IS NOT NULL GROUP BY ALL""")
def review_unapplied(spark: SparkSession, d: str) -> DataFrame:
    return _replayed(spark, d).unapplied.groupBy("round", "kind", "outcome").agg(
        F.count(F.lit(1)).alias("n"))


# --- J1-J13, J26-J31 on amounts that vary -----------------------------------------------------
# Fixed values of the view: the amounts EZ and Full rules read, in alphabetical order; amount k is
# line item k % 7 + 1 of the order, as price, discount, tax or quantity by k % 4, plus k.
RULE_AMOUNTS = rules.rule_fields(("EZ", "FULL"), include_inactive=True)


def _varied(spark: SparkSession, d: str) -> DataFrame:
    li = dt.table(spark, d, "lineitem")
    price, n = F.col("l_extendedprice"), F.col("l_linenumber")
    kinds = [price, price * F.col("l_discount"), price * F.col("l_tax"), F.col("l_quantity") * 100]
    per = li.groupBy("l_orderkey").agg(*[
        F.coalesce(F.max(F.when(n == i + 1, kinds[j].cast("double"))), F.lit(0.0)).alias(f"v{i}{j}")
        for i in range(7) for j in range(4)])
    kind = F.when(F.col("l_orderkey") % 2 == 0, "EZ").otherwise("FULL")
    return per.select("l_orderkey", kind.alias("SOURCE_KIND"), *[
        (F.col(f"v{k % 7}{k % 4}") + k).alias(f) for k, f in enumerate(RULE_AMOUNTS)])


def _varied_sql() -> str:
    kinds = ["l_extendedprice", "l_extendedprice * l_discount", "l_extendedprice * l_tax",
             "l_quantity * 100"]
    inner = ", ".join(f"coalesce(max(CASE WHEN l_linenumber = {i + 1} THEN CAST({kinds[j]} AS DOUBLE) END), 0)"
                      f" AS v{i}{j}" for i in range(7) for j in range(4))
    outer = ", ".join(f"v{k % 7}{k % 4} + {k} AS {f}" for k, f in enumerate(RULE_AMOUNTS))
    return (f"per AS (SELECT l_orderkey, {inner} FROM lineitem GROUP BY l_orderkey),\n"
            f"varied AS (SELECT l_orderkey, l_orderkey % 2 = 0 AS ez, {outer} FROM per)")


# The rules once more, as a form reads: written out, so that a wrong rule on one side shows.
_RULES_SQL = {
    "ez_saleothn": "SALEOTHN - (SALEOTHG - SALEOTHE)",
    "ez_netincfndrsng": "NETINCFNDRSNG - (GRSINCGAMING + GRSINCFNDRSNG - DIREXP)",
    "ez_grprof": "GRPROF - (INVENTG - GOODS)",
    "ez_totrev": "TOTREV - (CONT + PRGMSERVREV + DUESASSESMNTS + INVINC + SALEOTHN + NETINCFNDRSNG"
                 " + GRPROF + OTHINC)",
    "ez_netinc": "NETINC - (TOTREV - EXPS)",
    "ez_ass_eoy": "ASS_EOY - (LIAB_EOY + FUNDBAL)",
    "fu_netrent": "NETRENT - (RNTLINCREAL + RNTLINCPRSNL)",
    "fu_netgnls": "NETGNLS - (SALESECN + SALEOTHN)",
    "fu_netincfndrsng": "NETINCFNDRSNG - (GRSINCFNDRSNG - LESSDIRFNDRSNG)",
    "fu_netincgaming": "NETINCGAMING - (GRSINCGAMING - LESSDIRGAMING)",
    "fu_grprof": "GRPROF - (INVENTG - GOODS)",
    "fu_othinc": "OTHINC - (MISCREVTOTA + MISCREVTOT11B + MISCREVTOT11C + MISCREVTOT11D)",
    "fu_totrev2": "TOTREV2 - (CONT + PROGREV + INVINC + TXEXMPTBNDSPROCEEDS + ROYALTSINC + NETRENT"
                  " + NETGNLS + NETINCFNDRSNG + NETINCGAMING + GRPROF + OTHINC)",
    "fu_progrev": "PROGREV - (TOTREV2ACOLA + TOTREV2BCOLA + TOTREV2CCOLA + TOTREV2DCOLA"
                  " + TOTREV2ECOLA + TOTREV2FCOLA)",
    "fu_fundbal": "FUNDBAL - (ASS_EOY - LIAB_EOY)",
    "fu_exps": "EXPS - (GRNTSTOGOVT + GRNSTTOINDIV + GRNTSTOFRGNGOVT + BENIFITSMEMBRS + COMPENS"
               " + COMPNSATNANDOTHR + OTHSAL + PENSIONPLANCONTRB + OTHREMPLYEEBENEF + PAYTAX"
               " + FEESFORSRVCMGMT + LEGALFEES + ACCNTINGFEES + FEESFORSRVCLOBBY + FUNDFEES"
               " + FEESFORSRVCINVSTMGMT + FEESFORSRVCOTHR + ADVRTPROMO + OFFICEXPNS + INFOTECH"
               " + ROYALTSEXPNS + OCCUPANCY + TRAVEL + TRAVELOFPUBLICOFFCL + CONVERCONVENTMTNG"
               " + INTERESTAMT + PYMTOAFFILIATES + DEPRCATNDEPLETN + INSURANCE + OTHREXPNSA"
               " + OTHREXPNSB + OTHREXPNSC + OTHREXPNSD + OTHREXPNSE + OTHREXPNSF)",
    "fu_ass_eoy": "ASS_EOY - (NONINTCASHEND + SVNGSTEMPINVEND + PLDGEGRNTRCVBLEND + ACCNTSRCVBLEND"
                  " + CURRFRMRCVBLEND + RCVBLDISQUALEND + NOTESLOANSRCVBLEND + INVNTRIESALESEND"
                  " + PREPAIDEXPNSEND + LNDBLDGSEQUIPEND + INVSTMNTSEND + INVSTMNTSOTHREND"
                  " + INVSTMNTSPRGMEND + INTANGIBLEASSETSEND + OTHRASSETSEND)",
    "fu_liab_eoy": "LIAB_EOY - (ACCNTSPAYABLEEND + GRNTSPAYABLEEND + DEFEREDREVNUEND + BOND_EOY"
                   " + ESCRWACCNTLIABEND + PAYBLETOFFCRSEND + MRTG_EOY + UNSECUREDNOTESEND"
                   " + OTHRLIABEND)",
    "fu_totnetliabastend": "TOTNETLIABASTEND - (LIAB_EOY + FUNDBAL)",
}


@register("residuals_varied", "WITH " + _varied_sql() + "\nSELECT l_orderkey, " + ", ".join(
    f"CASE WHEN {'ez' if name.startswith('ez') else 'NOT ez'} THEN {e} END AS validate_{name}"
    for name, e in _RULES_SQL.items()) + " FROM varied")
def residuals_varied(spark: SparkSession, d: str) -> DataFrame:
    """Every EZ and Full rule, the ones that are switched off too, over amounts
    that all differ: no residual is constant."""
    out = rules.add_residuals(_varied(spark, d), ("EZ", "FULL"), include_inactive=True)
    return out.select("l_orderkey", *rules.residual_columns(out))
