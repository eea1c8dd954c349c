"""DuckDB twins of the driver-table views (for the correctness oracles).

Each function returns the body of one CTE; ``with_ctes`` joins them.  The
definitions mirror ``sources.driver_tables`` line for line.
"""

from __future__ import annotations

Y = 2000

FILINGS = """
li AS (SELECT l_orderkey, sum(l_extendedprice) AS gross, sum(l_extendedprice * l_discount) AS disc
       FROM lineitem GROUP BY l_orderkey),
filings AS (
 SELECT o_orderkey AS FILING_ID, lpad(cast(o_custkey AS varchar), 9, '0') AS EIN,
  strftime(o_orderdate, '%Y%m') AS TAXPER, cast(year(o_orderdate) AS int) AS FISYR,
  CASE o_orderkey % 3 WHEN 0 THEN '16extractez.dat' WHEN 1 THEN '16extract990.dat'
       ELSE '15extract990.dat.dat' END AS SOURCE,
  CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN '03' WHEN c_mktsegment = 'HOUSEHOLD' THEN '92'
       WHEN c_mktsegment = 'FURNITURE' THEN '04' END AS SUBSECCD,
  nullif(cast(o_custkey % 18 AS varchar), '5') AS FNDNCD,
  CASE WHEN o_custkey % 17 <> 0 THEN concat(chr(cast(65 + o_custkey % 26 AS int)),
       lpad(cast(o_custkey % 100 AS varchar), 2, '0')) END AS NTEEFINAL,
  o_totalprice AS TOTREV2, round(coalesce(gross, 0), 2) AS CONT, round(coalesce(disc, 0), 4) AS DIREXP,
  round(coalesce(gross, 0) - coalesce(disc, 0), 4) AS NETINCFNDRSNG, round(o_totalprice * 0.9, 3) AS EXPS,
  c_acctbal * 1000 AS ASS_EOY, c_acctbal * 400 AS LIAB_EOY,
  c_acctbal * 600 + (o_orderkey % 7) * 500 AS FUNDBAL,
  o_orderstatus AS ORDSTAT, o_orderpriority AS ORDPRI, c_name AS NAME
 FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN li ON l_orderkey = o_orderkey)"""

KIND = ("CASE WHEN upper(split_part(SOURCE, '.', 1)) LIKE '%EZ' THEN 'EZ' "
        "WHEN upper(split_part(SOURCE, '.', 1)) LIKE '%990' THEN 'FULL' "
        "WHEN upper(split_part(SOURCE, '.', 1)) LIKE '%PF' THEN 'PF' END")

BASE_COLS = f"""*, TOTREV2 - EXPS AS NETINC, EXPS + (TOTREV2 - EXPS) AS TOTREV,
  CASE WHEN substr(TAXPER, 5, 2) IN ('12', '01') THEN FISYR ELSE FISYR - 1 END AS STYEAR,
  {KIND} AS SOURCE_KIND,
  CASE WHEN SUBSECCD IS NOT DISTINCT FROM '03' THEN 'PC' ELSE 'CO' END AS RELEASE,
  0 AS VALIDATION_STATE, '' AS MANUALLY_FIXED"""

SCORE = "abs(TOTREV) + abs(ASS_EOY) + abs(EXPS)"


def base(name: str = "base", where: str = "TRUE") -> str:
    return f"{name} AS (SELECT {BASE_COLS} FROM filings WHERE {where})"


def prior(year: int, name: str | None = None) -> str:
    name = name or f"prior_{year}"
    return f"""{name} AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY RELEASE, EIN ORDER BY {SCORE} DESC, STYEAR DESC,
         FILING_ID DESC) AS rn
  FROM (SELECT {BASE_COLS} FROM filings WHERE FISYR = {year})) WHERE rn = 1)"""


def current(name: str = "cur", year: int = Y) -> str:
    return base(name, f"FISYR >= {year}")


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


REVIEWED_STATE = ("CASE ORDPRI WHEN '1-URGENT' THEN 1 WHEN '3-MEDIUM' THEN 2 "
                  "WHEN '4-NOT SPECIFIED' THEN 3 ELSE 0 END")


# --- the release pipeline (twin of plans.release) ----------------------------------------
BASE_NAMES = ["FILING_ID", "EIN", "TAXPER", "FISYR", "SOURCE", "SUBSECCD", "FNDNCD", "NTEEFINAL",
              "TOTREV2", "CONT", "DIREXP", "NETINCFNDRSNG", "EXPS", "ASS_EOY", "LIAB_EOY",
              "FUNDBAL", "ORDSTAT", "ORDPRI", "NAME", "NETINC", "TOTREV", "STYEAR",
              "SOURCE_KIND", "RELEASE", "VALIDATION_STATE", "MANUALLY_FIXED"]


def _prior_cols():
    # spelled out: the oracle shares no naming rule with the operators
    return [("ASS_EOY", "ASS_BOY"), ("LIAB_EOY", "LIAB_BOY"), ("TAXPER", "TAXPERP"),
            ("FISYR", "FISYRP"), ("TOTREV", "TOTREVP"), ("EXPS", "EXPSP"),
            ("NETINC", "NETINCP"), ("CONT", "CONTP"), ("FUNDBAL", "NETA_BOY"),
            ("SOURCE", "INPRIORSRC")]


def cur_reviewed(year: int = Y) -> str:
    return (f"cur_r AS (SELECT * REPLACE ({REVIEWED_STATE} AS VALIDATION_STATE) FROM "
            f"(SELECT {BASE_COLS} FROM filings WHERE FISYR >= {year}))")


def prior_joined(year: int = Y) -> str:
    ok = "coalesce(c.FISYR = p.FISYR + 1, false)"
    cols = ", ".join(f"CASE WHEN {ok} THEN p.{a} END AS {b}" for a, b in _prior_cols())
    return (f"py AS (SELECT c.*, {cols}, CASE WHEN {ok} THEN '1' ELSE '0' END AS INPRIOR "
            f"FROM cur_r c LEFT JOIN prior_{year - 1} p ON c.RELEASE = p.RELEASE AND c.EIN = p.EIN)")


def backfilled(year: int = Y, depth: int = 2) -> str:
    parts = " UNION ALL ".join(
        f"SELECT * REPLACE ('core{year - k}' || lower(RELEASE) AS SOURCE), {year - k} AS _yr "
        f"FROM prior_{year - k}" for k in range(1, depth + 1))
    return f"""cand AS ({parts}),
cand2 AS (SELECT * FROM cand c WHERE NOT EXISTS (
  SELECT 1 FROM py x WHERE x.RELEASE = c.RELEASE AND x.EIN = c.EIN)),
back AS (SELECT * EXCLUDE (_yr) FROM cand2 c WHERE _yr = (
  SELECT max(_yr) FROM cand2 d WHERE d.RELEASE = c.RELEASE AND d.EIN = c.EIN)),
bf AS (SELECT * FROM py UNION ALL BY NAME SELECT * FROM back)"""


def deduped(year: int = Y) -> str:
    return f"""g AS (SELECT *,
  max(CASE WHEN FISYR = {year} AND FISYRP = {year - 1} THEN 1 ELSE 0 END) OVER w AS _a,
  max(CASE WHEN FISYR = {year + 1} AND FISYRP IS NULL THEN 1 ELSE 0 END) OVER w AS _b,
  max(FISYR) OVER w AS _maxy
  FROM bf WHERE FISYR >= {year - 2} WINDOW w AS (PARTITION BY RELEASE, EIN)),
dd AS (SELECT * EXCLUDE (_a, _b, _maxy, _rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY RELEASE, EIN ORDER BY
    CASE WHEN _a = 1 AND _b = 1 AND _maxy = {year + 1} AND FISYR = {year} THEN 1 ELSE 0 END DESC,
    FISYR DESC, {SCORE} DESC, STYEAR DESC, FILING_ID DESC) AS _rn FROM g) WHERE _rn = 1)"""


def residual_sql(forms=("EZ", "FULL"), present=BASE_NAMES, kind: bool = True) -> list[tuple[str, str]]:
    from ..operators.rules import rules_for

    def amt(n):
        return n if n in present else "cast(0 AS double)"
    out = []
    for form in forms:
        for r in rules_for(form):
            body = amt(r.parts[0][1])
            for s, f in r.parts[1:]:
                body += (" + " if s > 0 else " - ") + amt(f)
            e = f"{amt(r.total)} - ({body})"
            out.append((r.column, f"CASE WHEN SOURCE_KIND = '{r.form}' THEN {e} END" if kind else e))
    return out


def validated() -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in residual_sql())
    return f"res AS (SELECT *, {cols} FROM dd)"


def stages_until(upto: str = "res", year: int = Y) -> list[str]:
    steps = [FILINGS, prior(year - 1), prior(year - 2), cur_reviewed(year), prior_joined(year),
             backfilled(year), deduped(year), validated()]
    stop = {"cur_r": 4, "py": 5, "bf": 6, "dd": 7, "res": 8}[upto]
    return steps[:stop]


def any_over_sql(cols, tol) -> str:
    return "(" + " OR ".join(f"coalesce(abs({c}) > {tol}, false)" for c in cols) + ")"
