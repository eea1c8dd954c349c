"""Key, period and classification-code columns.

All rules are ``CASE`` chains over native string functions; ``substring``
is safe on short or empty codes, so no branch can raise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the published classification rules)
# ---------------------------------------------------------------------------
# Major group of ten by first letter of the class code (I9); Z, blank,
# null and anything else -> UN.
MAJOR10 = {
    "A": "AR", "B": "ED", "C": "EN", "D": "EN",
    "E": "HE", "F": "HE", "G": "HE", "H": "HE",
    "I": "HU", "J": "HU", "K": "HU", "L": "HU", "M": "HU", "N": "HU", "O": "HU", "P": "HU",
    "Q": "IN", "R": "PU", "S": "PU", "T": "PU", "U": "PU", "V": "PU", "W": "PU",
    "X": "RE", "Y": "MU",
}
# Level-3 group by first letter, used after the special codes of I11.
LEVEL3_LETTER = {
    "A": "AR", "B": "ED", "C": "EN", "D": "EN",
    "E": "HE", "F": "HE", "G": "HE", "H": "HE",
    "I": "HS", "J": "HS", "K": "HS", "L": "HS", "M": "HS", "N": "HS", "O": "HS", "P": "HS",
    "Q": "IN", "R": "PB", "S": "PB", "T": "PB", "U": "PB", "V": "PB", "W": "PB",
    "X": "RE", "Z": "UN",
}
# Major-10 groups folded into OT for the five-group scheme.
MAJOR5_OTHER = ["IN", "EN", "PU", "RE", "MU", "UN"]
# Foundation codes meaning private foundation (I8) and supporting org.
PF_FOUNDATION_CODES = [2, 3, 4]
PC_EXCLUDED_CODES = [0, 2, 3, 4, 9]
SUPPORTING_CODES = [4, 17]
# File-name suffix per source form.
FORM_SUFFIX = {"EZ": "990EZ", "FULL": "990O", "PF": "990PF"}
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _map_first(code: Column, mapping: dict[str, str], default: str) -> Column:
    first = F.substring(code, 1, 1)
    expr = None
    for out in dict.fromkeys(mapping.values()):
        keys = [k for k, v in mapping.items() if v == out]
        cond = first.isin(keys)
        expr = F.when(cond, out) if expr is None else expr.when(cond, out)
    return expr.otherwise(default)


# --- period and keys --------------------------------------------------------
def fiscal_year(taxper="TAXPER") -> Column:
    """Year part of ``YYYYMM`` as int (null when not numeric)."""
    return F.substring(_c(taxper), 1, 4).try_cast("int")


def accounting_period(taxper="TAXPER") -> Column:
    """Month part of ``YYYYMM``."""
    return F.substring(_c(taxper), 5, 2)


def start_year(taxper="TAXPER", literal: bool = False) -> Column:
    """I16: fiscal start year - the year for periods ending in Dec or Jan,
    otherwise the year before (intended rule, see README deviations).

    ``literal=True`` reproduces the published tool's slicing of a 6-char
    period: the first five characters as a number, minus one unless the
    sixth character is '1' (e.g. ``201506`` -> 20149)."""
    if literal:
        head = F.substring(_c(taxper), 1, 5).try_cast("int")
        return F.when(F.substring(_c(taxper), 6, 1) == "1", head).otherwise(head - 1)
    y = fiscal_year(taxper)
    m = accounting_period(taxper)
    return F.when(m.isin("12", "01"), y).otherwise(y - 1)


def soi_year(taxper="TAXPER", literal: bool = False) -> Column:
    """Same as ``start_year`` as text (literal mode: the float text
    of the five-digit value, e.g. ``20149.0``)."""
    if literal:
        head = F.substring(_c(taxper), 1, 5)
        return F.when(F.substring(_c(taxper), 6, 1) == "1", head).otherwise(
            (head.try_cast("double") - 1).cast("string"))
    return start_year(taxper).cast("string")


def filing_keys(ein="EIN", taxper="TAXPER", fisyr="FISYR") -> tuple[Column, Column]:
    """I4: EIN||TAXPER and EIN||FISYR (null-propagating); the release
    names them NCCSKEY and NCCSKEY2 (fixed column names)."""
    return (F.concat(_c(ein), _c(taxper)),
            F.concat(_c(ein), _c(fisyr).cast("string")))


def file_name(form: str | Column, ein="EIN", taxper="TAXPER") -> Column:
    """``EIN_TAXPER_990EZ|990O|990PF``; null if a part is null."""
    if isinstance(form, str):
        suffix = F.lit(FORM_SUFFIX[form.upper()])
    else:
        suffix = None
        for k, v in FORM_SUFFIX.items():
            suffix = F.when(form == k, v) if suffix is None else suffix.when(form == k, v)
    return F.concat(_c(ein), F.lit("_"), _c(taxper), F.lit("_"), suffix)


def clean_key(ein="EIN") -> Column:
    """Strip hyphens from an EIN."""
    return F.translate(_c(ein), "-", "")


def source_kind(source="SOURCE") -> Column:
    """C4: EZ / FULL / PF from the file stem before the first dot; prior
    release rows (``core2014co``) and anything else -> null."""
    stem = F.upper(F.substring_index(_c(source), ".", 1))
    return (F.when(stem.endswith("EZ"), "EZ")
             .when(stem.endswith("990"), "FULL")
             .when(stem.endswith("PF"), "PF"))


# --- classification ----------------------------------------------------------
def class_prefixes(ntee="NTEEFINAL") -> dict[str, Column]:
    """NTEECC (first 4), NTEE1 = NTEEFINAL1 = LEVEL4 (first letter)."""
    c = _c(ntee)
    first = F.substring(c, 1, 1)
    return {"NTEECC": F.substring(c, 1, 4), "NTEE1": first,
            "NTEEFINAL1": first, "LEVEL4": first}


def major10(ntee="NTEEFINAL") -> Column:
    """I9."""
    return _map_first(_c(ntee), MAJOR10, "UN")


def major_group_b(ntee="NTEEFINAL") -> Column:
    """Null and '' pass through; B4/B5 -> BH; E2 -> EH; else letter."""
    c = _c(ntee)
    two = F.substring(c, 1, 2)
    return (F.when(c.isNull() | (c == ""), c)
             .when(two.isin("B4", "B5"), "BH")
             .when(two == "E2", "EH")
             .otherwise(F.substring(c, 1, 1)))


def major12(ntee="NTEEFINAL", ntmaj10: Column | None = None) -> Column:
    """B4/B5 -> BH; E2 -> EH; else the major-10 group."""
    c = _c(ntee)
    two = F.substring(c, 1, 2)
    base = major10(c) if ntmaj10 is None else ntmaj10
    return F.when(two.isin("B4", "B5"), "BH").when(two == "E2", "EH").otherwise(base)


def major5(ntmaj10: Column) -> Column:
    """I14."""
    return F.when(ntmaj10.isin(MAJOR5_OTHER), "OT").otherwise(ntmaj10)


def level3(ntee="NTEEFINAL") -> Column:
    """I11, first matching branch wins."""
    c = _c(ntee)
    first = F.substring(c, 1, 1)
    two = F.substring(c, 1, 2)
    d1 = F.substring(c, 2, 1)
    d12 = F.substring(c, 2, 2)
    expr = (F.when(c.isNull() | (c == ""), "-")
             .when((two != "B8") & (d12 == "11"), "ZA")
             .when((two != "B8") & (d12 == "12"), "ZB")
             .when((first == "T") & (d1 == "2"), "ZC")
             .when((first == "T") & (d1 == "3"), "ZD")
             .when((first == "T") & (d1 == "7"), "ZE")
             .when((first == "T") & d12.isin("90", "99"), "ZF")
             .when((first == "T") & (d1 == "6"), "ZF")
             .when(F.substring(c, 1, 3) == "Y30", "MR")
             .when(first == "Y", "MO"))
    for out in dict.fromkeys(LEVEL3_LETTER.values()):
        keys = [k for k, v in LEVEL3_LETTER.items() if v == out]
        expr = expr.when(first.isin(keys), out)
    return expr.otherwise("-")


def level1(subseccd="SUBSECCD", fndncd="FNDNCD") -> Column:
    """I8: public charity / private foundation / other / unknown."""
    s = _c(subseccd).cast("string").try_cast("double")
    f = _c(fndncd).cast("string").try_cast("double")
    s_zero_or_null = s.isNull() | (s == 0)
    return (F.when((s > 3) | s.isin(1, 2), "O")
             .when((s == 3) & f.isin(PF_FOUNDATION_CODES), "PF")
             .when(s == 3, "PC")
             .when((s < 0) & (f.isNull() | (f == 0)), "O")
             .when(s_zero_or_null & f.isNotNull() & ~f.isin(PC_EXCLUDED_CODES), "PC")
             .when(s_zero_or_null & f.isin(PF_FOUNDATION_CODES), "PF")
             .otherwise("U"))


def level2(subseccd="SUBSECCD", fndncd="FNDNCD", level3_col: Column | None = None,
           ntee="NTEEFINAL") -> Column:
    """Supporting (S), mutual (M) or other (O); needs LEVEL3 first."""
    s = _c(subseccd).cast("string").try_cast("double")
    f = _c(fndncd).cast("string").try_cast("double")
    l3 = level3(ntee) if level3_col is None else level3_col
    return (F.when((s == 3) & f.isin(SUPPORTING_CODES), "S")
             .when(F.substring(l3, 1, 1) == "Z", "S")
             .when(F.substring(_c(ntee), 1, 1) == "Y", "M")
             .otherwise("O"))


def classification_columns(ntee="NTEEFINAL", subseccd="SUBSECCD",
                           fndncd="FNDNCD") -> dict[str, Column]:
    """All I6-I14 columns as one dict for a single ``withColumns``."""
    out = class_prefixes(ntee)
    m10 = major10(ntee)
    l3 = level3(ntee)
    out.update({
        "LEVEL1": level1(subseccd, fndncd),
        "NTMAJ10": m10,
        "MAJGRPB": major_group_b(ntee),
        "LEVEL3": l3,
        "LEVEL2": level2(subseccd, fndncd, l3, ntee),
        "NTMAJ12": major12(ntee, m10),
        "NTMAJ5": major5(m10),
    })
    return out


# --- registry reshaping (I20-I22) ---------------------------------------------
def contact_name(ico="ICO") -> Column:
    """Drop leading '%' signs, then leading blanks."""
    return F.ltrim(F.regexp_replace(_c(ico), r"^%+", ""))


def activity_parts(activity="ACTIVITY") -> dict[str, Column]:
    """Three 3-character activity codes."""
    a = _c(activity)
    return {"ACTIV1": F.substring(a, 1, 3), "ACTIV2": F.substring(a, 4, 3),
            "ACTIV3": F.substring(a, 7, 3)}


# --- document link (I29) -------------------------------------------------------
def document_link(base: str, form: Column, ein="EIN", filename="FILENAME",
                  prior_taxper: Column | None = None) -> Column:
    """Link to the scanned return: base/990[pf]_pdf_archive/EIN[0:3]/EIN/FILE.pdf.

    With ``prior_taxper`` the period part of the file name is swapped for the
    prior period (a trailing ``.0`` from a float round-trip is removed).
    """
    fn = _c(filename)
    folder = F.when(form == "PF", "990pf_pdf_archive").otherwise("990_pdf_archive")
    if prior_taxper is not None:
        p = F.regexp_replace(prior_taxper.cast("string"), r"\.0$", "")
        fn = F.concat(F.split_part(fn, F.lit("_"), F.lit(1)), F.lit("_"), p, F.lit("_"),
                      F.split_part(fn, F.lit("_"), F.lit(3)))
    return F.concat(F.lit(base), folder, F.lit("/"), F.substring(fn, 1, 3), F.lit("/"),
                    F.split_part(fn, F.lit("_"), F.lit(1)), F.lit("/"), fn, F.lit(".pdf"))
