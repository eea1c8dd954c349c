"""Lookup joins.

All joins are equi-joins on one key and carry no broadcast hint: Spark's own
byte limit (``spark.sql.autoBroadcastJoinThreshold``) decides, and AQE splits a
hot key on the big side of the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import activity_parts, clean_key, contact_name

# Registry column renames (I23) and column groups.
REGISTRY_RENAMES = {"ORGANIZATION": "ORGCD", "AFFILIATION": "AFCD",
                    "DEDUCTIBILITY": "DEDUCTCD", "ICO": "CONTACT", "SORT_NAME": "SEC_NAME",
                    "ASSET_CD": "ASS_CODE", "INCOME_CD": "INC_CODE", "STATUS": "EOSTATUS"}
REGISTRY_SHARED = ["ORGCD", "ZIP", "AFCD", "DEDUCTCD", "CONTACT", "SEC_NAME", "FRCD",
                   "ACTIV1", "ACTIV2", "ACTIV3"]
REGISTRY_PF_ONLY = ["ASS_CODE", "INC_CODE"]
REGISTRY_COPC_ONLY = ["EOSTATUS"]

# Classification master columns read.
CLASSIFICATION_COLUMNS = ["EIN", "OutNccs", "OutReas", "NteeFinal", "Fips", "NteeCC",
                          "NteeSrc", "NteeConf", "FndnCd", "NAICS", "LONGITUDE", "LATITUDE",
                          "zip5", "Name", "Address", "City", "State", "NteeIrs",
                          "RuleDate", "ClassCd", "censusTract", "block"]
# Place lookup columns.
PLACE_COLUMNS = ["FIPS", "PMSA", "MSA_NECH"]


def left_enrich(df: DataFrame, lookup: DataFrame, key: str | Sequence[str],
                on_collision: str = "error") -> DataFrame:
    """D5-safe left join.

    ``on_collision``: ``error`` (fail fast on same-named non-key columns) or
    ``left`` (keep the left value and drop the lookup's).
    """
    keys = [key] if isinstance(key, str) else list(key)
    clash = [c for c in lookup.columns if c in df.columns and c not in keys]
    if clash:
        if on_collision == "error":
            raise ValueError(f"lookup columns collide with table columns: {clash}")
        lookup = lookup.drop(*clash)
    return df.join(lookup, keys, "left")


def classification_lookup(master: DataFrame, columns: Sequence[str] = CLASSIFICATION_COLUMNS) -> DataFrame:
    """D1 right side: named columns, upper-cased, hyphens stripped from EIN."""
    cols = [F.col(c).alias(c.upper()) for c in columns if c in master.columns or c.upper() in master.columns]
    m = master.select(*cols)
    return m.withColumn("EIN", clean_key("EIN"))


def one_row_per_key(lookup: DataFrame, key: str = "EIN") -> DataFrame:
    """A lookup reduced to one deterministic row per key (the greatest row),
    as one aggregation with map-side combine."""
    cols = [c for c in lookup.columns if c != key]
    if not cols:
        return lookup.distinct()
    return lookup.groupBy(key).agg(F.max(F.struct(*cols)).alias("_r")).select(key, "_r.*")


def enrich_classification(df: DataFrame, master: DataFrame, on_collision: str = "error",
                          unique: bool = False) -> DataFrame:
    """Left join on EIN.

    The master is not guaranteed unique.  With ``unique=False`` duplicate
    keys fan out as in the source tool (its later de-dup then keeps one of
    the copies).  ``unique=True`` keeps one master row per EIN before the
    join - the same one-row-per-EIN outcome without multiplying a hot key's
    rows by the number of master duplicates."""
    lk = classification_lookup(master)
    if unique:
        lk = one_row_per_key(lk, "EIN")
    return left_enrich(df, lk, "EIN", on_collision)


def enrich_place(df: DataFrame, place: DataFrame) -> DataFrame:
    """Left join on FIPS (needs D1's FIPS).  Null FIPS never matches."""
    lk = place.select(*PLACE_COLUMNS)
    return left_enrich(df, lk, "FIPS")


def enrich_postcard(df: DataFrame, postcard: DataFrame, unique: bool = False,
                    on_collision: str = "error") -> DataFrame:
    """D3: left join of the short-form filing year (Full and EZ only).  The
    postcard list is unique per EIN (asserted by the build, D9); ``unique``
    reduces it to one deterministic row per key instead (see
    ``history.prior_year_join`` for why that is not the default)."""
    pc = postcard.select("EIN", "EPOSTCARD")
    return left_enrich(df, one_row_per_key(pc) if unique else pc, "EIN", on_collision)


def postcard_flag(fisyr: str = "FISYR", epostcard: str = "EPOSTCARD", literal: bool = False):
    """I15: '1' when the short-form year equals FISYR (compared as ints).

    ``literal=True`` keeps the published tool's text-vs-int comparison,
    which never matches, so the flag is always '0'."""
    if literal:
        return F.lit("0")
    same = F.col(epostcard).cast("string").try_cast("int").eqNullSafe(F.col(fisyr).cast("int")) \
        & F.col(epostcard).isNotNull()
    return F.when(same, "1").otherwise("0")


def registry_shape(registry: DataFrame) -> DataFrame:
    """Renames, CONTACT clean-up, FRCD, ACTIV1..3."""
    r = registry.withColumnsRenamed({k: v for k, v in REGISTRY_RENAMES.items()
                                     if k in registry.columns})
    r = r.withColumns({
        "CONTACT": contact_name("CONTACT"),
        "FRCD": F.concat(F.col("FILING_REQ_CD"), F.col("PF_FILING_REQ_CD")),
        **activity_parts("ACTIVITY"),
    })
    return r.select("EIN", *REGISTRY_SHARED, *REGISTRY_COPC_ONLY, *REGISTRY_PF_ONLY)


def enrich_registry(df: DataFrame, shaped: DataFrame, form: str, unique: bool = False,
                    on_collision: str = "error") -> DataFrame:
    """Full/EZ take shared + EOSTATUS; PF takes shared + asset/income
    codes.  The registry is unique per EIN (asserted by the build, D9);
    ``unique`` reduces it to one row per key instead."""
    extra = REGISTRY_PF_ONLY if form.upper() == "PF" else REGISTRY_COPC_ONLY
    reg = shaped.select("EIN", *REGISTRY_SHARED, *extra)
    return left_enrich(df, one_row_per_key(reg) if unique else reg, "EIN", on_collision)


def duplicate_keys(df: DataFrame, key: str = "EIN") -> DataFrame:
    """Keys occurring more than once, with their counts (partial
    aggregation first, so a hot key costs one row per map task)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, key: str = "EIN", what: str = "table") -> None:
    """D9 as a check: raises with a few offending keys."""
    bad = duplicate_keys(df, key).limit(5).collect()
    if bad:
        raise AssertionError(f"{what}: {key} not unique, e.g. {[r[key] for r in bad]}")
