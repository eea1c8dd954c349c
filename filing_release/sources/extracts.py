"""Scans of the raw inputs.

Every text source is read by ``scan.checked_scan``: all-string schemas from the
files' own headers, so there is no inference pass over the data, and rows that
don't fit their header are never cut or filled in silence.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .scan import checked_scan

# Text a tabular reader treats as missing by default.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
               "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
               "n/a", "nan", "null"]

# Field delimiters of the three source kinds.
EXTRACT_DELIMITER = " "
REGISTRY_DELIMITER = ","
POSTCARD_DELIMITER = "|"


def null_tokens_to_null(c: Column) -> Column:
    return F.when(c.isin(NULL_TOKENS[1:]) | (c == ""), F.lit(None).cast("string")).otherwise(c)


def read_extract(spark: SparkSession, path: str | list[str], source_name: str | None = None,
                 columns: Iterable[str] | None = None, sep: str = EXTRACT_DELIMITER,
                 on_bad: str = "raise", rejects: list[DataFrame] | None = None) -> DataFrame:
    """A1 + A2 + B2: one filing extract.

    * all columns are text; pandas-style missing tokens become null;
    * headers are upper-cased (``ein``/``EIN`` both work), and every part file
      of a folder is read by its own header;
    * ``SOURCE`` is ``source_name`` or the given path's last part, also when
      the path is a folder of part files;
    * several paths are read one by one, each with its own header and name;
    * a row whose token count differs from its header stops the job, or with
      ``on_bad="quarantine"`` goes to the table appended to ``rejects``.
    """
    if not isinstance(path, str):
        parts = [read_extract(spark, p, source_name, columns, sep, on_bad, rejects) for p in path]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    keep = None if columns is None else {c.upper() for c in columns} | {"EIN"}
    scan = checked_scan(spark, path, sep, on_bad=on_bad, columns=keep, required=["EIN"])
    name = source_name or path.rstrip("/").rsplit("/", 1)[-1]
    if rejects is not None:
        rejects.append(scan.rejects.withColumn("source", F.lit(name)))
    cols = [null_tokens_to_null(F.col(c)).alias(c) for c in scan.rows.columns if c != "FILE_NAME"]
    return scan.rows.select(*cols, F.lit(name).alias("SOURCE"))


def read_registry(spark: SparkSession, paths: list[str],
                  columns: Sequence[str] = ("EIN", "ORGANIZATION", "ZIP", "ACTIVITY",
                                            "AFFILIATION", "DEDUCTIBILITY", "ICO",
                                            "SORT_NAME", "FILING_REQ_CD",
                                            "PF_FILING_REQ_CD", "ASSET_CD", "INCOME_CD",
                                            "STATUS"), on_bad: str = "raise",
                  rejects: list[DataFrame] | None = None) -> DataFrame:
    """A3: the regional registry files as one table (header, comma); the files
    may order their columns differently and have others besides ``columns``."""
    scan = checked_scan(spark, list(paths), REGISTRY_DELIMITER, on_bad=on_bad, columns=columns,
                        required=columns, same_columns=False)
    if rejects is not None:
        rejects.append(scan.rejects.withColumn("source", F.lit("registry")))
    return scan.rows.select(*columns)


def read_postcard(spark: SparkSession, path: str, on_bad: str = "raise",
                  rejects: list[DataFrame] | None = None) -> DataFrame:
    """A4 + C3: headerless pipe file, first two columns -> EIN, EPOSTCARD;
    rows with an empty year are dropped (a null year is kept)."""
    scan = checked_scan(spark, path, POSTCARD_DELIMITER, header=False, on_bad=on_bad,
                        required=["C0", "C1"])
    if rejects is not None:
        rejects.append(scan.rejects.withColumn("source", F.lit("postcard")))
    return postcard_clean(scan.rows.select(F.col("C0").alias("EIN"), F.col("C1").alias("EPOSTCARD")))


def postcard_clean(df: DataFrame) -> DataFrame:
    """Drop empty-string years; blank lines (null EIN) are skipped."""
    return df.filter(F.col("EIN").isNotNull()
                     & (F.col("EPOSTCARD").isNull() | (F.col("EPOSTCARD") != "")))


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
               fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """A lookup or prior release; header upper-cased, optional
    column list (pushed into the scan by column pruning)."""
    df = spark.read.format(fmt).options(**(options or {})).load(path)
    df = df.toDF(*[c.upper() for c in df.columns])
    if columns is not None:
        df = df.select(*[c.upper() for c in columns])
    return df


def read_jdbc(spark: SparkSession, url: str, table: str, columns: Sequence[str] | None = None,
              properties: dict | None = None) -> DataFrame:
    """A5 over JDBC: the column list becomes the pushed SELECT list."""
    df = spark.read.jdbc(url, table, properties=properties or {})
    df = df.toDF(*[c.upper() for c in df.columns])
    return df.select(*[c.upper() for c in columns]) if columns else df


def conform_types(df: DataFrame, target: DataFrame | StructType) -> DataFrame:
    """Cast each column to the type of the same-named target column;
    numeric targets parse and fill 0; unknown columns become text."""
    from pyspark.sql.types import NumericType

    from ..functions.amounts import parse_amount

    schema = target.schema if isinstance(target, DataFrame) else target
    types = {f.name: f.dataType for f in schema.fields}
    out = []
    for f in df.schema.fields:
        t = types.get(f.name)
        if t is None or isinstance(t, StringType):
            out.append(F.col(f.name).cast("string").alias(f.name))
        elif isinstance(t, NumericType):
            out.append(parse_amount(F.col(f.name)).cast(t).alias(f.name))
        else:
            out.append(F.col(f.name).cast("string").alias(f.name))
    return df.select(*out)


def read_optional(spark: SparkSession, path: str, fmt: str = "csv",
                  options: dict | None = None) -> DataFrame | None:
    """A fixes table that may not exist (absent -> None, skip)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return None
    opts = {"header": "true"} if fmt == "csv" else {}
    opts.update(options or {})
    return spark.read.format(fmt).options(**opts).load(path)
