"""Checked scans of delimited text (A1, A3, A4).

A folder of part files may hold more than one column order, and a row may have
more or fewer tokens than its file's header.  A plain CSV scan takes one header
for the whole folder, cuts extra tokens and fills missing ones with null.  Here

* files are grouped by their own header line (``layouts``); every layout is one
  scan with its own schema, so a column always gets its own file's name;
* the reader flags a row whose token count differs from its header, and such
  rows either stop the job that reads them (``on_bad="raise"``, inside the
  running plan: no extra pass) or go to ``rejects`` (``on_bad="quarantine"``).

Only the list of files and one line of each pass through the driver; they are
read with the file system Spark itself uses, compressed files included.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

BAD_LINE = "_bad_line"
READERS = 16  # files whose first line is read at a time


class ScanError(ValueError):
    """The files themselves can't be read as one table."""


@dataclass(frozen=True)
class Layout:
    """Files with the same header line."""
    columns: tuple[str, ...]
    files: tuple[str, ...]


@dataclass
class Scan:
    rows: DataFrame       # well-formed rows, all columns text
    rejects: DataFrame    # file, n_columns, n_tokens, line
    layouts: list[Layout]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Data files at ``path`` (a file, folder or glob), as Spark's readers choose
    them: names that begin with ``_`` or ``.`` are not data."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    found: list[str] = []
    todo = list(fs.globStatus(root) or [])
    if not todo:
        raise ScanError(f"{path}: no such file or folder")
    while todo:
        status = todo.pop()
        if status.isDirectory():
            todo += [s for s in fs.listStatus(status.getPath())
                     if not s.getPath().getName().startswith(("_", "."))]
        elif status.getLen() > 0:
            found.append(status.getPath().toString())
    return sorted(found)


def first_line(spark: SparkSession, file: str) -> str:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        source = codec.createInputStream(stream) if codec is not None else stream
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8")).readLine()
    finally:
        stream.close()
    return (line or "").removeprefix("\ufeff")


def _tokens(line: str, sep: str) -> list[str]:
    return [t.strip().strip('"') for t in line.split(sep)]


def layouts(spark: SparkSession, path: str | Sequence[str], sep: str,
            header: bool = True) -> list[Layout]:
    """The files of ``path`` grouped by header; names are upper-cased.  Without
    a header the columns are ``C0``, ``C1``, ... as many as the first line has."""
    paths = [path] if isinstance(path, str) else list(path)
    files = [f for p in paths for f in list_files(spark, p)]
    with ThreadPoolExecutor(READERS) as pool:
        lines = list(pool.map(lambda f: first_line(spark, f), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for f, line in zip(files, lines, strict=True):
        tokens = _tokens(line, sep)
        names = tuple(t.upper() for t in tokens) if header else tuple(
            f"C{i}" for i in range(len(tokens)))
        if "" in names or len(set(names)) < len(names):
            raise ScanError(f"{f}: empty or repeated column names in its header: {line!r}")
        groups.setdefault(names, []).append(f)
    if not groups:
        raise ScanError(f"{path}: only empty files")
    return [Layout(names, tuple(fs)) for names, fs in sorted(groups.items())]


def _guard(bad: Column, file: Column, n: int) -> Column:
    """True for a well-formed row; a malformed one stops the job."""
    text = F.concat(F.lit("malformed row in "), file, F.lit(f" ({n} columns): "),
                    F.substring(bad, 1, 200))
    return F.when(bad.isNull(), F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))


def checked_scan(spark: SparkSession, path: str | Sequence[str], sep: str, header: bool = True,
                 on_bad: str = "raise", columns: Sequence[str] | None = None,
                 required: Sequence[str] = (), same_columns: bool = True) -> Scan:
    """All files of ``path`` as one table of text columns and ``FILE_NAME``.

    ``columns`` limits the columns (those that exist), ``required`` must exist
    in every layout, and with ``same_columns`` all layouts must have the same
    columns, in any order; otherwise an absent one is null.
    """
    if on_bad not in ("raise", "quarantine"):
        raise ValueError("on_bad is 'raise' or 'quarantine'")
    found = layouts(spark, path, sep, header)
    for lay in found:
        absent = {c.upper() for c in required} - set(lay.columns)
        if absent:
            raise ScanError(f"{lay.files[0]}: no column {', '.join(sorted(absent))}")
        if same_columns and set(lay.columns) != set(found[0].columns):
            odd = sorted(set(lay.columns) ^ set(found[0].columns))
            raise ScanError(f"{lay.files[0]} and {found[0].files[0]} differ in columns: {odd}")
    keep = None if columns is None else {c.upper() for c in columns}
    good, bad = [], []
    for lay in found:
        schema = StructType([StructField(c, StringType()) for c in (*lay.columns, BAD_LINE)])
        df = (spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
              .option("columnPruning", False)  # all tokens count, whatever is selected
              .option("columnNameOfCorruptRecord", BAD_LINE).schema(schema).csv(list(lay.files)))
        line, file, n = F.col(BAD_LINE), F.col("_metadata.file_path"), len(lay.columns)
        # the reader won't give the flag alone, so a column that is always there goes with it
        read = F.coalesce(F.length(F.col(lay.columns[0])) >= 0, F.lit(True))
        ok = _guard(line, file, n) if on_bad == "raise" else line.isNull()
        good.append(df.filter(ok & read).select(
            *[c for c in lay.columns if keep is None or c in keep], file.alias("FILE_NAME")))
        bad.append(df.filter(line.isNotNull() & read).select(
            file.alias("file"), F.lit(n).alias("n_columns"),
            F.size(F.split(line, _literal(sep), -1)).alias("n_tokens"), line.alias("line")))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), good)
    return Scan(rows, reduce(DataFrame.unionByName, bad), found)


def _literal(sep: str) -> str:
    return "".join(f"\\{c}" if not c.isalnum() and not c.isspace() else c for c in sep)


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Malformed rows per file, by kind."""
    return rejects.groupBy("file").agg(
        F.count_if(F.col("n_tokens") < F.col("n_columns")).cast("bigint").alias("n_short"),
        F.count_if(F.col("n_tokens") > F.col("n_columns")).cast("bigint").alias("n_long"))
