"""Published tables as commits.

A commit is a set of tables of one release year.  Every table is written to a
folder of its own version, and the commit becomes visible by one file written
last: the manifest, which names the folders, their schemas and row counts.

    <root>/data/year=2015/<version>/table=CO/part-...
    <root>/manifests/year=2015/<version>.json

Readers resolve the newest manifest of a year, so

* a job lost between two tables leaves the earlier release as it was;
* a table that comes out empty replaces the earlier one by *nothing*, and a
  table that a commit doesn't have is gone from the release;
* a reader that began on one version is not disturbed by the next.

The manifest is written under a temporary name and renamed, which is atomic on
HDFS and local disks; on object stores the single small object is.  Versions
are UTC times with a random tail, so the newest one sorts last.  ``prune``
removes data of versions that are no longer the newest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class NotPublished(LookupError):
    """There is no such release or table."""


@dataclass(frozen=True)
class Commit:
    root: str
    year: int
    version: str
    tables: Mapping[str, dict] = field(default_factory=dict)  # name -> path, rows, schema, format

    @property
    def names(self) -> list[str]:
        return sorted(self.tables)


def release_name(form: str, year: int) -> str:
    """A9 naming: ``core<Y><form>``; ``_full`` tables become ``_full990``."""
    f = form.lower()
    return f"core{year}{f}990" if f.endswith("_full") else f"core{year}{f}"


# --- the file system Spark uses ------------------------------------------------------
def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _list(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """The whole file or none of it."""
    fs, p = _fs(spark, path)
    _, temporary = _fs(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    stream = fs.create(temporary, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(temporary, p):
        raise OSError(f"could not publish {path}")


# --- commits -------------------------------------------------------------------------
def commit(spark: SparkSession, root: str, year: int, tables: Mapping[str, DataFrame],
           fmt: str = "parquet") -> Commit:
    """Write ``tables`` as the new state of ``year`` under ``root``; row counts
    are observed while the tables are written."""
    root = root.rstrip("/")
    version = f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    done: dict[str, dict] = {}
    for name, df in tables.items():
        path = f"data/year={int(year)}/{version}/table={name.upper()}"
        count = Observation()
        out = df.observe(count, F.count(F.lit(1)).alias("rows"))
        out.write.options(**_OPTIONS.get(fmt, {})).format(fmt).save(f"{root}/{path}")
        done[name.upper()] = {"path": path, "rows": count.get["rows"], "format": fmt,
                              "name": release_name(name, year), "schema": df.schema.json()}
    body = {"year": int(year), "version": version, "tables": done}
    _write_text(spark, f"{root}/manifests/year={int(year)}/{version}.json", json.dumps(body))
    return Commit(root, int(year), version, done)


_OPTIONS = {"csv": {"header": "true"}}


def versions(spark: SparkSession, root: str, year: int) -> list[str]:
    """Published versions of a year, the newest last."""
    return [n.removesuffix(".json") for n in _list(spark, f"{root.rstrip('/')}/manifests/year={year}")
            if n.endswith(".json") and not n.startswith(".")]


def published(spark: SparkSession, root: str, year: int, version: str | None = None) -> Commit:
    """The newest commit of ``year``, or the given one."""
    root = root.rstrip("/")
    found = versions(spark, root, year)
    if not found or (version and version not in found):
        raise NotPublished(f"{root}: no release of {year}" + (f", {version}" if version else ""))
    body = json.loads(_read_text(
        spark, f"{root}/manifests/year={year}/{version or found[-1]}.json"))
    return Commit(root, body["year"], body["version"], body["tables"])


def published_years(spark: SparkSession, root: str) -> list[int]:
    names = [n.removeprefix("year=") for n in _list(spark, f"{root.rstrip('/')}/manifests")]
    return [int(n) for n in names if n.isdigit() and versions(spark, root, int(n))]


def read_table(spark: SparkSession, release: Commit, table: str) -> DataFrame:
    """A table of a commit with the schema it was written with."""
    entry = release.tables.get(table.upper())
    if entry is None:
        raise NotPublished(f"{release.root}: the release of {release.year} has no table {table}; "
                           f"it has {', '.join(release.names)}")
    schema = StructType.fromJson(json.loads(entry["schema"]))
    return (spark.read.options(**_OPTIONS.get(entry["format"], {})).schema(schema)
            .format(entry["format"]).load(f"{release.root}/{entry['path']}"))


def prune(spark: SparkSession, root: str, year: int, keep: int = 1) -> list[str]:
    """Remove manifests, then data, of all but the newest ``keep`` versions and of
    writes that were never published.  Not while a build of the year runs."""
    root = root.rstrip("/")
    live = set(versions(spark, root, year)[-max(keep, 1):])
    gone = []
    for name in _list(spark, f"{root}/manifests/year={year}"):
        if name.removesuffix(".json") not in live:
            fs, p = _fs(spark, f"{root}/manifests/year={year}/{name}")
            fs.delete(p, False)
    for name in _list(spark, f"{root}/data/year={year}"):
        if name not in live:
            fs, p = _fs(spark, f"{root}/data/year={year}/{name}")
            fs.delete(p, True)
            gone.append(name)
    return gone


# --- the jobs' outputs ---------------------------------------------------------------
def write_release(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, year: int,
                  fmt: str = "parquet", gate_open: bool = True) -> list[str]:
    """A9 + K6: publish the release tables when the gate is open."""
    if not gate_open:
        return []
    done = commit(spark, root, year, tables, fmt)
    return [done.tables[t]["name"] for t in done.names]


def write_review_extract(spark: SparkSession, flagged: Mapping[str, DataFrame], root: str,
                         year: int, fmt: str = "parquet") -> Commit:
    """A10: flagged rows with their reason letters, per table and year."""
    return commit(spark, root, year, flagged, fmt)


def write_review_outputs(spark: SparkSession, table: str, year: int, fixes: DataFrame,
                         ledger: DataFrame, unapplied: DataFrame, root: str,
                         fmt: str = "parquet") -> Commit:
    """The two vertical halves of one reviewed table and the events that
    took no effect, as one commit under ``<root>/<table>``.  The caller stages
    the reviewed table first so both halves read it once."""
    return commit(spark, review_root(root, table), year,
                  {"FIXES": fixes, "LEDGER": ledger, "UNAPPLIED": unapplied}, fmt)


def review_root(root: str, table: str) -> str:
    """Reviews of CO, PC and PF are committed apart: they end at their own time."""
    return f"{root.rstrip('/')}/{table.upper()}"
