"""Published releases as commits: empty re-runs, lost jobs, versions."""

import tempfile

import pytest
from pyspark.sql import functions as F

from filing_release.sources import sinks


def rows_of(spark, root, table, year=2015, version=None):
    df = sinks.read_table(spark, sinks.published(spark, root, year, version), table)
    return sorted(tuple(r) for r in df.collect())


def test_empty_rerun_replaces_by_nothing(spark):
    root = tempfile.mkdtemp(prefix="commits-", dir="/tmp")
    co = spark.createDataFrame([("1", 2.5), ("2", None)], "EIN string, A double")
    sinks.write_review_extract(spark, {"CO": co, "PC": co}, root, 2015)
    sinks.write_review_extract(spark, {"CO": co}, root, 2014)
    first = sinks.published(spark, root, 2015)
    assert rows_of(spark, root, "co") == [("1", 2.5), ("2", None)]
    sinks.write_review_extract(spark, {"CO": co.limit(0)}, root, 2015)
    assert rows_of(spark, root, "CO") == []
    empty = sinks.read_table(spark, sinks.published(spark, root, 2015), "CO")
    assert empty.dtypes == co.dtypes
    with pytest.raises(sinks.NotPublished, match="no table PC"):      # the commit hasn't one
        rows_of(spark, root, "PC")
    assert rows_of(spark, root, "CO", 2014) == [("1", 2.5), ("2", None)]
    assert rows_of(spark, root, "PC", version=first.version) == [("1", 2.5), ("2", None)]
    assert sinks.published_years(spark, root) == [2014, 2015]


def test_lost_job_leaves_the_earlier_release(spark):
    root = tempfile.mkdtemp(prefix="commits-", dir="/tmp")
    old = spark.createDataFrame([("1", "old")], "EIN string, V string")
    new = spark.createDataFrame([("1", "new")], "EIN string, V string")
    broken = new.withColumn("V", F.raise_error(F.lit("executor lost")).cast("string"))
    assert sinks.write_release(spark, {"CO": old, "PC": old, "CO_full": old}, root, 2015) == [
        "core2015co", "core2015co_full990", "core2015pc"]
    with pytest.raises(Exception, match="executor lost"):
        sinks.write_release(spark, {"CO": new, "PC": broken}, root, 2015)
    assert rows_of(spark, root, "CO") == rows_of(spark, root, "PC") == [("1", "old")]
    # what the lost job wrote is removed, the release stays
    assert len(sinks.prune(spark, root, 2015)) == 1
    assert rows_of(spark, root, "CO") == [("1", "old")]
    sinks.write_release(spark, {"CO": new, "PC": new}, root, 2015)
    assert len(sinks.prune(spark, root, 2015)) == 1 and rows_of(spark, root, "PC") == [("1", "new")]
    assert sinks.write_release(spark, {"CO": old}, root, 2015, gate_open=False) == []
    assert rows_of(spark, root, "CO") == [("1", "new")]


def test_nothing_published(spark):
    root = tempfile.mkdtemp(prefix="commits-", dir="/tmp")
    with pytest.raises(sinks.NotPublished, match="no release of 2015"):
        sinks.published(spark, root, 2015)
    assert sinks.published_years(spark, root) == []


def test_row_counts_and_csv(spark):
    root = tempfile.mkdtemp(prefix="commits-", dir="/tmp")
    co = spark.range(7).select(F.col("id").cast("string").alias("EIN"), F.lit(1.5).alias("A"))
    done = sinks.commit(spark, root, 2015, {"CO": co}, fmt="csv")
    assert done.tables["CO"]["rows"] == 7
    assert rows_of(spark, root, "CO") == [(str(i), 1.5) for i in range(7)]
