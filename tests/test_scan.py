"""Checked scans: headers per file, malformed rows, compressed and odd files."""

import gzip
import os
import tempfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from filing_release.sources import extracts
from filing_release.sources.scan import ScanError, checked_scan, layouts, reject_counts


def folder(**files):
    d = tempfile.mkdtemp(prefix="scan-", dir="/tmp")
    for name, text in files.items():
        data = text.encode()
        with open(os.path.join(d, name.replace("__", ".")), "wb") as f:
            f.write(gzip.compress(data) if name.endswith("gz") else data)
    return d


def test_every_file_by_its_own_header(spark):
    d = folder(part_0="EIN A B\n11 22 33\n", part_1="B A EIN\n33 22 11\n", _skip="x\n",
               part_2__gz="ein a b\n44 55 \"6 6\"\n", empty="")
    assert [(lay.columns, len(lay.files)) for lay in layouts(spark, d, " ")] == [
        (("B", "A", "EIN"), 1), (("EIN", "A", "B"), 2)]
    rows = extracts.read_extract(spark, d, source_name="x990.dat")
    assert sorted(tuple(r) for r in rows.select("EIN", "A", "B", "SOURCE").collect()) == [
        ("11", "22", "33", "x990.dat"), ("11", "22", "33", "x990.dat"),
        ("44", "55", "6 6", "x990.dat")]


def test_malformed_row_stops_the_job(spark):
    d = folder(a="EIN A B\n1 2 3\n4 5 6 7\n")
    with pytest.raises(PySparkException, match="malformed row in .*3 columns.*4 5 6 7"):
        extracts.read_extract(spark, d).collect()
    # also when the query reads neither the bad column nor the line itself
    with pytest.raises(PySparkException, match="malformed row"):
        extracts.read_extract(spark, d).select("EIN").count()


def test_quarantine(spark):
    d = folder(a="EIN A B\n1 2 3\n4 5 6 7\n8 9\n", b="A B EIN\n2 3 1\n5\n")
    bad = []
    rows = extracts.read_extract(spark, d, on_bad="quarantine", rejects=bad)
    assert [tuple(r) for r in rows.select("EIN", "A", "B").collect()] == [("1", "2", "3")] * 2
    got = {tuple(r) for r in bad[0].select(F.element_at(F.split("file", "/"), -1), "n_columns",
                                           "n_tokens", "line").collect()}
    assert got == {("a", 3, 4, "4 5 6 7"), ("a", 3, 2, "8 9"), ("b", 3, 1, "5")}
    counts = {r.file[-1]: (r.n_short, r.n_long) for r in reject_counts(bad[0]).collect()}
    assert counts == {"a": (1, 1), "b": (1, 0)}


def test_headers_that_cant_be_read(spark):
    with pytest.raises(ScanError, match="differ in columns"):
        checked_scan(spark, folder(a="EIN A\n1 2\n", b="EIN C\n1 2\n"), " ")
    with pytest.raises(ScanError, match="no column EIN"):
        extracts.read_extract(spark, folder(a="A B\n1 2\n"))
    with pytest.raises(ScanError, match="repeated column"):
        checked_scan(spark, folder(a="EIN a A\n1 2 3\n"), " ")
    with pytest.raises(ScanError, match="only empty files"):
        checked_scan(spark, folder(a=""), " ")
    with pytest.raises(ScanError, match="no such file"):
        checked_scan(spark, "/tmp/no-such-folder-of-extracts", " ")
    marked = checked_scan(spark, folder(a="\ufeffEIN A\n1 2\n"), " ")     # a byte order mark
    assert [tuple(r)[:2] for r in marked.rows.collect()] == [("1", "2")]
    header_only = checked_scan(spark, folder(a="EIN A\n"), " ")
    assert header_only.rows.columns == ["EIN", "A", "FILE_NAME"] and not header_only.rows.collect()


def test_registry_files_may_differ_and_postcards_have_no_header(spark):
    names = ["EIN", "ORGANIZATION", "ZIP", "ACTIVITY", "AFFILIATION", "DEDUCTIBILITY", "ICO",
             "SORT_NAME", "FILING_REQ_CD", "PF_FILING_REQ_CD", "ASSET_CD", "INCOME_CD", "STATUS"]
    a = folder(r1=",".join(names) + "\n" + ",".join(n.lower() for n in names) + "\n")
    b = folder(r2=",".join(["X", *names[::-1]]) + "\n" + ",".join(
        ["x", *(n.lower() for n in names[::-1])]) + "\n")
    got = extracts.read_registry(spark, [a, b]).distinct().collect()
    assert [tuple(r) for r in got] == [tuple(n.lower() for n in names)]
    short = folder(r=",".join(names) + "\n1,2\n")
    with pytest.raises(PySparkException, match="malformed row"):
        extracts.read_registry(spark, [short]).collect()
    with pytest.raises(PySparkException, match="malformed row"):
        extracts.read_postcard(spark, folder(p="1|2015|x\n2|2014\n")).collect()
