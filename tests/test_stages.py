"""Staged tables: keyed by what their input holds, removed at the end of a job."""

import os
import tempfile

from filing_release.plans.materialize import fingerprint, remove_stages, stage, stage_once


def test_changed_input_is_staged_anew(spark):
    d = tempfile.mkdtemp(prefix="stages-", dir="/tmp")
    spark.range(3).write.parquet(f"{d}/t.parquet")
    built = []

    def build():
        built.append(1)
        return spark.read.parquet(f"{d}/t.parquet")

    assert stage_once(build, spark, (d, 1), "t").count() == 3
    assert stage_once(build, spark, (d, 1), "t").count() == 3 and len(built) == 1
    before = fingerprint(spark, d)
    spark.range(5).write.mode("append").parquet(f"{d}/t.parquet")
    assert fingerprint(spark, d) != before
    assert stage_once(build, spark, (d, 1), "t").count() == 8 and len(built) == 2


def test_no_stage_is_left_behind():
    # in an application of its own: other tests keep theirs
    import subprocess
    import sys
    code = """
import os
from filing_release.session import ensure_checkpoint_dir, local_session
from filing_release.plans.materialize import remove_stages, stage, stage_once
s = local_session(1)
root = ensure_checkpoint_dir(s).removeprefix("file:")
d = root + "/in"
s.range(3).write.parquet(d)
stage(s.range(2), "a"), stage_once(lambda: s.range(2), s, (d,), "b")
assert len(os.listdir(root + "/stages")) == 2
assert len(remove_stages(s)) == 2 and os.listdir(root + "/stages") == []
assert stage_once(lambda: s.range(2), s, (d,), "b").count() == 2
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=180)
    assert callable(remove_stages) and callable(stage)
