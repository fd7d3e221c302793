"""Merging of batch folders."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from quadrangle.sinks import compact as module
from quadrangle.sinks.compact import batch_files, compact
from quadrangle.sinks.files import land_json

LEVELS = ("university", "faculty")


def land(spark, root, batch, keys, faculty="a b"):
    rows = spark.createDataFrame([(k, "u", faculty) for k in keys], "k long, university string, faculty string")
    folders = {"university": F.col("university"), "faculty": F.col("faculty"), "batch": F.lit(batch)}
    land_json(rows, ["k"], folders, root)


def rows(spark, root):
    return sorted(r.k for r in spark.read.schema("k long").option("recursiveFileLookup", "true").json(f"{root}/university=*").collect())


def batches(root, faculty):
    return sorted(os.path.basename(p) for p in glob.glob(f"{root}/university=u/faculty={faculty}/batch=*"))


@pytest.fixture
def zone(spark, folder):
    root = f"{folder}/zone"
    for n in range(4):
        land(spark, root, f"b{n}", range(10 * n, 10 * n + 3))
    land(spark, root, "b1", [77], faculty="lone")
    return root


def test_settled_batches_are_merged_and_others_stay(spark, zone):
    before = rows(spark, zone)
    assert compact(spark, zone, "b3", LEVELS) == 1
    assert rows(spark, zone) == before
    left = batches(zone, "a b")
    assert left[0] == "batch=b3" and len(left) == 2 and left[1].startswith("batch=merged-")
    assert batches(zone, "lone") == ["batch=b1"]
    assert len(glob.glob(f"{zone}/university=u/faculty=a b/batch=merged-*/*.txt")) == 1
    assert not glob.glob(f"{zone}/_*")
    # nothing more to merge; a later batch joins the merged ones
    assert compact(spark, zone, "b3", LEVELS) == 0
    assert compact(spark, zone, "b9", LEVELS) == 1
    assert rows(spark, zone) == before and len(batches(zone, "a b")) == 1
    assert batch_files(spark, zone, LEVELS).count() == 2


@pytest.mark.parametrize("moved", [False, True])
def test_a_run_after_a_crash_finishes_the_merge(spark, zone, monkeypatch, moved):
    before = rows(spark, zone)
    finish, calls = module._finish, []

    def crash(spark, root):
        calls.append(1)
        if len(calls) == 2:
            if moved:  # the new batch is in, the old ones are there too
                journal = spark.read.parquet(f"{root}/{module.JOURNAL}").first()
                os.rename(f"{root}/_{journal.into}/{journal.folder}/batch={journal.into}", f"{root}/{journal.folder}/batch={journal.into}")
            raise RuntimeError("lost")
        finish(spark, root)

    with monkeypatch.context() as patched:
        patched.setattr(module, "_finish", crash)
        with pytest.raises(RuntimeError):
            compact(spark, zone, "b9", LEVELS)
    assert compact(spark, zone, "b9", LEVELS) == 0
    assert rows(spark, zone) == before and len(batches(zone, "a b")) == 1
    assert not glob.glob(f"{zone}/_*")


def test_an_absent_zone_has_nothing_to_merge(spark, folder):
    assert compact(spark, f"{folder}/none", "z") == 0
