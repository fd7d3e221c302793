"""Slots of upserted tables: growth, pruning, filters, crashes."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from quadrangle import schemas
from quadrangle.operators import upsert as module
from quadrangle.operators.slots import SLOT, Directory
from quadrangle.operators.upsert import read_table, rows_of_keys, upsert

DAY = "2024-06-01 00:00:00"
SCHEMA = "record_id string, v long, body string, business_timestamp string, university string, faculty string"


def batch(spark, keys, v=1, faculty="f"):
    rows = spark.createDataFrame([(int(k),) for k in keys], "k long")
    # bodies that do not compress, so that bytes follow rows
    return rows.select(
        F.concat(F.lit("k"), "k").alias("record_id"), F.lit(v).cast("long").alias("v"),
        F.concat(*[F.sha2(F.concat(F.lit(str(i)), F.col("k").cast("string")), 256) for i in range(4)]).alias("body"),
        F.lit(DAY).alias("business_timestamp"), F.lit("u").alias("university"), F.lit(faculty).alias("faculty"),
    )


def stored(spark, path):
    return {r.record_id: r.v for r in spark.read.parquet(path).collect()}


def files(path):
    return set(glob.glob(f"{path}/university=*/*/*/*.parquet"))


def slots(path):
    return {os.path.dirname(p) for p in files(path)}


def directory(spark, path):
    live = Directory(spark, path, spark.read.parquet(path).schema, ["university", "faculty"]).live()
    return {(r.faculty, r[SLOT]): (r.rows, r.bytes) for r in live.collect()}


def check_directory(spark, path):
    """What the directory says is what lies in the folders; slots tile the hashes of a partition."""
    held = spark.read.parquet(path).groupBy("faculty", SLOT).count().collect()
    said = directory(spark, path)
    assert {(r.faculty, r[SLOT]): r["count"] for r in held} == {k: rows for k, (rows, _) in said.items() if rows}
    for (faculty, slot), (_, size) in said.items():
        lying = sum(os.path.getsize(p) for p in files(path) if f"faculty={faculty}/{SLOT}={slot}/" in p)
        assert lying == size
    for faculty in {f for f, _ in said}:
        assert sum(2.0 ** -(s.bit_length() - 1) for f, s in said if f == faculty) == 1.0


def test_only_full_slots_split_as_a_table_grows(spark, folder):
    path = f"{folder}/t"
    room = 60_000
    upsert(batch(spark, range(600)), path, slot_bytes=room)
    before, many = files(path), len(slots(path))
    assert many > 1
    # a batch put again fits as it did
    upsert(batch(spark, range(600)), path, slot_bytes=room)
    assert len(slots(path)) == many and len(stored(spark, path)) == 600
    # one key: one folder rewritten
    before = files(path)
    upsert(batch(spark, [7], v=3), path, slot_bytes=room)
    assert len({os.path.dirname(p) for p in before - files(path)}) == 1 and len(slots(path)) == many
    check_directory(spark, path)
    # keys of one slot only: that slot splits, the others keep their files
    said = directory(spark, path)
    full = max(said, key=lambda k: said[k][1])[1]
    depth = full.bit_length() - 1
    kin = spark.range(1000, 9000).select(F.col("id"), F.xxhash64(F.lit("u"), F.lit("f"), F.concat(F.lit("k"), "id")).alias("h"))
    kin = [r.id for r in kin.where(F.shiftrightunsigned("h", 64 - depth) + (1 << depth) == full).limit(400).collect()]
    before = slots(path)
    kept = {p for p in files(path) if f"{SLOT}={full}/" not in p}
    upsert(batch(spark, kin), path, slot_bytes=room)
    gone, new = before - slots(path), slots(path) - before
    assert [int(p.rsplit("=", 1)[1]) for p in gone] == [full]
    assert len(new) > 1 and all(bin(int(p.rsplit("=", 1)[1])).startswith(bin(full)) for p in new)
    assert kept <= files(path)
    check_directory(spark, path)
    # ten times the table: most slots split, nothing is lost or doubled
    upsert(batch(spark, range(10_000, 14_000)), path, slot_bytes=room)
    check_directory(spark, path)
    assert len(stored(spark, path)) == spark.read.parquet(path).count() == 600 + len(kin) + 4000
    assert max(size for _, size in directory(spark, path).values()) < 1.5 * room


def test_partitions_of_all_sizes_in_one_batch(spark, folder):
    path = f"{folder}/t"
    rows = batch(spark, range(600), faculty="large").unionByName(batch(spark, range(3), faculty="small"))
    upsert(rows, path, slot_bytes=40_000)
    per = {f: sum("faculty=" + f in p for p in slots(path)) for f in ("large", "small")}
    assert per["small"] == 1 and per["large"] > 1
    upsert(batch(spark, range(5), v=9, faculty="small").unionByName(batch(spark, [0], faculty="new")), path, slot_bytes=40_000)
    assert spark.read.parquet(path).groupBy("faculty").count().orderBy("faculty").collect() == [("large", 600), ("new", 1), ("small", 5)]
    check_directory(spark, path)


def test_keys_of_slots_without_rows(spark, folder):
    path = f"{folder}/t"
    upsert(batch(spark, range(3)), path, slots=16)
    assert len(slots(path)) <= 3
    upsert(batch(spark, range(40), v=2), path, slots=16)
    assert stored(spark, path) == {f"k{i}": 2 for i in range(40)}
    check_directory(spark, path)


def scanned_rows(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_skips_row_groups_and_files_are_in_hash_order(spark, folder, monkeypatch):
    monkeypatch.setattr(module, "ROW_GROUP_BYTES", 64 * 1024)
    path = f"{folder}/t"
    upsert(batch(spark, range(20_000)), path)
    assert len(files(path)) == 1
    schema = batch(spark, [0]).schema
    found = rows_of_keys(spark, path, schema, [("k77",), ("k19999",), ("nowhere",)])
    assert sorted(r.record_id for r in found.collect()) == ["k19999", "k77"]
    assert 2 <= scanned_rows(found) < 4_000
    hashes = [r.h for r in spark.read.parquet(path).select(F.xxhash64("university", "faculty", "record_id").alias("h")).collect()]
    assert hashes == sorted(hashes)
    assert rows_of_keys(spark, path, schema, []).count() == 0
    with pytest.raises(ValueError):
        rows_of_keys(spark, path, schema, [(str(i),) for i in range(module.LOOKUP_KEYS + 1)])


def test_a_small_batch_put_again_rewrites_nothing(spark, folder):
    path = f"{folder}/t"
    upsert(batch(spark, range(300)), path, slots=4)
    before = files(path)
    assert upsert(batch(spark, range(20)), path, slots=4) == 20
    assert files(path) == before
    assert upsert(batch(spark, [1]).unionByName(batch(spark, [2], v=5)), path, slots=4) == 2
    assert len({os.path.dirname(p) for p in before - files(path)}) == 1
    assert stored(spark, path) == {f"k{i}": 5 if i == 2 else 1 for i in range(300)}


@pytest.mark.parametrize("step", ["_settle", "delete_folders"])
def test_a_batch_run_again_completes_a_crashed_one(spark, folder, monkeypatch, step):
    path = f"{folder}/t"
    upsert(batch(spark, range(300)), path, slot_bytes=60_000)
    second = batch(spark, range(200, 3000), v=2)
    calls = []

    def crash(*args, **more):
        calls.append(1)
        if step == "_settle" or len(calls) > 1:
            raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(module, step, crash)
        with pytest.raises(RuntimeError):
            upsert(second, path, slot_bytes=60_000)
    upsert(second, path, slot_bytes=60_000)
    assert stored(spark, path) == {f"k{i}": 1 if i < 200 else 2 for i in range(3000)}
    assert spark.read.parquet(path).count() == 3000
    check_directory(spark, path)


def test_manifest_of_many_small_partitions(spark, folder):
    """150 partitions of about a hundred rows are 150 files."""
    from quadrangle.plans import crawl
    from workload import fixtures as fx
    from workload.queries import _fetched

    path = f"{folder}/manifest"
    rows = crawl.manifest(_fetched(spark, "/root/testdata/sf0.1"), fx.instant())
    crawl.store_manifest(rows, path)
    assert len(files(path)) <= 200
    assert read_table(spark, path, schemas.MANIFEST).count() == rows.count()
    assert sum(map(os.path.getsize, files(path))) < 4_000_000


def test_the_scan_reads_only_touched_partitions(spark, folder):
    path = f"{folder}/t"
    for faculty in ("f1", "f2", "f3"):
        upsert(batch(spark, range(20), faculty=faculty), path)
    schema = batch(spark, [0]).schema
    touched = spark.createDataFrame([("u", "f2", 1)], "university string, faculty string, key_slot long")
    near = module.touched_rows(read_table(spark, path, module.with_slot(schema)), touched, ["university", "faculty"])
    assert near.count() == 20
    near.collect()
    plan = near._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("dynamicpruning") >= 3, text
