"""Keyed upsert into a partitioned Parquet table."""

from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quadrangle.operators.latest import first_per_key
from quadrangle.operators.slots import (
    HASH, SLOT, Directory, delete_folders, depth_of, levels, meet, slot_at, stored_bytes,
)
from quadrangle.session import COMPRESSION, cut, cut_with_path, discard

SLOT_BYTES = 128 * 1024 * 1024
ROW_GROUP_BYTES = 16 * 1024 * 1024
BROADCAST_SLOTS = 500_000
BROADCAST_KEYS = 200_000
LOOKUP_KEYS = 500


def read_table(spark, path, schema):
    """The stored rows, or an empty table where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def with_slot(schema):
    """The schema with the slot a row lies in."""
    return StructType([*[f for f in schema.fields if f.name != SLOT], StructField(SLOT, LongType())])


def upsert(batch, path, keys=("record_id",), order="business_timestamp", partitions=("university", "faculty"), slots=1, slot_bytes=SLOT_BYTES):
    """Merge `batch` into the table at `path`; returns the number of rows put.

    Within the batch the newest row per key wins; it replaces the stored row of that
    key; stored rows without a match stay. A key is scoped to its partition.

    Below its partitions a table has slots (see `slots`). A partition begins with at least
    `slots` of them and as many as its rows need at `slot_bytes` each; a slot that would
    hold more after a batch is split, all others stay as they are. A batch rewrites only
    slots that one of its keys falls into, and reads no others. Rows of a file are in the
    order of the hash of their keys, and the keys have Bloom filters: a batch of at most
    `LOOKUP_KEYS` rows first asks for its keys, and what is stored already is not put again.

    The batch is worked out once, into a staged table. Spark swaps the rewritten folders
    in when the whole write has succeeded, folder by folder; after that the directory of
    slots is brought up to date and folders of split slots go. A crash in between leaves
    some folders new, and running the batch again completes it. Needs one writer per table at a time, and a committer
    that supports dynamic overwrite.
    """
    spark, schema, partitions = batch.sparkSession, batch.schema, list(partitions)
    # a folder cannot tell an empty name from a missing one, so neither may the keys
    names = [p for p in partitions if schema[p].dataType == StringType()]
    batch = batch.withColumns({p: F.nullif(F.col(p), F.lit("")) for p in names})
    scope = [*partitions, *keys]
    staged, staged_path = cut_with_path(batch.withColumn(HASH, F.xxhash64(*scope)))
    staged, staged_path = _one_per_key(staged, staged_path, scope, order)
    rows = staged.count()
    if rows:
        _put(spark, path, schema, staged, staged_path, rows, scope, keys, partitions, slots, slot_bytes)
    discard(spark, staged_path)
    return rows


def _put(spark, path, schema, staged, staged_path, rows, scope, keys, partitions, slots, slot_bytes):
    """Bring the staged rows, one per key, into the table."""
    directory = Directory(spark, path, schema, partitions)
    version = directory.version()
    if version:
        delete_folders(spark, path, directory.split_away(version))  # what a crash may have left
        if rows <= LOOKUP_KEYS:
            staged = cut(_changed(spark, path, schema, staged, scope, keys))
            if staged.isEmpty():
                return
    row_bytes = max(1.0, stored_bytes(spark, staged_path) / rows)
    depths = _depths(staged, directory, row_bytes, slots, slot_bytes) if version else _first_depths(staged, partitions, row_bytes, slots, slot_bytes)
    touched = _touched(spark, path, schema, staged, depths, directory, scope, row_bytes, slot_bytes, version > 0)
    folders, size = touched.agg(F.count(F.lit(1)), F.sum("size")).first()
    small = folders <= BROADCAST_SLOTS
    placed = _moved(_candidates(staged, depths, partitions, small), touched, partitions, small)
    merged = placed
    if version:
        stored = read_table(spark, path, with_slot(schema)).withColumn(HASH, F.xxhash64(*scope))
        near = _moved(touched_rows(stored, touched, partitions, small), touched, partitions, small)
        merged = meet(near, staged, scope, "left_anti", small=rows <= BROADCAST_KEYS).unionByName(placed)
    # less than one slot in all: what costs then is opening a file per folder
    tasks = min(folders, spark.sparkContext.defaultParallelism) if size < slot_bytes else None
    _write(merged, path, [*partitions, SLOT], keys, tasks)
    _settle(spark, path, schema, touched, depths, directory, version + 1, small)


def _one_per_key(staged, path, scope, order):
    """The newest row per key, other columns settling ties, and where the rows lie.

    Whole rows are shuffled for keys that occur more than once only."""
    twice = staged.groupBy(*scope).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*scope)
    if twice.isEmpty():
        return staged, path
    twice = cut(twice)
    rest = [F.col(c).asc() for c in staged.columns if c not in (*scope, order, HASH)]
    newest = first_per_key(meet(staged, twice, scope, "left_semi"), scope, [F.col(order).desc(), *rest])
    single, single_path = cut_with_path(meet(staged, twice, scope, "left_anti").unionByName(newest))
    discard(staged.sparkSession, path)
    return single, single_path


def _first_depths(staged, partitions, row_bytes, slots, slot_bytes):
    """(partitions, depths): the one depth a new partition begins at."""
    start = (slots - 1).bit_length()
    depth = F.greatest(F.lit(start), levels(F.count(F.lit(1)) * row_bytes, F.lit(slot_bytes)))
    return staged.groupBy(*partitions).agg(F.array(depth).alias("depths"), F.lit(True).alias("is_new"))


def _depths(staged, directory, row_bytes, slots, slot_bytes):
    """(partitions, depths): the depths at which each partition of the batch has slots."""
    fresh = _first_depths(staged, directory.partitions, row_bytes, slots, slot_bytes).withColumnRenamed("depths", "first").drop("is_new")
    known = directory.live().groupBy(*directory.partitions).agg(F.collect_set(depth_of(F.col(SLOT))).alias("depths"))
    both = meet(fresh, known, directory.partitions, "left", ["depths"])
    return both.withColumn("is_new", F.col("depths").isNull()).withColumn("depths", F.coalesce("depths", "first")).drop("first")


def _candidates(rows, depths, partitions, small):
    """Rows with every slot that may be theirs, one per depth of their partition."""
    at = meet(rows, depths, partitions, "inner", ["depths", "is_new"], small).withColumn("_depth", F.explode("depths"))
    return at.withColumn(SLOT, slot_at(F.col(HASH), F.col("_depth"))).drop("_depth", "depths")


def _touched(spark, path, schema, staged, depths, directory, scope, row_bytes, slot_bytes, is_stored):
    """(partitions, key_slot, is_stored, size, extra): the slots the batch falls into, their
    bytes after it, and by how many bits each is to be split."""
    partitions, folders = directory.partitions, [*directory.partitions, SLOT]
    asked = _candidates(staged.select(*partitions, HASH), depths, partitions, False).groupBy(*folders, "is_new").agg(F.count(F.lit(1)).alias("put"))
    met = meet(asked, directory.live(), folders, "left", ["rows", "bytes"]).where(F.col("is_new") | F.col("rows").isNotNull())
    sized = met.select(
        *folders, "put", F.col("rows").isNotNull().alias("is_stored"),
        F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("bytes", F.lit(0)).alias("bytes"),
    )
    sized = cut(sized)
    # rows put may replace stored ones; only where both together do not fit is that looked up
    full = sized.where(F.col("is_stored") & (F.col("bytes") + F.col("put") * row_bytes > slot_bytes))
    known = is_stored and not full.isEmpty()
    if known:
        stored = touched_rows(read_table(spark, path, with_slot(schema)), full, partitions, False)
        hits = meet(stored, staged, scope, "left_semi").groupBy(*folders).agg(F.count(F.lit(1)).alias("replaced"))
        sized = meet(sized, hits, folders, "left", ["replaced"])
    replaced = F.coalesce("replaced", F.lit(0)) if known else F.lit(0)
    kept = F.col("bytes") * (F.col("rows") - replaced) / F.greatest("rows", F.lit(1))
    size = kept + F.col("put") * row_bytes
    extra = F.when(F.col("is_stored"), levels(size, F.lit(slot_bytes))).otherwise(0)
    touched = sized.select(*folders, "is_stored", size.alias("size"), extra.alias("extra"))
    return cut(touched) if known else touched


def _moved(rows, touched, partitions, small):
    """Rows of touched slots, each in the slot it belongs to after the splits."""
    joined = meet(rows, touched, [*partitions, SLOT], "inner", ["extra"], small)
    target = slot_at(F.col(HASH), depth_of(F.col(SLOT)) + F.col("extra"))
    return joined.withColumn(SLOT, target).drop("extra", "is_new")


def touched_rows(stored, touched, partitions, small=True):
    """Stored rows of the slots in `touched`; only their folders are scanned.

    The slots, counted before, prune the scan while it runs. A folder without a name is
    compared as the empty text, which no folder has as its name."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    folders = touched.where(F.col(SLOT) >= 0).select(
        *[named(c).alias(f"_on_{c}") for c in partitions], F.col(SLOT).alias("_on_slot")
    ).distinct()
    same_folder = reduce(and_, [named(c) == F.col(f"_on_{c}") for c in partitions], F.col(SLOT) == F.col("_on_slot"))
    return stored.join(F.broadcast(folders) if small else folders, same_folder, "left_semi")


def _write(merged, path, folders, keys, tasks=None):
    """Replace the folders of the rows; rows in the order of their hash, keys with Bloom filters.

    By default small folders share a task and a folder that holds too much is split."""
    dealt = merged.repartition(tasks, *folders) if tasks else merged.hint("rebalance", *folders)
    out = dealt.sortWithinPartitions(*folders, HASH).drop(HASH).write.mode("overwrite")
    for key in keys:
        out = out.option(f"parquet.bloom.filter.enabled#{key}", "true")
        out = out.option(f"parquet.bloom.filter.candidates.number#{key}", "12")  # down to 512 bytes
    (
        out.option("compression", COMPRESSION)
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .option("parquet.block.size", str(ROW_GROUP_BYTES))
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .parquet(path)
    )


def _settle(spark, path, schema, touched, depths, directory, version, small):
    """Enter what the touched slots hold now, and take away the folders of split ones.

    Slots without a row are entered too, so that every key of a known partition has one."""
    partitions, folders = directory.partitions, [*directory.partitions, SLOT]
    begin, zero = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.get("depths", F.lit(0))), F.lit(0).cast("bigint")
    begun = depths.where("is_new").select(*partitions, F.explode(F.sequence(begin, 2 * begin - 1)).alias(SLOT))
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("extra"))
    children = touched.where("is_stored").select(*partitions, F.explode(F.sequence(F.col(SLOT) * width, F.col(SLOT) * width + width - 1)).alias(SLOT))
    now = begun.unionByName(children)
    files = touched_rows(_file_rows(spark, path, schema), now, partitions, small)
    held = files.groupBy(*folders, "file").agg(F.count(F.lit(1)).alias("rows"), F.first("size").alias("bytes"))
    held = held.groupBy(*folders).agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
    entered = meet(now, held, folders, "left", ["rows", "bytes"]).withColumns({c: F.coalesce(c, zero) for c in ("rows", "bytes")})
    gone = touched.where("is_stored AND extra > 0").select(*folders)
    directory.append(entered.unionByName(gone.select("*", (zero - 1).alias("rows"), zero.alias("bytes"))), version)
    delete_folders(spark, path, gone)


def _file_rows(spark, path, schema):
    """A row per stored row with its file and the file's size; no column of the data is read."""
    stored = spark.read.schema(with_slot(schema)).parquet(path)
    return stored.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))


def rows_of_keys(spark, path, schema, wanted, keys=("record_id",)):
    """Stored rows with one of the wanted keys, a list of tuples of at most `LOOKUP_KEYS`.

    The keys go into the scan as literals, one condition each, so that Bloom filters skip
    the row groups that hold none."""
    if len(wanted) > LOOKUP_KEYS:
        raise ValueError(f"at most {LOOKUP_KEYS} keys, got {len(wanted)}")
    stored = read_table(spark, path, with_slot(schema))
    if not wanted:
        return stored.limit(0).drop(SLOT)
    one = [reduce(and_, [F.col(k) == F.lit(v) for k, v in zip(keys, row, strict=True)]) for row in sorted(set(wanted))]
    return stored.where(_any(one)).drop(SLOT)


def _any(conditions):
    """Disjunction as a balanced tree, so that its depth stays small."""
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return _any(conditions[:half]) | _any(conditions[half:])


def _changed(spark, path, schema, staged, scope, keys):
    """The rows of a small batch that are not stored as they are."""
    wanted = [tuple(row) for row in staged.select(*keys).distinct().collect()]
    if any(value is None for row in wanted for value in row):
        return staged
    stored = rows_of_keys(spark, path, schema, wanted, keys)
    return meet(staged, stored, schema.names, "left_anti")
