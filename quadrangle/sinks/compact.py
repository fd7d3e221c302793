"""Merging of the batch folders of a raw zone into few files of even size."""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quadrangle.session import cut

JOURNAL = "_merges"  # readers skip folders that begin with an underscore
MERGED = "merged-"
LOG_LEVELS = ("university", "faculty", "year", "month", "day")
LANDING_LEVELS = ("university", "faculty", "type", "year", "month", "day")


def batch_files(spark, root, levels=LOG_LEVELS):
    """folder, batch, place, path and length of every file in a batch folder; contents stay
    unread. `place` is folder and batch as a scan of lines spells them."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/{levels[0]}=*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "folder string, batch string, place string, path string, length bigint")
    found = files.select(
        F.regexp_extract("path", _inside(levels, r"/batch=[^/]+/[^/]+\z"), 1).alias("folder"),
        F.regexp_extract("path", r"/batch=([^/]+)/[^/]+\z", 1).alias("batch"),
        _place(levels).alias("place"), "path", "length",
    )
    return found.where("folder <> '' AND batch <> ''")


def _inside(levels, rest):
    return "/(" + "/".join(f"{c}=[^/]+" for c in levels) + ")" + rest


def _place(levels):
    return F.regexp_extract("_metadata.file_path", _inside([*levels, "batch"], r"/[^/]+\z"), 1)


def compact(spark, root, settled, levels=LOG_LEVELS):
    """Merge batches of each folder at `levels`; returns how many folders were merged.

    Taken are batches whose name comes before `settled`, which nobody will write again, and
    those merged earlier, where there are at least two of them. Their lines are written to
    new files, small ones together and large ones split, in a place readers skip; then a
    journal is entered, and folder by folder the new batch is moved in and the old ones
    are deleted. Lines are not changed, and none is lost or doubled in the end: a run after
    a crash first finishes the merges in the journal. To be run while nothing reads the zone."""
    _finish(spark, root)
    found = batch_files(spark, root, levels).where((F.col("batch") < settled) | F.col("batch").startswith(MERGED))
    per_folder = found.groupBy("folder").agg(
        F.collect_set("batch").alias("batches"), F.collect_set("place").alias("places"),
        F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"),
    ).where(F.size("batches") > 1)
    name = MERGED + uuid.uuid4().hex
    todo = cut(per_folder.withColumn("into", F.lit(name)))
    folders, size, files = todo.agg(F.count(F.lit(1)), F.sum("bytes"), F.sum("files")).first()
    if not folders:
        return 0
    names = ", ".join(f"{c} string" for c in [*levels, "batch"])
    lines = spark.read.schema(f"value string, {names}").option("basePath", root).option("pathGlobFilter", "*.txt").text(
        f"{root}/" + "/".join(f"{c}=*" for c in [*levels, "batch"])
    )
    wanted = todo.select(F.explode("places").alias("place"))
    taken = lines.withColumn("place", _place(levels)).join(wanted, "place", "left_semi")
    staging = f"{root}/_{name}"
    taken.select("value", *levels, F.lit(name).alias("batch")).hint("rebalance", *levels).write.partitionBy(*levels, "batch").text(staging)
    # every byte must be there before anything goes; a file's last line may lack its end
    staged = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(staging).agg(F.sum("length")).first()[0]
    if not size <= (staged or 0) <= size + files:
        raise RuntimeError(f"{staged} of {size} bytes in {staging}")
    todo.select("folder", "batches", "into").write.mode("append").parquet(f"{root}/{JOURNAL}")
    _finish(spark, root)
    return folders


def _finish(spark, root):
    """Carry out what the journal says, as far as it is still to be done, and empty it."""
    jvm = spark._jvm
    new = jvm.org.apache.hadoop.fs.Path
    journal = new(f"{root}/{JOURNAL}")
    fs = journal.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(journal):
        return
    names = set()
    # one folder at a time, as a commit of Spark moves them
    for row in spark.read.parquet(journal.toString()).toLocalIterator():
        names.add(row.into)
        ready = new(f"{root}/_{row.into}/{row.folder}/batch={row.into}")
        if fs.exists(ready) and not fs.rename(ready, new(f"{root}/{row.folder}/batch={row.into}")):
            raise RuntimeError(f"cannot move {ready.toString()}")
        for batch in row.batches:
            fs.delete(new(f"{root}/{row.folder}/batch={batch}"), True)
    fs.delete(journal, True)
    for name in names:
        fs.delete(new(f"{root}/_{name}"), True)
