"""Slots of a keyed table: folders below its partitions that split as they fill.

A slot is a prefix of the bits of the hash of a key, written as a number: 1 is the empty
prefix, and the slot s with one bit more is 2 s or 2 s + 1. A partition begins with as
many slots as its first rows need; later only a slot that is over-full is split. What
slots there are, with their rows and stored bytes, is kept in a small table of its own
below the data, to which every change of the table appends.
"""

from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quadrangle.operators.latest import first_per_key

SLOT = "key_slot"
HASH = "_key_hash"
DIRECTORY = "_slots"  # readers of the data skip folders that begin with an underscore
DEEPEST = 40


def meet(left, right, columns, how="inner", carry=(), small=False):
    """Join on null-safe equality of `columns`, as a folder without a name still is one
    folder. The right side gives its `carry` columns; it is broadcast if counted `small`."""
    other = right.select(*[F.col(c).alias(f"_on_{c}") for c in columns], *carry)
    condition = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in columns])
    joined = left.join(F.broadcast(other) if small else other, condition, how)
    return joined.drop(*[f"_on_{c}" for c in columns])


def depth_of(slot):
    """Bits in the prefix a slot stands for."""
    return F.length(F.bin(slot)) - 1


def slot_at(key_hash, depth):
    """The slot of a hash at a depth. A shift by 64 is none, hence the case of no bits."""
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), depth)
    return F.when(depth == 0, F.lit(1).cast("bigint")).otherwise(one + F.call_function("shiftrightunsigned", key_hash, 64 - depth))


def levels(size, room):
    """Halvings after which `size` bytes fit into `room`."""
    return F.when(size > room, F.least(F.ceil(F.log2(size / room)).cast("int"), F.lit(DEEPEST))).otherwise(0)


class Directory:
    """The slots of one table; rows: partitions, key_slot, rows, bytes, version.

    The latest row of a slot counts. Live slots tile the hashes of their partition, those
    without a row included; rows below zero mark a slot that has been split."""

    def __init__(self, spark, path, schema, partitions):
        self.spark, self.path, self.partitions = spark, f"{path}/{DIRECTORY}", list(partitions)
        fields = [f"`{p}` {schema[p].dataType.simpleString()}" for p in partitions]
        self.schema = ", ".join([*fields, f"{SLOT} bigint", "rows bigint", "bytes bigint", "version bigint"])

    def log(self):
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)

    def latest(self):
        return first_per_key(self.log(), [*self.partitions, SLOT], [F.col("version").desc()])

    def live(self):
        return self.latest().where("rows >= 0").drop("version")

    def version(self):
        """Number of the last change, 0 for a table that has none."""
        return self.log().agg(F.max("version")).first()[0] or 0

    def append(self, rows, version):
        columns = [*self.partitions, SLOT, "rows", "bytes"]
        rows.select(*columns, F.lit(version).cast("bigint").alias("version")).coalesce(1).write.mode("append").parquet(self.path)

    def split_away(self, version):
        """Slots that were split in one change."""
        return self.log().where((F.col("version") == version) & (F.col("rows") < 0)).select(*self.partitions, SLOT)


def delete_folders(spark, path, folders):
    """Delete the folders of split slots; `folders` has the partition columns and the slot.

    They come to the driver one by one, as do the renames of a commit."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    named = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for row in folders.toLocalIterator():
        parts = [named.getPartitionPathString(c, None if row[c] is None else str(row[c])) for c in folders.columns]
        folder = jvm.org.apache.hadoop.fs.Path("/".join([path, *parts]))
        folder.getFileSystem(conf).delete(folder, True)


def stored_bytes(spark, path):
    """Bytes below a path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
