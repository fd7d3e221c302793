"""Session defaults and the shared scratch folder."""

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


COMPRESSION = "zstd"
PARTITION_BYTES = 512 * 1024 * 1024
MAX_PARTITIONS = 100_000


def shuffle_partitions(input_bytes):
    """Shuffle partitions of about `PARTITION_BYTES` each.

    Never below Spark's default, nor above what a driver can track and a table can be
    bucketed into; beyond that partitions grow, and spill.
    """
    return min(MAX_PARTITIONS, max(200, -(-input_bytes // PARTITION_BYTES)))


def build_session(app_name="quadrangle", input_bytes=None):
    """A session with the settings the jobs are tuned for; master comes from the launcher.

    `input_bytes` sizes the shuffles for inputs far above what 200 partitions can hold;
    adaptive execution merges what turns out small.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions(input_bytes))
    return builder.getOrCreate()


def ship_code(spark):
    """Send this package to the executors, once per context, so that Python tasks can import
    it wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_quadrangle_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="code-"), "quadrangle.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in sorted(os.walk(home)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(home)))
    context.addPyFile(archive)
    context._quadrangle_shipped = True


def shared_dir(spark):
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    There is no other: on any master the folder must be named.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if current is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return current.rstrip("/")


def scratch_path(spark, name):
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def discard(spark, *paths):
    """Delete intermediate data that nothing will read again."""
    context = spark.sparkContext
    for path in paths:
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def cut(df):
    """Write `df` to the shared folder and read it back, so that retries and later steps
    never replay the plan behind it and the planner knows its size."""
    return cut_with_path(df)[0]


def cut_with_path(df):
    """`cut`, and where the rows lie."""
    path = scratch_path(df.sparkSession, "cut")
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path
