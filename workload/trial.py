"""What a session needs before a registered query runs."""

import functools
import tempfile

from quadrangle.session import ship_code


def ensure_scratch(spark):
    """Name a folder for intermediate data where none is named and one machine runs all tasks."""
    context = spark.sparkContext
    one_machine = context.master == "local" or context.master.startswith("local[")
    if one_machine and not spark.conf.get("spark.checkpoint.dir", None) and context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))


def with_scratch(query):
    """The query, run once the session has its shared folder and the package's code."""

    @functools.wraps(query)
    def run(spark, sf_dir):
        ensure_scratch(spark)
        ship_code(spark)
        return query(spark, sf_dir)

    return run
