"""Marks up to which a repeated job has come, in a small table that is appended to."""

from pyspark.sql import functions as F

from quadrangle.operators.upsert import read_table
from quadrangle.schemas import MARK


def read_mark(spark, path, job):
    """The last mark of a job, None where it has none."""
    return read_table(spark, path, MARK).where(F.col("job") == job).agg(F.max("mark")).first()[0]


def write_mark(spark, path, job, mark):
    """Enter a mark; marks only grow."""
    spark.createDataFrame([(job, mark)], MARK).write.mode("append").parquet(path)
