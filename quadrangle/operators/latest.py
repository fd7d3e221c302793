"""One row per key, and the first n rows per group."""

from pyspark.sql import Window
from pyspark.sql import functions as F


def first_per_key(df, keys, order):
    """The first row of every key under `order`, which should be total.

    Spark turns the `= 1` filter into a limit per map task ahead of the shuffle, so
    a key that holds a third of the rows sends one row per task, not its whole group.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")
    )


def cap_rows(df, groups, order, limit, salts=1024):
    """The first `limit` rows of every group under `order`.

    Two exact steps: the cap is taken inside `salts` slices of each group, then over
    what the slices kept. A row of the final result is always among the first `limit`
    of its slice, so nothing is lost, and no task ever ranks a whole large group.
    The partition number in the slice spreads exact copies; it is the same when a
    task is run again.
    """
    spread = F.xxhash64(*[F.col(c) for c in df.columns], F.spark_partition_id())
    slice_no = F.pmod(spread, F.lit(salts))
    in_slice = Window.partitionBy(*groups, "_slice").orderBy(*order)
    in_group = Window.partitionBy(*groups).orderBy(*order)
    return (
        df.withColumn("_slice", slice_no)
        .withColumn("_rank", F.row_number().over(in_slice))
        .filter(F.col("_rank") <= limit)
        .withColumn("_rank", F.row_number().over(in_group))
        .filter(F.col("_rank") <= limit)
        .drop("_slice", "_rank")
    )
