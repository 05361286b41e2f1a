"""The first n rows of a table by a stated order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

ROWS = 10_000
FAN_IN = 256


def sample_n(df: DataFrame, order_by: list[str | Column], n: int = ROWS,
             fan_in: int = FAN_IN) -> DataFrame:
    """First ``n`` rows by ``order_by``, which should be a total order.

    Two steps, as a table with hundreds of thousands of input partitions would send n rows of each
    to one task: every partition keeps its first n, a group of ``fan_in`` partitions keeps
    the first n of those, and the final limit sees one n per group.
    """
    group = Window.partitionBy("_group").orderBy(*order_by)
    kept = (df.withColumn("_group", F.floor(F.spark_partition_id() / F.lit(fan_in)))
            .withColumn("_row", F.row_number().over(group))
            .where(F.col("_row") <= n)
            .drop("_group", "_row"))
    return kept.orderBy(*order_by).limit(n)
