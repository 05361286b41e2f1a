"""What several operators of this package need: inputs, written tables, joins with hot keys."""

from __future__ import annotations

import sys
import types

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ratingloom.session import scratch_folder

# What a task uses of this module travels with it, so that workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
# A key is hot if it holds more than 1/HOT of all rows, so there are fewer than HOT hot keys.
HOT = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """The rows written as Parquet to the shared folder and read back: cuts the lineage, so a lost
    executor costs a re-read, and fixes values such as generated row ids."""
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Working:
    """Written tables that a step needs only until its result is written."""

    def __init__(self) -> None:
        self.paths: list[tuple[SparkSession, str]] = []

    def written(self, df: DataFrame, label: str) -> DataFrame:
        out = written(df, label)
        self.paths.append((df.sparkSession, out.inputFiles()[0].rsplit("/", 1)[0] if out.inputFiles() else ""))
        return out

    def drop(self) -> None:
        """Deletes the tables. Whatever was made of them must have been written."""
        for spark, path in self.paths:
            if path:
                place = spark._jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        self.paths = []


def process_memo(name: str) -> dict:
    """A dictionary that lives as long as a Python worker, which runs many tasks. Only for values
    that can be computed again at any time."""
    return vars(sys.modules.setdefault(f"_ratingloom_{name}", types.ModuleType(name)))


def join_counted(facts: DataFrame, groups: DataFrame, key: str, count: str, total: int,
                 spread: Column, hot: int = HOT) -> DataFrame:
    """Left join of ``facts`` with one row per key of ``groups``, whatever share a key holds.

    ``groups`` has ``key``, ``count`` (facts of that key, ``total`` in all) and further columns,
    which come back as the struct ``_group``. Fewer than ``hot`` keys can exceed ``total / hot``:
    these are broadcast. Their facts then go on under a key made from ``spread``, so that the
    sort-merge join of the rest never receives a hot key.
    """
    values = F.struct(*[c for c in groups.columns])
    is_hot = F.col(count) * hot > F.lit(total)
    kind = dict(groups.dtypes)[key]
    few = F.broadcast(groups.where(is_hot).select(F.col(key).alias("_hot_key"),
                                                  values.alias("_hot")))
    rest = groups.where(~is_hot).select(F.col(key).alias("_cold_key"), values.alias("_cold"))
    dealt = (facts.join(few, F.col(key) == F.col("_hot_key"), "left")
             .withColumn("_spread_key", F.when(F.col("_hot").isNotNull(),
                                               F.xxhash64(F.lit("spread"), spread).cast(kind))
                         .otherwise(F.col(key))))
    return (dealt.join(rest, F.col("_spread_key") == F.col("_cold_key"), "left")
            .withColumn("_group", F.coalesce("_hot", "_cold"))
            .drop("_hot_key", "_hot", "_cold_key", "_cold", "_spread_key"))


def row_hash(text: str = "text") -> Column:
    """Tells apart rows that repeat a doc_id with another text."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def own_orders(rows: DataFrame, keep=None) -> DataFrame:
    """``rows`` (order, row, ...; written, so that the generated ``row`` is fixed) with another order for
    every copy but the first of rows that share one. Copies are numbered by the part of the table that
    holds them and within it, so no task holds all; orders that are unique stay as they are."""
    part = F.shiftrightunsigned("row", 33)
    same = Window.partitionBy("order")
    shared = (keep or written)(
        rows.groupBy("order", part.alias("part")).agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(same.orderBy("part")) - F.col("n"))
        .withColumn("all", F.sum("n").over(same)).where("all > 1").select("order", "part", "before"), "copies")
    if shared.isEmpty():
        return rows
    inside = Window.partitionBy("order", "part").orderBy("row")
    copies = (rows.select("order", "row", part.alias("part")).join(shared, ["order", "part"])
              .select(F.col("row").alias("_row"),
                      (F.col("before") + F.row_number().over(inside) - 1).alias("_copy")).where("_copy > 0"))
    return (rows.join(copies, F.col("row") == F.col("_row"), "left")
            .withColumn("order", F.when(F.col("_copy").isNotNull(), F.xxhash64("order", "_copy"))
                        .otherwise(F.col("order"))).drop("_row", "_copy"))
