"""Tables that share one layout by business, so that what groups or joins by business moves no row.

Each table is bucketed and sorted by ``business_id`` into the same number of files. A business that holds a
large share of the reviews would make its bucket one long task, so such businesses, of which there are
few, are kept in files of their own, are dealt as usual, and what is made of them is added to the rest.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratingloom.operators import trends
from ratingloom.operators.spread import hot_keys

KEY = "business_id"
BUCKETS = 64


class BusinessStore:
    """Tables below one folder that all executors share, in the session's catalog until ``close``."""

    def __init__(self, spark: SparkSession, folder: str, reviews: DataFrame, buckets: int = BUCKETS) -> None:
        """``reviews`` tells which businesses are hot: those with more rows than two buckets hold on average."""
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        self.hot = sorted(hot_keys(reviews, [KEY], min(1.0, 2 / buckets))[0])
        self.kind = dict(reviews.dtypes)[KEY]
        self.prefix = f"business_{uuid.uuid4().hex}"
        self.names: list[str] = []

    def _is_hot(self) -> Column:
        return F.xxhash64(F.col(KEY).cast(self.kind)).isin(self.hot) if self.hot else F.lit(False)

    def keep(self, name: str, df: DataFrame) -> None:
        """Writes a table. Rows are dealt by bucket first, so that each bucket is one file."""
        apart = self._is_hot()
        (df.where(F.coalesce(~apart, F.lit(True))).repartition(self.buckets, KEY).write.mode("overwrite")
         .bucketBy(self.buckets, KEY).sortBy(KEY).option("path", f"{self.folder}/{name}")
         .saveAsTable(f"{self.prefix}_{name}"))
        if self.hot:
            df.where(apart).write.mode("overwrite").parquet(f"{self.folder}/{name}-hot")
        self.names.append(name)

    def bucketed(self, name: str) -> DataFrame:
        """The rows of all businesses that are not hot."""
        return self.spark.table(f"{self.prefix}_{name}")

    def apart(self, name: str) -> DataFrame:
        """The rows of the hot businesses."""
        return self.spark.read.parquet(f"{self.folder}/{name}-hot")

    def made(self, make: Callable[..., DataFrame], *names: str) -> DataFrame:
        """What ``make`` gives of the named tables, business by business."""
        rest = make(*[self.bucketed(n) for n in names])
        return rest.unionByName(make(*[self.apart(n) for n in names])) if self.hot else rest

    def of(self, name: str, business_id) -> DataFrame:
        """The rows of one business: one bucket is read, in which its rows stand together, or, if it is hot, the
        files kept apart."""
        one = self.bucketed(name).where(F.col(KEY) == business_id)
        return one.unionByName(self.apart(name).where(F.col(KEY) == business_id)) if self.hot else one

    def close(self) -> None:
        """Takes the tables out of the catalog; the files stay."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.prefix}_{name}")


def monthly_trends(raw: DataFrame, places: DataFrame) -> DataFrame:
    """The monthly series with differences and flags, and the business's name and place."""
    series = trends.month_over_month(trends.monthly_ratings(raw))
    flagged = series.withColumn("spike_or_dip", trends.flag_of(trends.THRESHOLD))
    return trends.with_business(flagged, places, trends.MONTH_ATTRIBUTES)


def spike_reviews(raw: DataFrame, flagged: DataFrame) -> DataFrame:
    """The reviews of the flagged months. The months of a business, bounded by the calendar, become one row,
    so that the business is all that is joined by."""
    months = flagged.groupBy(KEY).agg(F.collect_set(F.struct("year", "month")).alias("_months"))
    return (raw.join(months, KEY).where(F.array_contains("_months", F.struct("year", "month"))).drop("_months"))


def profiles(raw: DataFrame, places: DataFrame) -> DataFrame:
    """Reviews, mean rating and first and last month of each business, with its name and city."""
    sums = raw.groupBy(KEY).agg(F.count("*").alias("reviews"), F.round(F.avg("stars"), 2).alias("avg_rating"),
                                F.min(F.col("year") * 100 + F.col("month")).alias("first_month"),
                                F.max(F.col("year") * 100 + F.col("month")).alias("last_month"))
    return places.select(KEY, "name", "city").join(sums, KEY, "left")
