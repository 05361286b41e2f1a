"""Rating sums per business and month that can be added up, and what follows from them.

A row holds the number of ratings, their sum and the sum of their squares as decimals. Rows of any batches of
reviews, added by key, are the rows of all their reviews; mean and spread follow from them exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

KEY = ["business_id", "year", "month"]
STARS = "decimal(18,6)"
SUMS = "n bigint, total decimal(38,6), squares decimal(38,12)"


def monthly_sums(dated: DataFrame) -> DataFrame:
    """One row per business and month of a batch of reviews."""
    stars = F.col("stars").cast(STARS)
    return dated.groupBy(*KEY).agg(
        F.count("stars").alias("n"), F.sum(stars).cast("decimal(38,6)").alias("total"),
        F.sum((stars * stars).cast("decimal(30,12)")).cast("decimal(38,12)").alias("squares"))


def added(sums: DataFrame) -> DataFrame:
    """Rows of several batches by key."""
    return sums.groupBy(*KEY).agg(
        F.sum("n").alias("n"), F.sum("total").cast("decimal(38,6)").alias("total"),
        F.sum("squares").cast("decimal(38,12)").alias("squares"))


def monthly_ratings(sums: DataFrame) -> DataFrame:
    """The columns of ``trends.monthly_ratings``. The sample variance is (n * squares - total ** 2) / (n * (n - 1)):
    its numerator is formed in whole millionths of the squares of sums, where nothing cancels out."""
    n = F.col("n").cast("double")
    whole = F.col("n").cast("decimal(18,0)") * F.col("squares").cast("decimal(20,6)")
    spread = (whole - (F.col("total").cast("decimal(19,3)") * F.col("total").cast("decimal(19,3)"))).cast("double")
    deviation = F.sqrt(F.greatest(spread, F.lit(0.0)) / (n * (n - 1)))
    return sums.select(
        *KEY, F.round(F.col("total").cast("double") / n, 2).alias("monthly_avg_rating"),
        F.when(F.col("n") > 1, F.round(deviation, 2)).otherwise(F.lit(0.0)).alias("monthly_rating_std"),
        F.col("n").alias("review_volume"))
