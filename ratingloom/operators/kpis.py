"""Headline figures of the review table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratingloom.functions.numbers import with_thousands


def summary_kpis(raw: DataFrame, business: DataFrame | None = None) -> DataFrame:
    """One row: distinct businesses, reviews, distinct states and cities, mean rating.

    Rows first shrink to one per (business, state, city), on the map side already, so the three
    distinct counts run on that small table. A null key counts as one value, as in a distinct list.
    Where the reviews carry no place, ``business`` (business_id unique, state, city) gives it: they
    shrink to one row per business before they meet it, so no key of the join is hot.
    """
    sums = [F.count("*").alias("reviews"), F.sum("stars").alias("star_sum"), F.count("stars").alias("rated")]
    if business is None:
        places = raw.groupBy("business_id", "state", "city").agg(*sums)
    else:
        places = raw.groupBy("business_id").agg(*sums).join(
            business.select("business_id", "state", "city"), "business_id")

    def distinct(column: str):
        return F.count_distinct(column) + F.max(F.col(column).isNull().cast("int"))

    return places.agg(
        F.coalesce(distinct("business_id"), F.lit(0)).alias("total_businesses"),
        F.coalesce(F.sum("reviews"), F.lit(0)).alias("total_reviews"),
        F.coalesce(distinct("state"), F.lit(0)).alias("num_states"),
        F.coalesce(distinct("city"), F.lit(0)).alias("num_cities"),
        F.coalesce(F.round(F.try_divide(F.sum("star_sum"), F.sum("rated")), 2), F.lit(0.0))
        .alias("overall_avg_rating"))


def kpis_long(raw: DataFrame, business: DataFrame | None = None) -> DataFrame:
    """The same as (metric, value) rows, counts with thousands separators."""
    counts = ["total_businesses", "total_reviews", "num_states", "num_cities"]
    texts = summary_kpis(raw, business).select(
        *[with_thousands(F.col(c)).alias(c) for c in counts],
        F.col("overall_avg_rating").cast("string").alias("overall_avg_rating"))
    return texts.unpivot([], [*counts, "overall_avg_rating"], "metric", "value")
