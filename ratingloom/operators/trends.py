"""Ratings over time, and the months in which they jump."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratingloom.functions.dates import month_label, quarter_label, with_date_parts
from ratingloom.functions.numbers import mean_of, spread_of
from ratingloom.operators.cleaning import drop_null_keys

# Fixed value: a change of more than this many stars is a spike or a dip.
THRESHOLD = 1.0
MONTH_ATTRIBUTES = ["name", "address", "city", "state", "postal"]
QUARTER_ATTRIBUTES = ["name", "city", "state", "postal"]


def prepare(raw: DataFrame) -> DataFrame:
    """Adds date parts and drops rows without business, stars or date text."""
    return with_date_parts(drop_null_keys(raw, ["business_id", "stars", "datetime"]))


def monthly_ratings(dated: DataFrame) -> DataFrame:
    """Mean, spread and number of the ratings per business and month."""
    return dated.groupBy("business_id", "year", "month").agg(
        mean_of("stars").alias("monthly_avg_rating"),
        spread_of("stars").alias("monthly_rating_std"),
        F.count("*").alias("review_volume"))


def quarterly_ratings(dated: DataFrame) -> DataFrame:
    return dated.groupBy("business_id", "year", "quarter").agg(
        mean_of("stars").alias("avg_quarterly_rating"),
        F.count("*").alias("total_reviews"),
        spread_of("stars").alias("rating_volatility"))


def with_business(trend: DataFrame, business: DataFrame, attributes: list[str]) -> DataFrame:
    """Adds business attributes to a trend. The reviews have shrunk to one row per period by then,
    and ``business`` has unique ids, so no key of this join is hot."""
    columns = [a for a in attributes if a in business.columns]
    return trend.join(business.select("business_id", *columns), "business_id")


def month_over_month(monthly: DataFrame) -> DataFrame:
    """Adds the rating of the previous month that has reviews, and the difference.

    A window holds the months of one business: bounded by the calendar, not by its reviews.
    """
    months = Window.partitionBy("business_id").orderBy("year", "month")
    return (monthly
            .withColumn("prev_avg_rating", F.lag("monthly_avg_rating").over(months))
            .withColumn("rating_diff",
                        F.round(F.col("monthly_avg_rating") - F.col("prev_avg_rating"), 2)))


def flag_of(threshold: float) -> Column:
    diff = F.col("rating_diff")
    return F.when(diff > threshold, "spike").when(diff < -threshold, "dip")


def spikes_dips(monthly: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The months whose rating rose or fell by more than ``threshold``."""
    flag = flag_of(threshold)
    return month_over_month(monthly).withColumn("spike_or_dip", flag).where(flag.isNotNull())


def series_with_spikes(monthly: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The monthly series with the flag of each month, if any, and the difference of a flagged one. The
    flag is a column of the same window as the difference, so the series is computed once."""
    flag = flag_of(threshold)
    return (month_over_month(monthly).withColumn("spike_or_dip", flag)
            .withColumn("rating_diff", F.when(F.col("spike_or_dip").isNotNull(), F.col("rating_diff")))
            .drop("prev_avg_rating"))


def rating_series(trend: DataFrame, period: str, business_id: str | None = None,
                  year: int | None = None) -> DataFrame:
    """Label, rating and two-digit rating text per period ("month" or "quarter"), in time order,
    for one business or all of them, one year or all."""
    rating = "monthly_avg_rating" if period == "month" else "avg_quarterly_rating"
    label = month_label() if period == "month" else quarter_label()
    series = trend.where(F.col(rating).isNotNull())
    if business_id is not None:
        series = series.where(F.col("business_id") == business_id)
    if year is not None:
        series = series.where(F.col("year") == year)
    return (series.orderBy("business_id", "year", period)
            .select("business_id", label.alias("label"), F.col(rating).alias("rating"),
                    F.format_string("%.2f", F.col(rating)).alias("rating_text")))


def spike_at(flagged: DataFrame, business_id: str, label: str) -> DataFrame:
    """The flag of one business at a ``YYYY-MM`` label."""
    year, month = (int(p) for p in label.split("-"))
    return flagged.where((F.col("business_id") == business_id)
                         & (F.col("year") == year) & (F.col("month") == month))
