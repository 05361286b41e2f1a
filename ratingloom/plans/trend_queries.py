"""Queries on ratings over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.functions.dates import label_parts
from ratingloom.operators import trends
from ratingloom.plans import bindings as b, business_store as bs
from ratingloom.plans.trend_store import TrendStore
from ratingloom.session import scratch_folder


def monthly_trends(spark, d):
    return trends.with_business(b.monthly(spark, d), b.biz(spark, d), trends.MONTH_ATTRIBUTES)


def quarterly_trends(spark, d):
    return trends.with_business(trends.quarterly_ratings(b.dated(spark, d)), b.biz(spark, d),
                                trends.QUARTER_ATTRIBUTES)


def month_over_month(spark, d):
    return trends.month_over_month(b.monthly(spark, d))


def spikes_dips(spark, d):
    flagged = trends.spikes_dips(b.monthly(spark, d))
    return trends.with_business(flagged, b.biz(spark, d), ["name"])


def series_with_spikes(spark, d):
    return trends.series_with_spikes(b.monthly(spark, d))


def rating_series(spark, d):
    return trends.rating_series(b.monthly(spark, d), "month")


def rating_series_quarter(spark, d):
    return trends.rating_series(trends.quarterly_ratings(b.dated(spark, d)), "quarter")


def period_labels(spark, d):
    series = trends.rating_series(b.monthly(spark, d), "month")
    year, month = label_parts("label")
    return series.groupBy(year.alias("year"), month.alias("month")).agg(F.count("*").alias("businesses"))


def _merged(spark, d) -> TrendStore:
    """The reviews in three batches, dealt by a hash; the second comes twice, and the first two are compacted."""
    store, dated = TrendStore(spark, scratch_folder(spark, "trends")), b.dated(spark, d)
    batch = F.pmod(F.xxhash64("business_id", "datetime", "stars"), F.lit(3))
    for number in (0, 1, 1):
        store.merge(number, dated.where(batch == number))
    store.compact()
    store.merge(2, dated.where(batch == 2))
    return store


def merged_series(spark, d):
    return _merged(spark, d).series()


def merged_spikes(spark, d):
    flag = trends.flag_of(trends.THRESHOLD)
    return _merged(spark, d).series().withColumn("spike_or_dip", flag).where(flag.isNotNull())


def _store(spark, d) -> bs.BusinessStore:
    raw = b.dated(spark, d)
    store = bs.BusinessStore(spark, scratch_folder(spark, "by-business"), raw, buckets=16)
    store.keep("raw", raw)
    store.keep("places", b.biz(spark, d))
    return store


def bucketed_trends(spark, d):
    return _store(spark, d).made(bs.monthly_trends, "raw", "places")


def bucketed_spike_reviews(spark, d):
    """The trend table is kept in the same layout, and the reviews of its flagged months are counted."""
    store = _store(spark, d)
    store.keep("flagged", store.made(lambda raw: trends.spikes_dips(trends.monthly_ratings(raw)), "raw"))
    found = store.made(bs.spike_reviews, "raw", "flagged")
    return found.groupBy("business_id", "year", "month", "review_text").agg(F.count("*").alias("reviews"))


def bucketed_profiles(spark, d):
    return _store(spark, d).made(bs.profiles, "raw", "places")


def bucketed_series(spark, d):
    """The chart of one business from its bucket alone."""
    raw = _store(spark, d).of("raw", "7")
    return trends.rating_series(trends.monthly_ratings(raw), "month")


SERIES = [b.REV, b.MONTHLY]
FLAGS = [*SERIES, b.CHANGES, b.FLAGGED]
FLAG_COLUMNS = ("business_id, year, month, monthly_avg_rating, monthly_rating_std, review_volume, "
                "prev_avg_rating, rating_diff")
TWO_DIGITS = "CAST(CAST(monthly_avg_rating AS DECIMAL(18, 2)) AS VARCHAR)"

QUERIES = {
    "monthly_trends": (monthly_trends, b.with_views([*SERIES, b.BIZ], """
SELECT monthly.*, name, address, city, state, postal FROM monthly JOIN biz USING (business_id)""")),
    "quarterly_trends": (quarterly_trends, b.with_views([b.REV, b.QUARTERLY, b.BIZ], """
SELECT quarterly.*, name, city, state, postal FROM quarterly JOIN biz USING (business_id)""")),
    "merged_series": (merged_series, b.with_views([*SERIES, b.CHANGES], f"SELECT {FLAG_COLUMNS} FROM changes")),
    "merged_spikes": (merged_spikes, b.with_views(FLAGS, f"SELECT {FLAG_COLUMNS}, spike_or_dip FROM flagged")),
    "bucketed_trends": (bucketed_trends, b.with_views([*SERIES, b.CHANGES, b.BIZ], f"""
SELECT {FLAG_COLUMNS}, CASE WHEN rating_diff > 1e0 THEN 'spike' WHEN rating_diff < -1e0 THEN 'dip' END AS spike_or_dip,
  name, address, city, state, postal FROM changes JOIN biz USING (business_id)""")),
    "bucketed_spike_reviews": (bucketed_spike_reviews, b.with_views(FLAGS, """
SELECT business_id, year, month, review_text, count(*) AS reviews
FROM rev JOIN (SELECT business_id, year, month FROM flagged) USING (business_id, year, month) GROUP BY ALL""")),
    "bucketed_profiles": (bucketed_profiles, b.with_views([b.REV, b.BIZ], f"""
SELECT business_id, name, city, reviews, avg_rating, first_month, last_month FROM biz LEFT JOIN (
  SELECT business_id, count(*) AS reviews, {b.rounded('avg(stars)', 2)} AS avg_rating,
    min(year * 100 + month) AS first_month, max(year * 100 + month) AS last_month FROM rev GROUP BY business_id)
  USING (business_id)""")),
    "bucketed_series": (bucketed_series, b.with_views(SERIES, f"""
SELECT business_id, CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS label,
  monthly_avg_rating AS rating, {TWO_DIGITS} AS rating_text FROM monthly WHERE business_id = '7'""")),
    "month_over_month": (month_over_month, b.with_views([*SERIES, b.CHANGES],
                                                        f"SELECT {FLAG_COLUMNS} FROM changes")),
    "spikes_dips": (spikes_dips, b.with_views([*FLAGS, b.BIZ], f"""
SELECT {FLAG_COLUMNS}, spike_or_dip, name FROM flagged JOIN biz USING (business_id)""")),
    "series_with_spikes": (series_with_spikes, b.with_views(FLAGS, """
SELECT monthly.*, rating_diff, spike_or_dip FROM monthly LEFT JOIN
  (SELECT business_id, year, month, rating_diff, spike_or_dip FROM flagged) f
  USING (business_id, year, month)""")),
    "rating_series": (rating_series, b.with_views(SERIES, f"""
SELECT business_id, CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS label,
  monthly_avg_rating AS rating, {TWO_DIGITS} AS rating_text FROM monthly""")),
    "rating_series_quarter": (rating_series_quarter, b.with_views([b.REV, b.QUARTERLY], f"""
SELECT business_id, CAST(year AS VARCHAR) || '-Q' || CAST(quarter AS VARCHAR) AS label,
  avg_quarterly_rating AS rating,
  {TWO_DIGITS.replace('monthly_avg_rating', 'avg_quarterly_rating')} AS rating_text
FROM quarterly""")),
    "period_labels": (period_labels, b.with_views(SERIES, """
SELECT year, month, count(*) AS businesses FROM monthly GROUP BY year, month""")),
}
