"""Cities, categories and business details, from the per-business table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratingloom.functions import hours
from ratingloom.functions.numbers import mean_star
from ratingloom.sources.schemas import STARS

# A category belongs to the vocabulary if it contains one of these.
CATEGORY_ROOTS = [
    "food", "restaurant", "cafe", "bar", "eat", "drink", "halal", "vegan", "vegetarian",
    "dessert", "acai",
]


def with_category(df: DataFrame) -> DataFrame:
    """One row per business and listed category, trimmed and lower-cased. Repeats and empty
    entries stay; businesses without a list vanish."""
    listed = df.withColumn("category", F.explode(F.split("categories", ",")))
    return listed.withColumn("category", F.trim(F.lower("category")))


def top_categories(aggregated: DataFrame) -> DataFrame:
    """Businesses per (state, city, category), in no order."""
    return (with_category(aggregated.select("state", "city", "categories"))
            .groupBy("state", "city", "category").agg(F.count("*").alias("business_count")))


def biggest_first(top: DataFrame) -> DataFrame:
    """The category table as published: a city's biggest categories first."""
    return top.orderBy("state", "city", F.desc("business_count"), "category")


def avg_days_open(aggregated: DataFrame, closed_value: str | None = None) -> DataFrame:
    """Mean number of days with opening hours per (state, city), over parsable businesses."""
    parsed = aggregated.select("state", "city", hours.hours_map().alias("hours"))
    return (parsed.where("hours is not null")
            .groupBy("state", "city")
            .agg(F.avg(hours.days_open("hours", closed_value)).alias("avg_days_open_per_business")))


def hotspots(aggregated: DataFrame) -> DataFrame:
    """Review totals per (category, state, city), in no order."""
    sums = [F.sum("total").alias("total_reviews")]
    sums += [F.sum(STARS[i]).alias(f"sum_{i}stars") for i in reversed(range(6))]
    return (with_category(aggregated.select("state", "city", "categories", "total", *STARS))
            .groupBy("category", "state", "city").agg(*sums))


def hottest_first(spots: DataFrame) -> DataFrame:
    """The hotspot table as published: a category's cities with most reviews first."""
    return spots.orderBy("category", F.desc("total_reviews"), "state", "city")


def business_details(aggregated: DataFrame) -> DataFrame:
    """One row per business, with mean rating and the seven opening times."""
    return (aggregated.withColumn("_hours", hours.hours_map())
            .select("business_id", F.col("name").alias("business_name"), "city", "state",
                    F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
                    *[F.col(c).try_cast("int").alias(f"sum_{c}") for c in STARS],
                    F.col("total").try_cast("int").alias("sum_totalreviews"),
                    mean_star(STARS, "total").alias("avg_rating"),
                    "categories", "address", F.col("postal").alias("postal_code"),
                    hours.week("_hours").alias("hours")))


def category_vocab(df: DataFrame, roots: list[str] = CATEGORY_ROOTS, min_count: int = 3) -> DataFrame:
    """Categories listed at least ``min_count`` times that contain one of ``roots``."""
    rooted = reduce(lambda a, b: a | b, [F.col("category").contains(r) for r in roots])
    return (with_category(df.select("categories")).where(rooted)
            .groupBy("category").agg(F.count("*").alias("n"))
            .where(F.col("n") >= min_count).orderBy("category"))


def normalised(column: str) -> Column:
    return F.lower(F.trim(column))


def same_text(column: str, wanted: str) -> Column:
    """Equality without regard to case and outer blanks."""
    return normalised(column) == wanted.strip().lower()


def top_categories_in_city(top: DataFrame, state: str, city: str, n: int = 10) -> DataFrame:
    """The ``n`` biggest categories of one city, from the category table."""
    return (top.where(same_text("city", city) & same_text("state", state))
            .orderBy(F.desc("business_count"), "category").limit(n))


def top_categories_by_city(top: DataFrame, n: int = 10) -> DataFrame:
    """The same for all cities at once. Each task drops rows past rank ``n`` before the shuffle."""
    rank = F.row_number().over(
        Window.partitionBy("state", "city").orderBy(F.desc("business_count"), "category"))
    return top.withColumn("rank", rank).where(F.col("rank") <= n)


def top_hotspots(spots: DataFrame, category: str, n: int = 10) -> DataFrame:
    """The ``n`` cities with most reviews in one category."""
    return (spots.where(same_text("category", category))
            .orderBy(F.desc("total_reviews"), "state", "city").limit(n)
            .select(F.concat_ws(", ", "city", "state").alias("label"), "total_reviews"))


def top_hotspots_by_category(spots: DataFrame, n: int = 10) -> DataFrame:
    rank = F.row_number().over(
        Window.partitionBy("category").orderBy(F.desc("total_reviews"), "state", "city"))
    return (spots.withColumn("rank", rank).where(F.col("rank") <= n)
            .select("category", "rank", F.concat_ws(", ", "city", "state").alias("label"),
                    "total_reviews"))


def days_open_by_state(days: DataFrame, state: str) -> DataFrame:
    """Cities of a state by mean days open, most first."""
    return (days.where(same_text("state", state))
            .orderBy(F.desc("avg_days_open_per_business"), "city")
            .select("city", "avg_days_open_per_business"))


def distinct_places(df: DataFrame, state: str | None = None) -> DataFrame:
    """Distinct (state, city), or the cities of one state, in order; empty names are left out."""
    places = df.select("state", "city").where("state <> '' and city <> ''")
    if state is not None:
        places = places.where(F.col("state") == state)
    return places.distinct().orderBy("state", "city")


def each_once(df: DataFrame) -> DataFrame:
    """The distinct rows, by hash tables in the tasks. Before a smallest row per key, which would sort all rows; the count
    keeps the planner from taking a plain ``distinct`` out of there."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("_n")).where("_n > 0").drop("_n")


def distinct_business(df: DataFrame, key: str = "business_id") -> DataFrame:
    """One row per business; of differing rows the smallest is taken."""
    rest = [c for c in df.columns if c != key]
    return (df.groupBy(key).agg(F.min(F.struct(*rest)).alias("first"))
            .select(key, *[F.col(f"first.{c}").alias(c) for c in rest]))


def faceted_search(df: DataFrame, text: str = "", state: str | None = None, city: str | None = None,
                   category: str | None = None, name: str = "name") -> DataFrame:
    """Name substring without regard to case, and any of state, city, category."""
    found = df.where(F.lower(name).contains(text.lower())) if text else df
    if state:
        found = found.where(F.col("state") == state)
    if city:
        found = found.where(F.col("city") == city)
    if category:
        found = found.where(F.lower("categories").contains(category))
    return found
