"""Business and review tables joined: one row per review, and one row per business."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ratingloom.functions.numbers import half_up
from ratingloom.operators.spread import spread_join
from ratingloom.sources import schemas


def one_per_key(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest by ``order``, then by the remaining columns.

    A grouped maximum of structs, so duplicates of one key shrink before the shuffle.
    """
    order = order or []
    rest = [c for c in df.columns if c != key and c not in order]
    best = df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("best"))
    return best.select(*[F.col(c) if c == key else F.col(f"best.{c}").alias(c) for c in df.columns])


def join_raw(business: DataFrame, review: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per review of a known business. ``business`` has unique ids; ``extra`` review
    columns come after the usual ones."""
    joined = spread_join(review, business.select(*[c for c in schemas.PLACE if c in business.columns]),
                         ["business_id"])
    wanted = [*[f.name for f in schemas.RAW], *extra]
    return joined.select(*[c for c in wanted if c in joined.columns])


def star_histogram(review: DataFrame, key: str = "business_id", stars: str = "stars") -> DataFrame:
    """Counts of reviews by rounded star 0..5 and their total, per business."""
    bucket = half_up(stars)
    counts = review.groupBy(key).agg(
        *[F.count_if(bucket == i).alias(c) for i, c in enumerate(schemas.STARS)])
    return counts.withColumn("total", reduce(lambda a, b: a + b, [F.col(c) for c in schemas.STARS]))


def join_aggregated(business: DataFrame, review: DataFrame) -> DataFrame:
    """Every business with its star histogram; zeros where it has no review.

    Reviews shrink to one row per business before they meet the business table.
    """
    counts = [*schemas.STARS, "total"]
    joined = business.join(star_histogram(review), "business_id", "left")
    place = [c for c in schemas.PLACE if c in business.columns]
    return joined.select(*place, *[F.coalesce(c, F.lit(0)).cast("int").alias(c) for c in counts])


def star_histogram_long(aggregated: DataFrame, key: str = "business_id") -> DataFrame:
    """Six rows per business: star and count."""
    return (aggregated.select(key, *schemas.STARS)
            .unpivot([key], schemas.STARS, "star", "reviews")
            .withColumn("star", F.substring("star", 5, 1).cast("int")))


def sorted_by_key(df: DataFrame, key: str) -> DataFrame:
    """Total order by key over many files. The other columns break ties, so that the range
    boundaries can also cut inside one hot key."""
    return df.orderBy(key, *[c for c in df.columns if c != key])
