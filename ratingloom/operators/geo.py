"""Star-based sentiment on the map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratingloom.functions.numbers import mean_star, ratio
from ratingloom.functions.states import STATE_NAMES
from ratingloom.operators.spread import lookup_join
from ratingloom.sources.schemas import STARS

# Limits of the score bands, and the pixels of a map tile and of a cluster cell.
BAND = 0.25
TILE_PIXELS = 256
CELL_PIXELS = 60


def geo_sentiment(aggregated: DataFrame) -> DataFrame:
    """Adds the counts of negative (0-2 stars), neutral (3) and positive (4-5) reviews, the score
    (positive - negative) / total, null without reviews, and the mean star, 0.0 without reviews."""
    star = {i: F.col(c) for i, c in enumerate(STARS)}
    return (aggregated
            .withColumns({"negative_count": star[0] + star[1] + star[2],
                          "neutral_count": star[3],
                          "positive_count": star[4] + star[5]})
            .withColumns({
                "sentiment_score": ratio(F.col("positive_count") - F.col("negative_count"),
                                         F.col("total"), 3),
                "avg_star_rating": mean_star(STARS, "total")}))


def geo_points(aggregated: DataFrame) -> DataFrame:
    """The published point table: one row per business, whole."""
    return geo_sentiment(aggregated).select(
        "name", "lat", "lon", F.col("sentiment_score").alias("weight"), "address", "state",
        "postal", "avg_star_rating", "categories", "opening_hours")


def geo_markers(points: DataFrame, order_by: list[str]) -> DataFrame:
    """All points in the order in which a map draws them one by one."""
    return points.orderBy(*order_by)


def band_of(score: Column | str) -> Column:
    s = F.col(score) if isinstance(score, str) else score
    return (F.when(s > BAND, "positive").when(s < -BAND, "negative")
            .when(s.isNotNull(), "neutral"))


def score_band(points: DataFrame, band: str, weight: str = "weight") -> DataFrame:
    """The points of one band."""
    return points.where(band_of(weight) == band)


def points_in_bbox(points: DataFrame, south: float, west: float, north: float, east: float) -> DataFrame:
    """Points in a viewport, which may cross the 180th meridian (west > east)."""
    lon = F.col("lon")
    across = lon.between(west, east) if west <= east else (lon >= west) | (lon <= east)
    return points.where(F.col("lat").between(south, north) & across)


def cell_degrees(zoom: int) -> float:
    """Width of a cluster cell in degrees at a zoom level."""
    return 360.0 / 2 ** zoom * CELL_PIXELS / TILE_PIXELS


def geo_grid(points: DataFrame, degrees: float) -> DataFrame:
    """Count, mean weight (a missing one counts as 0) and colour of the points of each grid cell.

    Weights have three digits, so they are summed as decimals: the mean does not depend on order.
    """
    mean = F.avg(F.coalesce("weight", F.lit(0.0)).cast("decimal(10,6)")).cast("double")
    cells = points.groupBy(
        F.floor(F.col("lat") / degrees).alias("cell_lat"),
        F.floor(F.col("lon") / degrees).alias("cell_lon"),
    ).agg(F.count("*").alias("points"), F.round(mean, 6).alias("avg_weight"))
    colour = (F.when(band_of("avg_weight") == "positive", "green")
              .when(band_of("avg_weight") == "negative", "red").otherwise("gold"))
    return cells.withColumn("colour", colour)


def region_bounds(vertices: DataFrame) -> DataFrame:
    """Bounding box and centre of each region's vertices."""
    box = vertices.groupBy("region").agg(
        F.min("lat").alias("south"), F.max("lat").alias("north"),
        F.min("lng").alias("west"), F.max("lng").alias("east"))
    return box.withColumns({
        "centre_lat": F.round((F.col("south") + F.col("north")) / 2, 6),
        "centre_lng": F.round((F.col("west") + F.col("east")) / 2, 6)})


def state_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(STATE_NAMES.items()), "code string, name string")


def code_lookup(df: DataFrame, code: str, names: DataFrame) -> DataFrame:
    """Distinct names of the codes in use; unknown codes vanish. ``names``: code, name."""
    used = df.select(F.col(code).alias("code")).distinct()
    return lookup_join(used, names, ["code"]).select("name").distinct()
