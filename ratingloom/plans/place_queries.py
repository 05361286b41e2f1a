"""Queries on headline figures, cities, categories, opening hours and the map."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.functions import hours
from ratingloom.operators import geo, kpis, places
from ratingloom.plans import bindings as b
from ratingloom.plans.cleaning_queries import KPI_SQL, publish_json
from ratingloom.sources import readers


def summary_kpis(spark, d):
    return kpis.summary_kpis(b.rev(spark, d), b.biz(spark, d))


def kpis_long(spark, d):
    return kpis.kpis_long(b.rev(spark, d), b.biz(spark, d))


def top_categories(spark, d):
    return places.top_categories(b.partbiz(spark, d))


def hotspots(spark, d):
    return places.hotspots(b.aggregated(spark, d))


def category_vocab(spark, d):
    return places.category_vocab(b.partbiz(spark, d), roots=["ring", "bo", "ll"], min_count=3)


def top_categories_in_city(spark, d):
    return places.top_categories_in_city(places.top_categories(b.partbiz(spark, d)), " small ", "BRAND#7")


def top_categories_by_city(spark, d):
    return places.top_categories_by_city(places.top_categories(b.partbiz(spark, d)), 3)


def top_hotspots(spark, d):
    return places.top_hotspots(places.hotspots(b.aggregated(spark, d)), "Ring")


def top_hotspots_by_category(spark, d):
    return places.top_hotspots_by_category(places.hotspots(b.aggregated(spark, d)))


def json_map(spark, d):
    parsed = b.partbiz(spark, d).select("business_id", hours.hours_map().alias("h"))
    return parsed.select("business_id", F.col("h")["Monday"].alias("monday"),
                         F.col("h")["Sunday"].alias("sunday"), F.size("h").alias("days"))


def avg_days_open(spark, d):
    return places.avg_days_open(b.partbiz(spark, d))


def avg_days_really_open(spark, d):
    return places.avg_days_open(b.partbiz(spark, d), closed_value=hours.CLOSED)


def days_open_by_state(spark, d):
    return places.days_open_by_state(places.avg_days_open(b.partbiz(spark, d)), "economy")


def hours_display(spark, d):
    shown = b.partbiz(spark, d).select("business_id", hours.hours_map().alias("h"))
    week = shown.select("business_id", "h", hours.week("h").alias("week"))
    return week.select("business_id", F.array_join(hours.week_display("week"), "; ").alias("week"),
                       F.replace(hours.map_display("h"), F.lit("\n"), F.lit("; ")).alias("lines"))


def business_details(spark, d):
    details = places.business_details(b.aggregated(spark, d))
    return details.withColumn("hours", F.array_join("hours", "|", "-"))


def distinct_places(spark, d):
    return places.distinct_places(b.partbiz(spark, d))


def distinct_business(spark, d):
    lines = b.table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("business_id"), "l_returnflag", "l_suppkey")
    return places.distinct_business(lines)


def faceted_search(spark, d):
    return places.faceted_search(b.partbiz(spark, d), text="RED", state="ECONOMY", category="w").select(
        "business_id", "name", "city")


def geo_sentiment(spark, d):
    scored = geo.geo_sentiment(b.aggregated(spark, d))
    return scored.select("business_id", "negative_count", "neutral_count", "positive_count",
                         "sentiment_score", "avg_star_rating")


def avg_star_rating(spark, d):
    scored = geo.geo_sentiment(b.aggregated(spark, d))
    return scored.groupBy("avg_star_rating").agg(F.count("*").alias("businesses"))


def geo_points(spark, d):
    return geo.geo_points(b.aggregated(spark, d))


def geo_markers(spark, d):
    return geo.geo_markers(geo.geo_points(b.aggregated(spark, d)), ["postal"]).select(
        "postal", "lat", "lon", "weight")


def score_bands(spark, d):
    points = geo.geo_points(b.aggregated(spark, d))
    return points.groupBy(geo.band_of("weight").alias("band")).agg(F.count("*").alias("points"))


def negative_points(spark, d):
    return geo.score_band(geo.geo_points(b.aggregated(spark, d)), "negative").select("postal", "weight")


def points_in_bbox(spark, d):
    return geo.points_in_bbox(b.partbiz(spark, d), 30.0, -110.0, 40.0, -90.0).select(
        "business_id", "lat", "lon")


def points_across_meridian(spark, d):
    return geo.points_in_bbox(b.partbiz(spark, d), 30.0, -75.0, 40.0, -115.0).select("business_id")


def geo_grid(spark, d):
    return geo.geo_grid(geo.geo_points(b.aggregated(spark, d)), 2.0)


def region_bounds(spark, d):
    """Each part becomes a GeoJSON feature, a triangle or two of them; its brand is the region."""
    def ring(x, y, step):
        corners = [F.array(x, y), F.array(x + step, y), F.array(x, y + step), F.array(x, y)]
        return F.array(*corners)

    def feature(kind, coordinates):
        return F.to_json(F.struct(
            F.struct(F.col("city").alias("NAME")).alias("properties"),
            F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry")))

    x, y = F.col("lon"), F.col("lat")
    hole = ring(x - 50, y - 50, 200.0)
    single = feature("Polygon", F.array(ring(x, y, 0.5), hole))
    double = feature("MultiPolygon", F.array(F.array(ring(x, y, 0.5), hole), F.array(ring(x, y, -0.5))))
    lines = b.partbiz(spark, d).select(
        F.when(F.col("business_id").cast("int") % 2 == 0, double).otherwise(single).alias("value"))
    return geo.region_bounds(readers.vertices(readers.parse_features(lines)))


def code_lookup(spark, d):
    names = b.table(spark, d, "nation").select(F.col("n_nationkey").alias("code"),
                                               F.col("n_name").alias("name"))
    used = b.table(spark, d, "customer").select((F.col("c_nationkey") * 2 - 3).alias("code"))
    return geo.code_lookup(used, "code", names)


MEAN_STAR = "coalesce(" + b.rounded(
    "(star1 + 2 * star2 + 3 * star3 + 4 * star4 + 5 * star5) / CAST(nullif(total, 0) AS DOUBLE)", 2) + ", 0e0)"
SCORE = b.rounded("(star4 + star5 - star0 - star1 - star2) / CAST(nullif(total, 0) AS DOUBLE)", 3)
AGG = [b.PARTBIZ, b.PREV, b.AGGREGATED]
POINTS = [*AGG, f"\npts AS (SELECT *, {SCORE} AS weight, {MEAN_STAR} AS avg_star_rating FROM agg)"]
DAYS = "\ndays AS (SELECT *, bit_count(p_size) AS n FROM partbiz WHERE p_partkey % 10 <> 0)"
CITY_CATEGORIES = """
cc AS (SELECT state, city, trim(lower(c)) AS category, count(*) AS business_count
  FROM partbiz, unnest(string_split(categories, ',')) AS u(c) GROUP BY 1, 2, 3)"""
HOT = """
hot AS (SELECT category, state, city, CAST(sum(total) AS BIGINT) AS total_reviews, """ + ", ".join(
    f"CAST(sum(star{i}) AS BIGINT) AS sum_{i}stars" for i in reversed(range(6))) + """
  FROM cat GROUP BY category, state, city)"""


def _sql_day(i: int, day: str, missing: str) -> str:
    time = "CASE WHEN p_partkey % 7 = 0 THEN '0:0-0:0' ELSE '8:0-17:0' END" if i == 0 else "'8:0-17:0'"
    return f"CASE WHEN p_partkey % 10 <> 0 AND (p_size >> {i}) % 2 = 1 THEN {time} ELSE {missing} END"


WEEK_SQL = " || '|' || ".join(_sql_day(i, day, "'-'") for i, day in enumerate(hours.DAYS))
SHOWN_SQL = " || '; ' || ".join(
    f"'{day}: ' || replace({_sql_day(i, day, chr(39) + 'Closed' + chr(39))}, '0:0-0:0', 'Closed')"
    for i, day in enumerate(hours.DAYS))
LINES_SQL = ("CASE WHEN p_partkey % 10 = 0 THEN 'Unavailable' ELSE "
             "replace(replace(replace(replace(opening_hours, ', ', '; '), '{', ''), '}', ''), '''', '') END")

DETAILS = b.with_views(AGG, f"""
SELECT business_id, name AS business_name, city, state, lat AS latitude, lon AS longitude, """ + ", ".join(
        f"star{i} AS sum_star{i}" for i in range(6)) + f""", total AS sum_totalreviews,
  {MEAN_STAR} AS avg_rating, categories, address, postal AS postal_code, {WEEK_SQL} AS hours FROM agg""")

QUERIES = {
    "summary_kpis": (summary_kpis, b.with_views([b.REV, b.BIZ, KPI_SQL], "SELECT * FROM k")),
    "kpis_long": (kpis_long, b.with_views([b.REV, b.BIZ, KPI_SQL], "SELECT * FROM long_")),
    "top_categories": (top_categories, b.with_views([b.PARTBIZ, CITY_CATEGORIES], "SELECT * FROM cc")),
    "hotspots": (hotspots, b.with_views([*AGG, b.CATEGORY, HOT], "SELECT * FROM hot")),
    "category_vocab": (category_vocab, b.with_views([b.PARTBIZ], """
SELECT trim(lower(c)) AS category, count(*) AS n
FROM partbiz, unnest(string_split(categories, ',')) AS u(c)
WHERE c LIKE '%ring%' OR c LIKE '%bo%' OR c LIKE '%ll%' GROUP BY 1 HAVING count(*) >= 3""")),
    "top_categories_in_city": (top_categories_in_city, b.with_views([b.PARTBIZ, CITY_CATEGORIES], """
SELECT * FROM cc WHERE state = 'SMALL' AND city = 'Brand#7' ORDER BY business_count DESC, category
LIMIT 10""")),
    "top_categories_by_city": (top_categories_by_city, b.with_views([b.PARTBIZ, CITY_CATEGORIES], """
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY state, city
  ORDER BY business_count DESC, category) AS INTEGER) AS rank FROM cc) WHERE rank <= 3""")),
    "top_hotspots": (top_hotspots, b.with_views([*AGG, b.CATEGORY, HOT], """
SELECT city || ', ' || state AS label, total_reviews FROM hot WHERE category = 'ring'
ORDER BY total_reviews DESC, state, city LIMIT 10""")),
    "top_hotspots_by_category": (top_hotspots_by_category, b.with_views([*AGG, b.CATEGORY, HOT], """
SELECT category, rank, city || ', ' || state AS label, total_reviews FROM (SELECT *,
  CAST(row_number() OVER (PARTITION BY category ORDER BY total_reviews DESC, state, city) AS INTEGER)
    AS rank FROM hot) WHERE rank <= 10""")),
    "json_map": (json_map, b.with_views([b.PARTBIZ], f"""
SELECT business_id, {_sql_day(0, 'Monday', 'NULL')} AS monday, CAST(NULL AS VARCHAR) AS sunday,
  CASE WHEN p_partkey % 10 <> 0 THEN CAST(bit_count(p_size) AS INTEGER) END AS days FROM partbiz""")),
    "avg_days_open": (avg_days_open, b.with_views([b.PARTBIZ, DAYS], """
SELECT state, city, avg(n) AS avg_days_open_per_business FROM days GROUP BY state, city""")),
    "avg_days_really_open": (avg_days_really_open, b.with_views([b.PARTBIZ, DAYS], """
SELECT state, city, avg(n - CASE WHEN p_partkey % 7 = 0 AND p_size % 2 = 1 THEN 1 ELSE 0 END)
  AS avg_days_open_per_business FROM days GROUP BY state, city""")),
    "days_open_by_state": (days_open_by_state, b.with_views([b.PARTBIZ, DAYS], """
SELECT city, avg(n) AS avg_days_open_per_business FROM days WHERE state = 'ECONOMY' GROUP BY city""")),
    "hours_display": (hours_display, b.with_views([b.PARTBIZ],
        f"SELECT business_id, {SHOWN_SQL} AS week, {LINES_SQL} AS lines FROM partbiz")),
    "business_details": (business_details, DETAILS),
    "publish_json": (publish_json, DETAILS),
    "distinct_places": (distinct_places, "SELECT DISTINCT p_type AS state, p_brand AS city FROM part"),
    "distinct_business": (distinct_business, """
SELECT l_partkey AS business_id, min(l_returnflag) AS l_returnflag,
  arg_min(l_suppkey, l_returnflag || lpad(CAST(l_suppkey AS VARCHAR), 12, '0')) AS l_suppkey
FROM lineitem GROUP BY l_partkey"""),
    "faceted_search": (faceted_search, b.with_views([b.PARTBIZ], """
SELECT business_id, name, city FROM partbiz
WHERE name LIKE '%red%' AND state = 'ECONOMY' AND categories LIKE '%w%'""")),
    "geo_sentiment": (geo_sentiment, b.with_views(POINTS, """
SELECT business_id, star0 + star1 + star2 AS negative_count, star3 AS neutral_count,
  star4 + star5 AS positive_count, weight AS sentiment_score, avg_star_rating FROM pts""")),
    "avg_star_rating": (avg_star_rating, b.with_views(POINTS, """
SELECT avg_star_rating, count(*) AS businesses FROM pts GROUP BY avg_star_rating""")),
    "geo_points": (geo_points, b.with_views(POINTS, """
SELECT name, lat, lon, weight, address, state, postal, avg_star_rating, categories, opening_hours
FROM pts""")),
    "geo_markers": (geo_markers, b.with_views(POINTS, """
SELECT postal, lat, lon, weight FROM pts""")),
    "score_bands": (score_bands, b.with_views(POINTS, """
SELECT CASE WHEN weight > 0.25 THEN 'positive' WHEN weight < -0.25 THEN 'negative'
  WHEN weight IS NOT NULL THEN 'neutral' END AS band, count(*) AS points FROM pts GROUP BY 1""")),
    "negative_points": (negative_points, b.with_views(POINTS, """
SELECT postal, weight FROM pts WHERE weight < -0.25""")),
    "points_in_bbox": (points_in_bbox, b.with_views([b.PARTBIZ], """
SELECT business_id, lat, lon FROM partbiz WHERE lat BETWEEN 30 AND 40 AND lon BETWEEN -110 AND -90""")),
    "points_across_meridian": (points_across_meridian, b.with_views([b.PARTBIZ], """
SELECT business_id FROM partbiz WHERE lat BETWEEN 30 AND 40 AND (lon >= -75 OR lon <= -115)""")),
    "geo_grid": (geo_grid, b.with_views(POINTS, f"""
SELECT CAST(floor(lat / 2e0) AS BIGINT) AS cell_lat, CAST(floor(lon / 2e0) AS BIGINT) AS cell_lon,
  count(*) AS points, {b.rounded('avg(CAST(coalesce(weight, 0e0) AS DECIMAL(10, 6)))', 6)} AS avg_weight,
  CASE WHEN avg(coalesce(weight, 0e0)) > 0.25 THEN 'green'
    WHEN avg(coalesce(weight, 0e0)) < -0.25 THEN 'red' ELSE 'gold' END AS colour
FROM pts GROUP BY 1, 2""")),
    "region_bounds": (region_bounds, b.with_views([b.PARTBIZ], f"""
SELECT city AS region, south, north, west, east, {b.rounded('(south + north) / 2', 6)} AS centre_lat,
  {b.rounded('(west + east) / 2', 6)} AS centre_lng
FROM (SELECT city, min(CASE WHEN p_partkey % 2 = 0 THEN lat - 5e-1 ELSE lat END) AS south,
    max(lat + 5e-1) AS north, min(CASE WHEN p_partkey % 2 = 0 THEN lon - 5e-1 ELSE lon END) AS west,
    max(lon + 5e-1) AS east FROM partbiz GROUP BY city)""")),
    "code_lookup": (code_lookup, """
SELECT DISTINCT n_name AS name FROM customer JOIN nation ON c_nationkey * 2 - 3 = n_nationkey"""),
}
