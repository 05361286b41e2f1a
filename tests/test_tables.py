"""KPIs, places, hours, geo and trends on planted rows."""

import json

import pytest
from pyspark.sql import functions as F

from ratingloom.functions import hours
from ratingloom.functions.dates import with_date_parts
from ratingloom.functions.numbers import half_up, mean_star, ratio
from ratingloom.operators import geo, kpis, places, trends
from ratingloom.functions.states import STATE_NAMES
from ratingloom.sources import readers, schemas, writers
from ratingloom.session import scratch_folder


def test_kpis_count_a_null_city(spark):
    raw = spark.createDataFrame(
        [("a", "S", "X", 4.0), ("a", "S", "X", 5.0), ("b", "S", None, None)],
        "business_id string, state string, city string, stars double")
    row = kpis.summary_kpis(raw).first()
    assert tuple(row) == (2, 3, 1, 2, 4.5)
    long = {r.metric: r.value for r in kpis.kpis_long(raw).collect()}
    assert long["overall_avg_rating"] == "4.5" and long["total_reviews"] == "3"
    assert tuple(kpis.summary_kpis(raw.limit(0)).first()) == (0, 0, 0, 0, 0.0)


def test_categories(spark):
    df = spark.createDataFrame(
        [("X", "S", "Food,"), ("X", "S", "Food, food , BAR"), ("X", "S", ""), ("X", "S", None)],
        "city string, state string, categories string")
    got = [tuple(r)[2:] for r in places.biggest_first(places.top_categories(df)).collect()]
    assert got == [("food", 3), ("", 2), ("bar", 1)]
    assert [tuple(r) for r in places.category_vocab(df).collect()] == [("food", 3)]


def test_hours(spark):
    rows = [("{'Monday': '8:0-17:0', 'Sunday': '0:0-0:0'}",), ("{}",), ("None",), (None,), ("{'Monday': 'it's'}",)]
    df = spark.createDataFrame([("S", "X", *r) for r in rows], "state string, city string, opening_hours string")
    parsed = df.select(hours.hours_map().alias("h"))
    got = parsed.select(hours.days_open("h").alias("n"), hours.days_open("h", hours.CLOSED).alias("open"),
                        hours.map_display("h").alias("shown")).collect()
    assert [r.shown for r in got][:2] == ["Monday: 8:0-17:0\nSunday: 0:0-0:0", ""]
    assert (got[0].n, got[0].open) == (2, 1)
    assert places.avg_days_open(df).first()[2] == 1.0
    week = parsed.select(hours.week("h").alias("w")).select(hours.week_display("w")).first()[0]
    assert week[0] == "Monday: 8:0-17:0" and week[6] == "Sunday: Closed" and week[1] == "Tuesday: Closed"


def test_numbers(spark):
    df = spark.createDataFrame([(0.5, 0), (2.5, 4), (3.4999, 8)], "x double, n int")
    assert [r[0] for r in df.select(half_up("x")).collect()] == [1, 3, 3]
    assert [r[0] for r in df.select(ratio(F.lit(1), F.col("n"), 2)).collect()] == [None, 0.25, 0.13]
    stars = spark.createDataFrame([(0, 0, 0, 0, 0, 0, 0), (0, 1, 0, 0, 0, 1, 2)], ", ".join(
        f"{c} int" for c in [*schemas.STARS, "total"]))
    assert [r[0] for r in stars.select(mean_star(schemas.STARS, "total")).collect()] == [0.0, 3.0]


def test_dates(spark):
    df = spark.createDataFrame([("2020-12-31 23:59:59",), ("2020-13-01 00:00:00",), ("",), (None,)], "datetime string")
    got = [tuple(r)[2:] for r in with_date_parts(df).collect()]
    assert got == [(2020, 12, 4), (None,) * 3, (None,) * 3, (None,) * 3]


def series(spark, rows):
    return spark.createDataFrame(rows, "business_id string, year int, month int, monthly_avg_rating double")


def test_spikes(spark):
    monthly = series(spark, [("a", 2019, 12, 3.0), ("a", 2020, 1, 4.0), ("a", 2020, 4, 2.99), ("a", 2020, 5, 4.0),
                             ("b", 2020, 1, 5.0)])
    got = sorted(tuple(r)[1:] for r in trends.spikes_dips(monthly).collect())
    assert got == [(2020, 4, 2.99, 4.0, -1.01, "dip"), (2020, 5, 4.0, 2.99, 1.01, "spike")]
    assert trends.spikes_dips(monthly.limit(0)).isEmpty()
    assert trends.spike_at(trends.spikes_dips(monthly), "a", "2020-05").first().spike_or_dip == "spike"


def test_single_review_month_has_no_spread(spark):
    raw = spark.createDataFrame(
        [("a", "N", 4.0, "2020-01-02 00:00:00"), ("a", "N", None, "2020-01-02 00:00:00"), (None, "N", 1.0, "x")],
        "business_id string, name string, stars double, datetime string")
    row = trends.monthly_ratings(trends.prepare(raw)).first()
    assert (row.monthly_avg_rating, row.monthly_rating_std, row.review_volume) == (4.0, 0.0, 1)
    quarter = trends.rating_series(trends.quarterly_ratings(trends.prepare(raw)), "quarter").first()
    assert (quarter.label, quarter.rating_text) == ("2020-Q1", "4.00")


def test_bands_and_boxes(spark):
    df = spark.createDataFrame([(0.26,), (0.25,), (-0.25,), (-0.26,), (None,)], "weight double")
    assert [r[0] for r in df.select(geo.band_of("weight")).collect()] == [
        "positive", "neutral", "neutral", "negative", None]
    points = spark.createDataFrame([(1.0, 179.0), (1.0, -179.0), (1.0, 0.0), (9.0, 179.0)], "lat double, lon double")
    assert geo.points_in_bbox(points, 0, 170, 2, -170).count() == 2
    assert geo.points_in_bbox(points, 0, -10, 2, 10).count() == 1
    cells = spark.createDataFrame([(0.1, 0.1, 1.0), (0.2, 0.2, None), (-0.1, 0.1, -1.0)],
                                  "lat double, lon double, weight double")
    got = {(r.cell_lat, r.cell_lon): (r.points, r.avg_weight, r.colour) for r in geo.geo_grid(cells, 1.0).collect()}
    assert got == {(0, 0): (2, 0.5, "green"), (-1, 0): (1, -1.0, "red")}
    assert geo.cell_degrees(0) == pytest.approx(84.375)


def test_no_reviews_no_score(spark):
    row = geo.geo_sentiment(spark.createDataFrame(
        [(0, 0, 0, 0, 0, 0, 0)], ", ".join(f"{c} int" for c in [*schemas.STARS, "total"]))).first()
    assert row.sentiment_score is None and row.avg_star_rating == 0.0


def test_geojson_outer_rings(spark, tmp_path):
    square = [[0, 0], [0, 2], [4, 2], [0, 0]]
    far = [[10, 5], [12, 7], [10, 5]]
    doc = {"type": "FeatureCollection", "features": [
        {"properties": {"NAME": "A"}, "geometry": {"type": "Polygon", "coordinates": [square, far]}},
        {"properties": {"NAME": "B"}, "geometry": {"type": "MultiPolygon", "coordinates": [[square], [far, square]]}}]}
    (tmp_path / "s.json").write_text(json.dumps(doc, indent=1))
    rings = readers.read_features(spark, str(tmp_path / "s.json"))
    got = {r.region: tuple(r)[1:] for r in geo.region_bounds(readers.vertices(rings)).collect()}
    assert got == {"A": (0.0, 2.0, 0.0, 4.0, 1.0, 2.0), "B": (0.0, 7.0, 0.0, 12.0, 3.5, 6.0)}


def test_state_names(spark):
    assert len(STATE_NAMES) == 57
    used = spark.createDataFrame([("TX",), ("TX",), ("ZZ",), (None,)], "state string")
    assert [r.name for r in geo.code_lookup(used, "state", geo.state_names(spark)).collect()] == ["Texas"]


def test_search(spark):
    df = spark.createDataFrame([("Joe's Diner", "TX", "A", "Food, Bar"), ("JOE", "TX", "B", None), ("Al", "NY", "A", "Bar")],
                               "name string, state string, city string, categories string")
    assert places.faceted_search(df, "joe").count() == 2
    assert places.faceted_search(df, "joe", state="TX", city="A", category="bar").count() == 1
    assert places.faceted_search(df).count() == 3
    assert [tuple(r) for r in places.distinct_places(df, "TX").collect()] == [("TX", "A"), ("TX", "B")]


def test_readers_skip_bad_lines(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"metric": "a", "value": "1"}\nnot json\n{"metric": "b", "value": "2"}\n')
    assert readers.read_json_lines(spark, str(tmp_path / "l.json"), schemas.KPIS).count() == 2
    (tmp_path / "w.txt").write_text("The\n the \n\nOf\n")
    assert {r.word for r in readers.read_word_list(spark, str(tmp_path / "w.txt")).collect()} == {"the", "of"}
    (tmp_path / "v.txt").write_text("good\t1.9\t0.3\t[1]\n:)\t2.0\nbroken\n")
    assert {(r.word, r.valence) for r in readers.read_lexicon(spark, str(tmp_path / "v.txt")).collect()} == {
        ("good", 1.9), (":)", 2.0)}


class FakeSession:
    """Just what the folder choice reads."""

    def __init__(self, setting, master):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_folder_follows_the_session():
    assert scratch_folder(FakeSession("/shared/x/", "spark://host"), "a").startswith("/shared/x/a-")
    assert scratch_folder(FakeSession(None, "local[2]"), "a") != scratch_folder(FakeSession(None, "local[2]"), "a")
    with pytest.raises(ValueError):
        scratch_folder(FakeSession(None, "spark://host"), "a")


def test_small_writes_make_one_file(spark, tmp_path):
    writers.write_json(spark.range(0, 100, 1, 8), str(tmp_path / "j"), small=True)
    assert len(list((tmp_path / "j").glob("part-*"))) == 1
