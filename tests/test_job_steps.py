"""Steps of the batch run that every review passes: the same rows as before, by plans that do less."""

from pyspark.sql import functions as F

from ratingloom.operators import cleaning, places


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_blank_as_by_trimming(spark):
    odd = [None, "", " ", "\t\n", "\x00", "\x1f ", "!", " !", "a", " ", " ", "é", "\x7f", "\U0001f600", " 　", "\x00a"]
    df = spark.createDataFrame([(t,) for t in odd], "t string")
    trimmed = F.coalesce(F.trim("t", F.lit(cleaning.BLANKS)) == "", F.lit(True))
    assert df.where(cleaning.is_blank("t") != trimmed).isEmpty()
    assert df.where(cleaning.is_blank("t").isNull()).isEmpty()
    # Only texts that begin with a blank are trimmed.
    assert ">= !" in plan(df.select(cleaning.is_blank("t")))


def test_numbers_are_not_blank(spark):
    df = spark.createDataFrame([(1, 0.5), (-2, None), (None, 1.0), (0, float("nan"))], "a bigint, b double")
    assert sorted(r.a for r in cleaning.validate_non_blank(df, ["a", "b"]).collect()) == [0, 1]


def test_tabs_at_the_end_do_not_count(spark):
    lines = ["a\tb", "a\tb\t", "a\tb\t\t\t", "\t", "", "a\t\tb", "a \t ", None]
    got = cleaning._fields(spark.createDataFrame([(t,) for t in lines], "value string"))
    assert {r.value: r.f for r in got.collect()} == {t: None if t is None else t.rstrip("\t").split("\t") for t in lines}
    assert "endswith" in plan(got).lower()


def test_places_are_hashed_before_they_are_sorted(spark):
    rows = [(b, n, c) for b in ("x", "y", None) for n in ("N", "M", None) for c in ("C", None)] * 3
    df = spark.createDataFrame(rows, "business_id string, name string, city string")
    got = places.distinct_business(places.each_once(df))
    assert sorted(map(str, got.collect())) == sorted(map(str, places.distinct_business(df).collect()))
    assert plan(got).count("HashAggregate") >= 2  # a plain distinct is taken out by the planner
