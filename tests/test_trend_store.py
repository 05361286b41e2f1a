"""Batches merged into kept trends."""

import pytest
from pyspark.sql import functions as F

import compare
from ratingloom.operators import trend_state, trends
from ratingloom.plans.trend_store import TrendStore

SCHEMA = "business_id string, stars double, datetime string"


@pytest.fixture(scope="module")
def reviews(spark):
    rows = [(f"b{i % 7}", float(1 + i * 7 % 5) / (1 if i % 3 else 2), f"2020-{1 + i % 9:02d}-1{i % 10} 10:00:00") for i in range(400)]
    rows += [("lone", 5.0, "2021-01-01 00:00:00"), ("exact", 3.1, "2021-01-01 00:00:00"), ("exact", 3.1, "2021-01-02 00:00:00")]
    return trends.prepare(spark.createDataFrame(rows, SCHEMA)).withColumn("i", F.monotonically_increasing_id())


def one_run(reviews):
    return compare.spark_rows(trends.month_over_month(trends.monthly_ratings(reviews)))


def test_sums_give_mean_and_spread(reviews):
    found = compare.spark_rows(trend_state.monthly_ratings(trend_state.monthly_sums(reviews)))
    assert found == compare.spark_rows(trends.monthly_ratings(reviews))


def test_batches_equal_one_run_and_repeats_change_nothing(spark, reviews, tmp_path):
    store = TrendStore(spark, str(tmp_path))
    assert store.batches() == []
    for number in range(4):
        assert store.merge(number, reviews.where(F.col("i") % 4 == number))
        assert not store.merge(number, reviews)
        if number == 1:
            store.compact()
        done = reviews.where(F.col("i") % 4 <= number)
        assert compare.spark_rows(store.series()) == one_run(done)
    store.compact()
    assert compare.spark_rows(store.series()) == one_run(reviews) and store.batches() == [0, 1, 2, 3]
    assert store.sums().agg(F.sum("n")).first()[0] == reviews.count()
    with pytest.raises(ValueError):
        TrendStore(spark, str(tmp_path)).merge(-1, reviews)


def test_only_touched_businesses_are_written(spark, reviews, tmp_path):
    store = TrendStore(spark, str(tmp_path))
    store.merge(1, reviews)
    store.merge(2, reviews.where("business_id = 'b3'"))
    written = spark.read.parquet(f"{tmp_path}/series/batch=2")
    assert [r[0] for r in written.select("business_id").distinct().collect()] == ["b3"]
    both = reviews.unionByName(reviews.where("business_id = 'b3'"))
    assert compare.spark_rows(store.series()) == one_run(both)


def test_broken_batch_is_done_again(spark, reviews, tmp_path, monkeypatch):
    """The run breaks behind the sums: readers see the old state, and the next try replaces what it left."""
    store = TrendStore(spark, str(tmp_path))
    store.merge(1, reviews.where("i % 2 = 0"))
    before = compare.spark_rows(store.series())
    with monkeypatch.context() as m:
        m.setattr(trends, "month_over_month", lambda _: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.merge(2, reviews)
    again = TrendStore(spark, str(tmp_path))
    assert compare.spark_rows(again.series()) == before and again.batches() == [1]
    assert again.merge(2, reviews.where("i % 2 = 1"))
    assert compare.spark_rows(again.series()) == one_run(reviews)
