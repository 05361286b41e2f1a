"""Tables in one layout by business: plans without exchanges, and hot businesses."""

import pytest
from pyspark.sql import functions as F

import compare
from ratingloom.operators import trends
from ratingloom.plans import business_store as bs


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(f"b{i % 40}" if i % 3 else "hot", float(i % 5 + 1), f"2020-{1 + i % 12:02d}-11 10:00:00", f"t{i}") for i in range(3000)]
    raw = trends.prepare(spark.createDataFrame(rows, "business_id string, stars double, datetime string, text string"))
    places = raw.select("business_id").distinct().select(
        "business_id", *[F.concat(F.lit(c), "business_id").alias(c) for c in trends.MONTH_ATTRIBUTES])
    return raw, places


def stored(spark, tables, folder, buckets):
    store = bs.BusinessStore(spark, str(folder), tables[0], buckets)
    store.keep("raw", tables[0])
    store.keep("places", tables[1])
    store.keep("flagged", store.made(lambda raw: trends.spikes_dips(trends.monthly_ratings(raw)), "raw"))
    return store


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange")


def test_no_exchange_by_business(spark, tables, tmp_path):
    store = stored(spark, tables, tmp_path, 8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for make, names in ((bs.monthly_trends, ("raw", "places")), (bs.spike_reviews, ("raw", "flagged")),
                            (bs.profiles, ("raw", "places"))):
            assert exchanges(make(*[store.bucketed(n) for n in names])) == 0, make
        # The same on tables without the layout moves rows.
        assert exchanges(bs.monthly_trends(*tables)) >= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        store.close()


@pytest.mark.parametrize("buckets", [1, 8, 64])
def test_hot_business_is_kept_apart_and_nothing_changes(spark, tables, tmp_path, buckets):
    raw, places = tables
    store = stored(spark, tables, tmp_path, buckets)
    assert len(store.hot) == (0 if buckets == 1 else 1 if buckets == 8 else 1)
    if store.hot:
        assert {r[0] for r in store.apart("raw").select("business_id").distinct().collect()} == {"hot"}
        assert store.bucketed("raw").where("business_id = 'hot'").isEmpty()
    flagged = trends.spikes_dips(trends.monthly_ratings(raw))
    for make, mine, names in ((bs.monthly_trends, tables, ("raw", "places")), (bs.profiles, tables, ("raw", "places")),
                              (bs.spike_reviews, (raw, flagged), ("raw", "flagged"))):
        assert compare.spark_rows(store.made(make, *names)) == compare.spark_rows(make(*mine))
    store.close()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(store.prefix)]


def test_empty_tables(spark, tables, tmp_path):
    store = stored(spark, [t.limit(0) for t in tables], tmp_path, 4)
    assert store.made(bs.monthly_trends, "raw", "places").count() == 0
    store.close()


def test_one_business_reads_one_bucket(spark, tables, tmp_path):
    store = stored(spark, tables, tmp_path, 8)
    found = store.of("raw", "b7")
    # The plan names the buckets only where it keeps their layout, which it need not for a filter.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        shown = store.of("raw", "b7")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 8" in shown
    assert compare.spark_rows(found) == compare.spark_rows(tables[0].where("business_id = 'b7'"))
    assert compare.spark_rows(store.of("raw", "hot")) == compare.spark_rows(tables[0].where("business_id = 'hot'"))
    store.close()
