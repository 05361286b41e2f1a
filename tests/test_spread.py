"""Joins with a hot key."""

import pytest
from pyspark.sql import functions as F

from ratingloom.operators import sampling, spread


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows belong to key 7."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000)
    return spark.range(30_000).select(key.cast("int").alias("k"), F.col("id"))


def test_hot_keys(spark, facts):
    hot, rows = spread.hot_keys(facts, ["k"])
    assert rows == 30_000 and list(hot.values()) == [10_020]
    even = spark.range(10_000).select((F.col("id") % 1000).alias("k"))
    assert spread.hot_keys(even, ["k"]) == ({}, 10_000)
    assert spread.hot_keys(even.limit(0), ["k"]) == ({}, 0)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_is_a_join(spark, facts, how):
    lookup = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    want = facts.join(lookup, "k", how)
    for max_bytes in (0, spread.BROADCAST_BYTES):
        got = spread.spread_join(facts, lookup, ["k"], how, max_bytes=max_bytes)
        assert got.columns == want.columns
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_hot_rows_are_dealt_out(spark, facts):
    lookup = spark.range(0, 500).select(F.col("id").alias("k"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        def biggest(joined):
            sizes = joined.groupBy(F.spark_partition_id()).count().collect()
            return max(r["count"] for r in sizes)

        assert biggest(facts.join(lookup, "k")) > 10_000
        assert biggest(spread.spread_join(facts, lookup, ["k"], max_bytes=0)) < 5_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_null_keys_and_unsupported_joins(spark):
    facts = spark.createDataFrame([(None, 1)] * 50 + [(2, 2)], "k int, x int")
    lookup = spark.createDataFrame([(2, "two"), (None, "none")], "k int, v string")
    assert spread.spread_join(facts, lookup, ["k"], "left", max_bytes=0).where("v is null").count() == 50
    with pytest.raises(ValueError):
        spread.spread_join(facts, lookup, ["k"], "outer")


def test_lookup_join_beyond_the_bound(spark, facts):
    lookup = spark.range(0, 500).select(F.col("id").cast("int").alias("k"))
    assert spread.is_small(lookup) and not spread.is_small(lookup, max_bytes=5000)
    big = spread.spread_join(facts, lookup, ["k"], max_bytes=5000)
    assert big.count() == spread.lookup_join(facts, lookup, ["k"]).count()


def test_equal_rows_are_dealt_out_by_their_id(spark):
    """One key, 200,000 rows in four kinds: with a row id every task gets its share."""
    rows = spark.range(200_000).select(F.lit(7).alias("k"), (F.col("id") % 4).alias("v"), "id")
    lookup = spark.createDataFrame([(7,)], "k int")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
                "spark.sql.adaptive.enabled": "false"}
    old = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = spread.spread_join(rows, lookup, ["k"], row_id="id", max_bytes=0)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 16 and max(sizes) < 30_000
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("n", [0, 1, 37, 5000])
def test_sample_n(spark, n):
    df = spark.range(0, 3000, 1, 9).select((F.col("id") * 7919 % 3001).alias("v"))
    got = [r.v for r in sampling.sample_n(df, ["v"], n, fan_in=2).collect()]
    assert got == sorted(r.v for r in df.collect())[:n]
