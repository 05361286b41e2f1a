"""Topics of the flagged months: the same rows as before, by plans that do less."""

import random

from pyspark.sql import functions as F

from ratingloom.operators import topics


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


REVIEWS = "business_id string, year int, month int, review_text string"


def test_texts_are_split_once(spark):
    df = spark.createDataFrame([("a", 2020, 1, "fine food fine"), ("a", 2020, 1, None), ("b", 2020, 1, "a b 12"),
                                ("c", 2020, 2, "")], REVIEWS)
    tokens = topics.topic_token_table(df, topics.SEGMENT, "review_text", [])
    assert sorted(tuple(r) for r in tokens.collect()) == [("a", 2020, 1, "fine"), ("a", 2020, 1, "fine"), ("a", 2020, 1, "food")]
    assert plan(tokens).count("regexp_replace") == 1


def test_months_flagged_twice_keep_their_reviews_once(spark):
    df = spark.createDataFrame([("a", 2020, 1, "x"), ("a", 2020, 2, "y"), ("a", 2020, 1, "x")], REVIEWS)
    flagged = spark.createDataFrame([("a", 2020, 1), ("a", 2020, 1), (None, 2020, 1)], "business_id string, year int, month int")
    assert [r.review_text for r in topics.spike_reviews(df, flagged).collect()] == ["x", "x"]


def test_top_terms_without_collecting(spark):
    draw = random.Random(3)
    rows = [(draw.choice(["a", "b", None]), 2020, m, draw.choice("uvwxyz") * draw.choice([3, 4]))
            for m in (1, 2, 3) for _ in range(60)] + [("one", 2020, 1, "only")]
    tokens = spark.createDataFrame(rows, "business_id string, year int, month int, term string")
    got = topics.segment_topics(tokens)
    collected = topics._topic_strings(topics.segment_top_terms(tokens), topics.SEGMENT).select(
        *topics.SEGMENT, F.array("topic").alias("topics"))
    assert sorted(map(str, got.collect())) == sorted(map(str, collected.collect())) and got.count() == 10
    assert "collect_list" not in plan(got)
    assert topics.segment_topics(tokens, terms=1).where("topics[0] LIKE '% + %'").isEmpty()
