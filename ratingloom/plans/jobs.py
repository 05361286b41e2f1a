"""The whole batch run: incoming lines to published tables.

Every table that more than one later step reads is written once and read back: that cuts the
lineage, so a lost executor costs at most the step at hand, and no step is computed twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratingloom.functions.dates import with_date_parts
from ratingloom.functions.wordlists import RESTAURANT_WORDS, english_stop_words
from ratingloom.operators import (cleaning, geo, joins, kpis, places, sampling, sentiment, similar,
                                  similar_index, text_vectors, topics, trends, words)
from ratingloom.sources import readers, schemas, writers


# Column names of the published trend tables.
TREND_NAMES = {"business_id": "business_ID", "name": "business_name"}


def made(table: DataFrame | Callable[[], DataFrame]) -> DataFrame:
    """A table, or what makes it: work that begins while a plan is made, such as fitting a model, is passed as
    a function, so that a store which has the table already need not begin it."""
    return table() if callable(table) else table


class Store:
    """Tables below one folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def keep(self, name: str, df: DataFrame | Callable[[], DataFrame]) -> DataFrame:
        """Writes a working table and returns it as read back. One file per task: no partition
        columns, which would multiply the files of a big run."""
        writers.write_parquet(made(df), self.path(name))
        return self.spark.read.parquet(self.path(name))

    def publish(self, name: str, df: DataFrame | Callable[[], DataFrame], small: bool = False) -> None:
        writers.write_json(made(df), self.path(f"published/{name}"), small)


def _judged(store: Store, name: str, judged: DataFrame) -> DataFrame:
    """One pass over the lines writes kept and rejected ones; only rejected ones keep their text."""
    reason = F.col("reject_reason")
    return store.keep(f"judged/{name}",
                      judged.withColumn("value", F.when(reason.isNotNull(), F.col("value"))).drop("n"))


def numbered(raw: DataFrame) -> DataFrame:
    """Adds date parts and a ``row_id``, unique even where a review is listed twice. Writing the table
    fixes the numbers."""
    return with_date_parts(raw).withColumn("row_id", F.monotonically_increasing_id())


def run_etl(spark: SparkSession, business_path: str, review_path: str, folder: str,
            keyword: str = "food", store: Store | None = None) -> tuple[DataFrame, DataFrame]:
    """(raw, aggregated) from the two incoming files."""
    store = store or Store(spark, folder)
    business = cleaning.kept_business(_judged(
        store, "business", cleaning.judge_business(readers.read_lines(spark, business_path), keyword)))
    review = cleaning.kept_review(_judged(
        store, "review", cleaning.judge_review(readers.read_lines(spark, review_path))))
    business = store.keep("business", joins.one_per_key(business, "business_id", ["review_count"]))
    return (store.keep("raw", numbered(joins.join_raw(business, review, extra=("review_id",)))),
            store.keep("aggregated", joins.join_aggregated(business, review)))


def stage_text(spark: SparkSession, raw_path: str, aggregated_path: str, folder: str,
               escaped: bool) -> tuple[DataFrame, DataFrame]:
    """(raw, aggregated) from tab-separated files that were joined before; ``escaped`` if by ``publish_text``."""
    store = Store(spark, folder)
    return (store.keep("raw", numbered(readers.read_raw(spark, raw_path, escaped))),
            store.keep("aggregated", readers.read_aggregated(spark, aggregated_path, escaped)))


def publish_text(raw: DataFrame, aggregated: DataFrame, folder: str) -> None:
    """Both tables as tab-separated text."""
    writers.write_tsv(raw.select(*[f.name for f in schemas.RAW]), f"{folder}/raw")
    writers.write_tsv(aggregated.select(*[f.name for f in schemas.AGGREGATED]), f"{folder}/aggregated")


def sample_text(spark: SparkSession, path: str, out: str, n: int = sampling.ROWS) -> None:
    """The first ``n`` lines of a text table, in the order of the lines themselves."""
    lines = readers.read_lines(spark, path)
    sampling.sample_n(lines, ["value"], n).write.mode("overwrite").text(out)


def run_cities(store: Store, aggregated: DataFrame) -> None:
    store.publish("top_categories_per_city", places.biggest_first(places.top_categories(aggregated)))
    store.publish("avg_business_hours", places.avg_days_open(aggregated))
    store.publish("hotspot_cities_per_category", places.hottest_first(places.hotspots(aggregated)))
    store.publish("business_details", places.business_details(aggregated))


def run_geo(store: Store, aggregated: DataFrame) -> None:
    store.publish("geospatial_sentiment", geo.geo_points(aggregated))


def run_kpis(store: Store, raw: DataFrame) -> None:
    table = kpis.kpis_long(raw)
    store.publish("summary_kpis", table, small=True)


def run_sentiment(store: Store, raw: DataFrame, lexicon: DataFrame, domain: list[str],
                  stop_words: list[str], rules: bool = True) -> None:
    score = sentiment.rule_sentiment if rules else sentiment.lexicon_sentiment
    labelled = store.keep("labelled", score(raw, "row_id", "review_text", lexicon, ["stars"])
                          .withColumn("rating_category", sentiment.rating_category("stars")))
    counts = store.keep("word_counts", words.word_counts(
        raw, "row_id", "review_text", labelled, domain, stop_words))
    store.publish("word_frequencies", words.word_frequencies(counts), small=True)
    clouds = words.wordclouds(counts)
    for label in ("positive", "negative"):
        store.publish(f"{label}_wordcloud",
                      clouds.where(F.col("sentiment") == label).select("word", "count"), small=True)
    store.publish("sentiment_rating_summary", sentiment.label_summary(labelled), small=True)
    store.publish("sentiment_vs_rating", sentiment.sentiment_vs_rating(labelled), small=True)


def run_trends(store: Store, raw: DataFrame, stop_words: list[str], model: bool = True) -> None:
    """Trends and the report on spikes and dips. Without usable reviews nothing is written."""
    raw = cleaning.drop_null_keys(raw, ["business_id", "stars", "datetime"])
    if raw.isEmpty():
        return
    places_of = store.keep("places", places.distinct_business(places.each_once(
        raw.select("business_id", *trends.MONTH_ATTRIBUTES))))
    monthly = store.keep("monthly", trends.monthly_ratings(raw))
    store.publish("business_monthly_trends", trends.with_business(
        monthly, places_of, trends.MONTH_ATTRIBUTES).withColumnsRenamed(TREND_NAMES))
    store.publish("business_quarterly_trends", trends.with_business(
        trends.quarterly_ratings(raw), places_of, trends.QUARTER_ATTRIBUTES).withColumnsRenamed(TREND_NAMES))
    flagged = store.keep("flagged", trends.with_business(trends.spikes_dips(monthly), places_of, ["name"]))
    if flagged.isEmpty():
        return
    reviews = topics.spike_reviews(raw.select("row_id", "review_text", *topics.SEGMENT), flagged)
    if model:
        kept = store.keep("spike_reviews", reviews)
        found = store.keep("spike_topics", lambda: topics.lda_segment_topics(topics.lda_topics(
            kept, "row_id", "review_text", stop_words)))
    else:
        found = topics.segment_topics(topics.topic_token_table(
            reviews, topics.SEGMENT, "review_text", stop_words))
    columns = ["business_id", "name", "year", "month", "monthly_avg_rating", "prev_avg_rating",
               "rating_diff", "spike_or_dip"]
    report = topics.spike_report(flagged.select(*columns), found)
    store.publish("spike_dip_topic_modeling", report.withColumnsRenamed(TREND_NAMES))


def text_profiles(raw: DataFrame, vectors: str, stop_words: list[str], **fit) -> DataFrame:
    """Business profiles from the vectors of categories and reviews: "cooccurrence" (tables only, exact at any
    number of partitions) or "word2vec" (vocabulary on the driver)."""
    texts = similar.business_text(raw).select("row_id", "business_id", "name", "city", "state", "combined_text")
    if vectors == "word2vec":
        found = similar.word2vec_docs(texts, "combined_text", **fit).drop("combined_text")
    else:
        size = fit.get("size", similar.VECTOR_SIZE)
        learned = text_vectors.learn(texts, "combined_text", stop_words, size=size)
        return text_vectors.mean_vectors(texts, "business_id", "row_id", "combined_text", ["name", "city", "state"],
                                         learned, stop_words, size)
    return similar.business_profiles(found, ["name", "city", "state"])


def run_similar(store: Store, raw: DataFrame, aggregated: DataFrame, vectors: str = "word2vec",
                stop_words: list[str] | None = None, **fit) -> None:
    profiles = store.keep("profiles", lambda: text_profiles(raw, vectors, stop_words or [], **fit))
    nested = store.keep("similar", lambda: similar.recs_nested(similar_index.similar_topk_index(profiles)))
    store.publish("top5_similar_businesses", nested)
    store.publish("similar_businesses_enriched",
                  similar.recs_enriched(nested, places.business_details(aggregated)))


def run_analytics(spark: SparkSession, raw: DataFrame, aggregated: DataFrame, folder: str,
                  lexicon: DataFrame, domain: list[str] = RESTAURANT_WORDS,
                  stop_words: list[str] | None = None, store: Store | None = None, **fit) -> None:
    stop_words = english_stop_words() if stop_words is None else stop_words
    store = store or Store(spark, folder)
    run_cities(store, aggregated)
    run_similar(store, raw, aggregated, stop_words=stop_words, **fit)
    run_geo(store, aggregated)
    run_sentiment(store, raw, lexicon, domain, stop_words)
    run_kpis(store, raw)
    run_trends(store, raw, stop_words)


def run_all(spark: SparkSession, business_path: str, review_path: str, folder: str,
            lexicon: DataFrame, **options) -> None:
    raw, aggregated = run_etl(spark, business_path, review_path, folder)
    run_analytics(spark, raw, aggregated, folder, lexicon, **options)
