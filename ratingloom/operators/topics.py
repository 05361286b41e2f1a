"""What the reviews of the flagged months talk about."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratingloom.functions import text as tx
from ratingloom.operators import segment_fit
from ratingloom.operators.spread import spread_join
from ratingloom.session import removed, scratch_folder, stored

SEGMENT = ["business_id", "year", "month"]
# Topics, words shown per topic, passes over the texts, seed; the way a topic string
# is written, and the least merged weight shown.
TOPICS = 3
TERMS = 5
PASSES = 10
SEED = 100
TERM_IN_TOPIC = r"""(\d+\.\d+)\*["']?([^"'\s]+)["']?"""
LEAST_WEIGHT = 0.5


def spike_reviews(dated: DataFrame, flagged: DataFrame) -> DataFrame:
    """The reviews of the flagged months: one join for all of them."""
    return spread_join(dated, flagged.select(*SEGMENT), SEGMENT, "left_semi")


def topic_token_table(df: DataFrame, keys: list[str], text: str, stop_words: list[str]) -> DataFrame:
    """One row per topic token."""
    # Outer, as the size filter of a plain explode would split every text a second time, before it is joined.
    return df.select(*keys, F.explode_outer(tx.topic_tokens(text, stop_words)).alias("term")).where("term IS NOT NULL")


def bag_of_words(tokens: DataFrame, key: str) -> DataFrame:
    """Occurrences of each term in each text."""
    return tokens.groupBy(key, "term").agg(F.count("*").alias("n"))


def top_terms(weights: DataFrame, keys: list[str], terms: int) -> DataFrame:
    """The heaviest terms of each group with their share of the group's whole weight."""
    group = Window.partitionBy(*keys)
    rank = F.row_number().over(group.orderBy(F.desc("w"), "term"))
    exact = F.col("w") if dict(weights.dtypes)["w"] == "bigint" else F.col("w").cast("decimal(30,6)")
    whole = F.sum(exact).over(group).cast("double")
    return (weights.withColumn("rank", rank).withColumn("_all", whole).where(F.col("rank") <= terms)
            .select(*keys, "rank", "term", "w", F.round(F.col("w") / F.col("_all"), 3).alias("weight")))


def segment_top_terms(tokens: DataFrame, segment: list[str] = SEGMENT, terms: int = TERMS) -> DataFrame:
    """The most used terms of each segment and their share of its tokens."""
    counts = tokens.groupBy(*segment, "term").agg(F.count("*").alias("w"))
    return top_terms(counts, segment, terms).withColumnRenamed("w", "n")


def topic_text(weight: Column, term: Column) -> Column:
    """Written like 0.050*"service"."""
    return F.format_string('%.3f*"%s"', weight, term)


def _topic_strings(top: DataFrame, keys: list[str]) -> DataFrame:
    """One string per group of at most a few ranked terms."""
    parts = F.array_sort(F.collect_list(F.struct("rank", topic_text(F.col("weight"), F.col("term")).alias("t"))))
    return top.groupBy(*keys).agg(
        F.array_join(F.transform(parts, lambda p: p["t"]), " + ").alias("topic"))


def segment_topics(tokens: DataFrame, segment: list[str] = SEGMENT, terms: int = TERMS) -> DataFrame:
    """The top terms as a one-entry ``topics`` list per segment: the exact, model-free report."""
    # The rows are sorted by segment as they come, so each first one takes the texts of those behind it.
    group = Window.partitionBy(*segment).orderBy("rank")
    texts = segment_top_terms(tokens, segment, terms).withColumn("t", topic_text(F.col("weight"), F.col("term")))
    topic = F.concat_ws(" + ", "t", *[F.lead("t", i).over(group) for i in range(1, terms)])
    return (texts.withColumn("topic", topic).where("rank = 1")
            .select(*segment, F.array("topic").alias("topics")))


def term_fractions(parts: list[Column]) -> list[Column]:
    """Parts of their sum, as decimals: sums of them do not depend on the order of rows."""
    whole = reduce(lambda x, y: x + y, parts)
    return [(p / whole).cast("decimal(12,9)") for p in parts]


def start_value(seed: int, topic: int, columns: list[str]) -> Column:
    """A number from 1 to 2 drawn by a hash of seed, topic and columns."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(str(topic)), *[F.col(c).cast("string") for c in columns])
    return 1.0 + F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("double") / 65536.0


def lda_topics(reviews: DataFrame, key: str, text: str, stop_words: list[str],
               segment: list[str] = SEGMENT, k: int = TOPICS, terms: int = TERMS,
               passes: int = PASSES, seed: int = SEED, most_chars: int = segment_fit.MOST_CHARS) -> DataFrame:
    """``k`` topics per segment, each with its ``terms`` heaviest terms and their share of the topic.

    Every segment has a model of its own over all its terms. A review's term is divided among the topics by
    (weight of the topic in the review) x (weight of the term in the topic), both smoothed by 1/k; each pass sums
    the parts anew. The texts of a segment go to one task, which makes all passes; segments of more than
    ``most_chars`` characters are fitted as grouped sums, with the same parts.
    """
    texts = stored(reviews.select(*segment, key, text), "topic-texts")
    small, large = segment_fit.split_by_size(texts, text, segment, most_chars)

    fit = partial(segment_fit.smoothed_fit, key=key, seed=seed, k=k, passes=passes, terms=terms)
    # A segment without a key has no reviews to be joined with.
    keyed = small.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in segment]))
    found = segment_fit.shown(stored(segment_fit.fit_segments(
        keyed, key, text, stop_words, segment, fit), "topics-found"), segment)
    return found if large is None else found.unionByName(
        _summed_lda(large, key, text, stop_words, segment, k, terms, passes, seed))


def _summed_lda(reviews: DataFrame, key: str, text: str, stop_words: list[str], segment: list[str], k: int,
                terms: int, passes: int, seed: int) -> DataFrame:
    """The passes as grouped sums over (segment, review, term). Each is written to the shared folder, and the one
    before it removed. A segment, review or term of any frequency is a sum of partial sums; the joins back
    are left to the planner's skew handling.
    """
    spark, split = reviews.sparkSession, [f"r{t}" for t in range(k)]
    bags = (topic_token_table(reviews, [*segment, key], text, stop_words)
            .groupBy(*segment, key, "term").agg(F.count("*").alias("n")))
    starts = [start_value(seed, t, [*segment, "term"]) for t in range(k)]
    state = bags.select("*", *[r.alias(c) for r, c in zip(term_fractions(starts), split)])

    def sums(df: DataFrame, keys: list[str], names: str) -> DataFrame:
        return df.groupBy(*keys).agg(*[F.sum(F.col("n") * F.col(c)).cast("double").alias(f"{names}{t}")
                                       for t, c in enumerate(split)])

    last = None
    for _ in range(passes):
        path = scratch_folder(spark, "topics")
        state.write.parquet(path)
        state = spark.read.parquet(path)
        if last:
            removed(spark, last)
        last = path
        exact = state.groupBy(*segment, "term").agg(*[
            F.sum(F.col("n") * F.col(c)).alias(f"b{t}") for t, c in enumerate(split)])
        # The segment's sums and number of words follow from its terms; no pass counts the state again.
        whole = exact.groupBy(*segment).agg(F.count("*").alias("words"), *[
            F.sum(f"b{t}").cast("double").alias(f"a{t}") for t in range(k)])
        weights = exact.select(*segment, "term", *[F.col(f"b{t}").cast("double").alias(f"b{t}") for t in range(k)])
        joined = (state.join(sums(state, [*segment, key], "d"), [*segment, key])
                  .join(weights.join(whole, segment), [*segment, "term"]))
        parts = [(F.col(f"d{t}") + 1.0 / k) * (F.col(f"b{t}") + 1.0 / k)
                 / (F.col(f"a{t}") + F.col("words") / float(k)) for t in range(k)]
        state = joined.select(*segment, key, "term", "n", *[r.alias(c) for r, c in zip(term_fractions(parts), split)])
    weights = (sums(state, [*segment, "term"], "t").unpivot([*segment, "term"], [f"t{t}" for t in range(k)], "topic", "w")
               .withColumn("topic", F.substring("topic", 2, 9).cast("int")))
    # Weights below the decimals that a pass keeps are none.
    return top_terms(weights.where("w > 0").withColumn("w", F.round("w", 6)), [*segment, "topic"], terms).drop("w")


def lda_segment_topics(lda: DataFrame, segment: list[str] = SEGMENT) -> DataFrame:
    """``topics`` list per segment from the rows of ``lda_topics``."""
    numbered = lda.withColumnRenamed("topic", "number")
    listed = F.array_sort(F.collect_list(F.struct("number", "topic")))
    return (_topic_strings(numbered, [*segment, "number"])
            .groupBy(*segment)
            .agg(F.transform(listed, lambda t: t["topic"]).alias("topics")))


def spike_report(flagged: DataFrame, topics: DataFrame) -> DataFrame:
    """The flag rows with the topics of their reviews; an empty list where no text is left."""
    return (flagged.join(topics, SEGMENT, "left")
            .withColumn("topics", F.coalesce("topics", F.array().cast("array<string>"))))


def topic_word_merge(df: DataFrame, keys: list[str], column: str = "topics") -> DataFrame:
    """Words of a list of topic strings with their summed weights in whole percent, heaviest
    first."""
    one = df.select(*keys, F.explode(column).alias("_topic"))
    pattern = F.lit(TERM_IN_TOPIC)
    pairs = F.arrays_zip(F.regexp_extract_all("_topic", pattern, F.lit(1)).alias("w"),
                         F.regexp_extract_all("_topic", pattern, F.lit(2)).alias("t"))
    words = one.select(*keys, F.explode(pairs).alias("p"))
    percent = F.floor(F.col("p.w").cast("double") * 100 + 0.5)
    return (words.groupBy(*keys, F.lower("p.t").alias("word"))
            .agg(F.sum(percent).alias("value"))
            .where(F.col("value") > LEAST_WEIGHT)
            .orderBy(*keys, F.desc("value"), "word"))
