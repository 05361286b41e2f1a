"""Token tables and word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ratingloom.functions import text as tx
from ratingloom.operators.spread import lookup_join

# Words in the frequency table and in a word cloud.
TOP_WORDS = 20
CLOUD_WORDS = 50


def token_table(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per token with its position."""
    return df.select(key, F.posexplode(tx.tokens(text)).alias("pos", "word"))


def whitespace_tokens(df: DataFrame, key: str, text: str) -> DataFrame:
    """Lower-cased words between blanks, empty ones left out."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    return df.select(key, F.explode(words).alias("word"))


def token_filter(words: DataFrame, column: str = "word") -> DataFrame:
    """Rows whose word has only letters and more than two of them."""
    return words.where(tx.is_counted(F.col(column)))


def keep_words(words: DataFrame, allowed: DataFrame) -> DataFrame:
    """Rows whose word is in ``allowed`` (column word)."""
    return lookup_join(words, allowed.select("word").distinct(), ["word"], "left_semi")


def drop_words(words: DataFrame, stop: DataFrame) -> DataFrame:
    """Rows whose word is not in ``stop`` (column word)."""
    return lookup_join(words, stop.select("word").distinct(), ["word"], "left_anti")


def word_counts(df: DataFrame, key: str, text: str, labels: DataFrame, domain: list[str],
                stop_words: list[str]) -> DataFrame:
    """Occurrences of the domain words in positive and in negative texts.

    ``labels``: one row per ``key`` with its sentiment. Texts shrink to their few domain words
    before they meet the labels; every token is counted.
    """
    words = (df.select(key, F.explode(tx.counted_tokens(text, domain, stop_words)).alias("word"))
             .groupBy(key, "word").agg(F.count("*").alias("n")))
    classes = labels.where(F.col("sentiment").isin("positive", "negative")).select(key, "sentiment")
    return (words.join(classes, key)
            .groupBy("sentiment", "word").agg(F.sum("n").alias("count")))


def word_frequencies(counts: DataFrame, n: int = TOP_WORDS) -> DataFrame:
    """The ``n`` most used words with their positive and negative counts."""
    def of(label: str):
        return F.coalesce(F.sum(F.when(F.col("sentiment") == label, F.col("count"))),
                          F.lit(0).cast("bigint")).alias(label)

    return (counts.groupBy("word").agg(of("positive"), of("negative"))
            .orderBy(F.desc(F.col("positive") + F.col("negative")), "word").limit(n))


def wordclouds(counts: DataFrame, n: int = CLOUD_WORDS) -> DataFrame:
    """The ``n`` most used words of each class. Tasks drop lower ranks before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("sentiment").orderBy(F.desc("count"), "word"))
    return (counts.withColumn("rank", rank).where(F.col("rank") <= n)
            .select("sentiment", "word", "count"))


def vocab_union(counts: DataFrame) -> DataFrame:
    """Words used in either class."""
    positive = counts.where("sentiment = 'positive'").select("word")
    negative = counts.where("sentiment = 'negative'").select("word")
    return positive.union(negative).distinct()
