"""Substring search over names by a table of trigrams.

A row of the postings says that a name holds three characters in a row. A needle's rarest trigrams, by a
table of their frequencies, are looked up and intersected; names that have them all are then checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratingloom.operators.spread import spread_join

GRAM = 3
# Trigrams of a needle that are looked up at most: the rarest ones.
RAREST = 3
# A trigram that more than this share of the names have is looked up only if a needle has no other.
COMMON = 0.05


def trigrams(text: Column) -> Column:
    """The distinct trigrams of a text in lower case; none for shorter ones."""
    lower = F.lower(text)
    starts = F.sequence(F.lit(1), F.greatest(F.length(lower) - (GRAM - 1), F.lit(1)))
    grams = F.array_distinct(F.transform(starts, lambda i: F.substring(lower, i, F.lit(GRAM))))
    return F.filter(grams, lambda g: F.length(g) == GRAM)


def postings(names: DataFrame, key: str, name: str) -> DataFrame:
    """trigram and ``key`` of every name, in the order of the trigrams over many files, so that a look-up reads
    few row groups."""
    return (names.select(F.explode(trigrams(F.col(name))).alias("trigram"), key)
            .repartitionByRange("trigram", key).sortWithinPartitions("trigram", key))


class NameIndex:
    """The index of a table of names in one folder: names, postings, and how often each trigram occurs."""

    def __init__(self, spark: SparkSession, folder: str, key: str, name: str = "name") -> None:
        self.spark, self.folder, self.key, self.name = spark, folder.rstrip("/"), key, name

    def build(self, names: DataFrame) -> NameIndex:
        names.write.mode("overwrite").parquet(f"{self.folder}/names")
        postings(self.read("names"), self.key, self.name).write.mode("overwrite").parquet(f"{self.folder}/postings")
        (self.read("postings").groupBy("trigram").agg(F.count("*").alias("n"))
         .repartitionByRange("trigram").sortWithinPartitions("trigram")
         .write.mode("overwrite").parquet(f"{self.folder}/frequencies"))
        return self

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}")

    def rarest(self, needle: str) -> list[str] | None:
        """The trigrams to look up, rarest first; None if the needle is too short to have any. No more rows
        come to the driver than the needle has trigrams."""
        lower = needle.lower()
        grams = {lower[i:i + GRAM] for i in range(len(lower) - GRAM + 1)}
        if not grams:
            return None
        found = {r["trigram"]: r["n"] for r in
                 self.read("frequencies").where(F.col("trigram").isin(sorted(grams))).collect()}
        names = self.read("names").count()
        order = sorted(grams, key=lambda g: (found.get(g, 0), g))
        rare = [g for g in order if found.get(g, 0) <= COMMON * names]
        return (rare or order[:1])[:RAREST]

    def search(self, needle: str) -> DataFrame:
        """The names that contain ``needle``, whatever its case: all their columns. Needles of fewer than three
        characters are looked for in all names."""
        holds = F.lower(self.name).contains(needle.lower())
        grams = self.rarest(needle)
        if grams is None:
            return self.read("names").where(holds)
        ids = (self.read("postings").where(F.col("trigram").isin(grams)).groupBy(self.key)
               .agg(F.count("*").alias("n")).where(F.col("n") == len(grams)).select(self.key))
        return spread_join(self.read("names"), ids, [self.key], "left_semi").where(holds)
