"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratingloom.llm.shared import written


def _towards_least(sym: DataFrame) -> DataFrame:
    """Of (u, v) in both directions: every larger neighbour of u linked to u's smallest one."""
    least = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return (sym.where("v > u").join(least, "u")
            .select(F.col("v").alias("a"), F.col("least").alias("b")).where("a <> b"))


def _stars(links: DataFrame) -> DataFrame:
    """Of (a, b) with b < a: a and all its smaller neighbours linked to the smallest."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    joined = links.join(least, "a")
    return (joined.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
            .union(least.select("a", F.col("least").alias("b"))))


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``links`` (a, b), which are
    numbers, except the smallest nodes themselves.

    Alternates two steps (Kiveris et al. 2014): every node points its larger neighbours, then its
    smaller ones, at its smallest neighbour, until only stars are left. The passes grow with the
    logarithm of the longest chain. Each pass is written to the shared folder. A node with many
    links is reduced by partial minima; the joins are left to the planner's skew handling.
    """
    now = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                               F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        both = (now.select(F.col("a").alias("u"), F.col("b").alias("v"))
                .union(now.select(F.col("b").alias("u"), F.col("a").alias("v"))))
        mid = written(_towards_least(both).distinct(), "links")
        now = written(_stars(mid).distinct(), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = state
