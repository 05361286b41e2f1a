"""Distinct counts that can be added up: sketches per place and month beside the exact counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The sketch keeps 2 ** 12 registers: its standard error is 0.83 / sqrt(4096), or 1.3 %.
LOG_REGISTERS = 12
ERROR = 0.83 / 2 ** (LOG_REGISTERS / 2)
# An estimate is held to be right within so many standard errors.
ERRORS = 4


def sketched(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``keys`` and the ``sketch`` of the distinct values of a column; some kilobytes a row, whatever it counts."""
    return df.where(F.col(column).isNotNull()).groupBy(*keys).agg(
        F.hll_sketch_agg(column, LOG_REGISTERS).alias("sketch"))


def rolled_up(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of fewer keys, or of two batches with the same keys, from sketches alone."""
    merged = F.hll_union_agg("sketch").alias("sketch")
    return sketches.groupBy(*keys).agg(merged) if keys else sketches.agg(merged)


def estimated(sketches: DataFrame) -> DataFrame:
    """``sketches`` with the ``estimate`` in the sketch's place."""
    return sketches.withColumn("estimate", F.hll_sketch_estimate("sketch")).drop("sketch")


def is_right(estimate: str, exact: str):
    """Whether an estimate lies within the stated error of an exact count."""
    return F.abs(F.col(estimate) - F.col(exact)) <= F.greatest(F.lit(1.0), F.col(exact) * (ERRORS * ERROR))
