"""Expressions on array<double> vectors."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x * y), F.lit(0.0),
                       lambda total, x: total + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity, 0.0 when a vector is null or has length zero."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def register_cosine(spark: SparkSession, name: str = "cosine_sim") -> None:
    """The same as a SQL function."""
    def product(x: str, y: str) -> str:
        return (f"aggregate(zip_with({x}, {y}, (p, q) -> p * q), cast(0 as double), "
                "(total, p) -> total + p)")

    spark.sql(
        f"create or replace temporary function {name}(a array<double>, b array<double>) "
        "returns double return coalesce(try_divide("
        f"{product('a', 'b')}, sqrt({product('a', 'a')}) * sqrt({product('b', 'b')})), 0.0d)")
