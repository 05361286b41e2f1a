"""Cleaning of incoming lines: every line ends up either kept or rejected with a reason."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ratingloom.functions.numbers import parse_finite, parse_int
from ratingloom.sources import schemas

# Characters a blank field may consist of: everything up to the space.
BLANKS = "".join(chr(i) for i in range(33))


def is_blank(column: str) -> Column:
    """Null, empty or nothing but blanks. Most texts begin with a character beyond the space, so trimming tells
    nothing new of them."""
    return F.when(F.col(column).cast("string") >= "!", F.lit(False)).otherwise(
        F.coalesce(F.trim(F.col(column), F.lit(BLANKS)) == "", F.lit(True)))


def all_non_blank(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [~is_blank(c) for c in columns])


def validate_non_blank(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where(all_non_blank(columns))


def has_keyword(column: str, keyword: str) -> Column:
    """Substring test without regard to case: "Seafood" has "food"."""
    return F.lower(column).contains(keyword.lower())


def keyword_filter(df: DataFrame, keyword: str = "food", column: str = "categories") -> DataFrame:
    return df.where(has_keyword(column, keyword))


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows without a null (or, in a number column, NaN) in ``keys``; the null tests reach the scan."""
    kinds = dict(df.dtypes)
    kept = df
    for key in keys:
        kept = kept.where(F.col(key).isNotNull())
        if kinds[key] in ("double", "float"):
            kept = kept.where(~F.isnan(key))
    return kept


def _fields(lines: DataFrame) -> DataFrame:
    # Empty fields at the end of a line do not count. The one-element explode keeps the filters
    # below from being merged into the scan's projection, where each of them would split again.
    value = F.when(F.endswith("value", F.lit("\t")), F.rtrim("value", F.lit("\t"))).otherwise(F.col("value"))
    parts = F.split(value, "\t")
    return lines.select("value", F.explode(F.array(parts)).alias("f"))


def _named(positions: dict[str, int]) -> list[Column]:
    return [F.get("f", F.lit(i)).alias(name) for name, i in positions.items()]


def judge_business(lines: DataFrame, keyword: str = "food") -> DataFrame:
    """Named text fields plus ``reject_reason``, null for good lines."""
    names = list(schemas.BUSINESS_POSITIONS)
    required = [n for n in names if n != "business_id"]
    fields = _fields(lines).select("value", F.size("f").alias("n"), *_named(schemas.BUSINESS_POSITIONS))
    return fields.withColumn(
        "reject_reason",
        F.when(F.col("n") < schemas.BUSINESS_MIN_FIELDS, "field_count")
        .when(~has_keyword("categories", keyword), "category")
        .when(reduce(lambda a, b: a | b, [F.col(c) == "" for c in required]), "missing_field")
        .when(parse_finite("lat").isNull() | parse_finite("lon").isNull()
              | parse_int("review_count").isNull(), "bad_number")
        .when(~all_non_blank(names), "blank_field"))


def judge_review(lines: DataFrame) -> DataFrame:
    names = list(schemas.REVIEW_POSITIONS)
    fields = _fields(lines).select("value", F.size("f").alias("n"), *_named(schemas.REVIEW_POSITIONS))
    stars = F.col("stars").try_cast("double")
    return fields.withColumn(
        "reject_reason",
        F.when(F.col("n") != schemas.REVIEW_FIELDS, "field_count")
        .when(stars.isNull(), "bad_number")
        .when(F.isnan(stars) | ~stars.between(1, 5), "stars_range")
        .when(is_blank("review_text"), "blank_text")
        .when(~all_non_blank(names), "blank_field"))


def kept_business(judged: DataFrame) -> DataFrame:
    casts = {f.name: f.dataType for f in schemas.BUSINESS}
    return (judged.where(F.col("reject_reason").isNull())
            .select(*[F.col(n).try_cast(t).alias(n) for n, t in casts.items()]))


def kept_review(judged: DataFrame) -> DataFrame:
    casts = {f.name: f.dataType for f in schemas.REVIEW}
    return (judged.where(F.col("reject_reason").isNull())
            .select(*[F.col(n).try_cast(t).alias(n) for n, t in casts.items()]))


def rejected(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reject_reason").isNotNull()).select("value", "reject_reason")


def clean_business(lines: DataFrame, keyword: str = "food") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected); a narrow pass over the lines."""
    judged = judge_business(lines, keyword)
    return kept_business(judged), rejected(judged)


def clean_review(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    judged = judge_review(lines)
    return kept_review(judged), rejected(judged)


def reject_reasons(*judged: DataFrame) -> DataFrame:
    """How many lines were rejected for each reason."""
    reasons = reduce(DataFrame.unionByName, [j.select("reject_reason") for j in judged])
    return (reasons.where("reject_reason is not null")
            .groupBy("reject_reason").agg(F.count("*").alias("lines")))
