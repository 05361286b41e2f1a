"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: how review times are written.
STAMP = "yyyy-MM-dd HH:mm:ss"


def with_date_parts(df: DataFrame, column: str = "datetime") -> DataFrame:
    """Adds review_timestamp, year, month, quarter; all null when a text is no valid time."""
    time = F.col(column)
    if dict(df.dtypes)[column] == "string":
        time = F.try_to_timestamp(time, F.lit(STAMP))
    return (df.withColumn("review_timestamp", time)
            .withColumns({
                "year": F.year("review_timestamp"),
                "month": F.month("review_timestamp"),
                "quarter": F.quarter("review_timestamp"),
            }))


def month_label(year: str = "year", month: str = "month") -> Column:
    return F.format_string("%d-%02d", year, month)


def quarter_label(year: str = "year", quarter: str = "quarter") -> Column:
    return F.format_string("%d-Q%d", year, quarter)


def label_parts(label: str) -> tuple[Column, Column]:
    """Year and month of a ``YYYY-MM`` label."""
    parts = F.split(label, "-")
    return parts[0].try_cast("int"), parts[1].try_cast("int")
