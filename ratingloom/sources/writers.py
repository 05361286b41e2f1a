"""Sinks. Every partition writes its own file; nothing is squeezed through one task
unless the caller says the table is small by nature (a handful of KPI rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _field(column: str) -> Column:
    """Text of a field: backslash, tab and line ends as two characters each, null as ``\\N``."""
    text = F.col(column).cast("string")
    for char, written in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(char), F.lit(written))
    return F.coalesce(text, F.lit("\\N"))


def write_tsv(df: DataFrame, path: str) -> None:
    """One line per row. ``readers.read_tsv`` gives every value back as it was."""
    lines = df.select(F.concat_ws("\t", *[_field(c) for c in df.columns]).alias("value"))
    lines.write.mode("overwrite").option("lineSep", "\n").text(path)


def write_json(df: DataFrame, path: str, small: bool = False) -> None:
    (df.coalesce(1) if small else df).write.mode("overwrite").json(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv_header(df: DataFrame, path: str, small: bool = False) -> None:
    (df.coalesce(1) if small else df).write.mode("overwrite").csv(path, header=True)
