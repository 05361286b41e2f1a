"""Opening hours: text like {'Monday': '8:0-17:0'} with single quotes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Week days in order, and the text that stands for a closed day.
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
CLOSED = "0:0-0:0"


def hours_map(text: str = "opening_hours") -> Column:
    """Day to time; null when the text cannot be parsed."""
    return F.from_json(F.regexp_replace(text, "'", '"'), "map<string,string>")


def days_open(hours: str, closed_value: str | None = None) -> Column:
    """Number of week days with a time. ``closed_value`` names a time that means closed."""
    def is_open(day: str) -> Column:
        time = F.col(hours).getItem(day)
        return time.isNotNull() if closed_value is None else time.isNotNull() & (time != closed_value)

    return sum((is_open(day).cast("int") for day in DAYS[1:]), is_open(DAYS[0]).cast("int"))


def week(hours: str) -> Column:
    """The seven times from Monday on, null for a missing day."""
    return F.array(*[F.col(hours).getItem(day) for day in DAYS])


def week_display(week_column: str) -> Column:
    """The seven "day: time" lines, with "Closed" for missing and closed days."""
    times = [F.get(F.col(week_column), F.lit(i)) for i in range(len(DAYS))]
    return F.array(*[
        F.concat(F.lit(f"{day}: "),
                 F.when(time.isNull() | (time == CLOSED), "Closed").otherwise(time))
        for day, time in zip(DAYS, times)
    ])


def map_display(hours: str) -> Column:
    """The "day: time" lines in the order written; "Unavailable" when there is no map."""
    lines = F.transform(F.map_entries(hours), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return F.coalesce(F.array_join(lines, "\n"), F.lit("Unavailable"))
