"""Dates: parsing, calendar parts, and season and time-of-day labels.

The label functions take SQL text of the month, hour or day they work on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and their calendar ranges.
SEASON_MONTHS = {
    "Winter": (12, 1, 2),
    "Summer": (3, 4, 5),
    "Monsoon": (6, 7, 8, 9),
    "Post_Monsoon": (10, 11),
}
TIMING_HOURS = {
    "Night": (22, 23, 0, 1, 2, 3),
    "Morning": (4, 5, 6, 7, 8, 9, 10, 11),
    "Afternoon": (12, 13, 14, 15, 16),
    "Evening": (17, 18, 19, 20, 21),
}
UNKNOWN_TIMING = "X"
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
#: Day first; single letters accept padded and unpadded numbers alike.
NOTED_FORMAT = "d-M-yyyy H:m"
NOTED_PATTERN = "^([0-9]{1,2})-([0-9]{1,2})-([0-9]{4}) ([0-9]{1,2}):([0-9]{1,2})$"


def text_array(names: list[str] | tuple[str, ...]) -> str:
    """SQL array literal of plain names."""
    return "array(" + ", ".join(f"'{name}'" for name in names) + ")"


def parse_noted(text: Column, strict: bool = True) -> Column:
    """Text to a zone-free timestamp; bad or no text raises, or is NULL if not strict."""
    if strict:
        return F.to_timestamp_ntz(F.coalesce(text, F.lit("")), F.lit(NOTED_FORMAT))
    # by way of the ISO form, because a zoned timestamp would skip hours of some zones
    iso = F.regexp_replace(text, NOTED_PATTERN, "$3-$2-$1 $4:$5:00")
    return F.when(text.rlike(NOTED_PATTERN), iso).try_cast("timestamp_ntz")


def _by_number(labels: dict[str, tuple[int, ...]]) -> list[str]:
    """The labels in the order of the numbers they stand for."""
    return [label for _, label in sorted((n, label) for label in labels for n in labels[label])]


def season_of(month: str) -> Column:
    """Season label of a month number; anything but 1-12 is an error.

    A constant array, so that an expensive ``month`` is evaluated once and not
    in every branch of a case.
    """
    return F.expr(f"element_at({text_array(_by_number(SEASON_MONTHS))}, {month})")


def timing_of(hour: str) -> Column:
    """Time-of-day label of an hour; anything but 0-23 is ``X``."""
    labels = text_array(_by_number(TIMING_HOURS))
    return F.expr(f"coalesce(get({labels}, {hour}), '{UNKNOWN_TIMING}')")


def weekday_name(day: str) -> Column:
    """Full English weekday name, independent of locale and time zone."""
    return F.expr(f"element_at({text_array(WEEKDAYS)}, weekday({day}) + 1)")


def weekday_ordinal(name: str) -> Column:
    """0 for Monday to 6 for Sunday."""
    return F.expr(f"CAST(array_position({text_array(WEEKDAYS)}, {name}) - 1 AS INT)")


def year_month(moment: str) -> Column:
    """``yyyy-MM`` text."""
    return F.expr(f"substring(CAST(CAST({moment} AS DATE) AS STRING), 1, 7)")


def calendar_parts(moment: str) -> list[Column]:
    """The calendar features of a timestamp, named."""
    numbers = {
        "year": "year",
        "month": "month",
        "day": "dayofmonth",
        "weekofyear": "weekofyear",
        "hour": "hour",
        "minute": "minute",
    }
    parts = {name: F.expr(f"{part}({moment})") for name, part in numbers.items()}
    parts["weekday"] = weekday_name(moment)
    parts["season"] = season_of(f"month({moment})")
    parts["timing"] = timing_of(f"hour({moment})")
    return [column.alias(name) for name, column in parts.items()]
