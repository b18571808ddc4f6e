"""Calendar parts and the business date of a run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dow_sunday0(when: Column) -> Column:
    """Day of week with Sunday = 0."""
    return F.dayofweek(when) - 1


def time_parts(when: Column, prefix: str = "departure") -> list[Column]:
    """Weekday (Sunday = 0), month, hour and day of month."""
    return [
        dow_sunday0(when).alias(f"{prefix}_weekday"),
        F.month(when).alias(f"{prefix}_month"),
        F.hour(when).alias(f"{prefix}_hour"),
        F.dayofmonth(when).alias(f"{prefix}_monthday"),
    ]


def _parsed_date(text: Column) -> Column:
    """The calendar date written in a date or timestamp text; null when the text does not parse."""
    clean = F.trim(text)
    return F.when(clean.try_cast("timestamp").isNotNull(), F.substring(clean, 1, 10).try_cast("date"))


def business_date(
    explicit: Column,
    conf_start: Column,
    conf_business: Column,
    param_start: Column,
    logical: Column,
    interval_start: Column,
    now: Column,
) -> Column:
    """First usable of: explicit date, run conf (two keys), parameter, logical date, interval start, now.

    The first four are texts, and one that does not parse falls through to the next.
    """
    texts = [_parsed_date(c) for c in (explicit, conf_start, conf_business, param_start)]
    return F.coalesce(*texts, F.to_date(logical), F.to_date(interval_start), F.to_date(now))
