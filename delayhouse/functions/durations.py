"""Durations and differences in minutes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_minutes(duration: Column) -> Column:
    """Minutes of an ISO-8601 duration text such as ``PT2H25M``.

    Only the first hour and the first minute group count; days and seconds are ignored, and a text
    without either group (``'00'``), like a null, gives 0.
    """

    def part(unit: str) -> Column:
        digits = F.regexp_extract(duration, rf"(\d+){unit}", 1)
        return F.coalesce(digits.try_cast("int"), F.lit(0))

    return part("H") * 60 + part("M")


def delay_minutes(actual: Column, scheduled: Column) -> Column:
    """Whole minutes from scheduled to actual, half away from zero; negative when early."""
    micros = F.unix_micros(actual) - F.unix_micros(scheduled)
    return F.round(micros / 60e6).cast("int")
