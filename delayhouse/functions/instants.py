"""Points in time as literals and back, independent of the driver's time zone."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def aware(value: datetime) -> datetime:
    """The same point in time with a zone; a value without one is UTC."""
    return value if value.tzinfo else value.replace(tzinfo=timezone.utc)


def instant(value: datetime) -> Column:
    """A timestamp literal; a value without a zone is UTC."""
    return F.lit(aware(value))


def newest_instant(df: DataFrame, column: str) -> datetime | None:
    """The largest timestamp of a column, in UTC; None without rows."""
    micros = df.agg(F.unix_micros(F.max(column))).first()[0]
    return None if micros is None else _EPOCH + timedelta(microseconds=micros)
