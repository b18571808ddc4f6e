"""Column expressions; everything here stays inside the JVM."""

from .calendar import business_date, dow_sunday0, time_parts
from .durations import delay_minutes, iso_minutes
from .flags import delay_flag, event_status, event_volumes, is_delayed
from .ids import uuid5
from .instants import aware, instant, newest_instant
from .rates import percent_half_up, ratio_half_up

__all__ = [
    "aware",
    "business_date",
    "delay_flag",
    "delay_minutes",
    "dow_sunday0",
    "event_status",
    "event_volumes",
    "instant",
    "is_delayed",
    "iso_minutes",
    "newest_instant",
    "percent_half_up",
    "ratio_half_up",
    "time_parts",
    "uuid5",
]
