"""Calendar column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def temporal_parts(ts) -> dict[str, Column]:
    """hour, weekday (Mon=0), month, day of month, ISO week."""
    ts = _c(ts)
    return {
        "hour_of_day": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "month": F.month(ts),
        "day_of_month": F.dayofmonth(ts),
        "week_of_year": F.weekofyear(ts),
    }


def cyclical(x, period: float) -> tuple[Column, Column]:
    """sin/cos of 2*pi*x/period."""
    angle = 2 * math.pi * _c(x) / float(period)
    return F.sin(angle), F.cos(angle)


def cyclical_features(hour="hour_of_day", dow="day_of_week", month="month") -> dict[str, Column]:
    out = {}
    for name, col, period in (("hour", hour, 24), ("dow", dow, 7), ("month", month, 12)):
        if col is None:
            continue
        s, c = cyclical(col, period)
        out[f"{name}_sin"] = s
        out[f"{name}_cos"] = c
    return out


def rush_flags(hour="hour_of_day") -> dict[str, Column]:
    """0/1 flags: morning 7-9, lunch 11-14, dinner 17-21, late night >=22 or <=5."""
    h = _c(hour)
    return {
        "is_morning_rush": h.between(7, 9).cast("int"),
        "is_lunch_rush": h.between(11, 14).cast("int"),
        "is_dinner_rush": h.between(17, 21).cast("int"),
        "is_late_night": ((h >= 22) | (h <= 5)).cast("int"),
    }


def weekend_flag(dow="day_of_week") -> Column:
    return (_c(dow) >= 5).cast("int")
