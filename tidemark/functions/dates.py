"""Date and time expressions on naive timestamps."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.spans import MICROS_PER_DAY, column, instant, micros


def elapsed_days(later, earlier) -> Column:
    """Fractional days."""
    return (micros(instant(later)) - micros(instant(earlier))) / F.lit(float(MICROS_PER_DAY))


def elapsed_seconds(later, earlier) -> Column:
    return (micros(instant(later)) - micros(instant(earlier))) / F.lit(1e6)


def days_truncated(later, earlier) -> Column:
    """Whole days, cut towards zero."""
    return elapsed_days(later, earlier).cast("bigint")


def days_floored(later, earlier) -> Column:
    """Whole days, rounded down: differs from the truncated form below zero."""
    return F.floor(elapsed_days(later, earlier))


def at_least(value: Column, bound) -> Column:
    return F.greatest(F.lit(bound), value)


def weekday_sunday0(time) -> Column:
    return F.dayofweek(column(time)) - 1


def weekday_monday0(time) -> Column:
    return F.weekday(column(time))


def weekday_monday1(time) -> Column:
    return F.weekday(column(time)) + 1


def weekday_name(time) -> Column:
    return F.date_format(column(time), "EEEE")


def is_weekend(time) -> Column:
    return (F.weekday(column(time)) >= 5).cast("int")


def month_key(time) -> Column:
    return F.date_format(column(time), "yyyy-MM")


def month_start(time) -> Column:
    return F.trunc(F.to_date(column(time)), "month")


def part_of_day(time) -> Column:
    hour = F.hour(column(time))
    return (
        F.when(hour.between(6, 11), "morning")
        .when(hour.between(12, 17), "afternoon")
        .when(hour.between(18, 22), "evening")
        .otherwise("night")
    )


def year_start(year) -> Column:
    return F.make_date(column(year).cast("int"), F.lit(1), F.lit(1))


def cyclical(value, period: float) -> tuple[Column, Column]:
    angle = column(value) * F.lit(2 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def campaign_position(time, start, end) -> tuple[Column, Column]:
    """Days into a campaign and its total length."""
    return days_floored(time, start), days_floored(end, start)
