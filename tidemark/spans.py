"""Time offsets and windows whose edges are stated by the caller."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND


def column(value) -> Column:
    """A column from a column, a column name or a point in time."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        return F.to_timestamp_ntz(F.lit(value.isoformat(sep=" ")))
    return F.col(value)


def instant(value) -> Column:
    """The value as a naive timestamp; a plain date becomes its midnight."""
    return column(value).cast("timestamp_ntz")


def micros(value) -> Column:
    """Microseconds since the epoch, used for exact arithmetic and RANGE frames."""
    return F.unix_micros(column(value).cast("timestamp"))


@dataclass(frozen=True)
class Offset:
    """A signed shift: calendar months plus an exact number of microseconds."""

    months: int = 0
    us: int = 0

    def after(self, value) -> Column:
        shifted = instant(value)
        if self.months:
            # month ends clamp: 31 March minus one month is the last day of February
            shifted = shifted + F.make_ym_interval(F.lit(0), F.lit(self.months))
        if self.us:
            whole, rest = divmod(self.us, MICROS_PER_SECOND)
            shifted = shifted + F.make_dt_interval(
                F.lit(0), F.lit(0), F.lit(0), F.lit(whole + rest / MICROS_PER_SECOND).cast("decimal(18,6)")
            )
        return shifted

    def __neg__(self) -> Offset:
        return Offset(-self.months, -self.us)


def days(n: float) -> Offset:
    return Offset(us=round(n * MICROS_PER_DAY))


def hours(n: float) -> Offset:
    return Offset(us=round(n * 3600 * MICROS_PER_SECOND))


def weeks(n: float) -> Offset:
    return days(7 * n)


def months(n: int) -> Offset:
    return Offset(months=n)


EDGES = ("both", "left", "right", "neither")


@dataclass(frozen=True)
class Span:
    """A window relative to an anchor: [anchor+start, anchor+end] with stated edges.

    ``closed`` says which ends belong to the window. ``whole_last_day`` stretches a closed end to
    the last microsecond of its day, for rules of the form "up to and including day N".
    A missing end is unbounded.
    """

    start: Offset | None
    end: Offset | None
    closed: str
    whole_last_day: bool = False

    def __post_init__(self):
        if self.closed not in EDGES:
            raise ValueError(f"closed must be one of {EDGES}")

    def contains(self, time, anchor) -> Column:
        at = instant(time)
        inside = at.isNotNull()
        if self.start is not None:
            low = self.start.after(anchor)
            inside = inside & ((at >= low) if self.closed in ("both", "left") else (at > low))
        if self.end is not None:
            high = self.end.after(anchor)
            if self.whole_last_day:
                next_day = (F.date_add(F.to_date(high), 1)).cast("timestamp_ntz")
                inside = inside & (at < next_day)
            else:
                inside = inside & ((at <= high) if self.closed in ("both", "right") else (at < high))
        return inside


def day_window(first: int, last: int) -> Span:
    """Calendar days ``first`` to ``last`` after the anchor, both whole."""
    return Span(days(first), days(last), "both", whole_last_day=True)
