"""Time: an explicit as-of date turned into bounds and period flags.

Stored instants are UTC without a zone (``timestamp_ntz``); reports use a fixed local
offset. Day filters are written as half-open bounds on the *stored* column, because
arithmetic on the column would keep the predicate out of the parquet scan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.vocabulary import OFF_HOUR, OFFICE_HOUR

UTC_OFFSET = dt.timedelta(hours=5, minutes=30)
MIDNIGHT = dt.time(0, 0)


def instant(value: dt.datetime) -> Column:
    """A zone-free timestamp literal; folds to a constant, so it reaches the scan."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def to_local(ts: Column, offset: dt.timedelta = UTC_OFFSET) -> Column:
    return ts + F.lit(offset)


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp, whatever the session zone."""
    seconds = (
        F.unix_date(ts.cast("date")).cast("long") * 86_400
        + F.hour(ts).cast("long") * 3_600
        + F.minute(ts).cast("long") * 60
    )
    return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("long")


def event_time(ts: Column) -> Column:
    """The same clock reading as a UTC instant, which is what a watermark accepts."""
    return F.timestamp_micros(micros(ts))


def clock_time(at: Column) -> Column:
    """Back from ``event_time``, whatever the session zone."""
    zero = F.lit(0)
    seconds = (F.unix_micros(at).cast("decimal(18,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return instant(dt.datetime(1970, 1, 1)) + F.make_dt_interval(zero, zero, zero, seconds)


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, rounded towards the past."""
    return F.floor((micros(end) - micros(start)) / F.lit(1_000_000)).cast("long")


def local_day_bounds(
    first: dt.date, last: dt.date, offset: dt.timedelta = UTC_OFFSET
) -> tuple[dt.datetime, dt.datetime]:
    """Stored-clock bounds ``[lo, hi)`` of the local days first..last inclusive."""
    lo = dt.datetime.combine(first, MIDNIGHT) - offset
    hi = dt.datetime.combine(last + dt.timedelta(days=1), MIDNIGHT) - offset
    return lo, hi


def in_local_days(
    ts: Column, first: dt.date, last: dt.date, offset: dt.timedelta = UTC_OFFSET
) -> Column:
    lo, hi = local_day_bounds(first, last, offset)
    return (ts >= instant(lo)) & (ts < instant(hi))


def in_previous_local_day(
    ts: Column, as_of: dt.date, offset: dt.timedelta = UTC_OFFSET
) -> Column:
    yesterday = as_of - dt.timedelta(days=1)
    return in_local_days(ts, yesterday, yesterday, offset)


def up_to_yesterday(ts: Column, as_of: dt.date, offset: dt.timedelta = UTC_OFFSET) -> Column:
    return ts < instant(dt.datetime.combine(as_of, MIDNIGHT) - offset)


def since_local(
    ts: Column, start: dt.datetime, offset: dt.timedelta = UTC_OFFSET
) -> Column:
    return ts >= instant(start - offset)


def in_time_slot(ts: Column, start: dt.time, minutes: int) -> Column:
    """Time of day inside ``[start, start + minutes]``, on any date; may wrap midnight."""
    lo = start.hour * 3_600 + start.minute * 60 + start.second
    hi = lo + minutes * 60
    second_of_day = (
        F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.date_part(F.lit("SECOND"), ts)
    )
    if hi < 86_400:
        return second_of_day.between(lo, hi)
    return (second_of_day >= lo) | (second_of_day <= hi - 86_400)


@dataclass(frozen=True)
class Periods:
    """Yesterday, month to date and last month, all seen from ``as_of``.

    "This month" is the month of *yesterday*: on the first of a month the report still
    covers the month that has just ended.
    """

    as_of: dt.date

    @property
    def yesterday(self) -> dt.date:
        return self.as_of - dt.timedelta(days=1)

    @property
    def month_start(self) -> dt.date:
        return self.yesterday.replace(day=1)

    @property
    def last_month_end(self) -> dt.date:
        return self.month_start - dt.timedelta(days=1)

    @property
    def last_month_start(self) -> dt.date:
        return self.last_month_end.replace(day=1)

    def covers(self, ts: Column, offset: dt.timedelta = UTC_OFFSET) -> Column:
        """Whole report range on the stored column."""
        return in_local_days(ts, self.last_month_start, self.yesterday, offset)

    def flags(self, local_ts: Column) -> dict[str, Column]:
        """Overlapping period flags of a local timestamp."""
        day = local_ts.cast("date")
        return {
            "yesterday": day == F.lit(self.yesterday),
            "month_to_date": day.between(F.lit(self.month_start), F.lit(self.yesterday)),
            "last_month": day.between(
                F.lit(self.last_month_start), F.lit(self.last_month_end)
            ),
        }


@dataclass(frozen=True)
class Stretch(Periods):
    """The local days ``first`` to yesterday only."""

    first: dt.date

    def covers(self, ts: Column, offset: dt.timedelta = UTC_OFFSET) -> Column:
        return in_local_days(ts, self.first, self.yesterday, offset)


PERIOD_NAMES = ("yesterday", "month_to_date", "last_month")


def year_month_label(ts: Column) -> Column:
    """``2023-4``: the month is not padded."""
    return F.concat_ws("-", F.year(ts).cast("string"), F.month(ts).cast("string"))


def short_time_text(ts: Column) -> Column:
    return F.date_format(ts, "MMM dd, HH:mm:ss")


def parse_time(text: Column) -> Column:
    """Tolerant parse: text that is no timestamp becomes NULL."""
    return text.try_cast("timestamp_ntz")


def office_hours(ts: Column, opening: int = 8, closing: int = 20) -> Column:
    return F.when(F.hour(ts).between(opening, closing), OFFICE_HOUR).otherwise(OFF_HOUR)
