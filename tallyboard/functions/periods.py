"""Calendar days, ISO weeks and months in the boards' own time zone."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyboard.schemas import BOARD_KEY_PREFIX, BOARD_ZONE

# Whole seconds whose local date has a four-digit year, with a day to spare at each end.
EARLIEST_SECOND = -62135510400
LATEST_SECOND = 253402214400


def whole_seconds(ts_epoch: Column) -> Column:
    """Epoch seconds truncated toward zero; null where no calendar date exists."""
    seconds = ts_epoch.try_cast("bigint")
    return F.when(seconds.between(EARLIEST_SECOND, LATEST_SECOND), seconds)


def board_day(ts_epoch: Column, zone: str = BOARD_ZONE) -> Column:
    instant = F.timestamp_seconds(whole_seconds(ts_epoch))
    return F.to_date(F.from_utc_timestamp(instant, zone))


def day_period(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def week_period(day: Column) -> Column:
    """ISO week-year and week, neither padded."""
    year = F.extract(F.lit("YEAROFWEEK"), day)
    return F.concat(year.cast("string"), F.lit("-W"), F.weekofyear(day).cast("string"))


def month_period(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("-M"), F.month(day).cast("string"))


def board_key(board: Column, period: Column) -> Column:
    return F.concat(F.lit(f"{BOARD_KEY_PREFIX}:"), board, F.lit(":"), period)


def period_days(kind: str, period: str) -> tuple[dt.date, dt.date]:
    """First and last day of a ``day``, ``week`` or ``month`` written as above."""
    if kind == "day":
        day = dt.date.fromisoformat(period)
        return day, day
    year, _, number = period.replace("W", "").replace("M", "").partition("-")
    if kind == "week":
        return dt.date.fromisocalendar(int(year), int(number), 1), dt.date.fromisocalendar(int(year), int(number), 7)
    if kind == "month":
        days = calendar.monthrange(int(year), int(number))[1]
        return dt.date(int(year), int(number), 1), dt.date(int(year), int(number), days)
    raise ValueError(f"no such kind of period: {kind}")
