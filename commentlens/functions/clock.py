"""Column functions on epoch seconds and wall-clock times.

Wall-clock times are ``TIMESTAMP_NTZ``; the session zone should be UTC.
"""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instant(epoch: Column | str) -> Column:
    """Epoch seconds to a timestamp."""
    return F.timestamp_seconds(_col(epoch))


def wall_clock(epoch: Column | str, zone: str = "UTC", offset_hours: int = 0) -> Column:
    """Epoch seconds to the wall clock of ``zone``, then moved by a fixed offset."""
    moved = _col(epoch) + F.lit(3600 * offset_hours) if offset_hours else _col(epoch)
    return F.convert_timezone(None, F.lit(zone), F.timestamp_seconds(moved))


def floor_seconds(epoch: Column | str, step: int = 300) -> Column:
    """Largest multiple of ``step`` seconds not after ``epoch``."""
    e = _col(epoch)
    return e - F.pmod(e, F.lit(step))


def week_start(day: Column | str) -> Column:
    """Monday of the week of a date."""
    d = _col(day).cast("date")
    return F.date_sub(d, F.weekday(d))


def weekday_monday0(ts: Column | str) -> Column:
    return F.weekday(_col(ts))


def weekday_sunday0(ts: Column | str) -> Column:
    return F.dayofweek(_col(ts)) - F.lit(1)


def weekday_label(ts: Column | str) -> Column:
    """Three-letter English day name."""
    return F.date_format(_col(ts), "E")


def time_of_day(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "HH:mm:ss")


def on_reference_day(ts: Column | str, year: int = 2019, month: int = 1, day: int = 1) -> Column:
    """The same clock time on one fixed day, for overlaying days."""
    t = _col(ts)
    return F.make_timestamp_ntz(
        F.lit(year), F.lit(month), F.lit(day), F.hour(t), F.minute(t), F.second(t)
    )


def epoch_of(moment: datetime, zone: str = "UTC") -> int:
    """Epoch seconds of a naive wall-clock moment in ``zone``."""
    return int(moment.replace(tzinfo=ZoneInfo(zone)).timestamp())


def in_month(epoch: Column | str, year: int, month: int, zone: str = "UTC") -> Column:
    """Month filter as a plain range on the stored number, so scans can push it down."""
    following = datetime(year + month // 12, month % 12 + 1, 1)
    return in_range(epoch, epoch_of(datetime(year, month, 1), zone), epoch_of(following, zone))


def in_years(epoch: Column | str, years: list[int], zone: str = "UTC") -> Column:
    """Membership in a set of years as ranges on the stored number."""
    found = F.lit(False)
    for y in sorted(set(years)):
        found = found | in_range(epoch, epoch_of(datetime(y, 1, 1), zone), epoch_of(datetime(y + 1, 1, 1), zone))
    return found


def in_range(epoch: Column | str, start: int, stop: int) -> Column:
    e = _col(epoch)
    return (e >= F.lit(start)) & (e < F.lit(stop))
