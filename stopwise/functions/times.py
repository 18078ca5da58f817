"""Times of day as whole seconds since the start of the service day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stopwise.config import DAY_S, TIME_ZONE, WEEKDAYS


def parse_clock(text: Column) -> Column:
    """``HH:MM:SS`` text, hours possibly past 24, as seconds; null if malformed."""

    def seconds(parts: Column) -> Column:
        hours, minutes, rest = (F.get(parts, F.lit(i)).try_cast("int") for i in range(3))
        return hours * 3600 + minutes * 60 + rest

    # The one-element array has the text split once.
    return F.get(F.transform(F.array(F.split(text, ":")), seconds), F.lit(0))


def format_clock(seconds: Column) -> Column:
    """Seconds as ``HH:MM:SS`` text, null for null."""
    text = F.format_string(
        "%02d:%02d:%02d",
        F.floor(seconds / 3600),
        F.floor(F.pmod(seconds, F.lit(3600)) / 60),
        F.pmod(seconds, F.lit(60)),
    )
    return F.when(seconds.isNotNull(), text)


def day_shift(seconds: Column) -> Column:
    """Number of whole days a service-day time runs past midnight."""
    return F.floor(seconds / DAY_S).cast("int")


def wrap_clock(seconds: Column) -> Column:
    """Service-day time as a time of day."""
    return F.pmod(seconds, F.lit(DAY_S))


def clock_hour(seconds: Column) -> Column:
    return F.floor(seconds / 3600).cast("int")


def rotate_weekdays(flags: Sequence[Column], shift: Column) -> list[Column]:
    """Weekday flags moved forward by ``shift`` days; null for shifts of a week or more."""
    week = F.array(*flags)
    days = len(flags)
    return [
        F.when(shift.between(0, days - 1), F.get(week, F.pmod(F.lit(i) - shift, F.lit(days))))
        for i in range(days)
    ]


def _within_day(seconds: Column, strict: bool) -> Column:
    inside = seconds.between(0, DAY_S - 1)
    if strict:
        error = F.raise_error(F.lit("time of day wraps around midnight")).cast("int")
        return F.when(inside | seconds.isNull(), seconds).otherwise(error)
    return F.when(inside, seconds)


def add_seconds(clock: Column, seconds: Column, strict: bool = False) -> Column:
    """Later time of the same day; null (or an error when strict) past midnight."""
    return _within_day(clock + seconds, strict)


def subtract_seconds(clock: Column, seconds: Column, strict: bool = False) -> Column:
    """Earlier time of the same day; null (or an error when strict) before midnight."""
    return _within_day(clock - seconds, strict)


def seconds_between(later: Column, earlier: Column) -> Column:
    return later - earlier


def clock_of(timestamp: Column) -> Column:
    """Time of day of a timestamp, in seconds."""
    return F.hour(timestamp) * 3600 + F.minute(timestamp) * 60 + F.second(timestamp).cast("int")


def local_time(epoch_s: Column, zone: str = TIME_ZONE) -> Column:
    """Epoch seconds as wall-clock time of ``zone``, whatever the session time zone."""
    utc = F.timestamp_add("SECOND", epoch_s.cast("long"), F.expr("timestamp_ntz'1970-01-01 00:00:00'"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def parse_local(text: Column, zone: str = TIME_ZONE) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` wall-clock text of ``zone`` as UTC wall-clock time."""
    wall = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)


def weekday_name(day: Column) -> Column:
    return F.get(F.array(*[F.lit(d) for d in WEEKDAYS]), F.weekday(day))


def is_weekday(day: Column) -> Column:
    """True from Monday to Friday."""
    return F.dayofweek(day).isin(2, 3, 4, 5, 6)


def duration_text(seconds: Column) -> Column:
    """``"1h 5m"`` or ``"5m"``, rounded down to the minute."""
    hours = F.floor(seconds / 3600)
    minutes = F.floor(F.pmod(seconds, F.lit(3600)) / 60)
    return F.when(hours > 0, F.format_string("%dh %dm", hours, minutes)).when(
        seconds.isNotNull(), F.format_string("%dm", minutes)
    )
