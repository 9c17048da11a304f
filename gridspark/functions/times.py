"""Durations, bins, calendars and encodings of time stamps."""

from __future__ import annotations

import datetime
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days before each month of a 365-day year, and the bin of Feb 29 (that of Feb 28).
DAYS_BEFORE_MONTH = [0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334]
FEB_29_BIN = 58

# Seconds of the units a duration may be written in.
_UNIT_SECONDS = {"d": 86400, "day": 86400, "days": 86400, "h": 3600, "hour": 3600, "hours": 3600,
                 "min": 60, "minute": 60, "minutes": 60, "s": 1, "second": 1, "seconds": 1}

# Calendar frequencies and the unit ``date_trunc`` gives their bins.
_CALENDAR_UNITS = {"MS": "month", "QS": "quarter", "YS": "year", "W": "week"}


def seconds(duration: str | int | datetime.timedelta) -> int:
    """A duration ("1D", "-1h", "90min", a timedelta) in whole seconds."""
    if isinstance(duration, datetime.timedelta):
        return int(duration.total_seconds())
    if isinstance(duration, int):
        return duration
    match = re.fullmatch(r"\s*([+-]?\d*)\s*([A-Za-z]+)\s*", duration)
    if match is None or match.group(2).lower() not in _UNIT_SECONDS:
        raise ValueError(f"{duration!r} is not a fixed duration")
    digits = match.group(1)
    count = int(digits) if digits not in ("", "+", "-") else int(f"{digits}1")
    return count * _UNIT_SECONDS[match.group(2).lower()]


def calendar_unit(frequency: str) -> str | None:
    """The truncation unit of a calendar frequency ("1MS"), or None for fixed durations."""
    match = re.fullmatch(r"1?(MS|QS|YS|W)", frequency) if isinstance(frequency, str) else None
    return _CALENDAR_UNITS[match.group(1)] if match else None


# Months and weekdays as frequencies name them, in order.
_MONTHS = "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC".split()
_WEEKDAYS = "MON TUE WED THU FRI SAT SUN".split()
_FIRST_MONDAY = 4  # days since 1970-01-01


@dataclass(frozen=True)
class Calendar:
    """Bins of ``count`` weeks, months, quarters or years, as numbers of units since 1970.

    A unit is ``size`` months from month ``anchor`` (0 is January 1970) on, or 7 days from day ``anchor`` on. Frequencies of ends
    (ME, QE, YE, W) are named by their last day and closed on the right, those of starts (MS, QS, YS) by their first
    day and closed on the left.
    """

    size: int
    anchor: int
    count: int
    ends: bool

    @classmethod
    def of(cls, frequency: str) -> Calendar | None:
        """``3MS``, ``QE``, ``QS-FEB``, ``YE-JUN``, ``2W-MON``; None for fixed durations."""
        if not isinstance(frequency, str):
            return None
        match = re.fullmatch(r"(\d*)([MQY])([SE])(?:-([A-Z]{3}))?|(\d*)W(?:-([A-Z]{3}))?", frequency)
        if match is None:
            return None
        count, unit, side, month, weeks, day = match.groups()
        times = int(count or weeks or 1)
        if times < 1 or (unit == "M" and month) or month not in (None, *_MONTHS) or day not in (None, *_WEEKDAYS):
            raise ValueError(f"{frequency!r} is not a frequency")
        if unit is None:
            return cls(7, _FIRST_MONDAY + (_WEEKDAYS.index(day or "SUN") + 1) % 7, times, True)
        size, ends = {"M": 1, "Q": 3, "Y": 12}[unit], side == "E"
        first = _MONTHS.index(month or ("DEC" if ends else "JAN")) + ends
        return cls(size, first % size, times, ends)

    @property
    def weekly(self) -> bool:
        return self.size == 7

    def unit_of(self, time: Column) -> Column:
        """The number of the unit that holds ``time``."""
        if self.weekly:
            at = F.unix_date(F.to_date(time))
        else:
            at = (F.year(time) - 1970) * 12 + F.month(time) - 1
        return F.floor((at - F.lit(self.anchor)) / F.lit(self.size)).cast("int")

    def start_of(self, unit: Column) -> Column:
        """The midnight a unit starts at."""
        at = unit * self.size + self.anchor
        if self.weekly:
            return F.date_from_unix_date(at.cast("int")).cast("timestamp")
        return F.add_months(F.lit("1970-01-01").cast("date"), at.cast("int")).cast("timestamp")

    def bin_of(self, unit: Column, first: Column | None, last_closes: bool) -> Column:
        """The first unit of the bin that holds ``unit``. Bins of several units are counted from the unit of the first stamp,
        which begins a bin, or ends one (``last_closes``)."""
        if self.count == 1:
            return unit
        lead = self.count - 1 if last_closes else 0
        return first - lead + F.floor((unit - first + lead) / self.count).cast("int") * self.count


def stamp(value: str | datetime.datetime) -> Column:
    """A UTC instant literal; offsets other than UTC's are refused."""
    parsed = datetime.datetime.fromisoformat(value) if isinstance(value, str) else value
    if parsed.tzinfo is not None:
        if parsed.utcoffset() != datetime.timedelta(0):
            raise ValueError(f"{value}: give UTC stamps")
        parsed = parsed.replace(tzinfo=None)
    return F.lit(parsed.isoformat(sep=" ")).cast("timestamp")


def plus(time: Column, by: Column | int) -> Column:
    """``time`` moved by whole seconds."""
    moved = by if isinstance(by, Column) else F.lit(by)
    return F.timestamp_seconds(F.unix_seconds(time) + moved)


def floor_to(time: Column, origin: Column, step: int) -> Column:
    """The start of the right-open interval of ``step`` seconds from ``origin`` holding ``time``."""
    since = F.unix_micros(time) - F.unix_micros(origin)
    return F.timestamp_micros(F.unix_micros(time) - F.pmod(since, F.lit(step * 1_000_000)))


def day_of_year_bin(time: Column) -> Column:
    """The 0-based day of a 365-day year; Feb 29 shares Feb 28's bin."""
    before = F.element_at(F.array(*map(F.lit, DAYS_BEFORE_MONTH)), F.month(time))
    leap_day = (F.month(time) == 2) & (F.dayofmonth(time) == 29)
    return F.when(leap_day, F.lit(FEB_29_BIN)).otherwise(before + F.dayofmonth(time) - 1).cast("int")


def encode_time(time: Column, units: str, strict: bool = True) -> Column:
    """Stamps as whole numbers of CF ``units`` ("days since 2020-01-01"); a stamp that is not a whole
    number of them raises (or gives NULL if not ``strict``)."""
    match = re.fullmatch(r"\s*(\w+) since (.+?)\s*", units)
    if match is None:
        raise ValueError(f"{units!r} is not of the form '<unit> since <date>'")
    unit = seconds(f"1{match.group(1).lower()}")
    since = F.unix_micros(time) - F.unix_micros(stamp(match.group(2)))
    scale = unit * 1_000_000
    whole = (since / F.lit(scale)).cast("bigint")
    exact = (since % F.lit(scale)) == 0
    refused = F.raise_error(
        F.concat(F.lit("a stamp is not a whole number of '"), F.lit(units), F.lit("': "), time.cast("string"))
    ).cast("bigint") if strict else F.lit(None).cast("bigint")
    return F.when(time.isNull() | exact, whole).otherwise(refused)


def decode_time(number: Column, units: str) -> Column:
    """The stamps ``encode_time`` wrote."""
    unit, since = re.fullmatch(r"\s*(\w+) since (.+?)\s*", units).groups()
    return plus(stamp(since), number * seconds(f"1{unit.lower()}"))


def iso_duration(step: Column) -> Column:
    """An ISO 8601 duration of whole seconds: P1D, PT3H, PT90S."""
    return (
        F.when(step % 86400 == 0, F.concat(F.lit("P"), (step / 86400).cast("bigint"), F.lit("D")))
        .when(step % 3600 == 0, F.concat(F.lit("PT"), (step / 3600).cast("bigint"), F.lit("H")))
        .otherwise(F.concat(F.lit("PT"), step.cast("bigint"), F.lit("S")))
    )
