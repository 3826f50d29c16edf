"""Date helpers.

The reference turns a calendar date into the instant of midnight in
Europe/London. Comparing those instants orders exactly like comparing the
dates, so the pipeline compares ``DATE`` columns; these helpers give the
instant where one is wanted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the zone the reference pins every date to.
LONDON = "Europe/London"

# Fixed value: accepted text form of a date, one- or two-digit month and day.
DATE_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instant_from_ymd(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """(year, month, day) -> TIMESTAMP: the instant of London midnight.

    Impossible dates give null (``try_make_timestamp``) instead of failing.
    """
    return F.try_make_timestamp(_col(year), _col(month), _col(day), F.lit(0), F.lit(0), F.lit(0), F.lit(LONDON))


def utc_wall_time(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """London midnight of a date as a UTC wall-clock TIMESTAMP_NTZ.

    Independent of the session time zone: 2020-04-01 gives 2020-03-31 23:00
    (summer time), 2020-01-01 gives 2020-01-01 00:00.
    """
    local = F.try_make_timestamp_ntz(_col(year), _col(month), _col(day), F.lit(0), F.lit(0), F.lit(0))
    return F.convert_timezone(F.lit(LONDON), F.lit("UTC"), local)


def parse_date(text: Column | str) -> Column:
    """``y-m-d`` text -> DATE, null when malformed (one-digit parts accepted)."""
    t = F.trim(_col(text))
    return F.when(t.rlike(DATE_PATTERN), t.try_cast("date"))


def instant_from_string(text: Column | str) -> Column:
    """``y-m-d`` text -> London-midnight instant (D2); malformed text gives null."""
    d = parse_date(text)
    return instant_from_ymd(F.year(d), F.month(d), F.dayofmonth(d))


def utc_wall_time_from_string(text: Column | str) -> Column:
    """``y-m-d`` text -> London midnight as UTC wall-clock TIMESTAMP_NTZ."""
    d = parse_date(text)
    return utc_wall_time(F.year(d), F.month(d), F.dayofmonth(d))


def date_literal(value) -> Column:
    """A cutoff given as ``'2000-1-1'``, ``date`` or Column -> DATE column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        y, m, d = (int(p) for p in value.strip().split("-"))
        return F.make_date(F.lit(y), F.lit(m), F.lit(d))
    return F.lit(value)
