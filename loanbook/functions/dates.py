"""Civil dates and week bounds. Weeks run Monday to Sunday."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_DAY_NAMES = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def utc_session() -> bool:
    """Whether times with and without a zone read alike in the session."""
    session = SparkSession.getActiveSession()
    return session is not None and session.conf.get("spark.sql.session.timeZone") == "UTC"


def civil(ts: Column, zone: str) -> Column:
    """Wall-clock time in `zone` of a UTC `timestamp_ntz`.

    Shifting an instant is many times faster than `convert_timezone`, but reads
    the stored time in the session's zone and so needs that to be UTC.
    """
    if utc_session():
        return F.from_utc_timestamp(ts.cast("timestamp"), zone).cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def civil_date(ts: Column, zone: str) -> Column:
    return F.to_date(civil(ts, zone))


def week_end(day: Column) -> Column:
    """Sunday of the week of `day`; a Sunday is its own week end."""
    return F.date_add(F.trunc(day, "week"), 6)


def week_before(snapshot: Column) -> Column:
    """Week end one week before `snapshot`."""
    return week_end(F.date_sub(snapshot, 7))


def sunday_before(day: Column) -> Column:
    """Last Sunday strictly before `day`."""
    return F.date_sub(F.trunc(day, "week"), 1)


def next_weekday(day: Column, weekday: int) -> Column:
    """First date strictly after `day` on `weekday` (0 is Monday).

    -1 asks for the running week's Sunday, `day` itself included.
    """
    return week_end(day) if weekday == -1 else F.next_day(day, _DAY_NAMES[weekday])


def month_end(day: Column) -> Column:
    return F.last_day(day)


def sundays(first: Column, last: Column) -> Column:
    """Number of Sundays from `first` to `last`, both included; 0 if `last` is before."""
    return F.greatest(F.lit(0), F.ceil((F.datediff(sunday_before(F.date_add(last, 1)), sunday_before(first))) / 7).cast("long"))
