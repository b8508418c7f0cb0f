"""Calendars, week bounds and civil dates at their edges."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from loanbook import params
from loanbook.functions import dates as dt
from loanbook.params import Calendar
from loanbook.sources import tables as tb
from tests.helpers import ts

SUNDAY, MONDAY = date(2022, 1, 2), date(2022, 1, 3)


def test_calendar_keeps_every_period():
    calendar = Calendar(date(2022, 1, 1), date(2022, 1, 20))
    assert calendar.snapshots == [SUNDAY, date(2022, 1, 9), date(2022, 1, 16)]


@pytest.mark.parametrize(("end", "kept"), [(8, 0), (9, 1), (20, 2)])
def test_skipping_the_opening_period_does_not_look_at_their_number(end, kept):
    calendar = Calendar(SUNDAY, date(2022, 1, end), skip_opening=True)
    assert calendar.snapshots == [date(2022, 1, 9), date(2022, 1, 16)][:kept]


def test_calendar_without_sundays_is_empty():
    assert Calendar(MONDAY, date(2022, 1, 8)).snapshots == []


def test_cutoff_drops_later_snapshots():
    calendar = Calendar(date(2022, 1, 1), date(2022, 1, 31), cutoff=date(2022, 1, 18))
    assert calendar.last == date(2022, 1, 16)


@pytest.mark.parametrize(
    ("today", "credit_last", "cover_last"),
    [
        (date(2023, 1, 22), date(2023, 1, 22), date(2023, 1, 15)),  # a Sunday
        (date(2023, 1, 23), date(2023, 1, 29), date(2023, 1, 22)),  # a Monday
        (date(2022, 12, 31), date(2023, 1, 1), date(2022, 12, 25)),
    ],
)
def test_report_calendars(today, credit_last, cover_last):
    assert params.credit_calendar(today).last == credit_last
    assert params.cover_calendar(today).last == cover_last
    assert params.credit_calendar(today).first == date(2022, 4, 3)
    assert params.cover_calendar(today).first == date(2021, 8, 1)
    assert params.credit_calendar(today, skip_opening=True).first == date(2022, 4, 10)


def test_month_end():
    assert params.month_end_of(date(2024, 2, 10)) == date(2024, 2, 29)
    assert params.month_end_of(date(2023, 12, 31)) == date(2023, 12, 31)


def test_week_bounds_over_a_year_end(spark):
    days = [date(2021, 12, 25) + timedelta(days=i) for i in range(16)]
    frame = spark.createDataFrame([(d,) for d in days], "d date")
    d = F.col("d")
    found = frame.select(
        d,
        dt.week_end(d),
        dt.sunday_before(d),
        *[dt.next_weekday(d, n) for n in range(-1, 7)],
    ).collect()
    for row in found:
        day = row[0]
        assert row[1] == params.week_end_of(day)
        assert row[2] == params.sunday_before(day)
        for n in range(-1, 7):
            ahead = n - day.weekday()
            assert row[n + 4] == day + timedelta(days=ahead if ahead > 0 else ahead + 7)


def test_both_ways_to_civil_time_agree(spark):
    """Every half hour around the clock changes of two years."""
    frame = spark.sql(
        """select explode(sequence(timestamp_ntz'2021-03-13 00:00:00',
                                   timestamp_ntz'2022-11-08 00:00:00', interval 30 minutes)) as t"""
    )
    fast = dt.civil(F.col("t"), "America/Denver")
    exact = F.convert_timezone(F.lit("UTC"), F.lit("America/Denver"), F.col("t"))
    assert frame.where(~fast.eqNullSafe(exact)).count() == 0


def test_civil_date_differs_from_utc_date(spark):
    frame = spark.createDataFrame(
        [(ts("2022-01-01 06:59:59"),), (ts("2022-01-01 07:00:00"),), (ts("2022-07-01 05:59:59"),)],
        "t timestamp_ntz",
    )
    days = [r[0] for r in frame.select(dt.civil_date(F.col("t"), "America/Denver")).collect()]
    assert days == [date(2021, 12, 31), date(2022, 1, 1), date(2022, 6, 30)]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_session_zone_does_not_matter(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    instants = spark.sql("select timestamp_seconds(1641020400 + id * 3600) as t from range(5)")
    stored = spark.sql("select timestamp_ntz'2022-01-01 07:00:00' + id * interval 1 hour as t from range(5)")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        schema = tb._schema(t=tb._TIME)
        for source in (instants, stored):
            civil = dt.civil(F.col("t"), "America/Denver")
            found = tb.conform(source, schema).select(civil.cast("string")).collect()
            assert [r[0] for r in found] == [f"2022-01-01 0{h}:00:00" for h in range(5)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
