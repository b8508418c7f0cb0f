"""As-of expansion: states with a validity become one row per snapshot.

A state holds from its week end until the week end of the user's next state, so
it is computed once and repeated for the snapshots in between. Expansion only
multiplies rows in place; whatever needs a shuffle belongs before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanbook.params import Calendar


def expand(states: DataFrame, since: Column, until: Column, calendar: Calendar) -> DataFrame:
    """Add `snapshot`: every snapshot in [since, until]; NULL leaves an end open."""
    bounded = states.withColumns(
        {
            "_from": F.greatest(since, F.lit(calendar.first)),
            "_to": F.least(until, F.lit(calendar.last)),
        }
    ).where(F.col("_from") <= F.col("_to"))
    weeks = F.sequence("_from", "_to", F.expr("interval 7 days"))
    return bounded.withColumn("snapshot", F.explode(weeks)).drop("_from", "_to")


def within(states: DataFrame, since: Column, until: Column, calendar: Calendar) -> DataFrame:
    """The states seen by any snapshot of the calendar."""
    seen = (since <= F.lit(calendar.last)) & (
        until.isNull() | (until >= F.lit(calendar.first))
    )
    return states.where(seen)


def visible_totals(entries: DataFrame, calendar: Calendar) -> DataFrame:
    """Entries a user has by each snapshot, and the day of the last one."""
    in_order = Window.partitionBy("user_reference").orderBy("week_end")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    weeks = (
        entries.groupBy("user_reference", "week_end")
        .agg(F.count("*").alias("entries"), F.max("local_date").alias("last_day"))
        .withColumns(
            {
                "entries": F.sum("entries").over(so_far),
                "until": F.date_sub(F.lead("week_end").over(in_order), 7),
            }
        )
    )
    seen = expand(weeks, F.col("week_end"), F.col("until"), calendar)
    return seen.select("snapshot", "user_reference", "entries", "last_day")


def week_span(days: DataFrame, calendar: Calendar) -> DataFrame:
    """One row per week from the first to the last `week_end` of `days`.

    `reported` marks the weeks of `calendar`.
    """
    ends = days.agg(F.min("week_end").alias("lo"), F.max("week_end").alias("hi"))
    weeks = F.sequence("lo", "hi", F.expr("interval 7 days"))
    return ends.where("lo is not null").select(F.explode(weeks).alias("snapshot")).select(
        "snapshot",
        F.date_sub("snapshot", 7).alias("prev_snap"),
        F.col("snapshot")
        .between(F.lit(calendar.first), F.lit(calendar.last))
        .alias("reported"),
    )
