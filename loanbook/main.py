"""Compute a book's weekly report and replace its target.

    spark-submit loanbook/main.py cover --inputs /data/loans --parquet /reports/cover
    spark-submit loanbook/main.py credit --table ledger=raw.ledger ... --save-as credit_weekly
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from loanbook.params import COVER_START, CREDIT_START, ZONE, Calendar, cover_calendar, credit_calendar
from loanbook.operators.ledger import unreadable_amounts
from loanbook.plans.cover import CoverBook
from loanbook.plans.credit import CreditBook
from loanbook.session import build_session
from loanbook.sources import sinks
from loanbook.sources.tables import SCHEMAS, Tables, catalog_tables, read_tables

# What a row of each report is about.
GRAIN = {
    "cover": ("snapshot", "user_reference"),
    "credit": ("snapshot", "user_reference", "account_identifier"),
}


def build_report(
    tables: Tables,
    book: str,
    calendar: Calendar,
    zone: str = ZONE,
    legacy_overwrite: bool = False,
    strict: bool = True,
) -> DataFrame:
    if book == "credit":
        return CreditBook(tables, calendar, zone=zone, strict=strict).roll(legacy_overwrite)
    return CoverBook(tables, calendar, zone=zone, strict=strict).report()


def chosen_calendar(chosen: argparse.Namespace) -> Calendar:
    """The book's own weeks, or those from `--start` to `--end`."""
    usual, start = (credit_calendar, CREDIT_START) if chosen.book == "credit" else (cover_calendar, COVER_START)
    start = chosen.start or start
    if chosen.end:
        return Calendar(start, chosen.end, chosen.skip_opening)
    return usual(chosen.today, start, chosen.skip_opening)


def options(arguments: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Weekly loan-book report")
    parser.add_argument("book", choices=["credit", "cover"])
    parser.add_argument("--today", type=date.fromisoformat, default=date.today())
    parser.add_argument("--start", type=date.fromisoformat, help="first day of the first week")
    parser.add_argument("--end", type=date.fromisoformat, help="last day; default: by --today")
    parser.add_argument("--zone", default=ZONE, help="zone in which days are read")
    parser.add_argument("--skip-opening", action="store_true", help="leave out the first week")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--inputs", help="folder with a parquet folder per input table")
    source.add_argument(
        "--table", action="append", metavar="NAME=TABLE", help=f"one of {', '.join(SCHEMAS)}"
    )
    parser.add_argument("--lenient", action="store_true", help="go on over amounts that are no numbers")
    parser.add_argument("--rejects", help="parquet folder for ledger rows with such amounts")
    parser.add_argument(
        "--check", action="store_true", help="publish only if no row of the report is there twice"
    )
    parser.add_argument("--parquet", help="parquet folder to replace")
    parser.add_argument("--sorted", action="store_true", help="parquet rows by user and snapshot")
    parser.add_argument("--by-snapshot", action="store_true", help="a parquet folder per snapshot")
    parser.add_argument("--save-as", help="catalog table to replace")
    parser.add_argument("--csv", help="CSV folder to replace, sorted by user and snapshot")
    parser.add_argument(
        "--legacy-overwrite",
        action="store_true",
        help="credit: constant previous status and new-loan flag for accessed accounts",
    )
    chosen = parser.parse_args(arguments)
    if not (chosen.parquet or chosen.save_as or chosen.csv):
        parser.error("name at least one target: --parquet, --save-as or --csv")
    if chosen.sorted and chosen.by_snapshot:
        parser.error("--sorted sorts the folder as a whole, --by-snapshot each snapshot")
    return chosen


def run(spark: SparkSession, arguments: Sequence[str] | None = None) -> None:
    chosen = options(arguments)
    if chosen.inputs:
        tables = read_tables(spark, chosen.inputs)
    else:
        tables = catalog_tables(spark, dict(pair.split("=", 1) for pair in chosen.table))
    calendar = chosen_calendar(chosen)
    report = build_report(tables, chosen.book, calendar, chosen.zone, chosen.legacy_overwrite, not chosen.lenient)
    if chosen.rejects:
        sinks.write_parquet(unreadable_amounts(tables.ledger), chosen.rejects)
    if chosen.lenient:
        unknown = unreadable_amounts(tables.ledger).count()
        print(f"{unknown} ledger rows with unknown amounts are left out of the sums")

    def audit(staged: DataFrame) -> None:
        if chosen.check:
            sinks.check_grain(staged, GRAIN[chosen.book])

    # The report is computed once; further targets read the first.
    if chosen.parquet:
        sinks.write_parquet(report, chosen.parquet, chosen.by_snapshot, audit, chosen.sorted)
        report = spark.read.schema(report.schema).parquet(chosen.parquet).select(report.columns)
    if chosen.save_as:
        sinks.write_table(report, chosen.save_as, audit)
        report = spark.table(chosen.save_as)
    if chosen.csv:
        sinks.write_csv(sinks.in_order(report), chosen.csv, audit=audit)


if __name__ == "__main__":
    run(build_session("loanbook"))
