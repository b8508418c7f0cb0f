"""Every operator as a query over a test folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.functions import classify as cl
from loanbook.functions import dates as dt
from loanbook.functions.money import emit
from loanbook.operators import asof, ledger as lg
from loanbook.params import ZONE, Calendar
from loanbook.plans.cover import CoverBook
from loanbook.plans.credit import CreditBook
from loanbook.session import scratch_folder
from loanbook.sources import sinks
from loanbook.sources.fixtures import CALENDAR, COVER_RULES, CREDIT_RULES, CUTOFF, fixture_tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def credit_book(spark: SparkSession, sf_dir: str, calendar=CALENDAR) -> CreditBook:
    return CreditBook(fixture_tables(spark, sf_dir), calendar, CREDIT_RULES)


def cover_book(spark: SparkSession, sf_dir: str, calendar=CALENDAR) -> CoverBook:
    return CoverBook(fixture_tables(spark, sf_dir), calendar, COVER_RULES)


def money(*names: str, **renamed: str) -> list[Column]:
    same = [emit(F.col(name)).alias(name) for name in names]
    return same + [emit(F.col(source)).alias(name) for name, source in renamed.items()]


def flag(condition: Column) -> Column:
    return F.coalesce(condition.cast("int"), F.lit(0))


# --- sources, projections, filters, dates --------------------------------


@query
def account_map(spark, sf_dir):
    return lg.account_map(fixture_tables(spark, sf_dir).accounts)


@query
def ledger_normalize(spark, sf_dir):
    tables = fixture_tables(spark, sf_dir)
    shared = ["user_reference", "UserAccount", "TransactionID", "PaymentCode"]
    credit = lg.credit_entries(tables.ledger, CREDIT_RULES, ZONE).withColumn("entry", F.col("TR_Desc"))
    cover = lg.cover_entries(tables.ledger, COVER_RULES, ZONE).withColumn("entry", F.col("TType"))

    def side(book: str, entries: DataFrame) -> DataFrame:
        return lg.with_users(entries, tables.accounts).select(
            F.lit(book).alias("book"), *shared, "local_date", "week_end", "entry",
            *money(amount="Amount"),
        )

    return side("credit", credit).unionByName(side("cover", cover))


@query
def ledger_filter(spark, sf_dir):
    code = F.col("PaymentCode")
    activity, cover = code.isin(*CREDIT_RULES.activity_codes), code.isin(*COVER_RULES.codes)
    return fixture_tables(spark, sf_dir).ledger.where(activity | cover).select(
        "TransactionID",
        code,
        flag(activity).alias("is_activity"),
        flag(code == CREDIT_RULES.borrow_code).alias("is_borrow"),
        flag(code == CREDIT_RULES.repay_code).alias("is_repay"),
        flag(cover).alias("is_cover"),
        flag(code == COVER_RULES.fee_code).alias("is_fee"),
        flag(code == COVER_RULES.loan_code).alias("is_loan"),
    )


@query
def local_dates(spark, sf_dir):
    posted = F.col("PostedAt")
    return fixture_tables(spark, sf_dir).ledger.select(
        "TransactionID",
        posted,
        dt.civil(posted, ZONE).alias("local_time"),
        dt.civil_date(posted, ZONE).alias("local_date"),
    )


@query
def week_bounds(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    day = F.col("day")
    return orders.select(F.to_date("o_orderdate").alias("day")).distinct().select(
        day,
        dt.week_end(day).alias("week_end"),
        dt.week_before(day).alias("prev_snap"),
        dt.month_end(day).alias("month_end"),
        dt.next_weekday(day, -1).alias("coming_sunday"),
        dt.next_weekday(day, 0).alias("next_monday"),
        dt.next_weekday(day, 3).alias("next_thursday"),
        dt.sunday_before(day).alias("sunday_before"),
    )


@query
def snapshot_calendar(spark, sf_dir):
    posted = F.col("PostedAt")
    days = fixture_tables(spark, sf_dir).ledger.select(
        dt.week_end(dt.civil_date(posted, ZONE)).alias("week_end")
    )
    spans = asof.week_span(days, CALENDAR)
    return spans.withColumn("reported", flag(F.col("reported")))


@query
def asof_expand(spark, sf_dir):
    return asof.visible_totals(cover_book(spark, sf_dir).entries(), CALENDAR)


# --- credit-building book ------------------------------------------------


@query
def repay_after_first_loan(spark, sf_dir):
    shared = ["user_reference", "UserAccount", "TransactionID"]
    first = F.to_date("first_loan_date").alias("first_loan_date")
    credit = credit_book(spark, sf_dir).entries().where(~lg.is_borrow())
    cover = cover_book(spark, sf_dir).since_first_loan().where(lg.is_type(lg.REPAYMENT))

    def side(book: str, entries: DataFrame) -> DataFrame:
        return entries.select(F.lit(book).alias("book"), *shared, first, *money(amount="Amount"))

    return side("credit", credit).unionByName(side("cover", cover))


@query
def running_balance(spark, sf_dir):
    return credit_book(spark, sf_dir).running_balance().select(
        "user_reference", "UserAccount", "TransactionID", "PostedAt", "TR_Desc",
        *money("OS", amount="Amount"),
    )


@query
def next_withdrawal(spark, sf_dir):
    return credit_book(spark, sf_dir).withdrawals().select(
        "user_reference", "UserAccount", "TransactionID", "PostedAt",
        *money(amount="Amount"), "next_withdrawal_date",
    )


@query
def withdrawal_repayments(spark, sf_dir):
    return credit_book(spark, sf_dir).withdrawal_repayments().select(
        "user_reference", "TransactionID", "PostedAt", "next_withdrawal_date",
        "RepaymentDate", *money("RepaymentAmount"),
    )


@query
def last_withdrawal_group(spark, sf_dir):
    states = credit_book(spark, sf_dir).state_snapshots()
    return states.where("PrevWithdrawDate is not null").select(
        "snapshot", "user_reference", "PrevWithdrawDate", "RepaymentDate",
        *money("RepaymentAmount"),
    )


@query
def cb_weekly_flows(spark, sf_dir):
    return credit_book(spark, sf_dir).weekly_flows().select(
        "user_reference", "week_end", *money("withdrawals", "repayments")
    )


_CB_STATE = ["snapshot", "user_reference", "last_TR", "Last_TR_Desc", "PrevWithdrawDate"]
_CB_MONEY = ["OS", "in_month_withdrawals", "in_month_repayments", "RepaymentAmount", "prev_OS"]


@query
def cb_states(spark, sf_dir):
    return credit_book(spark, sf_dir).state_snapshots().select(*_CB_STATE, *money(*_CB_MONEY))


@query
def cb_due_date(spark, sf_dir):
    return credit_book(spark, sf_dir).state_snapshots().select(
        "snapshot", "user_reference", "last_TR", "PrevWithdrawDate",
        *money("RepaymentAmount", "prev_OS"), "due_at",
    )


@query
def dpd_bucket(spark, sf_dir):
    due, snapshot = F.to_date("due_at"), F.col("snapshot")
    credit = credit_book(spark, sf_dir).state_snapshots().withColumns(
        {"due_date": due, "snapshot_status": cl.credit_bucket(F.col("OS"), due, snapshot)}
    )
    cover = cover_book(spark, sf_dir).state_snapshots()

    def side(book: str, states: DataFrame) -> DataFrame:
        return states.select(
            F.lit(book).alias("book"), "snapshot", "user_reference", *money("OS"),
            "due_date", F.datediff("snapshot", "due_date").alias("days_past_due"),
            "snapshot_status",
        )

    return side("credit", credit).unionByName(side("cover", cover))


@query
def cb_accounts(spark, sf_dir):
    return credit_book(spark, sf_dir).accounts()


@query
def cb_stale_filter(spark, sf_dir):
    return credit_book(spark, sf_dir).live_snapshots().select(
        "snapshot", "user_reference", "account_identifier", "status", "updated_at"
    )


@query
def cohorts(spark, sf_dir):
    opened, none = F.to_date("open_date"), F.lit(None).cast("date")
    credit = credit_book(spark, sf_dir).facilities().select(
        F.lit("credit").alias("book"),
        F.col("account_identifier").alias("subject"),
        dt.week_end(opened).alias("cohort_end"),
        dt.month_end(opened).alias("cohort_end_month"),
        none.alias("cohort_paid"),
    )
    cover = cover_book(spark, sf_dir).states().where("next_week is null").select(
        F.lit("cover").alias("book"),
        F.col("user_reference").alias("subject"),
        dt.week_end(F.col("last_loan_date")).alias("cohort_end"),
        none.alias("cohort_end_month"),
        dt.week_end(F.col("last_payment_date")).alias("cohort_paid"),
    )
    return credit.unionByName(cover)


@query
def ever_accessed(spark, sf_dir):
    return credit_book(spark, sf_dir).holders().select(
        "user_reference", "account_identifier", "ever_accessed"
    )


@query
def cb_report(spark, sf_dir):
    return credit_book(spark, sf_dir).report()


@query
def cb_roll(spark, sf_dir):
    return credit_book(spark, sf_dir).roll()


@query
def cb_roll_legacy(spark, sf_dir):
    return credit_book(spark, sf_dir).roll(legacy_overwrite=True)


# --- cover book ----------------------------------------------------------


@query
def cover_last_dates(spark, sf_dir):
    return cover_book(spark, sf_dir).state_snapshots().select(
        "snapshot", "user_reference", "last_loan_date", "last_fee_date", "last_payment_date"
    )


@query
def cover_weekly_flows(spark, sf_dir):
    return cover_book(spark, sf_dir).weekly_flows().select(
        "user_reference", "week_end", "num_loans_in_week", "num_repayments_in_week",
        *money("total_loaned_in_week", "total_repaid_in_week"),
    )


@query
def cover_fee_counts(spark, sf_dir):
    return cover_book(spark, sf_dir).state_snapshots().select(
        "snapshot",
        "user_reference",
        "num_fee_payments",
        F.col("num_expected_fee_payments").cast("double").alias("num_expected_fee_payments"),
    )


@query
def cover_states(spark, sf_dir):
    return cover_book(spark, sf_dir).state_snapshots().select(
        "snapshot", "user_reference", "last_loan_date", "last_fee_date", "last_payment_date",
        "num_fee_payments", "num_loans_in_week", "num_repayments_in_week",
        *money("OS", "total_loaned_in_week", "total_repaid_in_week"),
    )


@query
def cover_due_date(spark, sf_dir):
    return cover_book(spark, sf_dir).state_snapshots().select(
        "snapshot", "user_reference", "orig_due_date", "due_date", "update_date"
    )


@query
def cover_flags(spark, sf_dir):
    book = cover_book(spark, sf_dir)
    users = lg.account_map(book.tables.accounts).select("user_reference").distinct()
    return users.join(book.flags(), "user_reference", "left").select(
        "user_reference",
        F.coalesce("grad_flag", F.lit(0)).alias("grad_flag"),
        F.coalesce("migration_flag", F.lit(0)).alias("migration_flag"),
    )


@query
def cover_prev_status(spark, sf_dir):
    return cover_book(spark, sf_dir).state_snapshots().select(
        "snapshot", "user_reference", "prev_snap", "snapshot_status", "prev_status"
    )


@query
def cover_paid_class(spark, sf_dir):
    late = F.datediff("update_date", "due_date").alias("days_between_paid_and_due")
    return cover_book(spark, sf_dir).rolled().select(
        "snapshot", "user_reference", late, "paid_class"
    )


@query
def cover_roll(spark, sf_dir):
    return cover_book(spark, sf_dir).rolled().select(
        "snapshot", "user_reference", "new_loan", "new_default", "paid_in_cohort"
    )


@query
def cover_report(spark, sf_dir):
    return cover_book(spark, sf_dir).report()


# --- counts and sinks ----------------------------------------------------


@query
def status_counts(spark, sf_dir):
    def side(book: str, counts: DataFrame) -> DataFrame:
        return counts.select(F.lit(book).alias("book"), "value", "n")

    credit = side("credit", credit_book(spark, sf_dir).access_counts())
    return credit.unionByName(side("cover", cover_book(spark, sf_dir).status_counts()))


@query
def sink_overwrite(spark, sf_dir):
    """Write a first table, replace it by the cover report, read that back."""
    book, path = cover_book(spark, sf_dir), scratch_folder(spark, "cover")
    sinks.write_parquet(lg.account_map(book.tables.accounts), path)
    report = book.report()
    sinks.write_parquet(report, path, by_snapshot=True)
    return spark.read.schema(report.schema).parquet(path).select(report.columns)


@query
def sink_csv(spark, sf_dir):
    """The accessed accounts of the credit book, numbered in reading order."""
    path = scratch_folder(spark, "accessed")
    accessed = credit_book(spark, sf_dir).report().where("ever_accessed = 'Yes'")
    order = (*sinks.REPORT_ORDER, "account_identifier")
    sinks.write_csv(accessed, path, "row", order, compression="gzip")
    schema = "row bigint, " + ", ".join(f"`{n}` {t}" for n, t in accessed.dtypes)
    return sinks.read_csv(spark, path, schema)


@query
def sink_csv_plain(spark, sf_dir):
    """The cover flags through a CSV without a place column."""
    path = scratch_folder(spark, "flags")
    flags = cover_flags(spark, sf_dir)
    sinks.write_csv(flags, path)
    return sinks.read_csv(spark, path, flags.schema)


# --- cut-off and faulty rows ---------------------------------------------


@query
def calendar_cutoff(spark, sf_dir):
    """The cover book of a calendar that is cut off in the middle of a week."""
    cut = Calendar(CALENDAR.start, CALENDAR.end, cutoff=CUTOFF)
    return cover_book(spark, sf_dir, cut).state_snapshots().select(
        "snapshot", "user_reference", "last_loan_date", "num_fee_payments"
    )


def spoiled_ledger(spark, sf_dir):
    """The ledger with amounts that are no numbers, and fees that are there twice."""
    ledger, amount = fixture_tables(spark, sf_dir).ledger, F.col("Amount")
    minus = F.when(F.col("TransactionID").endswith("7"), F.concat(F.lit("-"), amount))
    spoiled = ledger.withColumn("Amount", F.coalesce(minus, amount))
    return spoiled.unionByName(spoiled.where(F.col("PaymentCode") == COVER_RULES.fee_code))


@query
def amount_rejects(spark, sf_dir):
    return lg.unreadable_amounts(spoiled_ledger(spark, sf_dir)).select("TransactionID", "Amount")


@query
def repeated_ids(spark, sf_dir):
    return lg.repeated_transactions(spoiled_ledger(spark, sf_dir))
