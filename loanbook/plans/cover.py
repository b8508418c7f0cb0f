"""The cover book, built like the credit book on one row per user and day."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanbook.functions import classify as cl
from loanbook.functions.dates import civil_date, sundays, week_end
from loanbook.functions.money import emit, total
from loanbook.operators.asof import expand, within
from loanbook.operators.ledger import (
    FEE,
    LOAN,
    REPAYMENT,
    account_map,
    cover_entries,
    is_type,
    posted_by,
    with_owners,
    with_users,
)
from loanbook.operators.salting import ROWS_PER_SALT
from loanbook.params import ZONE, Calendar, CoverRules
from loanbook.session import written
from loanbook.sources.tables import Tables

USER = "user_reference"

REPORT_COLUMNS = [
    "snapshot", "user_reference", "OS", "last_loan_date", "last_fee_date",
    "last_payment_date", "num_fee_payments", "num_expected_fee_payments",
    "orig_due_date", "due_date", "update_date", "num_loans_in_week",
    "total_loaned_in_week", "num_repayments_in_week", "total_repaid_in_week",
    "prev_snap", "cohort_end", "cohort_paid", "snapshot_status", "grad_flag",
    "migration_flag", "prev_status", "new_loan", "paid_class", "new_default",
    "paid_in_cohort",
]

_FLOWS = (
    "num_loans_in_week", "total_loaned_in_week",
    "num_repayments_in_week", "total_repaid_in_week",
)


@dataclass(frozen=True)
class CoverBook:
    tables: Tables
    calendar: Calendar
    rules: CoverRules = CoverRules()
    zone: str = ZONE
    # Whether an amount that is no number raises, or counts as unknown.
    strict: bool = True
    rows_per_salt: int = ROWS_PER_SALT

    # --- entries ----------------------------------------------------------

    def entries(self, ledger: DataFrame | None = None) -> DataFrame:
        """Entries of known users."""
        source = self.tables.ledger if ledger is None else ledger
        entries = cover_entries(source, self.rules, self.zone, self.strict)
        return with_users(entries, self.tables.accounts, "inner", self.rows_per_salt)

    @cached_property
    def account_facts(self) -> DataFrame:
        """First loan day and number of loans and repayments of each account, from one scan.

        It is read several times, so it is written once per book.
        """
        loans = F.col("PaymentCode") == self.rules.loan_code
        day = civil_date(F.col("PostedAt"), self.zone)
        return written(
            self.tables.ledger.where(F.col("PaymentCode").isin(self.rules.loan_code, self.rules.repay_code))
            .groupBy("UserAccount")
            .agg(F.min(F.when(loans, day)).alias("first_loan_date"), F.count("*").alias("rows"))
            .where(F.col("UserAccount").isNotNull()),
            "cover-accounts",
        )

    def since_first_loan(self) -> DataFrame:
        """Loans and repayments from the day of the user's first loan on."""
        owners = account_map(self.tables.accounts).withColumnRenamed(
            "account_group_identifier", "UserAccount"
        )
        owned = owners.where(F.col(USER).isNotNull())
        first = (
            self.account_facts.where("first_loan_date is not null").join(owned, "UserAccount")
            .groupBy(USER).agg(F.min("first_loan_date").alias("first_loan_date"))
        )
        moves = cover_entries(self.tables.ledger, self.rules, self.zone, self.strict).where(~is_type(FEE))
        counts = self.account_facts.select("UserAccount", "rows")
        return with_owners(moves, owned.join(first, USER), "inner", self.rows_per_salt, counts).where(
            F.col("local_date") >= F.col("first_loan_date")
        )

    def weekly_flows(self) -> DataFrame:
        """Loaned and repaid per user and week; `num_loans_in_week` is a mark."""
        loans, repayments = is_type(LOAN), is_type(REPAYMENT)
        amount = F.col("Amount")
        repaid = F.count(F.when(repayments, 1))
        return (
            self.entries()
            .where(loans | repayments)
            .groupBy(USER, "week_end")
            .agg(
                F.max(F.when(loans, F.lit(1))).alias("num_loans_in_week"),
                F.sum(F.when(loans, amount)).alias("total_loaned_in_week"),
                F.when(repaid > 0, repaid).alias("num_repayments_in_week"),
                F.sum(F.when(repayments, -amount)).alias("total_repaid_in_week"),
            )
        )

    # --- states -----------------------------------------------------------

    def days(self) -> DataFrame:
        """One row per user and day with entries that the calendar can see.

        Entries are added up by account and day before users are joined, so an
        account brings one row a day to the join, however many entries it has.
        """
        amount, day = F.col("Amount"), ["week_end", "local_date"]
        seen = posted_by(self.tables.ledger, self.calendar.last)
        by_account = (
            cover_entries(seen, self.rules, self.zone, self.strict)
            .where(F.col("local_date") <= F.lit(self.calendar.last))
            .groupBy("UserAccount", *day)
            .agg(
                total(F.when(is_type(LOAN), amount)).alias("loaned"),
                total(F.when(is_type(REPAYMENT), -amount)).alias("repaid"),
                F.count(F.when(is_type(REPAYMENT), 1)).alias("repayments"),
                F.count(F.when(is_type(FEE), 1)).alias("fees"),
                F.max(F.when(is_type(LOAN), F.col("local_date"))).alias("loan_day"),
            )
        )
        owners = account_map(self.tables.accounts).where(F.col(USER).isNotNull())
        return (
            by_account.join(owners, F.col("UserAccount") == F.col("account_group_identifier"))
            .groupBy(USER, *day)
            .agg(
                total(F.col("loaned")).alias("loaned"),
                total(F.col("repaid")).alias("repaid"),
                F.sum("repayments").alias("repayments"),
                F.sum("fees").alias("fees"),
                F.max("loan_day").alias("loan_day"),
            )
        )

    def states(self) -> DataFrame:
        """A user's state at the end of each week with entries, from the first loan.

        Rows hold from `week_end` until the week before `next_week`. `was_status`
        is the bucket that the state before ended in.
        """
        in_order = Window.partitionBy(USER).orderBy("week_end", "local_date")
        so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        by_week = Window.partitionBy(USER).orderBy("week_end")
        day, zero = F.col("local_date"), F.lit(0)
        loaned, repaid = F.coalesce("loaned", zero), F.coalesce("repaid", zero)
        fees_at_loan = F.when(F.col("loan_day").isNotNull(), F.col("fees_ever"))
        carried = (
            self.days()
            .withColumns(
                {
                    "first_loan": F.min("loan_day").over(so_far),
                    "last_loan_date": F.max("loan_day").over(so_far),
                    "last_fee_date": F.max(F.when(F.col("fees") > 0, day)).over(so_far),
                    "last_payment_date": F.max(F.when(F.col("repayments") > 0, day)).over(so_far),
                    "fees_ever": F.sum("fees").over(so_far),
                    "loaned_ever": F.sum(loaned).over(so_far),
                    "repaid_ever": F.sum(repaid).over(so_far),
                    "repayments_ever": F.sum("repayments").over(so_far),
                    "next_week": F.lead("week_end").over(in_order),
                }
            )
            .withColumns(
                {
                    "OS": F.sum(F.when(day >= F.col("first_loan"), loaned - repaid)).over(so_far),
                    # Fees paid on the day of the last loan or before do not count.
                    "num_fee_payments": F.col("fees_ever")
                    - F.last(fees_at_loan, ignorenulls=True).over(so_far),
                }
            )
            .where("next_week is null or next_week > week_end")
        )
        last_loan, last_fee = F.col("last_loan_date"), F.col("last_fee_date")
        fees, last_seen = F.col("num_fee_payments"), F.date_sub("next_week", 7)
        dated = carried.withColumns(
            {
                "paid_until": cl.cover_paid_until(last_loan, last_fee, self.rules),
                "lapses_on": cl.cover_lapses_on(last_loan, fees, self.rules),
            }
        ).withColumn("ended_in", F.when(F.col("OS").isNotNull(), self._bucket(last_seen)))

        def in_week(ever: str) -> Column:
            return F.col(ever) - F.coalesce(F.lag(ever).over(by_week), zero)

        # Flows of the week, and the bucket seen in the snapshot before this state.
        flows = dated.withColumns(
            {
                "was_status": F.lag("ended_in").over(by_week),
                "total_loaned_in_week": in_week("loaned_ever"),
                "num_repayments_in_week": in_week("repayments_ever"),
                "total_repaid_in_week": in_week("repaid_ever"),
            }
        ).where("OS is not null")
        lent = last_loan > F.date_sub("week_end", 7)
        paid = F.col("num_repayments_in_week") > 0
        return flows.select(
            USER,
            "week_end",
            "next_week",
            "OS",
            "last_loan_date",
            "last_fee_date",
            "last_payment_date",
            "num_fee_payments",
            "paid_until",
            "lapses_on",
            "was_status",
            F.when(lent, F.lit(1)).alias("num_loans_in_week"),
            F.when(lent, F.col("total_loaned_in_week")).alias("total_loaned_in_week"),
            F.when(paid, F.col("num_repayments_in_week")).alias("num_repayments_in_week"),
            F.when(paid, F.col("total_repaid_in_week")).alias("total_repaid_in_week"),
        )

    def flags(self) -> DataFrame:
        """Users on the upgrade and migration lists; neither list ends at a snapshot."""
        upgraded = self.tables.ledger_lines.where(
            (F.col("line_ts") >= F.lit(self.rules.upgrade_from).cast("timestamp_ntz"))
            & (F.col("description") == self.rules.upgrade_text)
        ).select(USER, F.lit(1).alias("grad_flag"), F.lit(0).alias("migration_flag"))
        migrated = self.tables.migration_list.select(
            USER, F.lit(0).alias("grad_flag"), F.lit(1).alias("migration_flag")
        )
        return (
            upgraded.unionByName(migrated)
            .where(F.col(USER).isNotNull())
            .groupBy(USER)
            .agg(F.max("grad_flag").alias("grad_flag"), F.max("migration_flag").alias("migration_flag"))
        )

    # --- report -----------------------------------------------------------

    def _spans(self) -> DataFrame:
        """States seen by the calendar."""
        until = F.date_sub("next_week", 7)
        return within(self.states(), F.col("week_end"), until, self.calendar)

    def _expanded(self, spans: DataFrame) -> DataFrame:
        expanded = expand(
            spans, F.col("week_end"), F.date_sub("next_week", 7), self.calendar
        )
        own = F.col("snapshot") == F.col("week_end")
        return expanded.withColumns({name: F.when(own, F.col(name)) for name in _FLOWS})

    @staticmethod
    def _due(snapshot: Column) -> Column:
        return cl.cover_due_date(F.col("paid_until"), F.col("lapses_on"), snapshot)

    @classmethod
    def _bucket(cls, snapshot: Column) -> Column:
        return cl.cover_bucket(F.col("OS"), cls._due(snapshot), snapshot)

    def _evaluated(self, spans: DataFrame) -> DataFrame:
        """State rows at every snapshot, with their dates, bucket and previous bucket.

        What does not depend on the snapshot is worked out before the expansion.
        """
        last_loan, last_payment = F.col("last_loan_date"), F.col("last_payment_date")
        dated = spans.withColumns(
            {
                "orig_due_date": F.date_add(last_loan, self.rules.grace_days),
                "update_date": cl.cover_update_date(last_loan, last_payment),
                "cohort_end": week_end(last_loan),
                "cohort_paid": week_end(last_payment),
            }
        )
        snapshot, before = F.col("snapshot"), F.col("prev_snap")
        status_before = F.when(before >= F.col("week_end"), self._bucket(before)).otherwise(
            F.coalesce("was_status", F.lit(cl.NON_EXISTENT))
        )
        return (
            self._expanded(dated)
            .withColumn("prev_snap", F.date_sub(snapshot, 7))
            .withColumns(
                {
                    "num_expected_fee_payments": cl.expected_fees(last_loan, snapshot, self.rules),
                    "due_date": self._due(snapshot),
                    "snapshot_status": self._bucket(snapshot),
                    "prev_status": status_before,
                }
            )
        )

    def state_snapshots(self) -> DataFrame:
        return self._evaluated(self._spans())

    def status_counts(self) -> DataFrame:
        """Snapshot rows per bucket, `(value, n)`, counted without making them.

        Within a state the due date changes once, at `lapses_on`, and the limits of the buckets
        are fixed days after it; so each bucket is a span of days, and its rows are the
        Sundays of the calendar in it.
        """
        opens = F.greatest("week_end", F.lit(self.calendar.first))
        closes = F.least(F.date_sub("next_week", 7), F.lit(self.calendar.last))
        paid, lapses = F.col("paid_until"), F.col("lapses_on")

        def rows(after: int | None, until: int | None) -> Column:
            """Snapshots that are more than `after` and at most `until` days late."""

            def between(due: Column, since: Column, to: Column) -> Column:
                low = since if after is None else F.greatest(since, F.date_add(due, after + 1))
                high = to if until is None else F.least(to, F.date_add(due, until))
                return sundays(low, high)

            while_paid = between(paid, opens, F.least(closes, F.date_sub(lapses, 1)))
            return while_paid + between(lapses, F.greatest(opens, lapses), closes)

        settled = {cl.COVER_INACTIVE: F.col("OS") == 0, cl.COVER_ISSUE: F.col("OS") < 0}
        parts = {label: (holds, sundays(opens, closes)) for label, holds in settled.items()}
        parts |= {label: (F.col("OS") > 0, rows(*ages)) for label, ages in cl.COVER_AGES.items()}
        counted = self._spans().agg(
            *[F.coalesce(F.sum(F.when(owes, n)), F.lit(0)).alias(label) for label, (owes, n) in parts.items()]
        )
        pairs = F.array(*[F.struct(F.lit(v).alias("value"), F.col(f"`{v}`").alias("n")) for v in parts])
        return counted.select(F.inline(pairs)).where("n > 0")

    def rolled(self, spans: DataFrame | None = None) -> DataFrame:
        """State rows with new-loan, new-default and paid classes."""
        status, before = F.col("snapshot_status"), F.col("prev_status")
        starts = F.col("snapshot") == F.col("cohort_end")
        rows = self.state_snapshots() if spans is None else self._evaluated(spans)
        return rows.withColumns(
            {
                "new_loan": F.when(starts, "Yes").otherwise("No"),
                "paid_class": cl.paid_class(
                    status, before, F.col("update_date"), F.col("due_date")
                ),
                "new_default": cl.new_default(status, before, cl.COVER_DEFAULT),
                "paid_in_cohort": cl.paid_in_cohort(
                    status, F.col("cohort_paid"), F.col("snapshot")
                ),
            }
        )

    def report(self) -> DataFrame:
        # Flags join the states while there is one row per user and week.
        spans = self._spans().join(self.flags(), USER, "left")
        money = ("OS", "total_loaned_in_week", "total_repaid_in_week")
        flags = ("grad_flag", "migration_flag")
        shown = spans.withColumns(
            {
                **{name: emit(F.col(name)) for name in money},
                **{name: F.coalesce(name, F.lit(0)) for name in flags},
            }
        )
        expected = F.col("num_expected_fee_payments").cast("double")
        return (
            self.rolled(shown)
            .withColumn("num_expected_fee_payments", expected)
            .select(REPORT_COLUMNS)
        )
