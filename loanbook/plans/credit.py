"""The credit-building book.

The ledger is reduced to one row per user and day, running values over those
rows give the user's state, and each state row covers the snapshots until the
next one. Accounts are joined to the states while both are compact; expansion to
the calendar comes last and needs no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanbook.functions import classify as cl
from loanbook.functions.dates import civil, civil_date, month_end, sundays, week_end
from loanbook.functions.money import emit, total
from loanbook.operators.asof import expand, within
from loanbook.operators.ledger import (
    BORROW,
    REPAY,
    account_map,
    credit_entries,
    is_borrow,
    posted_by,
    with_owners,
)
from loanbook.operators.running import ROWS_PER_SLICE, leading, next_later, running
from loanbook.operators.salting import ROWS_PER_SALT, row_counts, salted_join
from loanbook.params import ZONE, Calendar, CreditRules
from loanbook.session import written
from loanbook.sources.tables import Tables

USER, ACCOUNT = "user_reference", "account_identifier"

REPORT_COLUMNS = [
    "snapshot", "accessed", "user_reference", "account_identifier", "open_date",
    "loan_type", "CBLimit", "snapshot_status", "in_month_withdrawals",
    "in_month_repayments", "OS", "due_date", "prev_snap", "cohort_end_month",
    "cohort_end", "ever_accessed",
]
ROLL_COLUMNS = [*REPORT_COLUMNS, "prev_status", "new_loan", "new_default"]

_FLOWS = ("in_month_withdrawals", "in_month_repayments")

# A user's entries in order: time, withdrawals first, then id.
ENTRY_ORDER = ("PostedAt", "TR_Desc", "TransactionID")


@dataclass(frozen=True)
class CreditBook:
    tables: Tables
    calendar: Calendar
    rules: CreditRules = CreditRules()
    zone: str = ZONE
    # Whether an amount that is no number raises, or counts as unknown.
    strict: bool = True
    rows_per_salt: int = ROWS_PER_SALT
    # An account's row grows into one per snapshot.
    accounts_per_salt: int = ROWS_PER_SALT // 10
    # Entries of one user that a task runs along.
    rows_per_slice: int = ROWS_PER_SLICE

    # --- accounts ---------------------------------------------------------

    @cached_property
    def account_facts(self) -> DataFrame:
        """All that the book asks of each account's ledger rows, from one scan, and its users.

        First withdrawal, week of the first activity, whether ever accessed, and the number
        of `entries`. Unmapped accounts have a NULL user. It is read many times, so it is
        written once per book.
        """
        code, posted = F.col("PaymentCode"), F.col("PostedAt")
        active = code.isin(*self.rules.activity_codes)
        borrowed, moved = code == self.rules.borrow_code, code.isin(*self.rules.entry_codes)
        codes = {*self.rules.activity_codes, *self.rules.entry_codes}
        facts = (
            self.tables.ledger.where(code.isin(*sorted(codes)))
            .groupBy(F.col("UserAccount").alias(ACCOUNT))
            .agg(
                F.min(F.when(borrowed, civil(posted, self.zone))).alias("first_loan_date"),
                week_end(F.min(F.when(active, civil_date(posted, self.zone)))).alias("first_week"),
                F.when(F.max(active & borrowed), "Yes").alias("ever_accessed"),
                F.count(F.when(moved, 1)).alias("entries"),
            )
        )
        return written(facts.join(self.owners(), ACCOUNT, "left"), "credit-accounts")

    def owners(self) -> DataFrame:
        return account_map(self.tables.accounts).withColumnRenamed(
            "account_group_identifier", ACCOUNT
        )

    def holders(self) -> DataFrame:
        """Active accounts with their users; unmapped ones keep a NULL user."""
        return self.account_facts.where("first_week is not null").select(
            ACCOUNT, "first_week", "ever_accessed", USER
        )

    def facilities(self) -> DataFrame:
        """First opening and latest terms of accounts with a loan of the book.

        The latest row is the one created when the newest loan of the book was;
        its own type is not asked for, and rows created at once are all kept.
        """
        created, by_account = F.col("created_at"), Window.partitionBy(ACCOUNT)
        of_book = F.when(F.col("loan_type").isin(*self.rules.loan_types), created)
        return (
            self.tables.loans.withColumns(
                {"opened": F.min(of_book).over(by_account), "newest": F.max(of_book).over(by_account)}
            )
            .where(created == F.col("newest"))
            .where(F.col(ACCOUNT).isNotNull())
            .select(
                ACCOUNT,
                civil(F.col("opened"), self.zone).alias("open_date"),
                "loan_type",
                F.col("amount").alias("CBLimit"),
                "status",
                civil(F.col("updated_at"), self.zone).alias("updated_at"),
            )
        )

    def accounts(self) -> DataFrame:
        """Account spine: holders with a facility of the book."""
        return self.holders().join(self.facilities(), ACCOUNT)

    def live_accounts(self) -> DataFrame:
        """Accounts with the last day, `closes`, that still reports them.

        A cancelled account is reported through the month of its last update.
        One whose status is unknown could be cancelled and is cut alike; without
        an update neither can be placed and drops out.
        """
        stays = F.col("status") != self.rules.cancelled
        through = month_end(F.to_date("updated_at"))
        closes = F.when(stays, F.lit(self.calendar.last)).otherwise(through)
        return self.accounts().withColumn("closes", closes).where("closes is not null")

    def live_snapshots(self) -> DataFrame:
        return expand(
            self.live_accounts(), F.col("first_week"), F.col("closes"), self.calendar
        )

    def access_counts(self) -> DataFrame:
        """Report rows per value of `ever_accessed`, `(value, n)`, counted without making them.

        An account meets one state of its user at each of its snapshots, or none, so
        its rows are the Sundays of the calendar from its first week until it closes.
        """
        opens = F.greatest("first_week", F.lit(self.calendar.first))
        closes = F.least("closes", F.lit(self.calendar.last))
        return (
            self.live_accounts().where("ever_accessed is not null")
            .groupBy(F.col("ever_accessed").alias("value"))
            .agg(F.sum(sundays(opens, closes)).alias("n"))
            .where("n > 0")
        )

    # --- entries ----------------------------------------------------------

    def borrowers(self) -> DataFrame:
        """Accounts that ever borrowed, with their known users."""
        borrowed = self.account_facts.where(f"first_loan_date is not null and {USER} is not null")
        return borrowed.select(F.col(ACCOUNT).alias("UserAccount"), "first_loan_date", USER)

    def entries(self, ledger: DataFrame | None = None) -> DataFrame:
        """Entries of known users, repayments before the first loan left out."""
        counted = is_borrow() | (F.col("PostedAt") >= F.col("first_loan_date"))
        source = self.tables.ledger if ledger is None else ledger
        entries = credit_entries(source, self.rules, self.zone, self.strict)
        counts = self.account_facts.where(F.col(ACCOUNT).isNotNull()).select(
            F.col(ACCOUNT).alias("UserAccount"), F.col("entries").alias("rows")
        ).distinct()
        return with_owners(entries, self.borrowers(), "inner", self.rows_per_salt, counts).where(counted)

    def user_entries(self) -> DataFrame:
        """At least the number of entries of each user, as `rows`."""
        known = self.account_facts.where(F.col(USER).isNotNull())
        return known.groupBy(USER).agg(F.sum("entries").alias("rows"))

    def running_balance(self) -> DataFrame:
        """Every entry with the user's balance after it."""
        return running(
            self.entries(), ENTRY_ORDER, {"OS": F.col("Amount")},
            counts=self.user_entries(), rows_per_slice=self.rows_per_slice,
        )

    def withdrawals(self) -> DataFrame:
        """Withdrawals with the time of the user's next later one."""
        return next_later(
            self.entries().where(is_borrow()), "PostedAt", "next_withdrawal_date", ENTRY_ORDER,
            self.user_entries(), self.rows_per_slice,
        )

    def withdrawal_repayments(self) -> DataFrame:
        """Withdrawals with what was repaid until the next one, both ends included.

        Each entry is placed behind the last withdrawal time up to its own. What was repaid
        at that very time counts for the withdrawal before it too, which takes
        it from the group that follows its own.
        """
        borrowed_at = F.when(is_borrow(), F.col("PostedAt"))
        counts = self.user_entries()
        placed = written(
            running(
                self.entries(), ENTRY_ORDER, maxima={"withdrawn_at": borrowed_at},
                counts=counts, rows_per_slice=self.rows_per_slice,
            ).select(USER, "UserAccount", "TransactionID", "PostedAt", "TR_Desc", "Amount", "withdrawn_at"),
            "placed",
        )
        repaid = F.when(~is_borrow(), F.col("Amount"))
        at_once = F.col("PostedAt") == F.col("withdrawn_at")
        groups = (
            placed.where("withdrawn_at is not null")
            .groupBy(USER, "withdrawn_at")
            .agg(
                F.sum(repaid).alias("repaid"),
                F.max(F.when(~is_borrow(), F.col("PostedAt"))).alias("repaid_at"),
                F.sum(F.when(at_once, repaid)).alias("repaid_at_once"),
                F.max(F.when(at_once & ~is_borrow(), F.col("PostedAt"))).alias("closed_at"),
            )
        )
        taken = {"next_withdrawal_date": "withdrawn_at", "closing": "repaid_at_once", "closing_at": "closed_at"}
        sessions = leading(groups, "withdrawn_at", taken, counts, self.rows_per_slice)
        zero, any_repaid = F.lit(0), F.coalesce("repaid", "closing").isNotNull()
        amount = F.coalesce("repaid", zero) + F.coalesce("closing", zero)
        summed = sessions.select(
            USER,
            F.col("withdrawn_at").alias("PostedAt"),
            "next_withdrawal_date",
            F.when(any_repaid, amount).alias("RepaymentAmount"),
            F.greatest("repaid_at", "closing_at").alias("RepaymentDate"),
        )
        return placed.where(is_borrow()).drop("withdrawn_at").join(summed, [USER, "PostedAt"])

    def weekly_flows(self) -> DataFrame:
        """Withdrawn and repaid per user and week."""
        amount = F.col("Amount")
        return (
            self.entries()
            .groupBy(USER, "week_end")
            .agg(
                F.sum(F.when(is_borrow(), amount)).alias("withdrawals"),
                F.sum(F.when(~is_borrow(), -amount)).alias("repayments"),
            )
        )

    # --- states -----------------------------------------------------------

    def days(self) -> DataFrame:
        """One row per user and day with entries that the calendar can see.

        `repaid_after` is what was repaid at or after the day's last withdrawal. Sums and
        bounds of a day tell it where all repayments lie on one side of that withdrawal;
        only days that it parts look at their repayments once more.
        """
        amount, posted = F.col("Amount"), F.col("PostedAt")
        day = [USER, "week_end", "local_date"]
        seen = posted_by(self.tables.ledger, self.calendar.last)
        in_calendar = F.expr("local_date is not null") & (F.col("local_date") <= F.lit(self.calendar.last))
        repaid_at = F.when(~is_borrow(), posted)
        summed = (
            self.entries(seen)
            .where(in_calendar)
            .groupBy(*day)
            .agg(
                total(F.when(is_borrow(), amount)).alias("withdrawn"),
                total(F.when(~is_borrow(), -amount)).alias("repaid"),
                F.max(F.when(is_borrow(), posted)).alias("borrowed_at"),
                F.min(repaid_at).alias("repaid_from"),
                F.max(repaid_at).alias("repaid_at"),
            )
        )
        parted = (F.col("repaid_from") < F.col("borrowed_at")) & (F.col("repaid_at") >= F.col("borrowed_at"))
        # True of all days, but it asks for both sums: so this branch equals the other up to
        # the shuffle, which Spark then runs once (as it does not with other null checks above).
        any_moved = F.expr("withdrawn is not null or repaid is not null or borrowed_at is not null")
        split = summed.where(parted & any_moved)
        looked_at = split.select(USER, F.col("local_date").alias("_day"), F.col("borrowed_at").alias("_since")).join(
            self.borrowers().withColumnRenamed("UserAccount", "_account"), USER
        )
        repayments = credit_entries(seen, self.rules, self.zone, self.strict).where(~is_borrow())
        late = (
            repayments.join(
                looked_at,
                (F.col("UserAccount") == F.col("_account"))
                & (F.col("local_date") == F.col("_day"))
                & (posted >= F.greatest("_since", "first_loan_date")),
            )
            .groupBy(*day)
            .agg(total(-amount).alias("repaid_late"))
        )
        after = F.when(parted, F.col("repaid_late")).when(F.col("repaid_from") >= F.col("borrowed_at"), F.col("repaid"))
        return summed.join(late, day, "left").withColumn("repaid_after", after).drop("repaid_from", "repaid_late")

    def states(self) -> DataFrame:
        """A user's state at the end of each week with entries.

        Rows hold from `week_end` until the week before `next_week`, the end of
        the next week with entries. `was_status` is the bucket that the state
        before ended in, NULL for a user's first.
        """
        in_order = Window.partitionBy(USER).orderBy("week_end", "local_date")
        so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        by_week = Window.partitionBy(USER).orderBy("week_end")
        zero = F.lit(0)
        withdrawn, repaid = F.coalesce("withdrawn", zero), F.coalesce("repaid", zero)
        # Repaid before the last withdrawal: where `repaid_since` starts from.
        base = F.when(
            F.col("borrowed_at").isNotNull(),
            F.col("repaid_ever") - F.coalesce("repaid_after", zero),
        )
        carried = (
            self.days()
            .withColumns(
                {
                    "withdrawn_ever": F.sum(withdrawn).over(so_far),
                    "repaid_ever": F.sum(repaid).over(so_far),
                    "last_borrowed": F.max("borrowed_at").over(so_far),
                    "last_repaid": F.max("repaid_at").over(so_far),
                    "next_week": F.lead("week_end").over(in_order),
                }
            )
            .withColumn(
                "repaid_since",
                F.col("repaid_ever") - F.last(base, ignorenulls=True).over(so_far),
            )
            .where("next_week is null or next_week > week_end")
        )
        balance = F.col("withdrawn_ever") - F.col("repaid_ever")
        paid_last = F.col("last_repaid") >= F.col("last_borrowed")
        state = carried.select(
            USER,
            "week_end",
            "next_week",
            "withdrawn_ever",
            "repaid_ever",
            "last_borrowed",
            "last_repaid",
            F.greatest("last_borrowed", "last_repaid").alias("last_TR"),
            F.when(paid_last, REPAY).otherwise(BORROW).alias("Last_TR_Desc"),
            cl.snap_to_zero(balance, self.rules).alias("OS"),
            F.when(paid_last, F.col("last_borrowed")).alias("PrevWithdrawDate"),
            F.when(paid_last, F.col("last_repaid")).alias("RepaymentDate"),
            F.when(paid_last, F.col("repaid_since")).alias("RepaymentAmount"),
            F.when(paid_last, F.col("repaid_since") + balance).otherwise(balance).alias("prev_OS"),
        )
        due = cl.credit_due_at(
            F.col("last_TR"),
            F.col("PrevWithdrawDate"),
            F.col("RepaymentAmount"),
            F.col("prev_OS"),
            self.rules,
        )
        last_seen = F.date_sub("next_week", 7)
        dated = state.withColumn("due_at", due).withColumn(
            "ended_in", cl.credit_bucket(F.col("OS"), F.to_date("due_at"), last_seen)
        )
        # Flows of the week, and the bucket seen in the snapshot before this state.
        week_start = F.date_sub("week_end", 6)

        def in_week(ever: str, last: str) -> Column:
            flow = F.col(ever) - F.coalesce(F.lag(ever).over(by_week), zero)
            return F.when(F.to_date(last) >= week_start, flow)

        return dated.withColumns(
            {
                "was_status": F.lag("ended_in").over(by_week),
                "in_month_withdrawals": in_week("withdrawn_ever", "last_borrowed"),
                "in_month_repayments": in_week("repaid_ever", "last_repaid"),
            }
        ).drop("withdrawn_ever", "repaid_ever", "last_borrowed", "last_repaid", "ended_in")

    def state_snapshots(self) -> DataFrame:
        """The state of every user at every snapshot since the first entry."""
        seen = expand(
            self.states(),
            F.col("week_end"),
            F.date_sub("next_week", 7),
            self.calendar,
        )
        # Flows belong to the week they happened in, not to later snapshots.
        own = F.col("snapshot") == F.col("week_end")
        return seen.withColumns({name: F.when(own, F.col(name)) for name in _FLOWS})

    # --- report -----------------------------------------------------------

    def _accounts_with_states(self) -> DataFrame:
        """Accounts with each state of their user and the span it is seen in.

        A user's first state also spans the weeks before it, so that the states
        leave no gap and an account meets one at each of its snapshots. What does
        not depend on the snapshot is worked out here, before rows multiply.
        """
        opened = F.to_date("open_date")
        accounts = self.live_accounts().withColumns(
            {
                "open_date": opened,
                "cohort_end_month": month_end(opened),
                "cohort_end": week_end(opened),
                "cancelled_on": F.when(
                    F.col("status") == self.rules.cancelled, F.to_date("updated_at")
                ),
                "CBLimit": F.col("CBLimit").cast("long"),
                "opening": F.col("first_week"),
            }
        )
        spans = self.states().select(
            USER,
            "week_end",
            "was_status",
            F.to_date("due_at").alias("due_date"),
            *[emit(F.col(name)).alias(name) for name in ("OS", *_FLOWS)],
            F.when(F.col("was_status").isNotNull(), F.col("week_end")).alias("since"),
            F.date_sub("next_week", 7).alias("until"),
        )
        seen = within(
            spans, F.coalesce("since", F.lit(self.calendar.first)), F.col("until"), self.calendar
        )
        overlap = (F.coalesce("since", "first_week") <= F.col("closes")) & (
            F.coalesce("until", "closes") >= F.col("first_week")
        )
        # A user has at most as many accounts in the report as have ledger rows.
        counts = row_counts(self.account_facts, USER)
        return salted_join(
            accounts, seen, USER, ACCOUNT, counts, "left", overlap, self.accounts_per_salt
        )

    def _evaluated(self) -> DataFrame:
        """The report with the account's status in the snapshot before, if it had one."""
        snapshot, before = F.col("snapshot"), F.col("prev_snap")
        week = F.col("week_end")

        def untouched(at: Column) -> Column:
            return cl.untouched_status(F.col("cancelled_on"), at)

        def bucket(at: Column) -> Column:
            return cl.credit_bucket(F.col("OS"), F.col("due_date"), at)

        expanded = expand(
            self._accounts_with_states(),
            F.greatest("first_week", "since"),
            F.least("closes", "until"),
            self.calendar,
        ).withColumn("prev_snap", F.date_sub(snapshot, 7))
        # Before its first week, and without any, a state has no part in the row.
        has_state, own_week = snapshot >= week, snapshot == week
        status_before = (
            F.when(before >= week, bucket(before))
            .when(F.col("was_status").isNotNull(), F.col("was_status"))
            .otherwise(untouched(before))
        )
        return expanded.withColumns(
            {
                "accessed": F.when(has_state, "Yes").otherwise("No"),
                "snapshot_status": F.when(has_state, bucket(snapshot)).otherwise(
                    untouched(snapshot)
                ),
                "status_before": status_before,
            }
        ).withColumns(
            {
                **{n: F.coalesce(F.when(own_week, F.col(n)), F.lit(0.0)) for n in _FLOWS},
                "OS": F.when(has_state, F.col("OS")).otherwise(F.lit(0.0)),
                "due_date": F.when(has_state, F.col("due_date")).otherwise(snapshot),
            }
        )

    def report(self) -> DataFrame:
        return self._evaluated().select(REPORT_COLUMNS)

    def roll(self, legacy_overwrite: bool = False) -> DataFrame:
        """The report with previous status, new-loan and new-default flags.

        An account is in the report for an unbroken run of weeks, so the row
        before is the week before, except in its first week. With
        `legacy_overwrite` the previous status and new-loan flag of accessed
        accounts are stored as constants.
        """
        # Flags of the credit-building report.
        yes, no = "1. Yes", "0. No"
        starts = F.col("snapshot") == F.col("cohort_end")
        accessed = F.col("ever_accessed").eqNullSafe("Yes")
        by_cohort = F.when(starts, cl.NON_EXISTENT).otherwise(cl.CREDIT_CURRENT)
        # Accounts never accessed have no history to roll.
        rolls = accessed & (F.col("snapshot") > F.col("opening"))
        before = F.when(rolls, F.col("status_before")).otherwise(by_cohort)
        new_loan = F.when(~rolls & starts, yes).otherwise(no)
        default = cl.new_default(F.col("snapshot_status"), before, cl.CREDIT_DEFAULT)
        if legacy_overwrite:
            before = F.when(accessed, cl.NON_EXISTENT).otherwise(before)
            new_loan = F.when(accessed, no).otherwise(new_loan)
        flagged = self._evaluated().withColumns(
            {
                "prev_status": before,
                "new_loan": new_loan,
                "new_default": F.when(accessed, default).otherwise("3. NA"),
            }
        )
        return flagged.select(ROLL_COLUMNS)
