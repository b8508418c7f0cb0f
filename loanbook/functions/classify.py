"""Due dates, ageing buckets and roll classes as column expressions.

Each takes the snapshot as a column, so that the same rule can be asked of a
state for this week and for the week before.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanbook.params import CoverRules, CreditRules

# Labels of the credit-building report.
CREDIT_CURRENT = "1. Current"
CREDIT_CANCELLED = "6. Cancelled"
CREDIT_DEFAULT = "5. 91+"

# Labels of the cover report.
COVER_INACTIVE = "1. Inactive"
COVER_DEFAULT = "6. 91+"
COVER_ISSUE = "7. Balance Issue"

# Days past due of each bucket of a cover debt, more than the first and at most the last.
COVER_AGES = {
    "2. current": (None, 0),
    "3. 1 to 30": (0, 30),
    "4. 31 to 60": (30, 60),
    "5. 61 to 90": (60, 90),
    COVER_DEFAULT: (90, None),
}

# Labels of both reports.
NON_EXISTENT = "0. non existent"


def snap_to_zero(balance: Column, rules: CreditRules) -> Column:
    """A balance of at most a cent either way counts as zero."""
    near = balance.between(F.lit(-rules.zero_tolerance), F.lit(rules.zero_tolerance))
    return F.when(near, F.lit(0)).otherwise(balance)


def credit_due_at(
    last_move: Column, borrowed: Column, repaid: Column, owed: Column, rules: CreditRules
) -> Column:
    """When the next payment is due, as a date and time.

    `borrowed` is the last withdrawal if the last move repaid it, else NULL;
    `repaid` is what came back since, out of `owed`. Only a minimum payment that
    leaves a debt moves the due date away from the withdrawal.
    """
    grace = F.expr(f"interval {rules.grace_days} days")
    floor = F.lit(rules.min_payment)
    least = F.greatest(F.lit(rules.min_payment_share) * owed, floor)
    met_minimum = (owed > floor) & (repaid < owed) & (repaid >= least)
    return F.when(borrowed.isNotNull() & ~met_minimum, borrowed + grace).otherwise(
        last_move + grace
    )


def credit_bucket(balance: Column, due: Column, snapshot: Column) -> Column:
    """Ageing bucket; a balance that is settled or negative is current."""
    late = F.when(balance > 0, F.datediff(snapshot, due))
    return (
        F.when(late.between(1, 30), "2. 1 to 30")
        .when(late.between(31, 60), "3. 31 to 60")
        .when(late.between(61, 90), "4. 61 to 90")
        .when(late >= 91, CREDIT_DEFAULT)
        .otherwise(CREDIT_CURRENT)
    )


def untouched_status(cancelled_on: Column, snapshot: Column) -> Column:
    """Status of an account without any loan movement."""
    return F.when(cancelled_on <= snapshot, CREDIT_CANCELLED).otherwise(CREDIT_CURRENT)


def new_default(status: Column, before: Column, default: str) -> Column:
    """Whether a defaulted row defaulted this week."""
    return (
        F.when(status != default, "3. NA").when(before != default, "1. Yes").otherwise("2. No")
    )


def expected_fees(last_loan: Column, snapshot: Column, rules: CoverRules) -> Column:
    """Fee payments due by now: one per full period since the last loan."""
    return F.floor(F.datediff(snapshot, last_loan) / rules.fee_period_days)


def cover_paid_until(last_loan: Column, last_fee: Column, rules: CoverRules) -> Column:
    """Due date while the fees are paid up."""
    from_loan = F.date_add(last_loan, rules.grace_days)
    from_fee = F.date_add(F.coalesce(last_fee, last_loan), rules.fee_period_days)
    return F.when(last_loan <= F.lit(rules.fee_rule_after), from_loan).otherwise(from_fee)


def cover_lapses_on(last_loan: Column, fees: Column, rules: CoverRules) -> Column:
    """Day from which a fee is missing, and due date from then on.

    `fees >= floor(days / period)` holds while `days < period * (fees + 1)`, so the
    missing fee shows on the day that the paid ones reach to. Loans up to the
    rule change are due after one period whatever was paid.
    """
    from_loan = F.date_add(last_loan, rules.grace_days)
    bought = F.date_add(last_loan, ((1 + fees) * rules.fee_period_days).cast("int"))
    return F.when(last_loan <= F.lit(rules.fee_rule_after), from_loan).otherwise(bought)


def cover_due_date(paid_until: Column, lapses_on: Column, snapshot: Column) -> Column:
    return F.when(snapshot < lapses_on, paid_until).otherwise(lapses_on)


def cover_update_date(last_loan: Column, last_payment: Column) -> Column:
    """Last payment if it came on or after the last loan, else the last loan."""
    return F.when(last_payment >= last_loan, last_payment).otherwise(last_loan)


def cover_bucket(balance: Column, due: Column, snapshot: Column) -> Column:
    late = F.datediff(snapshot, due)
    bucket = F.when(balance == 0, COVER_INACTIVE).when(balance < 0, COVER_ISSUE)
    for label, (after, until) in COVER_AGES.items():
        # Ages ascend, so the limit from below is that of the bucket before.
        bucket = bucket.when(late <= until if until is not None else late > after, label)
    return bucket.otherwise(COVER_ISSUE)


def paid_class(status: Column, before: Column, updated: Column, due: Column) -> Column:
    """How a settled loan was paid."""
    late = F.datediff(updated, due)
    return (
        F.when(status != COVER_INACTIVE, "4. NA")
        .when(late <= 0, "1. paid on time")
        .when((late >= 91) & (before == COVER_DEFAULT), "3. paid after default")
        .otherwise("2. paid late")
    )


def paid_in_cohort(status: Column, paid_week: Column, snapshot: Column) -> Column:
    """Whether a settled loan was paid in the snapshot's week."""
    return (
        F.when(status != COVER_INACTIVE, "3. NA")
        .when(paid_week == snapshot, "1. Yes")
        .otherwise("2. No")
    )
