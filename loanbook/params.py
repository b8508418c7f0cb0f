"""Rules and calendars of the two books.

Everything a report depends on besides its tables is here, as plain driver-side
values.
"""

from __future__ import annotations

from calendar import monthrange
from dataclasses import dataclass
from datetime import date, timedelta
from decimal import Decimal

WEEK = timedelta(days=7)

# Zone in which a posting's calendar day is read.
ZONE = "America/Denver"


def week_end_of(day: date) -> date:
    """The Sunday on or after `day`."""
    return day + timedelta(days=6 - day.weekday())


def sunday_before(day: date) -> date:
    """The last Sunday strictly before `day`."""
    return week_end_of(day) - WEEK


def month_end_of(day: date) -> date:
    """The last day of the month of `day`."""
    return day.replace(day=monthrange(day.year, day.month)[1])


@dataclass(frozen=True)
class Calendar:
    """The gap-free run of week-end snapshots of a report.

    Sundays from `start` to `end`, both included. `skip_opening` leaves out the
    first of them, as the usual reports do. Snapshots after `cutoff` are not computed.
    """

    start: date
    end: date
    skip_opening: bool = False
    cutoff: date | None = None

    @property
    def first(self) -> date:
        opening = week_end_of(self.start)
        return opening + WEEK if self.skip_opening else opening

    @property
    def last(self) -> date:
        """The last snapshot; before `first` when there is none."""
        limit = self.end if self.cutoff is None else min(self.end, self.cutoff)
        return sunday_before(limit + timedelta(days=1))

    @property
    def snapshots(self) -> list[date]:
        count = (self.last - self.first).days // 7 + 1
        return [self.first + i * WEEK for i in range(max(count, 0))]


# First day of each report's calendar.
CREDIT_START = date(2022, 4, 1)
COVER_START = date(2021, 7, 31)


def credit_calendar(today: date, start: date = CREDIT_START, skip_opening: bool = False) -> Calendar:
    """Credit-building weeks up to the coming Sunday."""
    closing = week_end_of(today)
    return Calendar(start, closing, skip_opening, cutoff=closing)


def cover_calendar(today: date, start: date = COVER_START, skip_opening: bool = False) -> Calendar:
    """Cover weeks up to the last Sunday before today."""
    return Calendar(start, month_end_of(today), skip_opening, cutoff=sunday_before(today))


@dataclass(frozen=True)
class CreditRules:
    """Credit-building book. Defaults are fixed values."""

    activity_codes: tuple[str, ...] = (
        "CRB-CR-A-E-001",
        "CRB-DR-A-E-001",
        "CRB-DR-A-E-002",
        "CRB-TR-A-I-001",
        "CRB-TR-A-I-002",
    )
    borrow_code: str = "CRB-TR-A-I-001"
    repay_code: str = "CRB-TR-A-I-002"
    loan_types: tuple[str, ...] = ("creditbuilding",)
    cancelled: str = "cancelled"
    min_payment: Decimal = Decimal("67.50")
    min_payment_share: Decimal = Decimal("0.3")
    grace_days: int = 30
    zero_tolerance: Decimal = Decimal("0.01")

    @property
    def entry_codes(self) -> tuple[str, ...]:
        return (self.borrow_code, self.repay_code)


@dataclass(frozen=True)
class CoverRules:
    """Cover book. Defaults are fixed values."""

    fee_code: str = "ODR-DR-A-E-001"
    loan_code: str = "ODR-CR-A-E-001"
    repay_code: str = "ODR-DR-A-E-002"
    fee_rule_after: date = date(2022, 5, 1)
    grace_days: int = 30
    # Days that one fee buys.
    fee_period_days: int = 30
    upgrade_text: str = "Cover Funds (Limit Upgrade)"
    upgrade_from: date = date(2022, 10, 12)

    @property
    def codes(self) -> tuple[str, ...]:
        return (self.fee_code, self.loan_code, self.repay_code)
