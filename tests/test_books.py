"""Both books against a plain recomputation of every snapshot."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal
from zoneinfo import ZoneInfo

import pytest

from loanbook.operators.ledger import account_map
from loanbook.plans.cover import CoverBook
from loanbook.plans.credit import CreditBook
from tests.helpers import COVER, CREDIT, make_tables, rows_of, ts, weeks

CALENDAR = weeks("2021-12-05", "2022-07-10")
UTC, DENVER = ZoneInfo("UTC"), ZoneInfo("America/Denver")

# `a0` has two users, `a1` and `a2` share one, `a5` has none, `a6` a NULL one.
OWNERS = [
    ("a0", "u0"), ("a0", "u0x"), ("a1", "u1"), ("a2", "u1"), ("a3", "u3"), ("a4", "u4"),
    ("a6", None), ("a1", "u1"),
]
LOANS = [
    ("a0", ts("2021-11-01 00:00:00"), None, "creditbuilding", 225, "active"),
    ("a0", ts("2022-01-20 03:00:00"), ts("2022-02-01 00:00:00"), "creditbuilding", 300, None),
    ("a1", ts("2021-12-20 03:00:00"), ts("2022-03-03 00:00:00"), "creditbuilding", 250, "cancelled"),
    ("a2", ts("2021-12-27 06:59:59"), None, "creditbuilding", 250, "active"),
    ("a2", ts("2022-02-01 00:00:00"), None, "other", 999, "active"),
    ("a3", ts("2022-01-01 00:00:00"), None, "creditbuilding", 250, "cancelled"),
    ("a4", ts("2022-01-01 00:00:00"), ts("2022-05-05 00:00:00"), "creditbuilding", 250, "active"),
    ("a5", ts("2022-01-03 00:00:00"), ts("2022-02-05 00:00:00"), "creditbuilding", 250, "cancelled"),
    ("a6", ts("2022-01-04 00:00:00"), None, "other", 250, "active"),
]


def random_ledger(seed: int, codes: list[str], entries: int = 90) -> list[tuple]:
    """Entries with equal times, reversed amounts and debts settled to the cent."""
    rng = random.Random(seed)
    start = datetime(2021, 11, 20)
    rows = []
    for _ in range(entries):
        posted = start + timedelta(days=rng.randrange(200), hours=rng.choice([1, 5, 6, 7, 20]))
        cents = rng.choice([500, 1, 2, 5000, 6750, 20000, 10000, -300])
        rows.append((f"a{rng.randrange(7)}", str(posted), rng.choice(codes), f"${cents / 100:.2f}"))
    return rows


def local(posted: str) -> datetime:
    return datetime.fromisoformat(posted).replace(tzinfo=UTC).astimezone(DENVER).replace(tzinfo=None)


def by_user(ledger: list[tuple], snapshot: date) -> dict[str, list[tuple]]:
    """Visible entries (time, code, id, account, amount) of each known user."""
    found = defaultdict(list)
    for i, (account, posted, code, amount) in enumerate(ledger):
        when = local(posted)
        if when.date() <= snapshot:
            for user in {u for a, u in OWNERS if a == account and u}:
                found[user].append((when, code, f"T{i:05d}", account, Decimal(amount.strip("$"))))
    return found


def week_end(day: date) -> date:
    return day + timedelta(days=6 - day.weekday())


def credit_bucket(balance, due, snapshot):
    late = (snapshot - due).days
    if balance <= 0 or late <= 0:
        return "1. Current"
    return "2. 1 to 30" if late <= 30 else "3. 31 to 60" if late <= 60 else "4. 61 to 90" if late <= 90 else "5. 91+"


def credit_state(entries: list[tuple], snapshot: date):
    firsts = {}
    for when, code, _, account, _ in entries:
        if code == "borrow":
            firsts[account] = min(when, firsts.get(account, when))
    valid = sorted(
        e for e in entries
        if e[1] == "borrow" or (e[1] == "repay" and e[3] in firsts and e[0] >= firsts[e[3]])
    )
    if not valid:
        return None
    def total(rows):
        return sum((r[4] for r in rows), Decimal(0))

    borrowed = [e for e in valid if e[1] == "borrow"]
    repaid = [e for e in valid if e[1] == "repay"]
    balance = total(borrowed) - total(repaid)
    last, since = valid[-1], borrowed[-1][0]
    back = total([e for e in repaid if e[0] >= since])
    paid_last = last[1] == "repay"
    owed = balance + back if paid_last else balance
    met = owed > Decimal("67.5") and back < owed and back >= max(Decimal("67.5"), Decimal("0.3") * owed)
    due = (last[0] if not paid_last or met else since) + timedelta(days=30)

    def flow(rows):
        rows = [e for e in rows if week_end(e[0].date()) == snapshot]
        return float(total(rows)) if rows else None

    shown = Decimal(0) if abs(balance) <= Decimal("0.01") else balance
    return {
        "last_TR": last[0],
        "Last_TR_Desc": "Repay" if paid_last else "Borrow",
        "OS": float(shown),
        "in_month_withdrawals": flow(borrowed),
        "in_month_repayments": flow(repaid),
        "PrevWithdrawDate": since if paid_last else None,
        "RepaymentAmount": float(back) if paid_last else None,
        "prev_OS": float(owed),
        "due_at": due,
        "bucket": credit_bucket(shown, due.date(), snapshot),
    }


@pytest.mark.parametrize("seed", range(4))
def test_credit_states(spark, seed):
    ledger = random_ledger(seed, ["borrow", "repay", "repay", "open"])
    book = CreditBook(make_tables(spark, ledger, OWNERS), CALENDAR, CREDIT)
    names = [
        "last_TR", "Last_TR_Desc", "OS", "in_month_withdrawals", "in_month_repayments",
        "PrevWithdrawDate", "RepaymentAmount", "prev_OS", "due_at",
    ]
    wanted = []
    for snapshot in CALENDAR.snapshots:
        for user, entries in by_user(ledger, snapshot).items():
            state = credit_state(entries, snapshot)
            if state:
                wanted.append((snapshot, user, *[state[n] for n in names]))
    found = [
        tuple(float(v) if isinstance(v, Decimal) else v for v in row)
        for row in rows_of(book.state_snapshots(), "snapshot", "user_reference", *names)
    ]
    assert sorted(found, key=str) == sorted(wanted, key=str)


def credit_roll(ledger: list[tuple]) -> list[tuple]:
    """(snapshot, user, account, status, previous status, new loan, new default)."""
    owners, terms = defaultdict(set), {}
    for account, user in OWNERS:
        owners[account].add(user)
    for account in {row[0] for row in LOANS}:
        of_book = [r for r in LOANS if r[0] == account and r[3] == "creditbuilding"]
        if of_book:
            terms[account] = (min(of_book, key=lambda r: r[1]), max(of_book, key=lambda r: r[1]))
    ever = {row[0] for row in ledger if row[2] == "borrow"}
    before, rows = {}, []
    for snapshot in [CALENDAR.first - timedelta(weeks=1), *CALENDAR.snapshots]:
        states = {u: credit_state(e, snapshot) for u, e in by_user(ledger, snapshot).items()}
        active = {r[0] for r in ledger if local(r[1]).date() <= snapshot}
        for account in sorted(active & set(terms)):
            opened, (_, _, updated, _, _, status) = terms[account]
            cohort = week_end(local(str(opened[1])).date())
            changed = local(str(updated)).date() if updated else None
            if status != "active":
                closing = changed and (changed.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)
                if closing is None or closing < snapshot:
                    continue
            for user in owners.get(account, {None}):
                state = states.get(user)
                cancelled = status == "cancelled" and changed <= snapshot
                now = state["bucket"] if state else "6. Cancelled" if cancelled else "1. Current"
                opening = snapshot == cohort
                prior = before.get((user, account)) if account in ever else None
                prev = prior or ("0. non existent" if opening else "1. Current")
                new = "1. Yes" if opening and not prior else "0. No"
                default = "3. NA"
                if account in ever and now == "5. 91+":
                    default = "2. No" if prev == "5. 91+" else "1. Yes"
                rows.append((snapshot, user, account, now, prev, new, default))
                before[user, account] = now
    return [row for row in rows if row[0] >= CALENDAR.first]


@pytest.mark.parametrize("seed", range(4))
def test_credit_roll(spark, seed):
    ledger = random_ledger(seed, ["borrow", "repay", "repay", "open"])
    book = CreditBook(make_tables(spark, ledger, OWNERS, LOANS), CALENDAR, CREDIT)
    columns = [
        "snapshot", "user_reference", "account_identifier", "snapshot_status", "prev_status",
        "new_loan", "new_default",
    ]
    found = rows_of(book.roll(), *columns)
    assert sorted(found, key=str) == sorted(credit_roll(ledger), key=str)


def test_legacy_overwrite_keeps_new_default(spark):
    ledger = random_ledger(1, ["borrow", "repay", "open"])
    book = CreditBook(make_tables(spark, ledger, OWNERS, LOANS), CALENDAR, CREDIT)
    key = ["snapshot", "user_reference", "account_identifier"]
    flags = ["ever_accessed", "prev_status", "new_loan", "new_default"]
    fixed = {row[:3]: row[3:] for row in rows_of(book.roll(), *key, *flags)}
    legacy = {row[:3]: row[3:] for row in rows_of(book.roll(legacy_overwrite=True), *key, *flags)}
    assert fixed.keys() == legacy.keys()
    for row, (ever, prev, new, default) in legacy.items():
        if ever == "Yes":
            assert (prev, new, default) == ("0. non existent", "0. No", fixed[row][3])
        else:
            assert (ever, prev, new, default) == fixed[row]


def cover_bucket(balance, due, snapshot):
    late = (snapshot - due).days
    if balance <= 0:
        return "1. Inactive" if balance == 0 else "7. Balance Issue"
    edges = [(0, "2. current"), (30, "3. 1 to 30"), (60, "4. 31 to 60"), (90, "5. 61 to 90")]
    return next((label for limit, label in edges if late <= limit), "6. 91+")


def cover_state(entries: list[tuple], snapshot: date):
    days = {k: [e[0].date() for e in entries if e[1] == k] for k in ("loan", "fee", "back")}
    if not days["loan"]:
        return None
    first, last = min(days["loan"]), max(days["loan"])
    fee, paid = (max(days[k], default=None) for k in ("fee", "back"))
    balance = sum(
        (e[4] if e[1] == "loan" else -e[4])
        for e in entries if e[1] != "fee" and e[0].date() >= first
    )
    fees = sum(d > last for d in days["fee"])
    expected = (snapshot - last).days // 30
    if last <= COVER.fee_rule_after:
        due = last + timedelta(days=30)
    elif fees >= expected:
        due = (fee or last) + timedelta(days=30)
    else:
        due = last + timedelta(days=30 * (1 + fees))
    week = {k: [e[4] for e in entries if e[1] == k and week_end(e[0].date()) == snapshot] for k in days}
    return {
        "OS": float(balance),
        "last_loan_date": last,
        "last_fee_date": fee,
        "last_payment_date": paid,
        "num_fee_payments": fees,
        "num_expected_fee_payments": float(expected),
        "due_date": due,
        "update_date": paid if paid and paid >= last else last,
        "num_loans_in_week": 1 if week["loan"] else None,
        "total_loaned_in_week": float(sum(week["loan"])) if week["loan"] else None,
        "num_repayments_in_week": len(week["back"]) or None,
        "total_repaid_in_week": float(sum(week["back"])) if week["back"] else None,
        "snapshot_status": cover_bucket(balance, due, snapshot),
    }


LINES = [
    ("u0", ts("2022-02-28 23:59:59"), COVER.upgrade_text),
    ("u1", ts("2022-03-01 00:00:00"), COVER.upgrade_text),
    ("u3", ts("2022-03-05 00:00:00"), "Cover Funds"),
    (None, ts("2022-03-05 00:00:00"), COVER.upgrade_text),
]


@pytest.mark.parametrize("seed", range(4))
def test_cover_report(spark, seed):
    ledger = random_ledger(seed, ["loan", "back", "back", "fee", "fee"])
    tables = make_tables(spark, ledger, OWNERS, lines=LINES, migrated=["u4", None, "u4"])
    found = rows_of(CoverBook(tables, CALENDAR, COVER).report())
    names = CoverBook(tables, CALENDAR, COVER).report().columns
    wanted, before = [], {}
    for snapshot in [CALENDAR.first - timedelta(weeks=1), *CALENDAR.snapshots]:
        seen = {}
        for user, entries in by_user(ledger, snapshot).items():
            state = cover_state(entries, snapshot)
            if state is None:
                continue
            status = seen[user] = state["snapshot_status"]
            prev = before.get(user, "0. non existent")
            late = (state["update_date"] - state["due_date"]).days
            settled, paid = status == "1. Inactive", state["last_payment_date"]
            paid_week = paid and week_end(paid)
            cohort = week_end(state["last_loan_date"])
            state |= {
                "snapshot": snapshot,
                "user_reference": user,
                "orig_due_date": state["last_loan_date"] + timedelta(days=30),
                "prev_snap": snapshot - timedelta(days=7),
                "cohort_end": cohort,
                "cohort_paid": paid_week,
                "grad_flag": int(user == "u1"),
                "migration_flag": int(user == "u4"),
                "prev_status": prev,
                "new_loan": "Yes" if cohort == snapshot else "No",
                "paid_class": "4. NA" if not settled else "1. paid on time" if late <= 0
                else "3. paid after default" if late >= 91 and prev == "6. 91+" else "2. paid late",
                "new_default": "3. NA" if status != "6. 91+" else "2. No" if prev == status else "1. Yes",
                "paid_in_cohort": "3. NA" if not settled else "1. Yes" if paid_week == snapshot else "2. No",
            }
            if snapshot >= CALENDAR.first:
                wanted.append(tuple(state[n] for n in names))
        before = seen
    assert sorted(found, key=str) == sorted(wanted, key=str)


def test_running_balance_orders_equal_times(spark):
    ledger = [
        ("a3", "2022-01-05 12:00:00", "repay", "$4.00"),  # same time as the first withdrawal
        ("a3", "2022-01-05 12:00:00", "borrow", "$10.00"),
        ("a3", "2022-01-05 11:59:59", "repay", "$9.00"),  # before it: left out
        ("a3", "2022-01-06 03:00:00", "repay", "$1.00"),
        ("a3", "2022-01-09 12:00:00", "borrow", "$5.00"),
        ("a5", "2022-01-05 12:00:00", "borrow", "$7.00"),  # no user
    ]
    book = CreditBook(make_tables(spark, ledger, OWNERS), CALENDAR, CREDIT)
    found = rows_of(book.running_balance(), "PostedAt", "TR_Desc", "OS")
    assert [(str(t), d, float(v)) for t, d, v in found] == [
        ("2022-01-05 05:00:00", "Borrow", 10.0),
        ("2022-01-05 05:00:00", "Repay", 6.0),
        ("2022-01-05 20:00:00", "Repay", 5.0),
        ("2022-01-09 05:00:00", "Borrow", 10.0),
    ]


def test_repayment_at_the_next_withdrawal_counts_for_both(spark):
    ledger = [
        ("a3", "2022-01-05 12:00:00", "borrow", "$10.00"),
        ("a3", "2022-01-05 12:00:00", "borrow", "$20.00"),
        ("a3", "2022-01-07 12:00:00", "repay", "$3.00"),
        ("a3", "2022-01-08 12:00:00", "repay", "$4.00"),
        ("a3", "2022-01-08 12:00:00", "borrow", "$30.00"),
        ("a3", "2022-01-20 12:00:00", "borrow", "$40.00"),
    ]
    book = CreditBook(make_tables(spark, ledger, OWNERS), CALENDAR, CREDIT)
    found = rows_of(
        book.withdrawal_repayments(), "Amount", "next_withdrawal_date", "RepaymentAmount", "RepaymentDate"
    )
    second, last = datetime(2022, 1, 8, 5), datetime(2022, 1, 20, 5)
    assert [(float(a), n, r and float(r), d) for a, n, r, d in found] == [
        (10.0, second, -7.0, second),
        (20.0, second, -7.0, second),
        (30.0, last, -4.0, second),
        (40.0, None, None, None),
    ]


@pytest.mark.parametrize(("repaid", "due"), [("214.98", 5), ("214.99", 15)])
def test_minimum_payment_is_compared_to_the_tenth_of_a_cent(spark, repaid, due):
    """Thirty per cent of 716.61 is 214.983."""
    ledger = [
        ("a3", "2022-01-05 12:00:00", "borrow", "$716.61"),
        ("a3", "2022-01-15 12:00:00", "repay", f"${repaid}"),
    ]
    book = CreditBook(make_tables(spark, ledger, OWNERS), CALENDAR, CREDIT)
    found = rows_of(book.state_snapshots().where("snapshot = '2022-01-30'"), "due_at")
    assert found == [(datetime(2022, 1, due, 5) + timedelta(days=30),)]


def test_account_map_is_distinct(spark):
    tables = make_tables(spark, [], OWNERS)
    assert len(rows_of(account_map(tables.accounts))) == len(set(OWNERS))


def test_empty_inputs_and_empty_calendar(spark):
    empty = make_tables(spark, [], [])
    assert CoverBook(empty, CALENDAR, COVER).report().count() == 0
    assert CreditBook(empty, CALENDAR, CREDIT).roll().count() == 0
    ledger = random_ledger(0, ["loan", "back", "fee"])
    none = weeks("2022-01-03", "2022-01-08")
    assert CoverBook(make_tables(spark, ledger, OWNERS), none, COVER).report().count() == 0


def test_entries_after_the_last_snapshot_do_not_count(spark):
    """The stored bound is wider than the civil one; states end at the calendar."""
    ledger = [
        ("a3", "2022-05-03 12:00:00", "loan", "$10.00"),
        ("a3", "2022-05-09 12:00:00", "loan", "$20.00"),  # the Monday after
    ]
    calendar = weeks("2022-05-01", "2022-05-08")
    states = CoverBook(make_tables(spark, ledger, OWNERS), calendar, COVER).states()
    assert rows_of(states, "week_end", "next_week", "last_loan_date", "OS") == [
        (date(2022, 5, 8), None, date(2022, 5, 3), Decimal("10.00"))
    ]


def test_first_snapshot_of_cover_knows_its_previous(spark):
    ledger = [("a3", "2022-01-01 12:00:00", "loan", "$10.00")]
    late = weeks("2022-05-01", "2022-05-08")
    book = CoverBook(make_tables(spark, ledger, OWNERS), late, COVER)
    found = rows_of(book.report(), "snapshot", "snapshot_status", "prev_status")
    assert found == [
        (date(2022, 5, 1), "5. 61 to 90", "5. 61 to 90"),
        (date(2022, 5, 8), "6. 91+", "5. 61 to 90"),
    ]
