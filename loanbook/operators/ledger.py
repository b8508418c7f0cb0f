"""From the raw ledger to typed entries of each book."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.functions.dates import civil, week_end
from loanbook.functions.money import parse_amount
from loanbook.operators.salting import ROWS_PER_SALT, row_counts, salted_join
from loanbook.params import CoverRules, CreditRules

BORROW, REPAY = "Borrow", "Repay"

# Entry types of the cover book.
FEE, LOAN, REPAYMENT = "1. fee", "2. loan", "3. repayment"


def account_map(accounts: DataFrame) -> DataFrame:
    """Distinct (account, user) pairs. An account may belong to several users."""
    return accounts.select("account_group_identifier", "user_reference").distinct()


def with_users(
    entries: DataFrame, accounts: DataFrame, how: str = "left", rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """Attach `user_reference` by `UserAccount`; `left` keeps unmapped accounts."""
    owners = account_map(accounts).withColumnRenamed("account_group_identifier", "UserAccount")
    if how == "inner":
        owners = owners.where(F.col("user_reference").isNotNull())
    return with_owners(entries, owners, how, rows_per_salt)


def with_owners(
    entries: DataFrame,
    owners: DataFrame,
    how: str,
    rows_per_salt: int = ROWS_PER_SALT,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join what `owners` has per `UserAccount` to ledger entries.

    `counts` has at least the `rows` of each account, where they are known already.
    """
    if counts is None:
        counts = row_counts(entries, "UserAccount")
    return salted_join(
        entries, owners, "UserAccount", "TransactionID", counts, how, rows_per_salt=rows_per_salt
    )


def posted_by(ledger: DataFrame, last_day: date) -> DataFrame:
    """Rows that can fall on or before the civil day `last_day`.

    A plain bound on the stored time, which reaches the file scan. It is a day
    wide of the exact civil cut, which any zone offset stays within.
    """
    bound = F.lit(last_day + timedelta(days=2)).cast("timestamp_ntz")
    return ledger.where(F.col("PostedAt") < bound)


def _timed(ledger: DataFrame, zone: str) -> DataFrame:
    """Replace `PostedAt` by its civil time; add its day and week end."""
    return ledger.withColumn("PostedAt", civil(F.col("PostedAt"), zone)).withColumns(
        {
            "local_date": F.to_date("PostedAt"),
            "week_end": week_end(F.to_date("PostedAt")),
        }
    )


def credit_entries(
    ledger: DataFrame, rules: CreditRules, zone: str, strict: bool = True
) -> DataFrame:
    """Withdrawals (positive) and repayments (negative) of the credit book."""
    amount = parse_amount(F.col("Amount"), strict)
    borrows = F.col("PaymentCode") == rules.borrow_code
    kept = ledger.where(F.col("PaymentCode").isin(rules.borrow_code, rules.repay_code))
    return _timed(kept, zone).select(
        "UserAccount",
        "TransactionID",
        "PaymentCode",
        "PostedAt",
        "local_date",
        "week_end",
        F.when(borrows, BORROW).otherwise(REPAY).alias("TR_Desc"),
        F.when(borrows, amount).otherwise(-amount).alias("Amount"),
    )


def cover_entries(
    ledger: DataFrame, rules: CoverRules, zone: str, strict: bool = True
) -> DataFrame:
    """Loans (positive), fees and repayments (negative) of the cover book."""
    code, amount = F.col("PaymentCode"), parse_amount(F.col("Amount"), strict)
    kept = ledger.where(code.isin(*rules.codes))
    return _timed(kept, zone).select(
        "UserAccount",
        "TransactionID",
        "PaymentCode",
        "local_date",
        "week_end",
        F.when(code == rules.fee_code, FEE)
        .when(code == rules.loan_code, LOAN)
        .otherwise(REPAYMENT)
        .alias("TType"),
        F.when(code == rules.loan_code, amount).otherwise(-amount).alias("Amount"),
    )


def unreadable_amounts(ledger: DataFrame) -> DataFrame:
    """Ledger rows whose amount text is no number."""
    text = F.col("Amount")
    return ledger.where(text.isNotNull() & parse_amount(text, strict=False).isNull())


def repeated_transactions(ledger: DataFrame) -> DataFrame:
    """Transaction ids held by more than one ledger row, with their counts."""
    return ledger.groupBy("TransactionID").count().where("count > 1")


def is_borrow() -> Column:
    return F.col("TR_Desc") == BORROW


def is_type(label: str) -> Column:
    return F.col("TType") == label
