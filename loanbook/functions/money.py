"""Money text and money types. Sums stay decimal so that they are exact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def parse_amount(text: Column, strict: bool = True) -> Column:
    """`$12.50` as a decimal.

    Text that is no number after the dollar signs at its ends are gone, such as
    `-$5.00` or `$1,200.00`, raises; with `strict=False` it gives NULL.
    """
    number = F.btrim(text, F.lit("$"))
    return number.cast(MONEY) if strict else number.try_cast(MONEY)


def total(amount: Column) -> Column:
    """Sum of amounts, kept as money.

    A sum is ten digits wider than its input. Sums of sums would reach the widest
    decimal, where comparing hundredths with thousandths rounds.
    """
    return F.sum(amount).cast(MONEY)


def emit(amount: Column) -> Column:
    """Money as a report column."""
    return amount.cast("double")
