"""Small hand-made inputs and plan inspection."""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from loanbook.params import Calendar, CoverRules, CreditRules
from loanbook.sources import tables as tb

CREDIT = CreditRules(activity_codes=("open", "borrow", "repay"), borrow_code="borrow", repay_code="repay")
COVER = CoverRules(
    fee_code="fee",
    loan_code="loan",
    repay_code="back",
    fee_rule_after=date(2021, 12, 31),
    upgrade_from=date(2022, 3, 1),
)


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def weeks(start: str, end: str, **more) -> Calendar:
    return Calendar(date.fromisoformat(start), date.fromisoformat(end), **more)


def make_tables(
    spark: SparkSession,
    ledger: list[tuple],
    accounts: list[tuple],
    loans: list[tuple] = (),
    lines: list[tuple] = (),
    migrated: list[str | None] = (),
) -> tb.Tables:
    """`ledger` rows are (account, posted UTC text, code, amount text)."""
    rows = [
        (f"T{i:05d}", account, ts(posted), code, amount)
        for i, (account, posted, code, amount) in enumerate(ledger)
    ]
    return tb.Tables(
        ledger=spark.createDataFrame(rows, tb.LEDGER),
        accounts=spark.createDataFrame(list(accounts), tb.ACCOUNTS),
        loans=spark.createDataFrame(list(loans), tb.LOANS),
        ledger_lines=spark.createDataFrame(list(lines), tb.LEDGER_LINES),
        migration_list=spark.createDataFrame([(u,) for u in migrated], tb.MIGRATION_LIST),
    )


def rows_of(frame: DataFrame, *columns: str) -> list[tuple]:
    """Rows as tuples, sorted with NULLs last."""
    found = [tuple(row) for row in frame.select(*columns or frame.columns).collect()]
    return sorted(found, key=lambda row: tuple((v is None, v if v is not None else 0) for v in row))


def plan_text(frame: DataFrame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def code_sizes(frame: DataFrame) -> list[int]:
    """Bytecode size of the largest method of each generated stage."""
    explain = frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "codegen")
    return [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", explain)]
