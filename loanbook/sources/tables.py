"""Input tables: declared schemas and readers.

Times are held as `timestamp_ntz` in UTC, so results do not depend on the
session's zone.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanbook.functions.dates import utc_session


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_TEXT, _TIME = T.StringType(), T.TimestampNTZType()

LEDGER = _schema(
    TransactionID=_TEXT, UserAccount=_TEXT, PostedAt=_TIME, PaymentCode=_TEXT, Amount=_TEXT
)
ACCOUNTS = _schema(account_group_identifier=_TEXT, user_reference=_TEXT)
LOANS = _schema(
    account_identifier=_TEXT,
    created_at=_TIME,
    updated_at=_TIME,
    loan_type=_TEXT,
    amount=T.LongType(),
    status=_TEXT,
)
LEDGER_LINES = _schema(user_reference=_TEXT, line_ts=_TIME, description=_TEXT)
MIGRATION_LIST = _schema(user_reference=_TEXT)


@dataclass(frozen=True)
class Tables:
    """The inputs of both books."""

    ledger: DataFrame
    accounts: DataFrame
    loans: DataFrame
    ledger_lines: DataFrame
    migration_list: DataFrame


# Names that some source tables hold these columns under.
SOURCE_NAMES = {"line_ts": "TIMESTAMP", "user_reference": "string_field_0"}

_UTC_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def conform(table: DataFrame, schema: T.StructType) -> DataFrame:
    """Pick the declared columns; instants with a zone become UTC wall-clock."""
    found = dict(table.dtypes)
    columns = []
    for field in schema:
        name = field.name if field.name in found else SOURCE_NAMES.get(field.name, field.name)
        instant = found.get(name) == "timestamp" and not utc_session()
        if isinstance(field.dataType, T.TimestampNTZType) and instant:
            micros = f"timestampadd(MICROSECOND, unix_micros(`{name}`), {_UTC_EPOCH})"
            columns.append(F.expr(micros).alias(field.name))
        else:
            columns.append(F.col(name).cast(field.dataType).alias(field.name))
    return table.select(columns)


SCHEMAS = {
    "ledger": LEDGER,
    "accounts": ACCOUNTS,
    "loans": LOANS,
    "ledger_lines": LEDGER_LINES,
    "migration_list": MIGRATION_LIST,
}


def read_tables(spark: SparkSession, root: str) -> Tables:
    """Read `{root}/<table>` parquet folders, whatever kind of time they hold."""
    found = {name: spark.read.parquet(f"{root}/{name}") for name in SCHEMAS}
    return Tables(**{name: conform(found[name], schema) for name, schema in SCHEMAS.items()})


def catalog_tables(spark: SparkSession, names: Mapping[str, str]) -> Tables:
    """Read catalog tables, named per field of `Tables`."""
    return Tables(
        **{name: conform(spark.table(names[name]), schema) for name, schema in SCHEMAS.items()}
    )


def write_tables(tables: Tables, root: str) -> None:
    for name in SCHEMAS:
        getattr(tables, name).write.parquet(f"{root}/{name}")


def read_written(spark: SparkSession, root: str) -> Tables:
    """Read what `write_tables` wrote, without looking into the files for schemas."""
    return Tables(
        **{n: spark.read.schema(s).parquet(f"{root}/{n}") for n, s in SCHEMAS.items()}
    )
