"""Stand-ins for the input tables, derived from the order tables of a test folder.

One SQL text serves both engines (`FIXTURES.md`): Spark fills the braces with
DataFrames, a SQL oracle with table names.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from loanbook.params import Calendar, CoverRules, CreditRules
from loanbook.session import scratch_folder
from loanbook.sources import tables as tb

# 104 snapshots, 1997-01-05 to 1998-12-27.
CALENDAR = Calendar(start=date(1997, 1, 5), end=date(1998, 12, 27))
# A Wednesday.
CUTOFF = date(1997, 3, 5)

CREDIT_RULES = CreditRules(
    activity_codes=("CB-OPEN", "CB-BORROW", "CB-REPAY"),
    borrow_code="CB-BORROW",
    repay_code="CB-REPAY",
)
COVER_RULES = CoverRules(
    fee_code="CV-FEE",
    loan_code="CV-LOAN",
    repay_code="CV-REPAY",
    fee_rule_after=date(1996, 12, 31),
    upgrade_from=date(1997, 6, 1),
)

LEDGER_SQL = """
with fx_orders as (
  select o_orderkey, o_custkey, o_orderstatus,
         o_orderdate + (o_orderkey % 86400) * interval '1' second as posted,
         cast(floor(o_totalprice / 10) as bigint) as cents
  from {orders}),
fx_lines as (
  select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-',
                cast(l_partkey as string), '-', cast(l_suppkey as string)) as line_id,
         l_returnflag, o_custkey,
         l_shipdate + ((l_orderkey * 7 + l_linenumber) % 86400) * interval '1' second as posted,
         cast(floor(l_extendedprice / 10) as bigint) as cents
  from {lineitem} join {orders} on l_orderkey = o_orderkey),
fx_raw as (
  select concat('CB-B', cast(o_orderkey as string)) as txid, o_custkey as k, posted,
         'CB-BORROW' as code, cents
  from fx_orders where o_orderstatus <> 'P' and o_custkey % 5 <> 4
  union all
  select concat('CB-P', cast(o_orderkey as string)), o_custkey,
         posted + (3 + o_orderkey % 170) * interval '1' day, 'CB-REPAY', cents
  from fx_orders where o_orderstatus <> 'P' and o_custkey % 5 <> 4 and o_custkey % 3 = 0
  union all
  select concat('CB-T', cast(o_orderkey as string)), o_custkey, posted, 'CB-REPAY', 1000
  from fx_orders where o_orderstatus <> 'P' and o_orderkey % 97 = 0
  union all
  select concat('CB-R', line_id), o_custkey, posted, 'CB-REPAY', cents
  from fx_lines where l_returnflag = 'R' and o_custkey % 3 = 1
  union all
  select concat('CB-O', cast(c_custkey as string)), c_custkey,
         timestamp '1996-01-01 00:00:00' + (c_custkey % 400) * interval '1' day, 'CB-OPEN', 0
  from {customer}
  union all
  select concat('CV-L', cast(o_orderkey as string)), o_custkey, posted, 'CV-LOAN', cents
  from fx_orders where o_orderstatus <> 'P'
  union all
  select concat('CV-P', cast(o_orderkey as string)), o_custkey,
         posted + (3 + o_orderkey % 170) * interval '1' day, 'CV-REPAY', cents
  from fx_orders where o_orderstatus <> 'P' and o_custkey % 3 = 0
  union all
  select concat('CV-R', line_id), o_custkey, posted, 'CV-REPAY', cents
  from fx_lines where l_returnflag = 'R' and o_custkey % 3 = 1
  union all
  select concat('CV-F', line_id), o_custkey, posted, 'CV-FEE', 500
  from fx_lines where l_returnflag = 'N')
select txid as TransactionID, concat('A', cast(k as string)) as UserAccount,
       posted as PostedAt, code as PaymentCode,
       concat('$', cast(cast(floor(cents / 100) as bigint) as string), '.',
              lpad(cast(cents % 100 as string), 2, '0')) as Amount
from fx_raw
"""

ACCOUNTS_SQL = """
select concat('A', cast(c_custkey as string)) as account_group_identifier,
       concat('U', cast(case when c_custkey % 10 = 1 then c_custkey - 1 else c_custkey end
                        as string)) as user_reference
from {customer} where c_custkey % 50 <> 3
union all
select concat('A', cast(c_custkey as string)), concat('U', cast(c_custkey as string), 'x')
from {customer} where c_custkey % 100 = 7
"""

LOANS_SQL = """
select concat('A', cast(c_custkey as string)) as account_identifier,
       timestamp '1996-01-01 00:00:00' + (c_custkey % 400) * interval '1' day as created_at,
       case when c_custkey % 91 = 0 then null
            else timestamp '1996-06-01 05:00:00'
                 + (c_custkey * 11 % 900) * interval '1' day end as updated_at,
       case when c_custkey % 17 = 0 then 'other' else 'creditbuilding' end as loan_type,
       225 + 25 * (c_custkey % 4) as amount,
       case when c_custkey % 13 = 0 then null
            when c_custkey % 7 = 0 then 'cancelled' else 'active' end as status
from {customer}
union all
select concat('A', cast(c_custkey as string)),
       timestamp '1996-08-01 04:00:00' + (c_custkey % 400) * interval '1' day,
       timestamp '1997-02-01 05:00:00' + (c_custkey * 11 % 600) * interval '1' day,
       'creditbuilding', 500, 'active'
from {customer} where c_custkey % 4 = 0
"""

LEDGER_LINES_SQL = """
select concat('U', cast(c_custkey as string)) as user_reference,
       timestamp '1997-01-01 03:00:00' + (c_custkey % 700) * interval '1' day as line_ts,
       case when c_custkey % 6 = 0 then 'Cover Funds (Limit Upgrade)'
            else 'Cover Funds' end as description
from {customer}
"""

MIGRATION_LIST_SQL = """
select concat('U', cast(c_custkey as string)) as user_reference
from {customer} where c_nationkey in (1, 2)
union all select cast(null as string)
"""


def derive_tables(spark: SparkSession, sf_dir: str) -> tb.Tables:
    """The input tables as views over the parquet files of `sf_dir`."""
    base = {
        name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
        for name in ("orders", "lineitem", "customer")
    }

    def view(sql: str, schema) -> DataFrame:
        text = sql.replace("timestamp '", "timestamp_ntz '")
        used = {name: table for name, table in base.items() if f"{{{name}}}" in text}
        return tb.conform(spark.sql(text, **used), schema)

    return tb.Tables(
        ledger=view(LEDGER_SQL, tb.LEDGER),
        accounts=view(ACCOUNTS_SQL, tb.ACCOUNTS),
        loans=view(LOANS_SQL, tb.LOANS),
        ledger_lines=view(LEDGER_LINES_SQL, tb.LEDGER_LINES),
        migration_list=view(MIGRATION_LIST_SQL, tb.MIGRATION_LIST),
    )


_written: dict[tuple[str, str], str] = {}


def fixture_tables(spark: SparkSession, sf_dir: str) -> tb.Tables:
    """The derived tables, written once per application and read as files.

    A report scans the ledger several times for different columns; over the
    views each scan would join orders and lines again.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        root = scratch_folder(spark, "inputs")
        tb.write_tables(derive_tables(spark, sf_dir), root)
        _written[key] = root
    return tb.read_written(spark, _written[key])
