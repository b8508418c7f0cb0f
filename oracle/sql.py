"""DuckDB statements that the queries are compared with.

They state each result per snapshot: every week end looks again at all entries
posted by then. Nothing is carried from one snapshot to the next, which is how
the Spark plans work, so agreement tests that rewrite.
"""

from __future__ import annotations

from loanbook.params import ZONE
from loanbook.sources import fixtures as fx

_TABLES = {name: name for name in ("orders", "lineitem", "customer")}
_CAL, _CV = fx.CALENDAR, fx.COVER_RULES


def _local(column: str) -> str:
    return f"({column} at time zone 'UTC' at time zone '{ZONE}')"


def _week(day: str) -> str:
    return f"(cast(date_trunc('week', {day}) as date) + 6)"


def _table(sql: str) -> str:
    return f"({sql.format(**_TABLES)})"


INPUTS = f"""
ledger as {_table(fx.LEDGER_SQL)},
accounts as {_table(fx.ACCOUNTS_SQL)},
loans as {_table(fx.LOANS_SQL)},
ledger_lines as {_table(fx.LEDGER_LINES_SQL)},
migration_list as {_table(fx.MIGRATION_LIST_SQL)},
cal as (
  -- One more week at the front, for what is compared with the week before.
  select cast(unnest(generate_series(date '{_CAL.first}' - interval 7 day, date '{_CAL.last}',
                                     interval 7 day)) as date) as snapshot),
owners as (
  select account_group_identifier as acct, user_reference as usr
  from accounts group by all),
posted as (
  select o.usr, l.UserAccount as acct, l.TransactionID as txid, l.PaymentCode as code,
         {_local('l.PostedAt')} as ts, cast({_local('l.PostedAt')} as date) as day,
         cast(replace(l.Amount, '$', '') as decimal(18,2)) as amt
  from ledger l left join owners o on l.UserAccount = o.acct)
"""

CREDIT = f"""
cb as (
  select *, if(code = 'CB-BORROW', 'Borrow', 'Repay') as kind
  from posted where code in ('CB-BORROW', 'CB-REPAY')),
cb_opening as (select acct, min(ts) as first_loan from cb where kind = 'Borrow' group by acct),
cb_valid as (
  select cb.*, first_loan, if(kind = 'Borrow', amt, -amt) as signed
  from cb join cb_opening using (acct)
  where usr is not null and (kind = 'Borrow' or ts >= first_loan)),
cb_followed as (
  select *, cast(min(ts) filter (where kind = 'Borrow') over (
      partition by usr order by ts
      range between interval 1 microsecond following and unbounded following) as date) as renewed
  from cb_valid),
cb_tail as (
  select cal.snapshot, e.usr, max(ts) as last_ts, sum(signed) as bal,
         max(ts) filter (where kind = 'Borrow') as borrow_ts,
         sum(amt) filter (where kind = 'Borrow' and {_week('day')} = snapshot) as wk_out,
         sum(amt) filter (where kind = 'Repay' and {_week('day')} = snapshot) as wk_in,
         -- Repaid at or after the last withdrawal seen: none later is seen.
         max(ts) filter (where kind = 'Repay' and (renewed is null or renewed > snapshot)) as repay_ts,
         sum(amt) filter (where kind = 'Repay' and (renewed is null or renewed > snapshot)) as since
  from cal join cb_followed e on e.day <= cal.snapshot
  group by cal.snapshot, e.usr),
cb_state as (
  select * exclude (repay_ts, since), ifnull(repay_ts = last_ts, false) as settles,
         if(repay_ts = last_ts, repay_ts, null) as repay_ts,
         if(repay_ts = last_ts, borrow_ts, null) as prev_ts,
         if(repay_ts = last_ts, since, null) as repaid,
         if(repay_ts = last_ts, since + bal, bal) as prev_os,
         if(abs(bal) <= 0.01, 0, bal) as os
  from cb_tail),
cb_due as (
  select *, case
      when prev_ts is null then last_ts
      when prev_os <= 67.50 then prev_ts
      when repaid >= prev_os then prev_ts
      when repaid >= 67.50 and repaid >= 0.3 * prev_os then last_ts
      else prev_ts end + interval 30 day as due_at
  from cb_state),
cb_weeks as (
  select *, cast(due_at as date) as due, snapshot - cast(due_at as date) as late,
    case when os <= 0 or late <= 0 then '1. Current'
         when late <= 30 then '2. 1 to 30'
         when late <= 60 then '3. 31 to 60'
         when late <= 90 then '4. 61 to 90'
         else '5. 91+' end as bucket
  from cb_due),
cb_aged as (select * from cb_weeks where snapshot >= date '{_CAL.first}')
"""

SPINE = f"""
acted as (
  select usr, acct, min(day) as first_day,
         if(bool_or(code = 'CB-BORROW'), 'Yes', null) as ever
  from posted where code like 'CB-%' group by usr, acct),
newest as (
  select account_identifier as acct, min(created_at) as opened, max(created_at) as created
  from loans where loan_type = 'creditbuilding' group by 1),
terms as (
  select n.acct, {_local('n.opened')} as open_ts, l.loan_type, l.amount as lim, l.status,
         {_local('l.updated_at')} as upd
  from newest n join loans l on l.account_identifier = n.acct and l.created_at = n.created),
spine as (
  select a.usr, a.acct, a.first_day, a.ever, t.open_ts, t.loan_type, t.lim, t.status, t.upd
  from acted a join terms t using (acct)),
live_weeks as (
  select cal.snapshot, s.* from cal join spine s on s.first_day <= cal.snapshot
  where not (s.status = 'cancelled' and last_day(cast(s.upd as date)) < cal.snapshot)),
live as (select * from live_weeks where snapshot >= date '{_CAL.first}')
"""

CB_REPORT = f"""
cb_view_weeks as (
  select l.snapshot, if(b.usr is not null, 'Yes', 'No') as accessed, l.usr as user_reference,
         l.acct as account_identifier, cast(l.open_ts as date) as open_date, l.loan_type,
         cast(l.lim as bigint) as "CBLimit",
         case when b.usr is not null then b.bucket
              when l.status = 'cancelled' and cast(l.upd as date) <= l.snapshot
                then '6. Cancelled'
              else '1. Current' end as snapshot_status,
         cast(ifnull(b.wk_out, 0) as double) as in_month_withdrawals,
         cast(ifnull(b.wk_in, 0) as double) as in_month_repayments,
         cast(ifnull(b.os, 0) as double) as "OS",
         ifnull(b.due, l.snapshot) as due_date,
         l.snapshot - 7 as prev_snap,
         last_day(cast(l.open_ts as date)) as cohort_end_month,
         {_week('cast(l.open_ts as date)')} as cohort_end,
         l.ever as ever_accessed
  from live_weeks l left join cb_weeks b on b.snapshot = l.snapshot and b.usr = l.usr),
cb_view as (select * from cb_view_weeks where snapshot >= date '{_CAL.first}'),
cb_lagged as (
  select *, lag(snapshot_status) over (
      partition by user_reference, account_identifier order by snapshot) as above
  from cb_view_weeks),
cb_prior as (select * from cb_lagged where snapshot >= date '{_CAL.first}'),
cb_rolled as (
  select * exclude (above),
    case when ever_accessed = 'Yes' and above is not null then above
         when snapshot = cohort_end then '0. non existent' else '1. Current' end as prev_status,
    case when ever_accessed = 'Yes' and above is not null then '0. No'
         when snapshot = cohort_end then '1. Yes' else '0. No' end as new_loan
  from cb_prior),
cb_final as (
  select *, case
      when ever_accessed is null or snapshot_status <> '5. 91+' then '3. NA'
      when prev_status = '5. 91+' then '2. No' else '1. Yes' end as new_default
  from cb_rolled)
"""

COVER = f"""
cv as (
  select *, case code when 'CV-FEE' then '1. fee' when 'CV-LOAN' then '2. loan'
                      else '3. repayment' end as kind
  from posted
  where code in ('CV-FEE', 'CV-LOAN', 'CV-REPAY') and usr is not null),
cv_followed as (
  select *, {_week('day')} as wk,
         min(day) filter (where kind = '2. loan') over (partition by usr) as first_loan,
         min(day) filter (where kind = '2. loan') over (
             partition by usr order by day
             range between current row and unbounded following) as renewed
  from cv),
cv_sums as (
  select cal.snapshot, s.usr,
         max(day) filter (where kind = '2. loan') as last_loan,
         max(day) filter (where kind = '1. fee') as last_fee,
         max(day) filter (where kind = '3. repayment') as last_pay,
         sum(if(kind = '2. loan', amt, -amt))
           filter (where kind <> '1. fee' and day >= first_loan) as os,
         -- Fees after the last loan seen: no loan on their day or later is seen.
         count(*) filter (where kind = '1. fee' and (renewed is null or renewed > snapshot)) as fees,
         max(if(kind = '2. loan', 1, null)) filter (where wk = snapshot) as n_out,
         sum(amt) filter (where kind = '2. loan' and wk = snapshot) as out,
         nullif(count(*) filter (where kind = '3. repayment' and wk = snapshot), 0) as n_in,
         sum(amt) filter (where kind = '3. repayment' and wk = snapshot) as back
  from cal join cv_followed s on s.day <= cal.snapshot
  group by cal.snapshot, s.usr having count(*) filter (where kind = '2. loan') > 0),
cv_dated as (
  select *, floor((snapshot - last_loan) / 30.0) as expected, last_loan + 30 as orig_due,
    case when last_loan <= date '{_CV.fee_rule_after}' then last_loan + 30
         when fees < expected then last_loan + cast((1 + fees) * 30 as integer)
         else ifnull(last_fee, last_loan) + 30 end as due,
    case when last_pay is null or last_pay < last_loan then last_loan else last_pay end as upd
  from cv_sums),
cv_weeks as (
  select *, snapshot - due as late,
    case when os = 0 then '1. Inactive'
         when os < 0 then '7. Balance Issue'
         when late <= 0 then '2. current'
         when late <= 30 then '3. 1 to 30'
         when late <= 60 then '4. 31 to 60'
         when late <= 90 then '5. 61 to 90'
         else '6. 91+' end as bucket
  from cv_dated),
cv_lagged as (
  select *, snapshot - 7 as prev_snap, upd - due as paid_late,
         ifnull(lag(bucket) over (partition by usr order by snapshot), '0. non existent') as before
  from cv_weeks),
cv_prior as (select * from cv_lagged where snapshot >= date '{_CAL.first}'),
cv_aged as (select * from cv_prior),
cv_rolled as (
  select *, if({_week('last_loan')} = snapshot, 'Yes', 'No') as new_loan,
    case when bucket <> '1. Inactive' then '4. NA'
         when paid_late <= 0 then '1. paid on time'
         when paid_late > 90 and before = '6. 91+' then '3. paid after default'
         else '2. paid late' end as paid_class,
    case when bucket <> '6. 91+' then '3. NA' when before <> '6. 91+' then '1. Yes'
         else '2. No' end as new_default,
    case when bucket <> '1. Inactive' then '3. NA'
         when {_week('last_pay')} = snapshot then '1. Yes' else '2. No' end as paid_in_cohort
  from cv_prior),
cv_graduated as (
  select distinct user_reference as usr from ledger_lines
  where cast(line_ts as date) >= date '{_CV.upgrade_from}'
    and description = '{_CV.upgrade_text}'),
cv_flagged as (
  select *,
    case when usr in (select usr from cv_graduated) then 1 else 0 end as grad_flag,
    case when usr in (select user_reference from migration_list) then 1 else 0
      end as migration_flag
  from cv_rolled)
"""

_CV_REPORT_BODY = f"""
select snapshot, usr as user_reference, cast(os as double) as "OS",
       last_loan as last_loan_date, last_fee as last_fee_date, last_pay as last_payment_date,
       fees as num_fee_payments, cast(expected as double) as num_expected_fee_payments,
       orig_due as orig_due_date, due as due_date, upd as update_date,
       n_out as num_loans_in_week, cast(out as double) as total_loaned_in_week,
       n_in as num_repayments_in_week, cast(back as double) as total_repaid_in_week,
       prev_snap, {_week('last_loan')} as cohort_end, {_week('last_pay')} as cohort_paid,
       bucket as snapshot_status, grad_flag, migration_flag, before as prev_status,
       new_loan, paid_class, new_default, paid_in_cohort
from cv_flagged
"""

_CB_VIEW_COLUMNS = """
snapshot, accessed, user_reference, account_identifier, open_date, loan_type, "CBLimit",
snapshot_status, in_month_withdrawals, in_month_repayments, "OS", due_date, prev_snap,
cohort_end_month, cohort_end, ever_accessed
"""


def _with(body: str, *parts: str) -> str:
    return "with " + ",".join([INPUTS, *parts]) + body


_SPOILED = """
, minus as (
  select TransactionID, PaymentCode,
         if(ends_with(TransactionID, '7'), '-' || Amount, Amount) as Amount
  from ledger),
spoiled as (
  select * from minus union all select * from minus where PaymentCode = 'CV-FEE')"""


ORACLES: dict[str, str] = {
    "account_map": _with(
        "select acct as account_group_identifier, usr as user_reference from owners"
    ),
    "ledger_normalize": _with(f"""
select if(code like 'CB-%', 'credit', 'cover') as book, usr as user_reference,
       acct as "UserAccount", txid as "TransactionID", code as "PaymentCode",
       day as local_date, {_week('day')} as week_end,
       case code when 'CB-BORROW' then 'Borrow' when 'CB-REPAY' then 'Repay'
                 when 'CV-FEE' then '1. fee' when 'CV-LOAN' then '2. loan'
                 else '3. repayment' end as entry,
       cast(if(code in ('CB-BORROW', 'CV-LOAN'), amt, -amt) as double) as amount
from posted where code <> 'CB-OPEN'"""),
    "ledger_filter": _with("""
select TransactionID as "TransactionID", PaymentCode as "PaymentCode",
       cast(PaymentCode like 'CB-%' as integer) as is_activity,
       cast(PaymentCode = 'CB-BORROW' as integer) as is_borrow,
       cast(PaymentCode = 'CB-REPAY' as integer) as is_repay,
       cast(PaymentCode like 'CV-%' as integer) as is_cover,
       cast(PaymentCode = 'CV-FEE' as integer) as is_fee,
       cast(PaymentCode = 'CV-LOAN' as integer) as is_loan
from ledger"""),
    "local_dates": _with(f"""
select TransactionID as "TransactionID", PostedAt as "PostedAt",
       {_local('PostedAt')} as local_time, cast({_local('PostedAt')} as date) as local_date
from ledger"""),
    "week_bounds": """
select distinct d as day, d + cast((7 - isodow(d)) as integer) as week_end,
       d - cast(isodow(d) as integer) as prev_snap,
       cast(date_trunc('month', d) + interval 1 month - interval 1 day as date) as month_end,
       d + cast((7 - isodow(d)) as integer) as coming_sunday,
       d + cast((8 - isodow(d)) as integer) as next_monday,
       d + cast((if(isodow(d) < 4, 4, 11) - isodow(d)) as integer) as next_thursday,
       d - cast(isodow(d) as integer) as sunday_before
from (select cast(o_orderdate as date) as d from orders)""",
    "snapshot_calendar": _with(f"""
select cast(s as date) as snapshot, cast(s as date) - 7 as prev_snap,
       cast(cast(s as date) between date '{_CAL.first}' and date '{_CAL.last}' as integer)
         as reported
from (select unnest(generate_series(min({_week('day')}), max({_week('day')}),
                                    interval 7 day)) as s from posted)"""),
    "asof_expand": _with(
        f"""
select snapshot, usr as user_reference, count(*) as entries, max(day) as last_day
from cal join cv on day <= snapshot
where snapshot >= date '{_CAL.first}' group by all""",
        COVER,
    ),
    "repay_after_first_loan": _with(
        """
select 'credit' as book, usr as user_reference, acct as "UserAccount", txid as "TransactionID",
       cast(first_loan as date) as first_loan_date, cast(signed as double) as amount
from cb_valid where kind = 'Repay'
union all
select 'cover', r.usr, r.acct, r.txid, f.first_day, cast(-r.amt as double)
from cv r join (select usr, min(day) as first_day from cv where kind = '2. loan' group by usr) f
  on f.usr = r.usr and r.day >= f.first_day
where r.kind = '3. repayment'""",
        CREDIT,
        COVER,
    ),
    "running_balance": _with(
        """
select usr as user_reference, acct as "UserAccount", txid as "TransactionID", ts as "PostedAt",
       kind as "TR_Desc", cast(signed as double) as amount,
       cast(sum(signed) over (partition by usr order by ts, kind, txid
            rows between unbounded preceding and current row) as double) as "OS"
from cb_valid""",
        CREDIT,
    ),
    "next_withdrawal": _with(
        """
select a.usr as user_reference, a.acct as "UserAccount", a.txid as "TransactionID",
       a.ts as "PostedAt", cast(a.amt as double) as amount, min(b.ts) as next_withdrawal_date
from cb_valid a left join cb_valid b on b.usr = a.usr and b.kind = 'Borrow' and b.ts > a.ts
where a.kind = 'Borrow' group by all""",
        CREDIT,
    ),
    "withdrawal_repayments": _with(
        """
, pairs as (
  select a.usr, a.txid, a.ts, min(b.ts) as next_ts
  from cb_valid a left join cb_valid b on b.usr = a.usr and b.kind = 'Borrow' and b.ts > a.ts
  where a.kind = 'Borrow' group by a.usr, a.txid, a.ts)
select p.usr as user_reference, p.txid as "TransactionID", p.ts as "PostedAt",
       p.next_ts as next_withdrawal_date, max(r.ts) as "RepaymentDate",
       cast(sum(r.signed) as double) as "RepaymentAmount"
from pairs p left join cb_valid r
  on r.usr = p.usr and r.kind = 'Repay' and r.ts >= p.ts and (p.next_ts is null or r.ts <= p.next_ts)
group by all""",
        CREDIT,
    ),
    "last_withdrawal_group": _with(
        """
select snapshot, usr as user_reference, prev_ts as "PrevWithdrawDate",
       repay_ts as "RepaymentDate", cast(repaid as double) as "RepaymentAmount"
from cb_aged where prev_ts is not null""",
        CREDIT,
    ),
    "cb_weekly_flows": _with(
        f"""
select usr as user_reference, {_week('day')} as week_end,
       cast(sum(amt) filter (where kind = 'Borrow') as double) as withdrawals,
       cast(sum(amt) filter (where kind = 'Repay') as double) as repayments
from cb_valid group by 1, 2""",
        CREDIT,
    ),
    "cb_states": _with(
        """
select snapshot, usr as user_reference, last_ts as "last_TR",
       if(settles, 'Repay', 'Borrow') as "Last_TR_Desc", prev_ts as "PrevWithdrawDate",
       cast(os as double) as "OS", cast(wk_out as double) as in_month_withdrawals,
       cast(wk_in as double) as in_month_repayments,
       cast(repaid as double) as "RepaymentAmount", cast(prev_os as double) as "prev_OS"
from cb_aged""",
        CREDIT,
    ),
    "cb_due_date": _with(
        """
select snapshot, usr as user_reference, last_ts as "last_TR", prev_ts as "PrevWithdrawDate",
       cast(repaid as double) as "RepaymentAmount", cast(prev_os as double) as "prev_OS", due_at
from cb_aged""",
        CREDIT,
    ),
    "dpd_bucket": _with(
        """
select 'credit' as book, snapshot, usr as user_reference, cast(os as double) as "OS",
       due as due_date, cast(late as integer) as days_past_due, bucket as snapshot_status
from cb_aged
union all
select 'cover', snapshot, usr, cast(os as double), due, cast(late as integer), bucket
from cv_aged""",
        CREDIT,
        COVER,
    ),
    "cb_accounts": _with(
        f"""
select usr as user_reference, acct as account_identifier, {_week('first_day')} as first_week,
       ever as ever_accessed, open_ts as open_date, loan_type, cast(lim as bigint) as "CBLimit",
       status, upd as updated_at
from spine""",
        SPINE,
    ),
    "cb_stale_filter": _with(
        """
select snapshot, usr as user_reference, acct as account_identifier, status, upd as updated_at
from live""",
        SPINE,
    ),
    "cohorts": _with(
        f"""
select 'credit' as book, acct as subject, {_week('cast(open_ts as date)')} as cohort_end,
       last_day(cast(open_ts as date)) as cohort_end_month, cast(null as date) as cohort_paid
from terms
union all
select 'cover', usr, {_week('last_loan')}, null, {_week('last_pay')}
from cv_aged where snapshot = date '{_CAL.last}'""",
        SPINE,
        COVER,
    ),
    "ever_accessed": _with(
        """
select usr as user_reference, acct as account_identifier, ever as ever_accessed from acted""",
        SPINE,
    ),
    "cb_report": _with(f"select {_CB_VIEW_COLUMNS} from cb_view", CREDIT, SPINE, CB_REPORT),
    "cb_roll": _with(
        f"select {_CB_VIEW_COLUMNS}, prev_status, new_loan, new_default from cb_final",
        CREDIT,
        SPINE,
        CB_REPORT,
    ),
    "cb_roll_legacy": _with(
        f"""
select {_CB_VIEW_COLUMNS},
       if(ever_accessed = 'Yes', '0. non existent', prev_status) as prev_status,
       if(ever_accessed = 'Yes', '0. No', new_loan) as new_loan, new_default
from cb_final""",
        CREDIT,
        SPINE,
        CB_REPORT,
    ),
    "cover_last_dates": _with(
        """
select snapshot, usr as user_reference, last_loan as last_loan_date, last_fee as last_fee_date,
       last_pay as last_payment_date
from cv_aged""",
        COVER,
    ),
    "cover_weekly_flows": _with(
        f"""
select usr as user_reference, {_week('day')} as week_end,
       max(1) filter (where kind = '2. loan') as num_loans_in_week,
       nullif(count(*) filter (where kind = '3. repayment'), 0) as num_repayments_in_week,
       cast(sum(amt) filter (where kind = '2. loan') as double) as total_loaned_in_week,
       cast(sum(amt) filter (where kind = '3. repayment') as double) as total_repaid_in_week
from cv where kind <> '1. fee' group by 1, 2""",
        COVER,
    ),
    "cover_fee_counts": _with(
        """
select snapshot, usr as user_reference, fees as num_fee_payments,
       cast(expected as double) as num_expected_fee_payments
from cv_aged""",
        COVER,
    ),
    "cover_states": _with(
        """
select snapshot, usr as user_reference, last_loan as last_loan_date, last_fee as last_fee_date,
       last_pay as last_payment_date, fees as num_fee_payments, n_out as num_loans_in_week,
       n_in as num_repayments_in_week, cast(os as double) as "OS",
       cast(out as double) as total_loaned_in_week, cast(back as double) as total_repaid_in_week
from cv_aged""",
        COVER,
    ),
    "cover_due_date": _with(
        """
select snapshot, usr as user_reference, orig_due as orig_due_date, due as due_date,
       upd as update_date
from cv_aged""",
        COVER,
    ),
    "cover_flags": _with(
        """
select usr as user_reference,
       case when usr in (select usr from cv_graduated) then 1 else 0 end as grad_flag,
       case when usr in (select user_reference from migration_list) then 1 else 0
         end as migration_flag
from (select distinct usr from owners)""",
        COVER,
    ),
    "cover_prev_status": _with(
        """
select snapshot, usr as user_reference, prev_snap, bucket as snapshot_status,
       before as prev_status
from cv_prior""",
        COVER,
    ),
    "cover_paid_class": _with(
        """
select snapshot, usr as user_reference, cast(paid_late as integer) as days_between_paid_and_due,
       paid_class
from cv_rolled""",
        COVER,
    ),
    "cover_roll": _with(
        """
select snapshot, usr as user_reference, new_loan, new_default, paid_in_cohort from cv_rolled""",
        COVER,
    ),
    "cover_report": _with(_CV_REPORT_BODY, COVER),
    "status_counts": _with(
        """
select 'credit' as book, ever_accessed as value, count(*) as n
from cb_view where ever_accessed is not null group by all
union all
select 'cover', bucket, count(*) from cv_aged group by all""",
        CREDIT,
        SPINE,
        CB_REPORT,
        COVER,
    ),
    "sink_overwrite": _with(_CV_REPORT_BODY, COVER),
    "sink_csv": _with(
        f"""
select row_number() over (order by user_reference nulls last, snapshot, account_identifier) - 1
         as "row", {_CB_VIEW_COLUMNS}
from cb_view where ever_accessed = 'Yes'""",
        CREDIT,
        SPINE,
        CB_REPORT,
    ),
    "sink_csv_plain": _with(
        """
select usr as user_reference,
       case when usr in (select usr from cv_graduated) then 1 else 0 end as grad_flag,
       case when usr in (select user_reference from migration_list) then 1 else 0
         end as migration_flag
from (select distinct usr from owners)""",
        COVER,
    ),
    "calendar_cutoff": _with(
        f"""
select snapshot, usr as user_reference, last_loan as last_loan_date, fees as num_fee_payments
from cv_aged where snapshot <= date '{fx.CUTOFF}'""",
        COVER,
    ),
    "amount_rejects": _with(
        f"""
{_SPOILED}
select TransactionID as "TransactionID", Amount as "Amount" from spoiled
where try_cast(trim(Amount, '$') as decimal(18,2)) is null""",
    ),
    "repeated_ids": _with(
        f"""
{_SPOILED}
select TransactionID as "TransactionID", count(*) as count from spoiled
group by 1 having count(*) > 1""",
    ),
}
