"""Hot keys, plan shapes and sinks."""

from __future__ import annotations

import re
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from loanbook.functions.dates import sundays
from loanbook.operators.asof import expand, week_span
from loanbook.operators.ledger import with_users
from loanbook.operators.running import leading, next_later, running, sliced
from loanbook.operators.salting import row_counts, salted_join
from loanbook.params import Calendar
from loanbook.plans.cover import CoverBook
from loanbook.plans.credit import CreditBook
from loanbook.sources import sinks
from loanbook.sources.fixtures import (
    CALENDAR,
    COVER_RULES,
    CREDIT_RULES,
    derive_tables,
    fixture_tables,
)
from loanbook.sources.tables import SCHEMAS, read_tables, write_tables
from tests.conftest import DATA
from tests.helpers import code_sizes, plan_text, rows_of, weeks


@pytest.fixture(scope="module")
def tables(spark):
    return fixture_tables(spark, DATA)


def test_written_inputs_equal_the_views(spark, tables, tmp_path):
    views = derive_tables(spark, DATA)
    write_tables(views, str(tmp_path))
    for source in (tables, read_tables(spark, str(tmp_path))):
        for name in SCHEMAS:
            view, read = getattr(views, name), getattr(source, name)
            assert read.dtypes == view.dtypes
            assert read.exceptAll(view).count() == 0 == view.exceptAll(read).count()


@pytest.fixture
def static_plans(spark):
    """Plans as written: no adaptive execution, no automatic broadcast."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def reports(tables, calendar=CALENDAR):
    return {
        "cover": CoverBook(tables, calendar, COVER_RULES).report(),
        "credit": CreditBook(tables, calendar, CREDIT_RULES).roll(),
    }


def test_salted_join_equals_join(spark):
    many = spark.createDataFrame(
        [(k, i) for i, k in enumerate(["hot"] * 50 + ["a", "b", None, None, "lost"])], "k string, i long"
    )
    few = spark.createDataFrame([("hot", 1), ("hot", 2), ("a", 3), ("never", 4), (None, 5)], "k string, v int")
    counts = row_counts(many, "k")
    for how in ("left", "inner"):
        plain = many.join(few, "k", how).where("v is null or i % 2 = 0 or v > 0")
        for limit in (7, 1000):
            salted = salted_join(many, few, "k", "i", counts, how, rows_per_salt=limit)
            assert rows_of(salted, "k", "i", "v") == rows_of(plain, "k", "i", "v")


def test_hot_key_is_spread(spark):
    many = spark.range(4000).select(F.lit("hot").alias("k"), "id")
    few = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = salted_join(many, few, "k", "id", row_counts(many, "k"), rows_per_salt=100)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert sum(sizes) == 4000
    assert max(sizes) < 2400


@pytest.mark.parametrize("limit", [1, 3])
def test_salts_do_not_change_reports(tables, limit):
    plain = reports(tables)
    salted = {
        "cover": CoverBook(tables, CALENDAR, COVER_RULES, rows_per_salt=limit).report(),
        "credit": CreditBook(
            tables, CALENDAR, CREDIT_RULES, rows_per_salt=limit, accounts_per_salt=1
        ).roll(),
    }
    for name, frame in plain.items():
        assert frame.exceptAll(salted[name]).count() == 0
        assert salted[name].exceptAll(frame).count() == 0


def hot_user_entries(spark):
    """One user with entries on every other minute of three days, equal times included."""
    return spark.range(3000).selectExpr(
        "if(id % 10 = 0, 'cold', 'hot') as user_reference",
        "timestampadd(MINUTE, cast(id - id % 2 as int), timestamp_ntz'2022-01-01 00:00:00') as PostedAt",
        "id",
        "cast(id * 7 % 11 - 5 as long) as v",
    ).withColumn("local_date", F.to_date("PostedAt"))


def test_running_across_days(spark):
    entries = hot_user_entries(spark)
    found = running(
        entries, ["PostedAt", "id"], sums={"total": F.col("v")},
        maxima={"top": F.when(F.col("v") < 4, F.col("id"))},
    )
    total, top, wanted = Counter(), {}, []
    for row in sorted(entries.collect(), key=lambda r: (r.PostedAt, r.id)):
        user = row.user_reference
        total[user] += row.v
        if row.v < 4:
            top[user] = max(row.id, top.get(user, row.id))
        wanted.append((row.id, total[user], top.get(user)))
    assert rows_of(found, "id", "total", "top") == sorted(wanted)


def test_next_later_across_days(spark):
    entries = hot_user_entries(spark)
    times = {}
    for row in entries.collect():
        times.setdefault(row.user_reference, set()).add(row.PostedAt)
    found = next_later(entries, "PostedAt", "later").collect()
    assert len(found) == 3000
    for row in found:
        after = [t for t in times[row.user_reference] if t > row.PostedAt]
        assert row.later == min(after, default=None)


def test_hot_users_are_cut(spark):
    """Slices of a hot user hold few rows each, equal times included, and others have one."""
    entries = hot_user_entries(spark)
    cut = sliced(entries, ["PostedAt", "id"], rows_per_slice=400)
    sizes = {(r.user_reference, r._slice): r["count"] for r in cut.rows.groupBy(*cut.keys).count().collect()}
    assert cut.hot and sizes.pop(("cold", 0)) == 300
    assert len(sizes) == 7 and max(sizes.values()) < 800 and sum(sizes.values()) == 2700
    ends = cut.rows.where("_is_hot").groupBy("_slice").agg(
        F.min(F.struct("PostedAt", "id")).alias("low"), F.max(F.struct("PostedAt", "id")).alias("high")
    )
    ordered = [(tuple(r.low), tuple(r.high)) for r in ends.orderBy("_slice").collect()]
    assert all(high < low for (_, high), (low, _) in zip(ordered, ordered[1:]))
    assert not sliced(entries, ["PostedAt"], rows_per_slice=10_000).hot


@pytest.mark.parametrize("limit", [40, 700])
def test_slices_do_not_change_running_values(spark, limit):
    entries = hot_user_entries(spark)
    cases = [
        lambda **more: running(
            entries, ["PostedAt", "id"], {"total": F.col("v")}, {"top": F.when(F.col("v") < 4, F.col("id"))}, **more
        ),
        lambda **more: next_later(entries, "PostedAt", "later", ["PostedAt", "id"], **more),
        lambda **more: next_later(entries, "PostedAt", "later", **more),
        lambda **more: leading(entries, "id", {"after": "v", "at": "PostedAt"}, **more),
    ]
    for case in cases:
        plain, cut = case(), case(rows_per_slice=limit)
        assert cut.columns == plain.columns
        assert plain.exceptAll(cut).count() == 0 == cut.exceptAll(plain).count()


def test_slices_where_all_times_are_equal(spark):
    """Ties cross slices: what follows is the first later time, wherever it is."""
    entries = spark.range(200).selectExpr(
        "'hot' as user_reference", "id",
        "timestampadd(DAY, cast(if(id < 150, 0, if(id < 160, 1, 2)) as int), timestamp_ntz'2022-01-01 00:00:00') as PostedAt",
    )
    found = next_later(entries, "PostedAt", "later", ["PostedAt", "id"], rows_per_slice=20)
    days = [(r.PostedAt.day, r.later and r.later.day, r["count"]) for r in found.groupBy("PostedAt", "later").count().collect()]
    assert sorted(days, key=str) == [(1, 2, 150), (2, 3, 10), (3, None, 40)]


def test_slices_do_not_change_the_book(tables):
    book = {limit: CreditBook(tables, CALENDAR, CREDIT_RULES, rows_per_slice=limit) for limit in (5, 10**6)}
    for name in ("running_balance", "withdrawals", "withdrawal_repayments"):
        cut, plain = (getattr(book[limit], name)() for limit in (5, 10**6))
        columns = plain.columns
        assert plain.exceptAll(cut.select(columns)).count() == 0 == cut.select(columns).exceptAll(plain).count()


def test_scans_and_shuffles(static_plans, tables):
    """Each query reads the ledger once besides the account facts; days parted twice."""
    book, cover = CreditBook(tables, CALENDAR, CREDIT_RULES), CoverBook(tables, CALENDAR, COVER_RULES)
    wanted = {
        "running": (book.running_balance(), 1, 5),
        "next": (book.withdrawals(), 1, 5),
        "repayments": (book.withdrawal_repayments(), 0, 4),
        "accounts": (book.accounts(), 0, 2),
        "states": (book.state_snapshots(), 2, 12),
        "roll": (book.roll(), 2, 17),
        "access": (book.access_counts(), 0, 3),
        "since": (cover.since_first_loan(), 1, 8),
        "status": (cover.status_counts(), 1, 6),
    }
    for name, (frame, scans, shuffles) in wanted.items():
        plan = plan_text(frame)
        assert len(re.findall(r"FileScan parquet \[[^\]]*PaymentCode", plan)) == scans, name
        assert len(re.findall(r"FileScan parquet \[[^\]]*loan_type", plan)) <= 1, name
        assert len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan)) <= shuffles, name
    # Nothing runs along the raw entries of a day.
    assert "TransactionID" not in plan_text(book.days()).split("HashAggregate")[0]
    assert "Window" not in plan_text(book.days())
    assert "explode" not in plan_text(cover.status_counts())


def test_sundays(spark):
    days = [date(2022, 1, 1) + timedelta(days=i) for i in range(30)]
    pairs = spark.createDataFrame([(a, b) for a in days for b in days], "a date, b date")
    for a, b, n in pairs.select("a", "b", sundays(F.col("a"), F.col("b"))).collect():
        assert n == sum(d.weekday() == 6 for d in days if a <= d <= b)


def test_counts_equal_the_rows(tables):
    """Counted from spans or from the rows themselves, in calendars that cut the spans."""
    for calendar in (CALENDAR, Calendar(CALENDAR.end - timedelta(weeks=9), CALENDAR.end), weeks("1900-01-01", "1900-02-01")):
        cover, credit = CoverBook(tables, calendar, COVER_RULES), CreditBook(tables, calendar, CREDIT_RULES)
        for counts, rows, name in (
            (cover.status_counts(), cover.state_snapshots(), "snapshot_status"),
            (credit.access_counts(), credit.report().where("ever_accessed is not null"), "ever_accessed"),
        ):
            wanted = rows.groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n"))
            assert rows_of(counts, "value", "n") == rows_of(wanted, "value", "n")


def test_expand_clamps_to_the_calendar(spark):
    calendar = weeks("2022-01-09", "2022-01-30")
    spans = spark.createDataFrame(
        [
            ("open", None, None),
            ("inside", date(2022, 1, 16), date(2022, 1, 23)),
            ("early", date(2021, 1, 3), date(2022, 1, 2)),
            ("late", date(2022, 2, 6), None),
        ],
        "k string, a date, b date",
    )
    found = rows_of(expand(spans, F.col("a"), F.col("b"), calendar), "k", "snapshot")
    assert [k for k, _ in found] == ["inside"] * 2 + ["open"] * 4
    assert [d for k, d in found if k == "open"] == calendar.snapshots


def test_week_span_of_nothing(spark):
    days = spark.createDataFrame([], "week_end date")
    assert week_span(days, weeks("2022-01-09", "2022-01-30")).count() == 0


def test_grain_is_unique(tables):
    frames = reports(tables)
    for name, key in {
        "cover": ["snapshot", "user_reference"],
        "credit": ["snapshot", "user_reference", "account_identifier"],
    }.items():
        assert frames[name].groupBy(key).count().where("count > 1").count() == 0


def test_rows_do_not_depend_on_partitions(spark, tables):
    few = {name: frame.collect() for name, frame in reports(tables).items()}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        many = {name: frame.collect() for name, frame in reports(tables).items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for name in few:
        assert Counter(few[name]) == Counter(many[name])


def test_shorter_calendar_is_a_part_of_the_longer(tables):
    """Rows of a week do not depend on the weeks computed with it."""
    late = Calendar(CALENDAR.end - timedelta(weeks=10), CALENDAR.end)
    for name in ("cover", "credit"):
        part = reports(tables, late)[name]
        whole = reports(tables)[name].where(F.col("snapshot") >= F.lit(late.first))
        assert part.count() > 0
        assert part.exceptAll(whole).count() == 0
        assert whole.exceptAll(part).count() == 0


def test_plans(static_plans, tables):
    one_week = Calendar(CALENDAR.end, CALENDAR.end)
    for name, frame in reports(tables).items():
        plan = plan_text(frame)
        for banned in ("BroadcastNestedLoopJoin", "CartesianProduct", "Python", "RangePartitioning"):
            assert banned not in plan
        # Expansion is last: nothing is shuffled or sorted after it.
        before_expansion = plan.split("explode(sequence(_from")[0]
        assert "Exchange" not in before_expansion
        assert "Sort " not in before_expansion
        scans = plan.count("FileScan")
        assert plan_text(reports(tables, one_week)[name]).count("FileScan") == scans
        # The bound of the calendar and the codes reach the ledger scan.
        assert "LessThan(PostedAt,1998-12-29T00:00)" in plan
        assert "In(PaymentCode" in plan
        # Larger methods are not compiled by the JVM.
        assert max(code_sizes(frame)) < 8000


def test_mapping_keeps_unmapped_accounts(tables):
    mapped = with_users(tables.ledger, tables.accounts)
    assert mapped.where("user_reference is null").count() > 0
    assert mapped.select("TransactionID").distinct().count() == (
        tables.ledger.select("TransactionID").distinct().count()
    )


def test_overwrite_replaces(spark, tables, tmp_path):
    path = str(tmp_path / "report")
    cover = reports(tables)["cover"]
    sinks.write_parquet(tables.accounts, path)
    sinks.write_parquet(cover, path)
    back = spark.read.parquet(path)
    assert back.columns == cover.columns
    assert back.exceptAll(cover).count() == 0 == cover.exceptAll(back).count()
    sinks.write_parquet(cover, path, by_snapshot=True)
    assert spark.read.parquet(f"{path}/snapshot=1998-12-27").count() == (
        cover.where("snapshot = '1998-12-27'").count()
    )


def test_table_sink(spark, tables, tmp_path):
    name = "cover_accounts_test"
    spark.sql(f"drop table if exists {name}")
    try:
        for _ in range(2):
            sinks.write_table(tables.accounts, name)
        assert spark.table(name).count() == tables.accounts.count()
    finally:
        spark.sql(f"drop table if exists {name}")


def test_csv_index_follows_the_order(spark, tmp_path):
    rows = spark.range(1000).selectExpr("if(id % 7 = 0, null, concat('u', id % 13)) as u", "id").repartition(5)
    path = str(tmp_path / "csv")
    sinks.write_csv(rows, path, "row", ["u", "id"])
    found = sinks.read_csv(spark, path, "row bigint, u string, id bigint").orderBy("row").collect()
    wanted = sorted(((r.u is None, r.u or "", r.id) for r in rows.collect()))
    assert [r.row for r in found] == list(range(1000))
    assert [(r.u is None, r.u or "", r.id) for r in found] == wanted
    sinks.write_csv(rows, path)
    assert sinks.read_csv(spark, path, rows.schema).columns == ["u", "id"]


def test_numbered_csv_stays_small(spark, tmp_path, monkeypatch):
    """Compressed files with the same rows, from sorted partitions that are not merged by their size on the wire."""
    from loanbook.plans import catalog

    path = str(tmp_path / "accessed")
    monkeypatch.setattr(catalog, "scratch_folder", lambda spark, label: path)
    found = catalog.QUERIES["sink_csv"](spark, DATA)
    files = [f.name for f in (tmp_path / "accessed").iterdir() if f.name.startswith("part-")]
    assert files and all(name.endswith(".csv.gz") for name in files)
    assert [r.row for r in found.select("row").orderBy("row").collect()] == list(range(found.count()))
    ordered = sinks.with_index(spark.range(1000).withColumn("u", F.lit("a")), "row", ["u", "id"])
    assert ordered.select(F.spark_partition_id()).distinct().count() == 4
    plain = str(tmp_path / "plain")
    sinks.write_csv(found.limit(5), plain)
    assert any(f.name.endswith(".csv") for f in (tmp_path / "plain").iterdir())
