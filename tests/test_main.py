"""The command line with the rules' own codes and calendars."""

from __future__ import annotations

import shutil
import subprocess
import sys
from datetime import date
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from loanbook.main import run
from loanbook.plans.catalog import QUERIES
from loanbook.plans.cover import CoverBook
from loanbook.session import scratch_root
from loanbook.sources import sinks
from loanbook.sources.tables import LEDGER_LINES, catalog_tables, conform, write_tables
from oracle.sql import ORACLES
from tests.helpers import make_tables, rows_of, ts

LEDGER = [
    ("a1", "2022-06-01 12:00:00", "CRB-CR-A-E-001", "$0.00"),
    ("a1", "2022-06-06 12:00:00", "CRB-TR-A-I-001", "$80.00"),
    ("a1", "2022-06-20 12:00:00", "CRB-TR-A-I-002", "$80.00"),
    ("a2", "2022-06-06 12:00:00", "ODR-CR-A-E-001", "$50.00"),
    ("a2", "2022-06-20 12:00:00", "ODR-DR-A-E-001", "$5.00"),
    ("a2", "2022-07-12 12:00:00", "ODR-DR-A-E-002", "$50.00"),
]
ACCOUNTS = [("a1", "u1"), ("a2", "u2")]
LOANS = [("a1", ts("2022-06-01 12:00:00"), ts("2022-06-01 12:00:00"), "creditbuilding", 225, "active")]


def inputs(spark):
    return make_tables(spark, LEDGER, ACCOUNTS, LOANS, migrated=["u2"])


def test_cover_from_files(spark, tmp_path):
    source, target, text = (str(tmp_path / n) for n in ("in", "out", "csv"))
    write_tables(inputs(spark), source)
    run(spark, ["cover", "--inputs", source, "--today", "2022-07-20", "--parquet", target, "--csv", text])
    report = spark.read.parquet(target)
    found = rows_of(report, "snapshot", "snapshot_status", "due_date", "paid_class", "migration_flag")
    assert found[0] == (date(2022, 6, 12), "2. current", date(2022, 7, 6), "4. NA", 1)
    # The fee of 20 June buys thirty days from its own date.
    assert found[2] == (date(2022, 6, 26), "2. current", date(2022, 7, 20), "4. NA", 1)
    assert found[-1] == (date(2022, 7, 17), "1. Inactive", date(2022, 7, 20), "1. paid on time", 1)
    back = sinks.read_csv(spark, text, report.schema)
    assert back.exceptAll(report).count() == 0 == report.exceptAll(back).count()


def test_credit_from_the_catalog(spark):
    names = {}
    for name in ("ledger", "accounts", "loans", "ledger_lines", "migration_list"):
        getattr(inputs(spark), name).createOrReplaceTempView(f"test_{name}")
        names[name] = f"test_{name}"
    assert catalog_tables(spark, names).ledger.count() == len(LEDGER)
    arguments = [f"--table={k}={v}" for k, v in names.items()]
    spark.sql("drop table if exists credit_weekly_test")
    try:
        run(spark, ["credit", *arguments, "--today", "2022-07-20", "--save-as", "credit_weekly_test"])
        found = rows_of(
            spark.table("credit_weekly_test"), "snapshot", "prev_status", "new_loan", "OS", "due_date"
        )
    finally:
        spark.sql("drop table if exists credit_weekly_test")
    assert found[0] == (date(2022, 6, 5), "0. non existent", "1. Yes", 0.0, date(2022, 6, 5))
    assert found[1] == (date(2022, 6, 12), "1. Current", "0. No", 80.0, date(2022, 7, 6))
    assert found[-1][:4] == (date(2022, 7, 24), "1. Current", "0. No", 0.0)


def test_window_and_targets(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    write_tables(inputs(spark), source)
    given = ["cover", "--inputs", source, "--start", "2022-06-13", "--end", "2022-06-26"]
    with pytest.raises(SystemExit):
        run(spark, given)
    run(spark, [*given, "--parquet", target])
    found = rows_of(spark.read.parquet(target), "snapshot", "prev_status")
    assert found == [(date(2022, 6, 19), "2. current"), (date(2022, 6, 26), "2. current")]
    run(spark, [*given, "--skip-opening", "--parquet", target])
    assert rows_of(spark.read.parquet(target), "snapshot") == [(date(2022, 6, 26),)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["in", "out"]


def test_unreadable_amounts(spark, tmp_path):
    source, target, rejects = (str(tmp_path / n) for n in ("in", "out", "bad"))
    ledger = [*LEDGER, ("a2", "2022-06-21 12:00:00", "ODR-DR-A-E-001", "five")]
    write_tables(make_tables(spark, ledger, ACCOUNTS, LOANS), source)
    given = ["cover", "--inputs", source, "--today", "2022-07-20", "--parquet", target, "--rejects", rejects, "--check"]
    with pytest.raises(Exception, match="five"):
        run(spark, given)
    run(spark, [*given, "--lenient"])
    assert spark.read.parquet(target).count() > 0
    assert rows_of(spark.read.parquet(rejects), "Amount") == [("five",)]
    doubled = spark.read.parquet(target)
    with pytest.raises(ValueError, match="2 rows"):
        sinks.check_grain(doubled.union(doubled), ("snapshot", "user_reference"))


def test_a_failed_write_leaves_the_report(spark, tmp_path):
    target = str(tmp_path / "out")
    sinks.write_parquet(spark.range(3), target)
    with pytest.raises(Exception):
        sinks.write_parquet(spark.range(3).select(F.raise_error(F.lit("no")).alias("x")), target)
    assert spark.read.parquet(target).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_a_repeated_row_leaves_the_old_targets(spark, tmp_path, monkeypatch):
    """The report is checked before it takes the place of the old one."""
    source, folder, text = (str(tmp_path / n) for n in ("in", "out", "csv"))
    write_tables(inputs(spark), source)
    given = ["cover", "--inputs", source, "--today", "2022-07-20"]
    spark.sql("drop table if exists checked_cover")
    targets = [["--parquet", folder], ["--parquet", folder, "--by-snapshot"], ["--save-as", "checked_cover"], ["--csv", text]]
    try:
        for target in targets:
            run(spark, [*given, *target, "--check"])
        before = spark.read.parquet(folder).count(), spark.table("checked_cover").count()
        build = CoverBook.report
        monkeypatch.setattr(CoverBook, "report", lambda book: build(book).union(build(book).limit(1)))
        for target in targets:
            with pytest.raises(ValueError, match="2 rows"):
                run(spark, [*given, *target, "--check"])
        assert (spark.read.parquet(folder).count(), spark.table("checked_cover").count()) == before
        assert spark.read.option("header", True).csv(text).count() == before[0]
        assert sorted(p.name for p in tmp_path.iterdir()) == ["csv", "in", "out"]
        assert [t.name for t in spark.catalog.listTables() if t.name.startswith("checked_cover")] == ["checked_cover"]
        run(spark, [*given, "--parquet", folder])
        assert spark.read.parquet(folder).count() == before[0] + 1
    finally:
        spark.sql("drop table if exists checked_cover")


def test_a_failed_table_write_leaves_the_table(spark):
    name = "kept_test"
    spark.sql(f"drop table if exists {name}")
    try:
        assert sinks.write_table(spark.range(3), name) == 3
        with pytest.raises(Exception):
            sinks.write_table(spark.range(3).select(F.raise_error(F.lit("no")).alias("x")), name)
        assert spark.table(name).count() == 3
        assert sinks.write_table(spark.range(5).toDF("other"), name) == 5
        assert spark.table(name).columns == ["other"]
        assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    finally:
        spark.sql(f"drop table if exists {name}")


@pytest.mark.parametrize("failing", [1, 2])
def test_a_failed_replacement_is_undone(failing):
    held = {"target": "before", "new": "after"}

    def move(source, target):
        nonlocal failing
        failing -= 1
        if not failing:
            raise OSError("no")
        held[target] = held.pop(source)

    with pytest.raises(OSError):
        sinks._swap(True, "target", "new", "old", move, held.pop)
    assert held == {"target": "before"}


def test_unknown_amounts_are_counted(spark, tmp_path, capsys):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    ledger = [*LEDGER, ("a2", "2022-06-21 12:00:00", "ODR-DR-A-E-001", "five")]
    write_tables(make_tables(spark, ledger, ACCOUNTS, LOANS), source)
    run(spark, ["cover", "--inputs", source, "--today", "2022-07-20", "--parquet", target, "--lenient", "--sorted"])
    assert "1 ledger rows with unknown amounts" in capsys.readouterr().out
    rows = spark.read.parquet(target).select("user_reference", "snapshot").collect()
    assert rows == sorted(rows)
    with pytest.raises(SystemExit):
        run(spark, ["cover", "--inputs", source, "--parquet", target, "--sorted", "--by-snapshot"])


def test_without_the_document_operators(tmp_path):
    """The rest imports where the operators on documents are gone, or left as empty folders."""
    root = Path(__file__).resolve().parents[1]
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    count = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    changes = [
        lambda: None,
        lambda: (copy / "loanbook" / "llm").mkdir(),
        lambda: (copy / "corpus_pipeline.py").unlink(missing_ok=True),
    ]
    for change in changes:
        change()
        done = subprocess.run([sys.executable, "-c", count], cwd=copy, capture_output=True, text=True, check=True)
        assert done.stdout.split()[-2:] == [str(len(QUERIES)), str(len(ORACLES))]


def test_a_cluster_must_name_a_shared_folder():
    conf = SimpleNamespace(get=lambda name, default=None: default)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(cluster)


def test_source_names(spark):
    lines = spark.createDataFrame([("u1", ts("2022-06-01 12:00:00"), "x")], "user_reference string, TIMESTAMP timestamp_ntz, description string")
    assert conform(lines, LEDGER_LINES).select(F.col("line_ts").cast("string")).first()[0] == "2022-06-01 12:00:00"
