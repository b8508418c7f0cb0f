"""Writing reports. Every write replaces what the target held.

A target is written beside the old one, read back and audited there, and takes its place
only then. A write or an audit that fails leaves the old report as it was, and
so does a replacement that fails half way.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from loanbook.session import ensure_checkpoints

# Rows of a report in reading order.
REPORT_ORDER = ("user_reference", "snapshot")


def nulls_last(names: Sequence[str]) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in names]


def in_order(report: DataFrame) -> DataFrame:
    """The report sorted by user and snapshot as a whole, for reading."""
    return report.orderBy(*nulls_last(REPORT_ORDER))


# Looks at a report that is written but not published, and raises if it must not be.
Audit = Callable[[DataFrame], None]


def write_parquet(
    report: DataFrame, path: str, by_snapshot: bool = False, audit: Audit | None = None, ordered: bool = False
) -> int:
    """Replace the folder `path`; returns the number of rows.

    With `by_snapshot` there is a folder per snapshot. The rows are then brought
    together by snapshot first, so that a task writes few folders; adaptive
    execution splits large snapshots and merges small ones. `ordered` sorts the rows
    as a whole, for reading.
    """
    spark = report.sparkSession
    counted, rows = _counted(in_order(report) if ordered else report)
    with _replaced(spark, path) as new:
        if by_snapshot:
            gathered = counted.hint("rebalance", "snapshot").sortWithinPartitions(
                "snapshot", *nulls_last(REPORT_ORDER[:1])
            )
            gathered.write.partitionBy("snapshot").parquet(new)
        else:
            counted.write.parquet(new)
        staged = spark.read.schema(report.schema).parquet(new).select(report.columns)
        return _audited(staged, rows, audit)


def _counted(report: DataFrame) -> tuple[DataFrame, Observation]:
    """The report, and its number of rows once it has been written."""
    rows = Observation()
    return report.observe(rows, F.count(F.lit(1)).alias("rows")), rows


def _audited(staged: DataFrame, written: Observation, audit: Audit | None) -> int:
    """Raise unless `staged` holds all rows that were written and passes the audit."""
    held, rows = staged.count(), written.get["rows"]
    if held != rows:
        raise OSError(f"{rows} rows were written, {held} are there")
    if audit is not None:
        audit(staged)
    return rows


@contextmanager
def _replaced(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder beside `path` to write to; it takes the place of `path` at the end."""
    new, old = (f"{path.rstrip('/')}-{kind}-{uuid.uuid4().hex}" for kind in ("new", "old"))
    jvm = spark.sparkContext._jvm
    place = {name: jvm.org.apache.hadoop.fs.Path(name) for name in (path, new, old)}
    files = place[path].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def move(source: str, target: str) -> None:
        if not files.rename(place[source], place[target]):
            raise OSError(f"{source} could not be moved to {target}")

    def drop(name: str) -> None:
        files.delete(place[name], True)

    try:
        yield new
    except BaseException:
        drop(new)
        raise
    _swap(files.exists(place[path]), path, new, old, move, drop)


def _swap(
    exists: bool, target: str, new: str, old: str, move: Callable[[str, str], None], drop: Callable[[str], None]
) -> None:
    """Put `new` in the place of `target`; on a failure `target` is what it was."""
    moved = False
    try:
        if exists:
            move(target, old)
            moved = True
        move(new, target)
    except BaseException:
        if moved:
            move(old, target)
        drop(new)
        raise
    if moved:
        drop(old)


def write_table(report: DataFrame, table: str, audit: Audit | None = None) -> int:
    """Replace the catalog table `table`; returns the number of rows."""
    spark = report.sparkSession
    new, old = (f"{table}_{kind}_{uuid.uuid4().hex}" for kind in ("new", "old"))

    def move(source: str, target: str) -> None:
        spark.sql(f"alter table {source} rename to {target}")

    def drop(name: str) -> None:
        spark.sql(f"drop table if exists {name}")

    counted, rows = _counted(report)
    try:
        counted.write.saveAsTable(new)
        held = _audited(spark.table(new), rows, audit)
    except BaseException:
        drop(new)
        raise
    _swap(spark.catalog.tableExists(table), table, new, old, move, drop)
    return held


def write_csv(
    report: DataFrame,
    path: str,
    index: str | None = None,
    order: Sequence[str] = (),
    audit: Audit | None = None,
    compression: str = "none",
) -> int:
    """Replace the CSV folder `path`, with a header line; returns the number of rows.

    `index` names a leading column with the row's place in `order`. Files are plain text
    unless a `compression` is named, which `read_csv` sees by itself.
    """
    placed = report if index is None else with_index(report, index, order)
    counted, rows = _counted(placed)
    with _replaced(report.sparkSession, path) as new:
        counted.write.option("header", True).option("compression", compression).csv(new)
        return _audited(read_csv(report.sparkSession, new, placed.schema), rows, audit)


def check_grain(report: DataFrame, key: Sequence[str]) -> None:
    """Raise if two rows of the report have the same key."""
    twice = report.groupBy(*key).count().where("count > 1").first()
    if twice is not None:
        raise ValueError(f"{twice['count']} rows for {[twice[k] for k in key]}")


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def with_index(rows: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """Number the rows from 0 in `order`, as the first column.

    The sorted rows are checkpointed, which fixes their partitions; the place of
    a row is then the size of the partitions before its own plus its place
    within. Only the partition sizes meet in one task.
    """
    spark, by = rows.sparkSession, nulls_last(order)
    ensure_checkpoints(spark)
    # Sorted rows of a report shrink twentyfold on the wire. Merged by that size, as after
    # `orderBy`, partitions would not fit into memory; a given number of them is kept.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    # The id counts up from partition << 33.
    ordered = ranged.checkpoint().withColumn("_id", F.monotonically_increasing_id())
    part = F.shiftright("_id", 33)
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy(part.alias("_part"))
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_offset") + place).alias(name), *rows.columns)
    )
