"""Running values along each user's entries that survive a hot user.

A window over all of a user's entries runs in one task, which is right for all but a
few users. Entries of users with more than `ROWS_PER_SLICE` are cut into slices of
their order: cuts come from a sample of their order keys, every slice runs on its own, and
what a user carries into a slice comes from one total per slice. There are at most
`MOST_SLICES` slices, whatever the size of the ledger, so cuts and totals are broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from loanbook.operators.salting import row_counts
from loanbook.session import checkpointed

USER = "user_reference"

# Rows of one user that a single task takes, unless that makes too many slices.
ROWS_PER_SLICE = 1_000_000
# Slices of all hot users together; as many hot users at most.
MOST_SLICES = 10_000
# Sampled keys that stand for a slice.
SAMPLED = 32


@dataclass(frozen=True)
class Slices:
    """Entries with the slice each belongs to; `hot` tells whether any user has two."""

    rows: DataFrame
    hot: bool

    @property
    def keys(self) -> list[str]:
        return [USER, "_slice"] if self.hot else [USER]

    def window(self, *order: Column | str) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*order)

    def totals(self, rows: DataFrame, *parts: Column) -> DataFrame:
        """`parts` of every slice of the hot users."""
        return rows.where("_is_hot").groupBy(*self.keys).agg(*parts)

    def with_carried(self, rows: DataFrame, carried: DataFrame) -> DataFrame:
        """Join one row per slice of the hot users."""
        return rows.join(F.broadcast(carried), self.keys, "left")


def _place(cuts: Column, key: Column) -> Column:
    """Number of `cuts`, which ascend, that are below `key`; found by halving."""

    def halved(span: Column, _: Column) -> Column:
        low, high = span["low"], span["high"]
        middle = F.floor((low + high) / 2).cast("int")
        after = F.struct((middle + 1).alias("low"), high.alias("high"))
        until = F.struct(low.alias("low"), middle.alias("high"))
        return F.when(low >= high, span).when(F.get(cuts, middle) < key, after).otherwise(until)

    whole = F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high"))
    rounds = F.sequence(F.lit(1), F.lit(MOST_SLICES.bit_length() + 1))
    return F.aggregate(rounds, whole, halved)["low"]


def sliced(
    entries: DataFrame,
    order: Sequence[str],
    counts: DataFrame | None = None,
    rows_per_slice: int | None = None,
) -> Slices:
    """Cut the entries of hot users along `order`.

    `counts` has for each user at least the `rows` that `entries` holds; it is worked out
    where not given. Entries with equal `order` stay together.
    """
    limit = ROWS_PER_SLICE if rows_per_slice is None else rows_per_slice
    if counts is None:
        counts = row_counts(entries, USER)
    total, largest = counts.agg(F.sum("rows"), F.max("rows")).first()
    size = max(limit, ceil((total or 0) / MOST_SLICES))
    if (largest or 0) <= size:
        return Slices(entries, False)
    fixed = checkpointed(entries)
    parts = F.ceil(F.col("rows") / size).cast("int").alias("_parts")
    hot = F.broadcast(counts.where(F.col("rows") > size).select(USER, parts))
    key = F.struct(*order)
    sampled = F.pmod(F.xxhash64(*order), F.lit(max(1, size // SAMPLED))) == 0
    seen = F.sort_array(F.collect_list(F.when(sampled, key)))
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("_parts") - 1),
        lambda i: F.get("_seen", F.floor(i * F.size("_seen") / F.col("_parts")).cast("int")),
    )
    cut_users = (
        fixed.join(hot, USER).groupBy(USER, "_parts").agg(seen.alias("_seen"))
        .select(USER, F.when(F.size("_seen") > 0, cuts).otherwise(F.slice("_seen", 1, 0)).alias("_cuts"))
    )
    placed = fixed.join(F.broadcast(cut_users), USER, "left").withColumns(
        {
            "_slice": F.coalesce(_place(F.col("_cuts"), key), F.lit(0)),
            "_is_hot": F.col("_cuts").isNotNull(),
        }
    )
    return Slices(placed.drop("_cuts"), True)


def running(
    entries: DataFrame,
    order: Sequence[str],
    sums: Mapping[str, Column] = {},
    maxima: Mapping[str, Column] = {},
    counts: DataFrame | None = None,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Add running sums and maxima per user, up to and including each entry."""
    slices = sliced(entries, order, counts, rows_per_slice)
    parts = {**{n: F.sum(c) for n, c in sums.items()}, **{n: F.max(c) for n, c in maxima.items()}}
    zero = F.lit(0)
    so_far = slices.window(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = slices.rows.withColumns({name: agg.over(so_far) for name, agg in parts.items()})
    if not slices.hot:
        return local.withColumns({name: F.coalesce(name, zero) for name in sums})
    before = Window.partitionBy(USER).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = slices.totals(slices.rows, *[agg.alias(name) for name, agg in parts.items()])
    carried = totals.select(
        *slices.keys,
        *[F.sum(name).over(before).alias(f"_{name}") for name in sums],
        *[F.max(name).over(before).alias(f"_{name}") for name in maxima],
    )
    return slices.with_carried(local, carried).withColumns(
        {
            **{n: F.coalesce(F.col(n), zero) + F.coalesce(F.col(f"_{n}"), zero) for n in sums},
            **{n: F.greatest(n, f"_{n}") for n in maxima},
        }
    ).select(*entries.columns, *parts)


def next_later(
    entries: DataFrame,
    time: str,
    name: str,
    order: Sequence[str] = (),
    counts: DataFrame | None = None,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Add the user's earliest `time` strictly after that of each entry.

    Hot users are cut along `order`, which starts with `time`; more columns cut ties.
    """
    slices = sliced(entries, order or [time], counts, rows_per_slice)
    keys = ", ".join(f"`{key}`" for key in slices.keys)
    later = F.expr(
        f"min(`{time}`) over (partition by {keys} order by `{time}` desc "
        "range between unbounded preceding and interval 1 microsecond preceding)"
    )
    local = slices.rows.withColumn(name, later)
    if not slices.hot:
        return local
    # The first two times of each slice and its last: what follows the last is one of them.
    ends = slices.totals(
        local, F.min(time).alias("_first"), F.min(name).alias("_second"), F.max(time).alias("_last")
    )
    points = ends.select(USER, F.explode(F.array("_first", "_second", "_last")).alias("_last"))
    following = F.lead("_last").over(Window.partitionBy(USER).orderBy("_last"))
    after = points.where("_last is not null").distinct().withColumn("_following", following)
    carried = ends.select(*slices.keys, "_last").join(after, [USER, "_last"]).drop("_last")
    return (
        slices.with_carried(local, carried)
        .withColumn(name, F.coalesce(name, "_following"))
        .select(*entries.columns, name)
    )


def leading(
    rows: DataFrame,
    order: str,
    columns: Mapping[str, str],
    counts: DataFrame | None = None,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Add columns of the user's next row: `columns` maps new names to those they take.

    A user's rows have different values of `order`.
    """
    slices = sliced(rows, [order], counts, rows_per_slice)
    following = F.struct(*columns.values())
    local = slices.rows.withColumn("_next", F.lead(following).over(slices.window(order)))
    if slices.hot:
        firsts = slices.totals(slices.rows, F.min_by(following, order).alias("_first"))
        by_slice = Window.partitionBy(USER).orderBy("_slice")
        carried = firsts.select(*slices.keys, F.lead("_first").over(by_slice).alias("_carried"))
        local = slices.with_carried(local, carried).withColumn("_next", F.coalesce("_next", "_carried"))
    taken = [F.col(f"_next.{source}").alias(name) for name, source in columns.items()]
    return local.select(*rows.columns, *taken)
