"""Sharding by a hypergeometric communication matrix, in DataFrame functions only.

Rows are spread over cells by a hash. The matrix says how many rows of each cell
go to each shard: a uniform shuffle with exact shard sizes makes it multivariate
hypergeometric, and it is drawn exactly so. The draw goes down a tree of cells, in
which each node splits its shard counts among at most `FAN` children, so that no
task holds more than one node. Then rows are permuted within their cell, cut
into shards by the cell's row of the matrix, exchanged, and permuted again within
their shard.

A cell and a stretch of a shard hold about `ROWS` rows each at any size of table.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanbook.llm.common import checkpointed, parallelism

#: Children of a node of the tree of cells.
FAN = 32
#: Rows of a cell, and of a stretch of a shard that is numbered by one task.
ROWS = 100_000
#: The support left out of a draw has a probability below that of any uniform value.
SIGMAS = 10
SPARE = 40

_UNIT = float(2**-53)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def uniform(*parts: Column) -> Column:
    """A double in [0, 1), fixed by `parts`."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(_UNIT)


def _steps(first: Column, last: Column, step: int) -> Column:
    empty = F.array().cast("array<bigint>")
    there = (first <= last) if step > 0 else (first >= last)
    return F.when(there, F.sequence(first, last, F.lit(step).cast("bigint"))).otherwise(empty)


def hypergeometric(total: Column, marked: Column, drawn: Column, at: Column) -> Column:
    """How many of `drawn` rows are marked, among `total` rows with `marked` ones.

    The quantile of `at`: weights relative to the mode follow from the ratios of
    neighbouring probabilities, so nothing large is subtracted from anything large.
    """

    def up(p: Column, k: Column) -> Column:
        return (p.m - k) * (p.d - k) / ((k + 1.0) * (p.t - p.m - p.d + k + 1))

    def down(p: Column, k: Column) -> Column:
        return (p.t - p.m - p.d + k) * k / ((p.m - k + 1.0) * (p.d - k + 1))

    def summed(p: Column, ks: Column, ratio: Callable) -> Column:
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"))

        def add(acc: Column, k: Column) -> Column:
            w = acc.w * ratio(p, k.cast("double"))
            return F.struct(w.alias("w"), (acc.s + w).alias("s"))

        return F.aggregate(ks, start, add, lambda acc: acc.s)

    def sought(p: Column, ks: Column, ratio: Callable, step: int, target: Column, cum: Column, found: Column) -> Column:
        start = F.struct(F.lit(1.0).alias("w"), cum.alias("c"), found.alias("k"))

        def look(acc: Column, k: Column) -> Column:
            w = acc.w * ratio(p, k.cast("double"))
            c = acc.c + w
            here = F.when(target < c, k + step)
            return F.struct(w.alias("w"), c.alias("c"), F.coalesce(acc.k, here).alias("k"))

        return F.aggregate(ks, start, look)

    def chosen(p: Column) -> Column:
        ups = _steps(p.mode, p.last - 1, 1)
        downs = _steps(p.mode, p.first + 1, -1)

        def among(q: Column) -> Column:
            target = p.at * (1.0 + q.u + q.d)
            none = F.lit(None).cast("bigint")
            first = sought(p, ups, up, 1, target, F.lit(1.0), F.when(target < 1.0, p.mode).otherwise(none))
            return _let(first, lambda a: F.coalesce(sought(p, downs, down, -1, target, a.c, a.k).k, p.mode))

        return _let(F.struct(summed(p, ups, up).alias("u"), summed(p, downs, down).alias("d")), among)

    def bounded(p: Column) -> Column:
        mode = F.greatest(p.lo, F.least(p.hi, F.floor((p.d + 1) * (p.m + 1) / (p.t + 2)).cast("bigint")))
        share = p.m / F.greatest(p.t, F.lit(1.0))
        spread = F.sqrt(p.d * share * (1 - share) * (p.t - p.d) / F.greatest(p.t - 1, F.lit(1.0)))
        reach = (F.ceil(spread * SIGMAS) + SPARE).cast("bigint")
        return F.struct(
            p.t, p.m, p.d, p.at, mode.alias("mode"),
            F.greatest(p.lo, mode - reach).alias("first"), F.least(p.hi, mode + reach).alias("last"),
        )

    given = F.struct(
        total.cast("double").alias("t"), marked.cast("double").alias("m"), drawn.cast("double").alias("d"),
        at.alias("at"),
        F.greatest(F.lit(0).cast("bigint"), drawn + marked - total).alias("lo"), F.least(drawn, marked).alias("hi"),
    )
    return _let(given, lambda g: _let(bounded(g), chosen))


def _row(rest: Column, n: Column, child: Column, level: int, seed: int) -> Column:
    """Of `n` rows, how many go to each shard, when `rest` says what each still takes."""
    start = F.struct(
        F.aggregate(rest, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("t"),
        n.alias("n"),
        F.array().cast("array<bigint>").alias("out"),
    )

    def next_shard(acc: Column, marked: Column) -> Column:
        at = uniform(F.lit(seed), F.lit(level), child, F.size(acc.out))
        drawn = _let(hypergeometric(acc.t, marked, acc.n, at), lambda k: F.struct(
            (acc.t - marked).alias("t"), (acc.n - k).alias("n"), F.concat(acc.out, F.array(k)).alias("out")
        ))
        return drawn

    return F.aggregate(rest, start, next_shard, lambda acc: acc.out)


def _split(level: int, seed: int) -> Callable[[Column, Column], Column]:
    """Give a child its share of what its node's shards still take."""

    def split(acc: Column, kid: Column) -> Column:
        return _let(_row(acc.rest, kid.n, kid.child, level, seed), lambda row: F.struct(
            F.zip_with(acc.rest, row, lambda a, b: a - b).alias("rest"),
            F.concat(acc.out, F.array(F.struct(kid.child.alias("cell"), row.alias("takes")))).alias("out"),
        ))

    return split


def matrix(cells: DataFrame, depth: int, takes: list[int], seed: int) -> DataFrame:
    """`(cell, takes)`: rows of each cell for each shard; `cells` has `(cell, n)`."""
    spark = cells.sparkSession
    taken = spark.range(1).select(
        F.col("id").alias("cell"), F.array(*[F.lit(t).cast("bigint") for t in takes]).alias("takes")
    )
    for level in range(1, depth + 1):
        width = FAN ** (depth - level)
        sizes = cells.groupBy(F.floor(F.col("cell") / width).alias("child")).agg(F.sum("n").alias("n"))
        kids = sizes.groupBy(F.floor(F.col("child") / FAN).alias("cell")).agg(
            F.array_sort(F.collect_list(F.struct("child", "n"))).alias("kids")
        )
        nothing = F.array().cast("array<struct<cell:bigint,takes:array<bigint>>>")
        start = F.struct(F.col("takes").alias("rest"), nothing.alias("out"))
        parts = F.aggregate("kids", start, _split(level, seed), lambda acc: acc.out)
        taken = taken.join(kids, "cell").select(F.inline(parts))
    return taken


def shard(documents: DataFrame, shards: int = 24, seed: int = 20, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every row with its shard and its place in the shard, a uniform shuffle.

    Returns `doc_id, size, text_crc32, shard, slot` and the columns in `carry`, which keep
    their names, also where these are among the five.
    `size` is the UTF-8 bytes of the text plus 8; a null text counts as empty, with
    crc32 0. Shards differ by one row at most, and slots run from 0 without gaps.
    Rows are told apart by their place in the table, so null and repeated ids,
    repeated rows and equal texts are all placed like any others; an empty table
    gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    # The columns in `carry` travel as one, so that none meets a name of ours.
    carried = [F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]).alias("row")] if carry else []
    kept = ["row"] if carry else []
    base = checkpointed(
        documents.select(
            "doc_id",
            (F.octet_length(text) + 8).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.monotonically_increasing_id().alias("_place"),
            *carried,
        )
    )
    n = base.count()
    depth, wanted = 1, max(parallelism(base.sparkSession), ceil(n / ROWS))
    while FAN**depth < wanted:
        depth += 1
    count = FAN**depth if depth > 1 else max(1, wanted)
    base = base.withColumn("cell", F.pmod(F.xxhash64(F.lit(seed), "_place"), F.lit(count)).cast("bigint"))

    takes = [n // shards + (s < n % shards) for s in range(shards)]
    cells = base.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("cell").orderBy(F.xxhash64(F.lit(seed + 1), "_place"), "_place"))
    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(0).alias("shard"))
    first_beyond = F.aggregate(
        "takes",
        start,
        lambda acc, x: F.struct(
            (acc["sum"] + x).alias("sum"), (acc["shard"] + F.when(acc["sum"] + x < F.col("_rank"), 1).otherwise(0)).alias("shard")
        ),
        lambda acc: acc["shard"],
    )
    stretches = max(1, count // shards)
    placed = checkpointed(
        base.withColumn("_rank", rank.cast("bigint"))
        .join(matrix(cells, depth, takes, seed + 2), "cell")
        .select(
            "doc_id", "size", "text_crc32", first_beyond.alias("shard"), "_place",
            uniform(F.lit(seed + 3), F.col("_place")).alias("_order"), *kept,
        )
        .withColumn("_stretch", F.floor(F.col("_order") * stretches))
    )
    ahead = Window.partitionBy("shard").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        placed.groupBy("shard", "_stretch").agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "_stretch", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_before"))
    )
    within = F.row_number().over(Window.partitionBy("shard", "_stretch").orderBy("_order", "_place"))
    return (
        placed.withColumn("_within", within)
        .join(before, ["shard", "_stretch"])
        .select(
            "doc_id", "size", "text_crc32", "shard", (F.col("_before") + F.col("_within") - 1).cast("bigint").alias("slot"),
            *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(carry)],
        )
    )
