"""Connected groups of a similarity join that never lists all pairs of a group.

Candidates share a bucket. Every member of a bucket is first compared with one
hub. Buckets whose members are all connected by then are done. In each further round the other buckets elect a new hub,
the member that shares buckets with the most others, for copies meet their original more
often than each other. What is not connected by then is paired with others of its
bucket. Pairs inside a connected group would not change the groups, so no group is lost
by leaving them out.
"""

from __future__ import annotations

import atexit
from collections.abc import Callable
from math import ceil

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanbook.llm.common import checkpointed
from loanbook.session import scratch_folder

#: Bits of a set of ids that is sent to all tasks, in blocks of 32,768: 1 MB at most.
BITS = 2**23
_BLOCK = 2**15
_CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Links of one partition while groups are worked out.
LINKS_PER_PARTITION = 100_000


def stored(frame: DataFrame, label: str) -> DataFrame:
    """`frame` as a table in the shared scratch folder, for what is read repeatedly.

    The table goes when the program ends, or with `discard`; shuffle files that its
    rows came from go as soon as it is written.
    """
    spark = frame.sparkSession
    path = scratch_folder(spark, label)
    before = spark.conf.get(_CLEAN_SHUFFLES, "false")
    spark.conf.set(_CLEAN_SHUFFLES, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_SHUFFLES, before)
    atexit.register(_remove, spark, path)
    table = spark.read.parquet(path)
    table.scratch_path = path
    return table


def discard(table: DataFrame) -> None:
    """Remove what `stored` wrote, when all that was read from it is written."""
    _remove(table.sparkSession, table.scratch_path)


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None:  # the session has ended
        return
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def bits(ids: DataFrame, name: str, hashed: bool = False) -> np.ndarray:
    """A filter that knows all of `ids`, and others by chance: `BITS` flags of fixed size.

    `known` reads it, at the place `place_of` gives, or at the low bits of an id that
    is a hash already. Only saves work; a join must follow.
    """
    place = F.col(name).bitwiseAND(F.lit(BITS - 1)) if hashed else place_of(name)
    made = ids.groupBy(F.floor(place / _BLOCK).alias("block")).agg(
        F.bitmap_construct_agg(place % _BLOCK).alias("bits")
    )
    flags = np.zeros(BITS, dtype=bool)
    for block, part in made.collect():
        flags[block * _BLOCK : (block + 1) * _BLOCK] = np.unpackbits(
            np.frombuffer(bytes(part), dtype=np.uint8), bitorder="little"
        )
    return np.packbits(flags)


def place_of(name: str) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(BITS))


def known(filled: np.ndarray, place: int) -> bool:
    return bool(filled[place >> 3] & (128 >> (place & 7)))


def components(links: DataFrame) -> DataFrame:
    """`(node, component)` of every node in `links` (`a`, `b`): its least reachable node."""
    ways = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ways = checkpointed(ways.where("a <> b").distinct())
    # Many rounds over few links: as many partitions as their number asks for.
    parts = max(1, ceil(ways.count() / LINKS_PER_PARTITION))
    ways = ways.coalesce(parts)
    labels = checkpointed(
        ways.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        .select("node", F.least("node", "b").alias("component"), F.lit(True).alias("changed"))
        .coalesce(parts)
    )
    while not labels.where("changed").isEmpty():
        names = labels.select(F.col("node").alias("b"), F.col("component").alias("seen"))
        nearby = ways.join(names, "b").select(F.col("a").alias("node"), "seen")
        beyond = labels.select("node", F.col("component").alias("b")).join(names, "b").select("node", "seen")
        best = nearby.union(beyond).groupBy("node").agg(F.min("seen").alias("seen"))
        labels = checkpointed(
            labels.join(best, "node").select(
                "node",
                F.least("component", "seen").alias("component"),
                (F.col("seen") < F.col("component")).alias("changed"),
            ).coalesce(parts)
        )
    return labels.select("node", "component")


def nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def connected(
    buckets: DataFrame,
    verified: Callable[[DataFrame], DataFrame],
    may_link: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
    prepare: Callable[[DataFrame], DataFrame | None] | None = None,
    marks: DataFrame | None = None,
    marks_may_link: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
    once: bool = False,
    rounds: int = 0,
) -> DataFrame:
    """`(node, component)` of all nodes that are linked with any other.

    `buckets` has `key`, `node` and what `may_link` looks at to rule a pair out. It
    may repeat rows. `verified` keeps the pairs (`a`, `b`) that are links. `prepare` first gets all nodes that share a
    bucket with another, and may return `marks`. `marks` has more of each `node` for `marks_may_link` to look at
    before members of a bucket are paired with others than the hub. With `once`, for nodes of few
    keys, a pair comes from the least of the buckets that both are in, not from each of them.
    Hubs are elected anew at most `rounds` times, and no more after a round without links; `marks` are
    needed for that.
    """
    extra = [c for c in buckets.columns if c not in ("key", "node")]
    bucket = Window.partitionBy("key").orderBy("node")
    shared = stored(
        buckets.withColumn("hub", F.first(F.struct("node", *extra)).over(bucket))
        .withColumn("_next", F.lead("node").over(bucket))
        .where((F.col("node") > F.col("hub.node")) | (F.col("_next") > F.col("node")))
        .drop("_next"),
        "buckets",
    )
    if prepare:
        made = prepare(shared.select("node").distinct())
        marks = made if marks is None else marks

    found: list[DataFrame] = []

    def links_among(pairs: DataFrame) -> DataFrame:
        # Not a checkpoint: what was shuffled to verify the pairs goes now.
        found.append(stored(verified(pairs).select("a", "b"), "links"))
        return found[-1]

    def possible(x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
        return may_link(x, y) if may_link else F.lit(True)

    def fits(x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
        return possible(x, y) & marks_may_link(x, y) if marks_may_link else possible(x, y)

    near_hub = stored(
        shared.where((F.col("node") != F.col("hub.node")) & possible(lambda c: F.col(f"hub.{c}"), F.col))
        .select(F.col("hub.node").alias("a"), F.col("node").alias("b"))
        .distinct(),
        "near_hub",
    )
    met = [near_hub]
    links = links_among(near_hub)
    groups = components(links)
    members = shared.drop("hub")

    hubs = None
    for _ in range(rounds):
        rest = stored(_unconnected(members, groups).join(marks, "node"), "rest")
        hubs = _elected(rest, hubs)
        x, y = rest.join(hubs, ["key", "node"], "left_semi").alias("x"), rest.alias("y")
        left, right = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
        near = (
            x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component")) & fits(left, right))
            .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
        )
        for pairs in met:
            near = near.join(pairs, ["a", "b"], "left_anti")
        met.append(stored(near, "near_hub"))
        discard(rest)
        new = links_among(met[-1])
        if new.isEmpty():
            break
        links = links.union(new)
        groups = components(links)

    rest = _unconnected(members, groups)
    if once:
        # Written first, as it is read twice.
        mixed = stored(_linkable(rest, possible), "mixed")
        rest = mixed.join(mixed.groupBy("node").agg(F.collect_set("key").alias("keys")), "node")
    rest = stored(rest if marks is None else rest.join(marks, "node"), "rest")
    discard(shared)
    if once:
        discard(mixed)
    x, y = rest.alias("x"), rest.alias("y")
    left, right = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    fit = possible(left, right)
    if once:
        fit = fit & (F.array_min(F.array_intersect(left("keys"), right("keys"))) == left("key"))
    if marks_may_link:
        fit = fit & marks_may_link(left, right)
    others = (
        x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node"))
               & (F.col("x.component") != F.col("y.component"))
               & fit)
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        .distinct()
    )
    for pairs in met:
        others = others.join(pairs, ["a", "b"], "left_anti")
    others = stored(others, "others")
    for table in [rest, *met]:
        discard(table)
    if not others.isEmpty():
        groups = components(links.union(links_among(others)))
    for table in [others, *found]:
        discard(table)
    return groups


def _unconnected(members: DataFrame, groups: DataFrame) -> DataFrame:
    """`members`, with `component`, of the buckets that are in several components."""
    labelled = members.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = (
        labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo < hi").select("key")
    )
    return labelled.join(mixed, "key")


def _linkable(rest: DataFrame, possible: Callable[[Callable[[str], Column], Callable[[str], Column]], Column]) -> DataFrame:
    """Members that may be linked with one of another component, before more of them is fetched."""
    x, y = rest.alias("x"), rest.alias("y")
    apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component"))
    return x.join(y, apart & possible(lambda c: F.col(f"x.{c}"), lambda c: F.col(f"y.{c}")), "left_semi")


def _elected(rest: DataFrame, before: DataFrame | None) -> DataFrame:
    """`(key, node)`: of each bucket the member that shares buckets with the most others, and was no hub `before`."""
    crowds = rest.groupBy("key").agg(F.count(F.lit(1)).alias("crowd"))
    free = rest.select("key", "node")
    if before is not None:
        free = free.join(before, ["key", "node"], "left_anti")
    free = checkpointed(free.join(crowds, "key"))
    weights = free.groupBy("node").agg(F.sum("crowd").alias("weight"))
    best = F.max_by("node", F.struct("weight", "node"))
    chosen = free.join(weights, "node").groupBy("key").agg(best.alias("node"))
    return checkpointed(chosen if before is None else chosen.union(before))
