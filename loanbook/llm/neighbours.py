"""Rows next to each other in a total order, without a window over all rows.

The order is cut into ranges of rows. A range is sorted by one task, and the rows at
its edges are also sent to the ranges beside it. The cuts are kept on the driver, two
keys for each range.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import parallelism

#: What a row is to its range: a copy from before it, its own, or a copy from after it.
BEFORE, OWN, AFTER = -1, 0, 1


def _comparable(key) -> tuple:
    """Nulls first, as in Spark."""
    return tuple((value is not None, value) for value in key)


def beside(frame: DataFrame, keys: list[str], circular: bool = False, cut_by: DataFrame | None = None) -> DataFrame:
    """`frame` with `_range` and `_side`, sorted by both and then by `keys`.

    Every row is in its range once with `_side` `OWN`. The last row of the range before
    is there as `BEFORE`, the first of the range after as `AFTER`; with `circular`, the
    last row of all comes before the first. Rows with equal keys stay in one range.
    `cut_by` has the same keys where they are cheaper to read.
    """
    spark = frame.sparkSession
    ranges = parallelism(spark)
    cuts = (
        (cut_by or frame).select(F.struct(*keys).alias("key")).repartitionByRange(ranges, "key")
        .groupBy(F.spark_partition_id()).agg(F.min("key").alias("low"), F.max("key").alias("high"))
        .collect()
    )
    cuts = sorted((_comparable(c.low), _comparable(c.high)) for c in cuts)
    lows = [low for low, _ in cuts]
    before, after = {}, {}
    for i, (low, high) in enumerate(cuts):
        if i + 1 < len(cuts):
            before.setdefault(high, []).append(i + 1)
        if i:
            after.setdefault(low, []).append(i - 1)
    if circular and cuts:
        before.setdefault(cuts[-1][1], []).append(0)

    @F.arrow_udf("array<int>")
    def places(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for key in batch.to_pylist():
                key = _comparable(key.values())
                own = max(0, bisect_right(lows, key) - 1)
                out.append(
                    [own * 3 + 1, *(i * 3 for i in before.get(key, ())), *(i * 3 + 2 for i in after.get(key, ()))]
                )
            yield pa.array(out, type=pa.list_(pa.int32()))

    dealt = frame.withColumn("_place", F.explode(places(F.struct(*keys))))
    dealt = dealt.withColumn("_range", F.floor(F.col("_place") / 3)).withColumn("_side", F.col("_place") % 3 - 1)
    # A range is a partition; by hash, several would share a task and others have none.
    dealt = dealt.drop("_place").repartitionById(max(1, len(cuts)), F.col("_range").cast("int"))
    return dealt.sortWithinPartitions("_range", "_side", *keys)
