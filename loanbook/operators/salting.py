"""Join on a key that a large part of one side may share.

Adaptive execution splits a hot partition only where both sides of a join come
straight from a shuffle, which a side that was aggregated or joined on the same
key does not. These joins split hot keys by themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one key that a single join task takes.
ROWS_PER_SALT = 1_000_000
# Keys that are split; all others have a smaller share of the rows than any of them.
MOST_HOT = 10_000


def row_counts(rows: DataFrame, key: str) -> DataFrame:
    """Rows per key, as `salted_join` takes them."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))


def salted_join(
    many: DataFrame,
    few: DataFrame,
    key: str,
    spread_by: str,
    counts: DataFrame,
    how: str = "inner",
    on: Column | None = None,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """`many` join `few` on `key` and the residual `on`, hot keys split.

    `counts` has for each key at least the `rows` that `many` holds of it. Keys
    with more than `rows_per_salt` are cut into salts by the hash of `spread_by`,
    and the rows of `few` are repeated for the salts of their key only. NULL keys
    match nothing and are spread by that hash alone. The hot keys are broadcast: the
    `MOST_HOT` largest at most, so that any other key has less than a `MOST_HOT`th
    of all rows.
    """
    largest = counts.where(F.col("rows") > rows_per_salt).orderBy(F.desc("rows")).limit(MOST_HOT)
    hot = F.broadcast(
        largest.select(F.col(key).alias("_hot"), F.ceil(F.col("rows") / rows_per_salt).alias("_salts"))
    )
    spread, salts = F.xxhash64(spread_by), F.coalesce("_salts", F.lit(1))
    salt = F.when(F.col(key).isNull(), spread).otherwise(F.pmod(spread, salts))
    salted = many.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", salt)
    parts = F.sequence(F.lit(0).cast("long"), salts - 1)
    repeated = (
        few.join(hot, F.col(key) == F.col("_hot"), "left")
        .withColumn("_part", F.explode(parts))
        .withColumnRenamed(key, "_key")
        .drop("_hot", "_salts")
    )
    matched = (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_part"))
    joined = salted.join(repeated, matched if on is None else matched & on, how)
    return joined.drop("_hot", "_salts", "_salt", "_key", "_part")
