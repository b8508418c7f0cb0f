"""N-gram Jaccard join by vertical partitioning.

The order of all n-grams is cut into fragments, ranges of their hash. A document's
set falls into one segment per fragment; the overlaps of a pair are counted
separately for each fragment and summed per pair, so that no task needs two whole
sets. Candidates come from prefix filtering over a second order, rare n-grams
first: two sets that are similar enough share one of the few rarest n-grams of
each. Rareness comes from counts of all documents, kept in `BINS` counters of
fixed size. Counts that fall together make the order a little worse, never a result.

Sets, not documents, are joined: copies share the hash of their set.
Hashes have 64 bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import WordHashes, checkpointed, column, document_key, mixed, rows, shingles, signed, small_batches, whole_rows, words
from loanbook.llm.links import bits, connected, known, nodes_of, place_of, stored

#: Counters of n-grams: 2 MB when sent to all tasks.
BINS = 2**21
BLOCK = 2**16
#: Segments of a set.
FRAGMENTS = 8

_PLACE = "_place"
#: Words of 64 bits in the short parity of a set.
_PARITIES = [f"p{k}" for k in range(8)]


def set_hash(values: np.ndarray) -> int:
    """Hash of a sorted set of hashes."""
    spread = mixed(values + np.uint64(0x51ED270B))
    ranks = np.arange(1, len(values) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    total = np.bitwise_xor.reduce(mixed(spread + ranks)) + np.uint64(len(values))
    return int(signed(np.array([total], dtype=np.uint64))[0])


def parity(values: np.ndarray, words: int) -> np.ndarray:
    """Of each bucket of hashes, whether it holds an odd number of them, as 64-bit words."""
    odd = np.bincount((values & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def parity_words(n: int) -> int:
    """Words of the long parity of a set: as many bits as n-grams, and a power of two."""
    return max(len(_PARITIES), 1 << max(0, (n - 1) // 64).bit_length())


def _sets(documents: DataFrame, size: int) -> DataFrame:
    """Per document its set's size and hash; per task and block, the counts of n-grams."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()),
        *((p, pa.int64()) for p in _PARITIES), ("parity", pa.list_(pa.int64())), ("block", pa.int32()), ("counts", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, counts = WordHashes(), np.zeros(BINS, dtype=np.uint32)
        for batch in batches:
            ids, sizes, nodes, parities, long_parities = column(batch, "doc_id"), [], [], [], []
            for text in column(batch, "text"):
                values = shingles(words(text), size, cache)
                sizes.append(len(values))
                nodes.append(set_hash(values) if len(values) else None)
                parities.append(parity(values, len(_PARITIES)))
                long_parities.append(parity(values, parity_words(len(values))))
                np.add.at(counts, values >> np.uint64(64 - 21), np.uint32(1))
            none = [None] * len(ids)
            words_of = dict(zip(_PARITIES, np.array(parities).reshape(-1, len(_PARITIES)).T))
            yield rows(schema, doc_id=ids, text_hash=column(batch, "text_hash"), n_shingles=sizes, node=nodes, parity=long_parities, block=none, counts=none, **words_of)
        if counts.any():
            parts = [zlib.compress(c.tobytes(), 1) for c in counts.reshape(-1, BLOCK)]
            none = [None] * len(parts)
            yield rows(
                schema, doc_id=none, text_hash=none, n_shingles=none, node=none, parity=none, block=range(len(parts)), counts=parts,
                **dict.fromkeys(_PARITIES, none),
            )

    return documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "doc_id long, text_hash long, n_shingles long, node long, " + "".join(f"{p} long, " for p in _PARITIES) + "parity array<bigint>, block int, counts binary"
    )


def parities_near(x: Callable[[str], Column], y: Callable[[str], Column], percent: int) -> Column:
    """Whether two sets, by their `n` and `parity`, can be similar.

    A parity has a bit for each bucket of n-grams that holds an odd number of them, so
    every bit in which two parities differ stands for an n-gram that is in one set only.
    """
    # Parities have a power of two words; that of the larger set is folded to the other's.
    words_x, words_y = x("parity"), y("parity")
    least = F.least(F.size(words_x), F.size(words_y))

    def folded(words: Column) -> Column:
        halves = F.zip_with(F.slice(words, 1, least), F.slice(words, least + 1, least), lambda u, v: u.bitwiseXOR(v))
        return F.when(F.size(words) > least, halves).otherwise(words)

    apart = F.aggregate(
        F.zip_with(folded(words_x), folded(words_y), lambda u, v: F.bit_count(u.bitwiseXOR(v))),
        F.lit(0), lambda total, bits: total + bits,
    )
    # Sizes within a factor of two, as all candidates', give words within a factor of two.
    comparable = F.greatest(F.size(words_x), F.size(words_y)) <= 2 * least
    return ~comparable | (apart * (100 + percent) <= (x("n") + y("n")) * (100 - percent))


def near_parities(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that can be similar by their parities."""
    x, y = sets.alias("x"), sets.alias("y")
    both = pairs.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node"))
    left, right = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    return both.where(parities_near(left, right, percent)).select("a", "b")


def _parities_near(x: Callable[[str], Column], y: Callable[[str], Column], percent: int) -> Column:
    apart = sum((F.bit_count(x(p).bitwiseXOR(y(p))) for p in _PARITIES), F.lit(0))
    return apart * (100 + percent) <= (x("n") + y("n")) * (100 - percent)


def _classes(counts: DataFrame) -> np.ndarray:
    """Frequency class of each counter, rare ones first: `BINS` bytes."""

    def add(block: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(BLOCK, dtype=np.float64)
        for part in block["counts"]:
            total += np.frombuffer(zlib.decompress(part), dtype=np.uint32)
        classes = np.minimum(255, 8 * np.log2(1 + total)).astype(np.uint8)
        return pd.DataFrame({"block": block["block"].iloc[:1], "classes": [classes.tobytes()]})

    out = np.zeros(BINS, dtype=np.uint8)
    for block, part in counts.select("block", "counts").groupBy("block").applyInPandas(add, "block int, classes binary").collect():
        out[block * BLOCK : (block + 1) * BLOCK] = np.frombuffer(bytes(part), dtype=np.uint8)
    return out


def _prefixes(documents: DataFrame, size: int, least: Fraction, classes: np.ndarray, chosen: np.ndarray) -> DataFrame:
    """`(key, node, n, pos)` for the rarest n-grams of each chosen document."""
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])
    shared = documents.sparkSession.sparkContext.broadcast((classes, chosen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, chosen = shared.value
        cache = WordHashes()
        for batch in batches:
            keys, nodes, sizes, places = [], [], [], []
            for place, text in zip(column(batch, _PLACE), column(batch, "text")):
                if not known(chosen, place):
                    continue
                values = shingles(words(text), size, cache)
                n = len(values)
                if not n:
                    continue
                order = classes[values >> np.uint64(64 - 21)].astype(np.uint64) << np.uint64(56) | values >> np.uint64(8)
                length = n - -(-n * least.numerator // least.denominator) + 1
                order = np.sort(np.partition(order, length - 1)[:length])
                keys.append(signed(order))
                nodes.append(np.full(length, set_hash(values)))
                sizes.append(np.full(length, n))
                places.append(np.arange(length))
            if keys:
                yield rows(
                    schema, key=np.concatenate(keys), node=np.concatenate(nodes),
                    n=np.concatenate(sizes).astype(np.int32), pos=np.concatenate(places).astype(np.int32),
                )

    placed = documents.select("text", place_of("doc_id").alias(_PLACE))
    return placed.mapInArrow(run, "key long, node long, n int, pos int")


def segments(documents: DataFrame, set_of: Callable[[str | None, WordHashes], np.ndarray], chosen: np.ndarray) -> DataFrame:
    """`(node, n, fragment, segment)` of each chosen document; `set_of` gives its sorted set."""
    schema = pa.schema([
        ("node", pa.int64()), ("n", pa.int64()), ("fragment", pa.int32()), ("segment", pa.list_(pa.int64())),
    ])
    shared = documents.sparkSession.sparkContext.broadcast(chosen)
    starts = np.array([k * 2**64 // FRAGMENTS for k in range(1, FRAGMENTS)], dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, cache = shared.value, WordHashes()
        for batch in batches:
            out = []
            for place, text in zip(column(batch, _PLACE), column(batch, "text")):
                if not known(chosen, place):
                    continue
                values = set_of(text, cache)
                if len(values):
                    node = set_hash(values)
                    parts = np.split(values, np.searchsorted(values, starts))
                    out += [(node, len(values), k, signed(part)) for k, part in enumerate(parts) if len(part)]
            if out:
                yield rows(schema, **dict(zip(schema.names, zip(*out))))

    placed = documents.select("text", place_of("doc_id").alias(_PLACE))
    return placed.mapInArrow(run, "node long, n long, fragment int, segment array<bigint>")


def overlaps(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """`(a, b, n_a, n_b, shared)`: overlaps counted per fragment and summed per pair.

    `parts` may hold a segment more than once, for copies of a document.
    """
    left = parts.select(F.col("node").alias("a"), F.col("n").alias("n_a"), "fragment", F.col("segment").alias("s_a"))
    right = parts.select(F.col("node").alias("b"), F.col("n").alias("n_b"), "fragment", F.col("segment").alias("s_b"))
    partial = (
        pairs.join(left, "a").join(right, ["b", "fragment"])
        .select("a", "b", "n_a", "n_b", "fragment", F.size(F.array_intersect("s_a", "s_b")).cast("long").alias("partial"))
    )
    counted = partial.groupBy("a", "b", "n_a", "n_b", "fragment").agg(F.max("partial").alias("partial"))
    return counted.groupBy("a", "b").agg(
        F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"), F.sum("partial").alias("shared")
    )


def _linked(documents: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows `(doc_id, text_hash, n_shingles, node)`, and `(node, component)` of every set."""
    small_batches(documents.sparkSession)
    least = Fraction(percent, 100)
    seen = stored(_sets(documents, size), "sets")
    documents_seen = seen.where("block is null")
    classes = _classes(seen.where("block is not null"))
    sets = checkpointed(
        documents_seen.where("n_shingles > 0").groupBy("node").agg(
            F.min("doc_id").alias("least_id"), F.max("n_shingles").alias("n"),
            *[F.max(p).alias(p) for p in _PARITIES], F.first("parity").alias("parity"),
        )
    )
    keys = _prefixes(documents, size, least, classes, bits(sets, "least_id"))

    def alike(x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
        n_x, n_y, i, j = x("n"), y("n"), x("pos"), y("pos")
        enough = F.least(n_x, n_y) * 100 >= F.greatest(n_x, n_y) * percent
        most = F.least(i, j) + F.least(n_x - i, n_y - j)
        return enough & (most * (100 + percent) >= (n_x + n_y) * percent)

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = checkpointed(near_parities(pairs, sets, percent))
        chosen = bits(nodes_of(pairs).join(sets, "node"), "least_id")
        parts = segments(documents, lambda text, cache: shingles(words(text), size, cache), chosen)
        return overlaps(pairs, parts).where(
            F.col("shared") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("shared")) * percent
        )

    groups = connected(
        keys, verified, alike,
        marks=sets.select("node", *_PARITIES), marks_may_link=lambda x, y: _parities_near(x, y, percent),
    )
    named = sets.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return documents_seen, named


def join_groups(documents: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """Each document's set size and the least `doc_id` it reaches by links.

    Two documents link when `100 * intersection >= percent * union` of their sets of
    `size`-word shingles. Takes `doc_id` and `text`; returns a row per input row:
    `doc_id, n_shingles, component_id`. A text with fewer words has its whole sequence
    as one shingle; without words (or null) the set is empty and linked with nothing.
    A document with a null id takes part, but a group is named by its least id that
    is not null, or null. Repeated rows are copies of each other. An empty table
    gives an empty result.
    """
    seen, named = _linked(documents, size, percent)
    names = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    ids = named.join(names, "component").select("node", "component_id")
    full = seen.where("n_shingles > 0").join(ids, "node")
    empty = seen.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return full.select("doc_id", "n_shingles", "component_id").union(
        empty.select("doc_id", "n_shingles", "component_id")
    )


def first_of_groups(documents: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """One document of each group of linked documents, with all its columns.

    It is the one with the least id (nulls last), then the least text hash. Rows with
    the same id and text are one document. Texts without words are in no group, and
    all of them stay.
    """
    seen, named = _linked(documents, size, percent)
    spot = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    placed = seen.where("n_shingles > 0").join(named.select("node", "component"), "node").withColumn("spot", spot)
    first = placed.groupBy("component").agg(F.min("spot").alias("first"), F.max("spot").alias("last")).where("first < last")
    gone = (
        placed.join(first, "component").where(~F.col("spot").eqNullSafe(F.col("first")))
        .select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct()
    )
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_hash") == F.col("gone_hash"))
    return whole_rows(documents, *document_key()).join(gone, same, "left_anti").select("row.*")
