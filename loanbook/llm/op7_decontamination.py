"""Benchmark passages inside documents: size-partitioned MinHash containment search.

The sets of shingles differ in size by orders of magnitude, so only the short side,
the item, is sketched: its smallest hashes. Items are partitioned by size, and the
sketch of each partition is just long enough that a document that contains the asked
share of an item must hold one hash of its sketch; no item is missed. Documents too
small to contain the share are left out per partition. Candidates are verified by
counting the item's shingles that the document holds.

An item of fewer than five words is one shingle of all its words, so documents are cut
into runs of each such length that some item has, besides those of five.

Documents meet the index in a join on hashes. Before it, a task drops what is in no
item, by a filter of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import (
    WordHashes, document_key, each, rolled, rows, shingles, signed, small_batches, whole_rows, words,
)
from loanbook.llm.links import BITS, bits, stored

SHINGLE = 5
SHARE_PERCENT = 80


def sketch_length(size: int, percent: int = SHARE_PERCENT) -> int:
    """Hashes of which a containing document holds one, for any item of the size's partition."""
    largest = 2 ** size.bit_length() - 1
    return min(size, largest - -(-largest * percent // 100) + 1)


def index(items: DataFrame, percent: int = SHARE_PERCENT) -> DataFrame:
    """`(item_id, hash, size, sketched, n_words)` of each distinct shingle of each item.

    `n_words` tells the words of a shingle: five, or all of a shorter item. Items without words (or null) have none, and are found nowhere.
    """
    schema = pa.schema([
        ("item_id", pa.int64()), ("hash", pa.int64()), ("size", pa.int64()), ("sketched", pa.bool_()),
        ("n_words", pa.int32()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for item_id, text in each(batches, "item_id", "text"):
            own = words(text)
            values = shingles(own, SHINGLE, cache)
            n = len(values)
            if n:
                yield rows(
                    schema, item_id=[item_id] * n, hash=signed(values), size=[n] * n,
                    sketched=np.arange(n) < sketch_length(n, percent), n_words=[min(SHINGLE, len(own))] * n,
                )

    found = items.select("item_id", "text").mapInArrow(run, "item_id long, hash long, size long, sketched boolean, n_words int")
    return found.distinct()


def _hits(documents: DataFrame, flags: np.ndarray, lengths: list[int]) -> DataFrame:
    """`(doc_id, text_hash, hash, n)`: runs of `lengths` words that may be in an item, and the
    number of distinct runs of that length in the document."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("hash", pa.int64()), ("n", pa.int64())])
    shared = documents.sparkSession.sparkContext.broadcast(flags)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, cache = shared.value, WordHashes()
        for batch in batches:
            out = []
            for doc_id, text_hash, text in each([batch], "doc_id", "text_hash", "text"):
                hashes = cache.of(words(text))
                for length in lengths:
                    if len(hashes) < length:
                        continue
                    values = rolled(hashes, length)
                    place = (values & np.uint64(BITS - 1)).astype(np.int64)
                    held = np.unique(values[(flags[place >> 3] & (128 >> (place & 7)).astype(np.uint8)) != 0])
                    if len(held):
                        n = len(np.unique(values))
                        out += [(doc_id, text_hash, int(h), n) for h in signed(held)]
            if out:
                yield rows(schema, **dict(zip(schema.names, zip(*out))))

    return documents.mapInArrow(run, "doc_id long, text_hash long, hash long, n long").distinct()


def contained(documents: DataFrame, items: DataFrame, percent: int = SHARE_PERCENT) -> DataFrame:
    """`(doc_id, text_hash, item_id, shared, size)`: items of which a document holds `percent`.

    `documents` has `doc_id`, `text_hash` and `text`. The share is of the distinct
    five-word shingles of the item; an item of fewer words is one shingle, which a
    document holds where all its words follow each other. Rows with
    the same id and text are one document. Null ids are kept and match like others;
    null texts hold nothing. Empty tables give an empty result.
    """
    small_batches(documents.sparkSession)
    known = stored(index(items, percent), "items")
    lengths = sorted(r.n_words for r in known.select("n_words").distinct().collect())
    hits = stored(_hits(documents, bits(known, "hash", hashed=True), lengths), "hits")
    document = ["doc_id", "text_hash"]
    candidates = (
        hits.join(known.where("sketched"), "hash")
        .where(F.col("n") * 100 >= F.col("size") * percent)
        .select(*(F.col(c).alias(f"_{c}") for c in [*document, "item_id"])).distinct()
    )
    pairs = hits.join(known.drop("n_words"), "hash")
    among = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*document, "item_id"]]
    return (
        pairs.join(candidates, among, "left_semi")
        .groupBy(*document, "item_id")
        .agg(F.count(F.lit(1)).alias("shared"), F.first("size").alias("size"))
        .where(F.col("shared") * 100 >= F.col("size") * percent)
    )


def decontaminate(documents: DataFrame, items: DataFrame, percent: int = SHARE_PERCENT) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    slim = documents.select(*document_key(), "text")
    found = contained(slim, items, percent).select(
        F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash")
    ).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash"))
    return whole_rows(documents, *document_key()).join(found, same, "left_anti").select("row.*")
