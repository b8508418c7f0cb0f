"""Document fingerprints: MinHash signatures, banded near duplicates.

A signature is the least value of each of `PERMUTATIONS` universal hash functions
over the five-word shingles of a text, worked out in numpy; the share of equal
values of two signatures estimates the Jaccard similarity of their sets. `START`
marks stand before the first word, so a short text has as many shingles as words.

For near duplicates, bands of the signatures are joined in Spark, and pairs that
share a band are verified by the exact Jaccard similarity of their shingles.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import reduce
from math import ceil, floor

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import WordHashes, checkpointed, column, each, mixed, rolled, rows, signed, small_batches, utf8, words
from loanbook.llm.links import bits, connected, discard, nodes_of, stored
from loanbook.llm.neighbours import OWN, beside
from loanbook.llm.op1_ngram_join import near_parities, overlaps, parities_near, parity, parity_words, segments, set_hash

SHINGLE = 5
PERMUTATIONS = 128
BAND_ROWS = 6
BANDS = 20
SIMILAR_PERCENT = 80
#: Low bits of each permutation that are compared before a pair is verified.
PLANES = 4
#: Standard deviations of the number of agreeing permutations below which a pair is ruled out.
DEVIATIONS = 3
#: Rounds in which the buckets of near duplicates elect new hubs.
HUB_ROUNDS = 1

_START = [b"\x00"] * (SHINGLE - 1)
_DRAWN = mixed(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS, _TERMS = (_DRAWN >> np.uint64(32)).astype(np.uint32).reshape(2, PERMUTATIONS)
_FACTORS |= np.uint32(1)
_CHUNK = 512
_NONE = np.zeros(0, dtype=np.uint64)
_EMPTY = np.full(PERMUTATIONS, 2**16 - 1, dtype=np.uint16)


def shingle_hashes(text: str | None, cache: WordHashes) -> np.ndarray:
    """Hashes of the shingles of a text in order; empty without words."""
    own = words(text)
    return rolled(cache.of(_START + own), SHINGLE) if own else np.zeros(0, dtype=np.uint64)


def least_values(hashes: np.ndarray) -> np.ndarray:
    """The least value of each permutation; all ones without shingles."""
    least, low = np.full(PERMUTATIONS, 2**32 - 1, dtype=np.uint32), hashes.astype(np.uint32)
    for start in range(0, len(low), _CHUNK):
        part = low[start : start + _CHUNK, None] * _FACTORS
        part += _TERMS
        np.minimum(least, part.min(axis=0), out=least)
    return least


def signature(hashes: np.ndarray) -> np.ndarray:
    """The low 16 bits of the least value of each permutation; all ones without shingles."""
    return least_values(hashes).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def readable(values: np.ndarray) -> str:
    return base64.b64encode(values.tobytes()).decode()


def bands(values: np.ndarray) -> np.ndarray:
    """A hash of each band, its number included."""
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    parts = values[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS).astype(np.uint64)
    for k in range(BAND_ROWS):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, k])
    return signed(out)


def planes(values: np.ndarray) -> np.ndarray:
    """The low `PLANES` bits of all values, plane by plane in words of 64."""
    return np.packbits((values >> np.arange(PLANES, dtype=np.uint16)[:, None]) & 1, axis=1).view(np.int64).ravel()


def sketch(distinct: np.ndarray, values: np.ndarray) -> tuple:
    """Hash, size, bands, planes and parity of a set with the signature `values`; nulls if it is empty."""
    n = len(distinct)
    if not n:
        return (None,) * 5
    return set_hash(distinct), n, bands(values), planes(values), parity(distinct, parity_words(n))


def agreeing(x: Column, y: Column) -> Column:
    """Permutations whose low bits agree, of two arrays as `planes` makes them."""
    halves = PERMUTATIONS // 64
    apart = F.lit(0)
    for half in range(halves):
        differing = [x[p * halves + half].bitwiseXOR(y[p * halves + half]) for p in range(PLANES)]
        apart = apart + F.bit_count(reduce(Column.bitwiseOR, differing))
    return F.lit(PERMUTATIONS) - apart


def least_agreeing(percent: int) -> int:
    """Permutations that agree in at least so many cases when two sets are `percent` alike."""
    share = percent / 100 + (1 - percent / 100) / 2**PLANES
    return floor(PERMUTATIONS * share - DEVIATIONS * (PERMUTATIONS * share * (1 - share)) ** 0.5)


def edited(text: str, after: str) -> str:
    """The last half of `text` replaced by as many first code points of `after`, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def same_words(text: str) -> int:
    """Words at the start of `text` that `edited` leaves alone; one less where the last may go on."""
    return max(0, len(utf8(text[: len(text) - len(text) // 2]).split()) - 1)


def compare_edits(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The next document is that of the next smaller `doc_id`; after the smallest comes
    the largest. Rows with the same id are ordered by the hash of their text, nulls
    come last, and a lone document follows itself. A null text counts as empty; all
    empty texts have the same fingerprint. Returns a row per input row: `doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`.
    An empty table gives an empty result.
    """
    return _compared(documents).drop("node", "n", "keys", "planes", "parity")


def fingerprints(documents: DataFrame, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """What `compare_edits` returns, and `group_id` as in `near_duplicates`, from the same signatures."""
    found = stored(_compared(documents), "fingerprints")
    ids = _group_ids(documents, found, percent)
    found = found.drop("n", "keys", "planes", "parity")
    grouped = found.where("node is not null").join(ids, "node")
    alone = found.where("node is null").withColumn("group_id", F.col("doc_id"))
    return grouped.drop("node").union(alone.drop("node"))


def _compared(documents: DataFrame) -> DataFrame:
    """`compare_edits`, and `sketch` of each set (nulls without words).

    The words that an edit leaves alone are hashed once for both texts.
    """
    small_batches(documents.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("packed", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [packer.compress((t or "").encode()) for t in column(batch, "text")]
            yield rows(schema, doc_id=batch.column(0), text_hash=batch.column(1), packed=packed)

    out = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ("node", pa.int64()), ("n", pa.int64()), ("keys", pa.list_(pa.int64())), ("planes", pa.list_(pa.int64())),
        ("parity", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, packer = WordHashes(), zstandard.ZstdDecompressor()
        at, after, after_values = None, "", _EMPTY
        for batch in batches:
            done = []
            for place, side, doc_id, packed in each([batch], "_range", "_side", "doc_id", "packed"):
                text = packer.decompress(packed).decode()
                own = words(text)
                word_hashes = cache.of(_START + own)
                hashes = rolled(word_hashes, SHINGLE) if own else _NONE
                kept = same_words(text) if side == OWN else 0
                common = least_values(hashes[:kept])
                values = np.minimum(common, least_values(hashes[kept:])).astype(np.uint16)
                if side == OWN:
                    if place != at:  # the only range has a copy of its last row before it
                        raise ValueError(f"range {place} has no row before it")
                    changed = edited(text, after)
                    tail = words(changed)[kept:]
                    before = word_hashes[kept : kept + SHINGLE - 1]
                    fresh = rolled(np.concatenate([before, cache.of(tail)]), SHINGLE) if tail else _NONE
                    new = np.minimum(common, least_values(fresh)).astype(np.uint16)
                    distinct = np.unique(hashes)
                    done.append((
                        doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), readable(values), readable(new),
                        likeness(values, new), likeness(values, after_values),
                        *sketch(distinct, values),
                    ))
                at, after, after_values = place, text, values
            if done:
                yield rows(out, **dict(zip(out.names, zip(*done))))

    packed = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        pack, "doc_id long, text_hash long, packed binary"
    )
    # Only ids and hashes are needed to cut the ranges.
    keys = documents.select("doc_id", F.xxhash64("text").alias("text_hash"))
    ordered = beside(packed, ["doc_id", "text_hash"], circular=True, cut_by=keys).where(F.col("_side") <= OWN)
    return ordered.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, node long, n long, keys array<bigint>, planes array<bigint>, parity array<bigint>",
    )


def _signatures(documents: DataFrame) -> DataFrame:
    """`(doc_id, node, n, keys, planes, parity)`: `sketch` of each document's set."""
    many = pa.list_(pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("keys", many), ("planes", many), ("parity", many)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            done = []
            for doc_id, text in each([batch], "doc_id", "text"):
                distinct = np.unique(shingle_hashes(text, cache))
                done.append((doc_id, *sketch(distinct, signature(distinct))))
            if done:
                yield rows(schema, **dict(zip(schema.names, zip(*done))))

    return documents.select("doc_id", "text").mapInArrow(
        run, "doc_id long, node long, n long, keys array<bigint>, planes array<bigint>, parity array<bigint>"
    )


def near_duplicates(documents: DataFrame, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """`doc_id, group_id` of every document: the least id of its near duplicates.

    Texts are near duplicates when they share a band and the Jaccard similarity of
    their shingles is at least `percent`; groups are connected. Texts without words
    are alone. A null id takes part, but a group is named by its least id that is
    not null.
    """
    small_batches(documents.sparkSession)
    found = checkpointed(_signatures(documents))
    ids = _group_ids(documents, found, percent)
    alone = found.where("node is null").select("doc_id", F.col("doc_id").alias("group_id"))
    return found.where("node is not null").select("doc_id", "node").join(ids, "node").select("doc_id", "group_id").union(alone)


def _group_ids(documents: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """`(node, group_id)` of every set; `found` has `doc_id` and what `_signatures` returns."""
    sets = stored(
        found.where("node is not null").groupBy("node")
        .agg(F.min("doc_id").alias("least_id"), *(F.first(c).alias(c) for c in ("n", "keys", "planes", "parity"))),
        "sets",
    )
    sketches = sets.select("node", "n", "planes")
    buckets = sets.select(F.explode("keys").alias("key"), "node", "n")
    least = least_agreeing(percent)

    def alike(x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
        return F.least(x("n"), y("n")) * 100 >= F.greatest(x("n"), y("n")) * percent

    def marks_alike(x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
        """Copies alike to every degree share bands: what the parities rule out is no row of the join."""
        return (agreeing(x("planes"), y("planes")) >= least) & parities_near(x, y, percent)

    def verified(pairs: DataFrame) -> DataFrame:
        for name in ("a", "b"):
            pairs = pairs.join(sketches.select(F.col("node").alias(name), F.col("planes").alias(f"{name}_planes")), name)
        pairs = pairs.where(agreeing(F.col("a_planes"), F.col("b_planes")) >= least).select("a", "b")
        pairs = stored(near_parities(pairs, sets, percent), "pairs")
        chosen = bits(nodes_of(pairs).join(sets, "node"), "least_id")
        parts = stored(segments(documents, lambda text, cache: np.unique(shingle_hashes(text, cache)), chosen), "segments")
        # Segments travel with each pair: no more pairs at a time than there are sets.
        slices = max(1, ceil(pairs.count() / max(1, sets.count())))
        links = []
        for k in range(slices):
            some = pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(slices)) == k)
            alike = (F.col("shared") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("shared")) * percent)
            links.append(stored(overlaps(some, parts).where(alike).select("a", "b"), "links"))
        for table in (pairs, parts):
            discard(table)
        return reduce(DataFrame.union, links)

    groups = connected(
        buckets, verified, alike, marks=sets.select("node", "planes", "parity"), marks_may_link=marks_alike, rounds=HUB_ROUNDS,
    )
    named = sets.select("node", "least_id").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("least_id").alias("group_id"))
    return named.select("node", "component").join(names, "component").select("node", "group_id")
