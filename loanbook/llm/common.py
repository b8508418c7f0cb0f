"""What the operators share: tables, checkpoints, words and their hashes.

A word is `[^\\x20\\x09-\\x0D]+` of the text with A-Z in lower case. Both rules
are those of `bytes.lower` and `bytes.split`, so texts are handled as UTF-8.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.session import ensure_checkpoints

# Functions that run on executors travel with the task, so that a cluster needs
# no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules["loanbook.llm"])

#: Words a task remembers before it starts afresh.
CACHED_WORDS = 1_000_000
#: Bytes of a word that is hashed by the library.
LONG = 128

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_FIRST_BYTES = np.array([2 ** (8 * n) - 1 for n in range(9)], dtype=np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(frame: DataFrame) -> DataFrame:
    """`frame` written once to the shared checkpoint folder, without its lineage."""
    ensure_checkpoints(frame.sparkSession)
    return frame.checkpoint()


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Let few rows cross to Python at once, as texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit(None)).cast("string")
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")) % modulus


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def words(text: str | None) -> list[bytes]:
    return utf8(text).lower().split()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed_pieces(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each of the pieces of `data`, eight bytes at a time."""
    data = np.append(data, np.zeros(8, dtype=np.uint8))
    pieces = np.lib.stride_tricks.sliding_window_view(data, 8)
    out = mixed(lengths.astype(np.uint64) + _ODD[0])
    left, at = np.flatnonzero(lengths <= LONG), 0
    while len(left):
        rest = lengths[left] - at
        piece = np.ascontiguousarray(pieces[starts[left] + at]).view(np.uint64).ravel()
        out[left] = mixed(out[left] * _ODD[0] + (piece & _FIRST_BYTES[np.minimum(rest, 8)]))
        left, at = left[rest > 8], at + 8
    for i in np.flatnonzero(lengths > LONG):
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + lengths[i]])
    return out


class WordHashes(dict):
    """64-bit hash of each word, worked out once while it is remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), dtype=np.uint64, count=len(tokens))


def rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` words; of the whole sequence if it is shorter."""
    n = len(hashes)
    size = min(size, n)
    if not n:
        return hashes
    total = np.full(n - size + 1, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        total = mixed(total * _ODD[k % 3] + hashes[k : n - size + 1 + k])
    return total


def shingles(tokens: list[bytes], size: int, cache: WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text; empty without words."""
    return np.unique(rolled(cache.of(tokens), size))


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )


def whole_rows(documents: DataFrame, *more: Column) -> DataFrame:
    """Each row as one column `row`, and `more`; no column of a user meets a name of ours."""
    return documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), *more)


def unused(name: str, columns: list[str]) -> str:
    """`name`, with underscores after it where `columns` have it."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def document_key() -> list[Column]:
    """Rows with the same id and text are one document."""
    return [F.col("doc_id"), F.xxhash64("text").alias("text_hash")]


def each(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of all batches, as tuples of the named columns."""
    for batch in batches:
        yield from zip(*(column(batch, name) for name in names))
