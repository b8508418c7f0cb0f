"""SentencePiece encoding and decoding over a table of distinct chunks.

No piece of the vocabulary has a white-space marker after another character
(`check_pieces` makes sure), so no piece crosses from a word into the marker
before the next one. A text is therefore cut in front of each run of markers.
Each task keeps a table of the chunks it has met, segments a chunk with the
library when it is new, and joins the stored ids back by position. The table
starts afresh at `CHUNKS` entries; what it holds never changes a result.

Nothing is shuffled. A corpus-wide chunk table would be joined back over one row
for every word, several times the size of the texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from loanbook.llm.common import each, rows, small_batches

#: Chunks a task remembers.
CHUNKS = 400_000
#: Characters of a chunk that is worth remembering.
REMEMBERED = 64
#: Rows of one output batch.
BATCH = 256

MARKER = "▁"
_CHUNK = re.compile(" +[^ ]*")

_DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_FULL = "doc_id long, ids array<int>, decoded string"


def check_pieces(model: sentencepiece.SentencePieceProcessor) -> None:
    """Raise if a piece has a marker after another character."""
    for i in range(model.get_piece_size()):
        if MARKER in model.id_to_piece(i).lstrip(MARKER):
            raise ValueError(f"piece {i} crosses a white-space marker")


class ChunkTable:
    """Ids of each distinct marked chunk."""

    def __init__(self, model: sentencepiece.SentencePieceProcessor):
        check_pieces(model)
        self.model = model
        self.marker = model.piece_to_id(MARKER)
        self.known: dict[str, list[int]] = {}

    def ids(self, text: str) -> list[int]:
        """Exactly the library's ids of the whole text."""
        if not text:
            return []
        # The library puts one marker before a text; a marker in the text is a space.
        chunks = _CHUNK.findall(" " + text.replace(MARKER, " "))
        known = self.known
        for chunk in set(chunks).difference(known):
            if len(known) >= CHUNKS:
                known = self.known = {}
                known.update((c, self._segment(c)) for c in set(chunks))
                break
            known[chunk] = self._segment(chunk)
        ids: list[int] = []
        for chunk in chunks:
            ids += known[chunk]
        for chunk in {c for c in chunks if len(c) > REMEMBERED}:
            del known[chunk]
        return ids

    def _segment(self, chunk: str) -> list[int]:
        # The library adds the first marker, but not to an empty text.
        return self.model.encode(chunk[1:], num_threads=1) if len(chunk) > 1 else [self.marker]


def _model(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def _shipped(spark: SparkSession, path: str) -> str:
    """The model's file name, after the file has been sent to the executors."""
    name = path.rsplit("/", 1)[-1]
    if name not in {f.rsplit("/", 1)[-1] for f in spark.sparkContext.listFiles}:
        spark.sparkContext.addFile(path)
    return name


def encode(documents: DataFrame, model_path: str, digest: bool = False) -> DataFrame:
    """Ids and decoded text of every document, or digests of both.

    Takes `doc_id` and `text`; other columns are ignored. A null text counts as
    empty: no ids, and the decoded text is empty. Repeated rows and null ids give
    a row each. No begin or end ids, no sampling.
    """
    name = _shipped(documents.sparkSession, model_path)
    small_batches(documents.sparkSession)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
        if digest
        else [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(SparkFiles.get(name))
        table, out = ChunkTable(model), []
        for doc_id, text in each(batches, "doc_id", "text"):
            ids = table.ids(text or "")
            decoded = model.decode(ids) if ids else ""
            if digest:
                listed = ",".join(map(str, ids)).encode()
                out.append((doc_id, len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
            else:
                out.append((doc_id, ids, decoded))
            if len(out) == BATCH:
                yield rows(schema, **dict(zip(schema.names, zip(*out))))
                out = []
        if out:
            yield rows(schema, **dict(zip(schema.names, zip(*out))))

    return documents.select("doc_id", "text").mapInArrow(run, _DIGEST if digest else _FULL)
