"""Packing of token ids into sequences, in the order of the stored documents.

Every task packs the documents of its own partition as one stream: nothing is shuffled,
and a lost task is packed again to the same sequences. A dynamic programme chooses where
the stream is cut. The cost of a window is its padding, and that of a cut a penalty: none
at the end of a document, `SENTENCE` at the end of a sentence, `INSIDE` elsewhere. A
window that is padded costs `f(i) + size - (p(j) - p(i))`, so the best start of all
windows that end at j is the least `f(i) + p(i)` that is still within reach: the head of a
monotone queue. Lengths at a power of two are not padded; those starts are looked up.

Streams are solved in blocks of `TOKENS` ids. A block keeps its sequences but the last few,
which are solved again with the next one. In the last `size` ids of a partition every
place may be a cut, so that what is left over goes to lengths that need no padding.

A tokenizer that drops white space encodes words apart from each other, so each distinct word
of some megabytes of text is encoded once.
"""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from loanbook.llm.common import rows, small_batches

#: Cost of a cut at the end of a sentence and elsewhere, in ids of padding.
SENTENCE, INSIDE = 8, 24
#: Places inside longer sentences where a stream can be cut, one in so many ids.
STRIDE = 96
#: Ids that are solved at once.
TOKENS = 1 << 19
#: Bytes of text that are encoded together, and ids of parts of words that a task remembers.
TOGETHER, HELD = 8 << 20, 1 << 23
#: Rows of one output batch.
BATCH = 2_000

# Words that the normaliser only puts in lower case, and how the tokenizer's own pattern cuts
# them then (fixed value). The marks of special tokens are looked for before it is applied.
_PLAIN, _MARK = "^[\\x21-\\x7EÀ-ÖØ-öø-ÿ]+$", "<|"
_PARTS = "('s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+)"
_SENTENCE_END = "[.!?…。！？][\"')\\]»”]*$"

_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])


def gathered(ids: np.ndarray, first: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs `first[k]` to `first[k + 1]` of `ids` for each k of `at`, and where each ends."""
    sizes = first[at + 1] - first[at]
    after = np.cumsum(sizes)
    shift = np.repeat(first[at] - (after - sizes), sizes)
    return ids[shift + np.arange(len(shift))], after


class Known:
    """Ids of each key met so far, one after the other in one array."""

    def __init__(self) -> None:
        self.places: dict[str, int] = {}
        self.ids, self.first = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def missing(self, keys: list[str]) -> list[str]:
        return [key for key in keys if key not in self.places]

    def add(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.places.update(zip(keys, range(len(self.places), len(self.places) + len(keys))))
        self.ids = np.concatenate([self.ids, ids])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])

    def at(self, keys: list[str]) -> np.ndarray:
        return np.fromiter(map(self.places.__getitem__, keys), np.int64, len(keys))

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return gathered(self.ids, self.first, at)


class WordTable:
    """Ids of words, each distinct one encoded once, as the library encodes them.

    A word is a run between ASCII white space. The tokenizer's pattern never crosses white
    space and drops it, and no character composes with it. Words of plain characters
    are cut further by that pattern, and their distinct parts are remembered.
    """

    def __init__(self, path: str):
        self.whole, self.bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.parts = Known()

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all `words` one after the other, and the number of each."""
        plain = pc.and_not(pc.match_substring_regex(words, _PLAIN), pc.match_substring(words, _MARK))
        cut = pc.replace_substring_regex(pc.utf8_lower(words.filter(plain)), _PARTS, "\\1 ")
        split = pc.ascii_split_whitespace(cut)
        coded = split.flatten().dictionary_encode()
        parts = coded.dictionary.to_pylist()
        if len(self.parts.ids) > HELD:
            self.parts = Known()
        new = self.parts.missing(parts)
        if new:
            encoded = self.bare.encode(new, is_pretokenized=True, add_special_tokens=False)
            sizes = np.bincount(np.array(encoded.word_ids, np.int64), minlength=len(new))
            self.parts.add(new, np.array(encoded.ids, np.uint32), sizes)
        ids, after = self.parts.gather(self.parts.at(parts)[coded.indices.to_numpy()])
        sizes = np.diff(np.concatenate([[0], after])[split.offsets.to_numpy()])
        others = words.filter(pc.invert(plain)).to_pylist()
        if not others:
            return ids, sizes
        encoded = [e.ids for e in self.whole.encode_batch_fast(others, add_special_tokens=False)]
        own = np.fromiter(map(len, encoded), np.int64, len(encoded))
        ids = np.concatenate([ids, np.fromiter(chain.from_iterable(encoded), np.uint32, own.sum())])
        # Plain words come first here; back to the order of `words`.
        order = np.argsort(np.argsort(~plain.to_numpy(False), kind="stable"), kind="stable")
        sizes = np.concatenate([sizes, own])
        return gathered(ids, np.concatenate([[0], np.cumsum(sizes)]), order)[0], sizes[order]

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of each text, and the places in them where sentences end."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        place = coded.indices.to_numpy()
        closing = pc.match_substring_regex(coded.dictionary, _SENTENCE_END).to_numpy(False)[place]
        ids, sizes = self._of_words(coded.dictionary)
        ids, after = gathered(ids, np.concatenate([[0], np.cumsum(sizes)]), place)
        after = np.concatenate([[0], after])
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            ends = after[low + 1 : high + 1][closing[low:high]]
            yield ids[after[low] : after[high]], ends - after[low]


def cut_places(length: int, sentences: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Where a document of `length` ids may be cut, and at what cost; its end is free.

    Sentence ends, and every `stride` ids of what lies further apart.
    """
    inner = np.unique(sentences[(sentences > 0) & (sentences < length)])
    bounds = np.concatenate([[0], inner, [length]])
    wide = np.nonzero(np.diff(bounds) > stride)[0]
    if not len(wide):
        return bounds[1:], np.append(np.full(len(inner), SENTENCE), 0)
    strided = np.concatenate([np.arange(bounds[i] + stride, bounds[i + 1], stride) for i in wide])
    places = np.concatenate([inner, strided])
    costs = np.concatenate([np.full(len(inner), SENTENCE), np.full(len(strided), INSIDE)])
    order = np.argsort(places)
    return np.append(places[order], length), np.append(costs[order], 0)


def best_cuts(places: np.ndarray, costs: np.ndarray, size: int, least_power: int = 1) -> list[int]:
    """Places that end the windows of least cost over a stream that starts at 0.

    `places` ascend without repeats, no two further apart than `size`; the last is the end.
    Windows of a power of two count as padded if it is less than `least_power`.
    """
    where, price = [0, *places.tolist()], [0, *costs.tolist()]
    whole = np.concatenate([[0], places])
    # Starts of windows at a power of two, for the few ends that have one.
    unpadded: dict[int, list[int]] = {}
    power = least_power
    while power < size:
        start = np.searchsorted(whole, whole - power)
        for j in np.nonzero((whole >= power) & (whole[np.minimum(start, len(whole) - 1)] == whole - power))[0]:
            unpadded.setdefault(int(j), []).append(int(start[j]))
        power *= 2
    total, came = [0] * len(where), [0] * len(where)
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (f + p, index), ascending in both
    for j in range(1, len(where)):
        at = where[j]
        while where[queue[0][1]] < at - size:
            queue.popleft()
        least, start = queue[0]
        least += size - at
        for i in unpadded.get(j, ()):
            if total[i] < least:
                least, start = total[i], i
        total[j], came[j] = least + price[j], start
        key = total[j] + at
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    ends, j = [], len(where) - 1
    while j:
        ends.append(where[j])
        j = came[j]
    return ends[::-1]


class Stream:
    """Documents of one partition that are not in a sequence yet."""

    def __init__(self, size: int, first_sequence: int):
        self.size, self.sequence = size, first_sequence
        # Per document: id, all its ids, and how many of them are in sequences.
        self.documents: deque[list] = deque()
        self.places: list[tuple[np.ndarray, np.ndarray]] = []
        self.length = 0

    def add(self, doc_id: int | None, ids: np.ndarray, sentences: np.ndarray) -> None:
        places, costs = cut_places(len(ids), sentences, min(STRIDE, max(1, self.size // 16)))
        self.documents.append([doc_id, ids, 0])
        self.places.append((places + self.length, costs))
        self.length += len(ids)

    def pieces(self, last: bool) -> Iterator[tuple]:
        """Cut off sequences: all of them if `last`, else all but the last few."""
        if not self.length:
            return
        places = np.concatenate([p for p, _ in self.places])
        costs = np.concatenate([c for _, c in self.places])
        if last:
            anywhere = np.setdiff1d(np.arange(max(1, self.length - self.size), self.length), places)
            places, costs = np.append(places, anywhere), np.append(costs, np.full(len(anywhere), INSIDE))
            order = np.argsort(places, kind="stable")
            places, costs = places[order], costs[order]
        ends = best_cuts(places, costs, self.size, 1 if last else max(1, self.size // 32))
        if not last:
            ends = [end for end in ends if end <= self.length - 4 * self.size]
        begin = 0
        for end in ends:
            yield from self._sequence(end - begin)
            begin = end
        kept = places > begin
        self.places = [(places[kept] - begin, costs[kept])]
        self.length -= begin

    def _sequence(self, length: int) -> Iterator[tuple]:
        offset = 0
        while offset < length:
            document = self.documents[0]
            doc_id, ids, start = document
            taken = min(length - offset, len(ids) - start)
            piece = ids[start : start + taken].astype("<u4").tobytes()
            yield doc_id, start, taken, piece, len(ids), self.sequence, offset
            offset += taken
            document[2] = start + taken
            if document[2] == len(ids):
                self.documents.popleft()
        self.sequence += 1


def together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, pa.Array]]:
    """Ids and texts of batches that have `TOGETHER` bytes or more between them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= TOGETHER:
            yield _joined(held)
            held = []
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> tuple[list, pa.Array]:
    table = pa.Table.from_batches(held).combine_chunks()
    texts = table["text"].combine_chunks()
    return table["doc_id"].to_pylist(), texts


def pack(documents: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of all documents in sequences of at most `size` ids.

    `(doc_id, start, length, ids, doc_tokens, sequence_id, offset)`: `ids` are the piece's
    ids as little-endian 32-bit values, `start` the ids of its document before it, `offset`
    those of its sequence. A document is its ids in the tokenizer file `tokenizer`, which must
    drop white space, and then `end_id`; a null text is empty, so it has that id only.
    Repeated rows are documents of their own. Sequences follow the order of rows within
    partitions; `sequence_id` is the partition's number times 2^33 plus the place there.
    `size` is a power of two. Columns other than `doc_id` and `text` are not looked at.
    """
    if size & (size - 1):
        raise ValueError("the size of sequences must be a power of two")
    spark = documents.sparkSession
    small_batches(spark)
    spark.sparkContext.addFile(tokenizer)
    name = os.path.basename(tokenizer)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The library would start a thread for each core of the machine.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        table = WordTable(SparkFiles.get(name))
        stream = Stream(size, TaskContext.get().partitionId() << 33)
        found: list[tuple] = []
        end = np.array([end_id], np.uint32)
        for ids_of, texts in together(batches):
            for doc_id, (ids, sentences) in zip(ids_of, table.encode(texts)):
                stream.add(doc_id, np.concatenate([ids, end]), sentences)
                if stream.length >= TOKENS:
                    found += stream.pieces(False)
                while len(found) >= BATCH:
                    yield rows(_PIECES, **dict(zip(_PIECES.names, zip(*found[:BATCH]))))
                    found = found[BATCH:]
        found += stream.pieces(True)
        for at in range(0, len(found), BATCH):
            yield rows(_PIECES, **dict(zip(_PIECES.names, zip(*found[at : at + BATCH]))))

    schema = (
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
    return documents.select("doc_id", "text").mapInArrow(packed, schema)
