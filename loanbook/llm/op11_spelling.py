"""Spelling variants: words one edit apart, compared tile by tile in dense matrices.

Two words are one edit apart exactly when their common prefix and suffix together
reach the longer length minus one. The edit spares the first or the last half
of the shorter word, so words meet in *tiles*: words of lengths L and L + 1 with
the same first L // 2 or the same last L - L // 2 code points. Every word is in
four tiles. A tile is a pair of matrices of padded code points, one aligned at the
first and one at the last letter, of which all rows are compared at once. Tiles of
more than `BLOCK` words are cut into blocks, and each pair of blocks is a tile of its own.

Rows without text or words give nothing; repeated rows count each time; a null id is
an empty one. Columns other than `doc_id` and `text` are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import checkpointed, each, rows, small_batches
from loanbook.llm.links import stored

#: Words of a tile, and cells of its matrices that are compared at once.
BLOCK, CELLS = 1024, 4_000_000
#: Distinct words that a task counts before it passes the counts on.
COUNTED = 500_000
#: Rows of one output batch.
BATCH = 50_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_LINKS = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def seen_word(doc_id: object, run: str, period: int) -> str:
    """`run` as the document has it: one run in `period` loses a code point."""
    place = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if place % period:
        return run
    at = place % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(documents: DataFrame, least_length: int = 6, least_count: int = 5, period: int = 199) -> DataFrame:
    """`(word, n)` of all words of at least that length and count.

    A word is a maximal run of letters up to U+00FF with A-Z in lower case, less a
    code point where crc32 of `<doc_id>:<run>` is a multiple of `period`.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for doc_id, text in each(batches, "doc_id", "text"):
            for run, n in Counter(_RUN.findall(text.encode().lower().decode())).items():
                word = seen_word(doc_id, run, period)
                if len(word) >= least_length:
                    counts[word] += n
            if len(counts) >= COUNTED:
                yield rows(_COUNTS, word=list(counts), n=list(counts.values()))
                counts = Counter()
        yield rows(_COUNTS, word=list(counts), n=list(counts.values()))

    small_batches(documents.sparkSession)
    texts = documents.where("text is not null").select("doc_id", "text")
    return (
        texts.mapInArrow(counted, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)
    )


def tiles(words: DataFrame) -> DataFrame:
    """Every word in its four tiles, `(tile, base, by_start, part, within, block, word, n)`.

    `base` is the shorter length of the tile. A tile of more than `BLOCK` words has a
    `part` `within` each of its blocks and one for each two of them.
    """
    length = F.length("word")
    base, half = F.col("base"), F.floor(F.col("base") / 2).cast("int")
    first, last = F.substr("word", F.lit(1), half), F.expr("right(word, base - cast(floor(base / 2) as int))")
    dealt = (
        words.withColumn("base", F.explode(F.array(length, length - 1)))
        .withColumn("by_start", F.explode(F.array(F.lit(True), F.lit(False))))
        .withColumn("tile", F.concat_ws("|", base, F.col("by_start").cast("int"), F.when(F.col("by_start"), first).otherwise(last)))
    )
    large = (
        dealt.groupBy("tile").count().where(F.col("count") > BLOCK)
        .select("tile", F.ceil(F.col("count") / BLOCK).alias("blocks"))
    )
    cut = dealt.join(large, "tile", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    return (
        cut.withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("within", F.col("block") == F.col("other"))
        .withColumn("part", F.least("block", "other") * F.col("blocks") + F.greatest("block", "other"))
        .drop("other", "blocks")
    )


def padded(words: list[str], width: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of `words`, one row each: aligned at the first letter, and backwards from the last."""
    ahead, back = np.full((len(words), width), pad, np.uint8), np.full((len(words), width), pad, np.uint8)
    for row, word in enumerate(words):
        points = np.frombuffer(word.encode("latin-1"), np.uint8)
        ahead[row, : len(points)] = points
        back[row, : len(points)] = points[::-1]
    return ahead, back


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading columns in which each row of `a` equals each row of `b`."""
    alike = np.ones((len(a), len(b)), bool)
    total = np.zeros((len(a), len(b)), np.int32)
    for column in range(a.shape[1]):
        alike &= a[:, column, None] == b[None, :, column]
        if not alike.any():
            break
        total += alike
    return total


def one_edit(left: list[str], right: list[str], skip_prefix: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places in `left` and `right` of different words one edit apart.

    The words of a list have one length, and `right` has the same or one more.
    Pairs with a common prefix of `skip_prefix` or more are left out.
    """
    if not left or not right:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = len(right[0])
    a, b = padded(left, width, 0), padded(right, width, 1)
    step = max(1, CELLS // len(right))
    found = []
    for at in range(0, len(left), step):
        prefix = _common(a[0][at : at + step], b[0])
        suffix = _common(a[1][at : at + step], b[1])
        near = (prefix + suffix >= width - 1) & (prefix < width)
        if skip_prefix is not None:
            near &= prefix < skip_prefix
        x, y = np.nonzero(near)
        found.append((x + at, y))
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def compare(
    base: int, by_start: bool, within: bool, members: list[tuple[int, str, int]]
) -> Iterator[tuple[str, str, int]]:
    """`(word, near word, its count)` both ways of the pairs of one tile.

    A tile by the last half leaves out what the tile by the first half finds. Members
    are `(block, word, n)`; unless `within` one block, only words of different blocks meet.
    """
    counts = {word: n for _, word, n in members}
    blocks: dict[int, tuple[list[str], list[str]]] = {}
    for block, word, _ in members:
        blocks.setdefault(block, ([], []))[len(word) - base].append(word)
    skip = None if by_start else base // 2
    sides = list(blocks.values())
    short, long = sides[0]
    if within:
        # Each pair of words of one length is there twice.
        pairs = [(short, short, True), (short, long, False)]
    elif len(sides) == 1:
        return
    else:
        other_short, other_long = sides[1]
        pairs = [(short, other_short, False), (short, other_long, False), (other_short, long, False)]
    for left, right, twice in pairs:
        for x, y in zip(*one_edit(left, right, skip)):
            a, b = left[x], right[y]
            yield a, b, counts[b]
            if not twice:
                yield b, a, counts[a]


def near_words(words: DataFrame) -> DataFrame:
    """`(word, near, near_n)` of all pairs of `words` (`word`, `n`) one edit apart, both ways."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[str, str, int]] = []
        names = ("tile", "part", "base", "by_start", "within", "block", "word", "n")
        for (*_, base, by_start, within), tile in groupby(each(batches, *names), itemgetter(slice(0, 5))):
            members = [row[5:] for row in tile]
            if len(members) > 1:
                found += compare(base, by_start, within, members)
            if len(found) >= BATCH:
                yield rows(_LINKS, **dict(zip(_LINKS.names, zip(*found))))
                found = []
        if found:
            yield rows(_LINKS, **dict(zip(_LINKS.names, zip(*found))))

    gathered = tiles(words).repartition("tile", "part").sortWithinPartitions("tile", "part")
    return gathered.mapInArrow(compared, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """`(word, root)` of every word that has a form (`word`, `form`): the end of its forms.

    Each round doubles the way; a form has a multiple of its word's count, so ways end.
    """
    reached = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = checkpointed(reached.join(ahead, "root", "left"))
        if further.where("next is not null").isEmpty():
            return reached
        reached = further.select("word", F.coalesce("next", "root").alias("root"))


def variants(
    documents: DataFrame, least_length: int = 6, least_count: int = 5, period: int = 199, ratio: int = 5
) -> DataFrame:
    """Words with the usual spelling of each: `(word, n, n_near, form, form_n, root)`.

    A word's form is its near word of largest count, the first in code-point order among
    equals, if that count is at least `ratio` times its own; else null. `root` is
    where the forms end, the word itself if it has none.
    """
    words = stored(word_counts(documents, least_length, least_count, period), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word")))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    usual = -F.col("best.less") >= ratio * F.col("n")
    linked = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(usual, F.col("best.word")).alias("form"),
            F.when(usual, -F.col("best.less")).alias("form_n"),
        ),
        "near-words",
    )
    ends = roots(linked.where("form is not null"))
    return linked.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
