"""Toxicity by maximum-scoring segments of token log-odds.

A token's score is its log-odds between toxic and other documents, less a drift that
makes ordinary text negative. Counts are smoothed by Dirichlet priors: the prior of
a word is the estimate of its longest known beginning, that of a beginning is the
next shorter one's, and so on to the rate of all tokens, so a word never seen takes
the odds of how it begins. A linear scan finds every maximal segment. Extreme-value
statistics say how high a segment reaches by chance in a text of that length; what
is above that is aggregated per document and calibrated to a probability.

Counts and calibration come from a bounded sample of labelled documents
(`SAMPLE`); each half of it is calibrated with the counts of the other half. All
tables have a fixed size. Every text is scored whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import CACHED_WORDS, each, remainder, rows, small_batches, utf8, words
from loanbook.llm.sample import labelled, logistic, logit

#: Labelled documents the model is fitted on, at most.
SAMPLE = 20_000
MODULUS, HELD_OUT = 4, 2
#: Scores from which `predicted` is 1.
THRESHOLD = 0.3
#: Buckets of words and beginnings.
BUCKETS = 2**19
#: Lengths in bytes of the beginnings of a word.
BEGINNINGS = (4, 6, 8)
#: Weight of a prior, in documents.
PRIOR = 3.0
DRIFT = 1.0
#: A segment is significant when chance reaches it in this share of texts.
CHANCE = 0.05
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_EDGES = b".,;:!?*#$%&|\"'()[]{}<>-_~`^+=/\\"


def bucket(feature: bytes) -> int:
    return xxhash.xxh64_intdigest(feature) % BUCKETS


def chain_of(word: bytes) -> list[int]:
    """Buckets of a word's beginnings, short to long, and of the whole word."""
    return [bucket(b"^%d:" % k + word[:k]) for k in BEGINNINGS if len(word) > k] + [bucket(b"=" + word)]


def tokens(text: str | None) -> list[bytes]:
    return [w for w in (w.strip(_EDGES) for w in words(text)) if w]


def places(text: str | None) -> tuple[bytes, list[tuple[int, int]]]:
    """The text as UTF-8, and where in it the word of each of its `tokens` begins and ends."""
    whole = utf8(text)
    return whole, [m.span() for m in _WORD.finditer(whole) if m.group().strip(_EDGES)]


class Odds(dict):
    """Score of each word, worked out once while it is remembered.

    `counts` has, per bucket, documents and toxic documents; the last row counts tokens.
    """

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        total, toxic = counts[-1]
        self.rate = (toxic + 1.0) / (total + 10.0)

    def __missing__(self, word: bytes) -> float:
        if len(self) >= CACHED_WORDS:
            self.clear()
        rate = self.rate
        for at in chain_of(word):
            seen, toxic = self.counts[at]
            rate = (toxic + PRIOR * rate) / (seen + PRIOR)
        value = self[word] = float(logit(rate) - logit(self.rate)) - DRIFT
        return value

    def of(self, own: list[bytes]) -> np.ndarray:
        """Scores of the tokens of a text; a word right after itself says nothing new."""
        scores = np.fromiter(map(self.__getitem__, own), dtype=np.float64, count=len(own))
        again = np.fromiter(map(eq, own, own[1:]), dtype=bool, count=max(0, len(own) - 1))
        scores[1:][again] = np.minimum(scores[1:][again], -DRIFT)
        return scores


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """Every maximal-scoring segment as (score, start, end), in one pass.

    Each positive token opens a segment. It is joined with the last one that began
    lower, if that one ended lower than the new one does, and so on; `links` keeps
    where the last lower beginning is, so that no segment is looked at twice.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[list] = []  # start, end, height at start, height at end, link
    for i in np.flatnonzero(scores > 0).tolist():
        start, low, high = i, sums[i], sums[i + 1]
        at = len(found) - 1
        while True:
            while at >= 0 and found[at][2] >= low:
                at = found[at][4]
            if at < 0 or found[at][3] >= high:
                break
            start, low = found[at][0], found[at][2]
            del found[at:]
            at -= 1
        found.append([start, i + 1, low, high, at])
    return [(float(high - low), start, end) for start, end, low, high, _ in found]


def decay(scores: np.ndarray) -> float:
    """The positive root of E[exp(x * score)] = 1 for scores of ordinary tokens."""
    if not len(scores) or scores.mean() >= 0 or scores.max() <= 0:
        return 1.0
    low, high = 0.0, 1.0
    while np.exp(np.clip(high * scores, -700, 700)).mean() < 1 and high < 64:
        low, high = high, high * 2
    for _ in range(50):
        middle = (low + high) / 2
        low, high = (middle, high) if np.exp(np.clip(middle * scores, -700, 700)).mean() < 1 else (low, middle)
    return (low + high) / 2


def reaching(own: list[bytes], odds: Odds, rate: float) -> list[tuple[float, int, int]]:
    """Every maximal segment as (how far it is above chance, first token, token after the last)."""
    chance = np.log(len(own) + 1.0)
    return [(rate * s - chance, start, end) for s, start, end in segments(odds.of(own))]


def significant(found: list[tuple[float, int, int]]) -> list[tuple[float, int, int]]:
    return [segment for segment in found if segment[0] > -np.log(CHANCE)]


def measured(own: list[bytes], odds: Odds, rate: float) -> tuple[float, float, float, int]:
    """The best segment above chance, the sum of significant ones, the log length, and their number."""
    found = reaching(own, odds, rate)
    chance = np.log(len(own) + 1.0)
    high = [above for above, _, _ in significant(found)]
    return max((above for above, _, _ in found), default=-chance), float(np.log1p(sum(high))), float(chance), len(high)


_COUNTS = pa.schema([("half", pa.int32()), ("bucket", pa.int64()), ("seen", pa.int64()), ("toxic", pa.int64())])


def _counts(sample: DataFrame) -> list[np.ndarray]:
    """Counts of both halves of the sample: `BUCKETS` rows and the total."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for doc_id, text, label in each(batches, "doc_id", "text", "label"):
            half, own = xxhash.xxh64_intdigest(str(doc_id)) & 1, set(tokens(text))
            named = Counter({b for w in own for b in chain_of(w)})
            named[BUCKETS] = len(own)
            for b, k in named.items():
                cell = seen.setdefault((half, b), [0, 0])
                cell[0] += k
                cell[1] += k * label
        if seen:
            keys, values = zip(*seen.items())
            yield rows(_COUNTS, half=[k[0] for k in keys], bucket=[k[1] for k in keys],
                       seen=[v[0] for v in values], toxic=[v[1] for v in values])

    found = sample.mapInArrow(run, "half int, bucket long, seen long, toxic long")
    summed = found.groupBy("half", "bucket").agg(F.sum("seen").alias("seen"), F.sum("toxic").alias("toxic")).toPandas()
    out = []
    for half in (0, 1):
        own, counts = summed[summed["half"] == half], np.zeros((BUCKETS + 1, 2), dtype=np.float32)
        counts[own["bucket"].to_numpy(dtype=np.int64)] = own[["seen", "toxic"]].to_numpy(dtype=np.float32)
        out.append(counts)
    return out


def fit(documents: DataFrame, labels: DataFrame) -> dict:
    """Counts, decay rate and calibration from the labels that are not held out."""
    spark = documents.sparkSession
    sample = labelled(documents, labels, "toxic", MODULUS, HELD_OUT, SAMPLE)
    halves = _counts(sample)
    shared = spark.sparkContext.broadcast(halves)
    grid = np.arange(-200, 201) / 10.0

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds, ordinary = [Odds(shared.value[1]), Odds(shared.value[0])], np.zeros(len(grid), dtype=np.int64)
        for doc_id, text, label in each(batches, "doc_id", "text", "label"):
            if not label:
                scores = odds[xxhash.xxh64_intdigest(str(doc_id)) & 1].of(tokens(text))
                ordinary += np.bincount(np.clip(np.rint(scores * 10) + 200, 0, 400).astype(np.int64), minlength=len(grid))
        yield rows(pa.schema([("counts", pa.list_(pa.int64()))]), counts=[ordinary])

    ordinary = np.zeros(len(grid), dtype=np.int64)
    for (counts,) in sample.mapInArrow(scored, "counts array<bigint>").collect():
        ordinary += np.array(counts, dtype=np.int64)
    thinned = np.repeat(grid, np.ceil(ordinary * (1e5 / max(1, ordinary.sum()))).astype(np.int64))
    rate = decay(thinned)
    schema = pa.schema([(c, pa.float64()) for c in ("top", "total", "chance", "label")])

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds = [Odds(shared.value[1]), Odds(shared.value[0])]
        out = [
            (*measured(tokens(text), odds[xxhash.xxh64_intdigest(str(doc_id)) & 1], rate)[:3], float(label))
            for doc_id, text, label in each(batches, "doc_id", "text", "label")
        ]
        if out:
            yield rows(schema, **dict(zip(schema.names, zip(*out))))

    found = sample.mapInArrow(reached, "top double, total double, chance double, label double").toPandas()
    x = found[["top", "total", "chance"]].to_numpy(dtype=np.float64)
    y = found["label"].to_numpy(dtype=np.float64)
    middle, spread = (x.mean(axis=0), x.std(axis=0) + 1e-9) if len(x) else (np.zeros(3), np.ones(3))
    return {
        "counts": halves[0] + halves[1], "rate": rate, "middle": middle, "spread": spread,
        "weights": logistic((x - middle) / spread, y),
    }


def score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id, held_out, score, predicted, n_segments` of every document.

    `score` is between 0 and 1, higher for likelier toxic texts; a null or empty text
    has no segments and gets a score too. Repeated rows give a row each; a null id
    counts as the empty text in the crc32. Without labels every score is 0.5. An
    empty table gives an empty result.
    """
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(fit(documents, labels))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("n_segments", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        odds = Odds(m["counts"])
        for batch in batches:
            out = []
            for doc_id, held_out, text in each([batch], "doc_id", "held_out", "text"):
                *reached, n = measured(tokens(text), odds, m["rate"])
                x = np.append((np.array(reached) - m["middle"]) / m["spread"], 1.0)
                out.append((doc_id, held_out, float(1 / (1 + np.exp(-np.clip(x @ m["weights"], -30, 30)))), n))
            if out:
                yield rows(schema, **dict(zip(schema.names, zip(*out))))

    given = documents.select("doc_id", (remainder("doc_id", MODULUS) == HELD_OUT).alias("held_out"), "text")
    scored = given.mapInArrow(run, "doc_id long, held_out boolean, score double, n_segments int")
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_segments"
    )


def passages(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id, start, end, above, text` of every significant toxic passage.

    `start` and `end` count code points of the document's text from 0, `end` behind the
    last; `above` is how far the passage is above what chance reaches in a text of that
    length. A document has as many rows as `score` gives it `n_segments`; null and
    empty texts have none. Repeated rows and null ids give rows like any others. An empty
    table gives an empty result.
    """
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(fit(documents, labels))
    schema = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("above", pa.float64()), ("text", pa.string()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        odds = Odds(m["counts"])
        for doc_id, text in each(batches, "doc_id", "text"):
            found = sorted(significant(reaching(tokens(text), odds, m["rate"])), key=lambda segment: segment[1])
            if not found:
                continue
            whole, spans = places(text)
            out, at, chars = [], 0, 0
            for above, first, behind in found:
                start, end = spans[first][0], spans[behind - 1][1]
                chars += len(whole[at:start].decode())
                passage = whole[start:end].decode()
                out.append((doc_id, chars, chars + len(passage), above, passage))
                at, chars = end, chars + len(passage)
            yield rows(schema, **dict(zip(schema.names, zip(*out))))

    return documents.select("doc_id", "text").mapInArrow(
        run, "doc_id long, start long, end long, above double, text string"
    )
