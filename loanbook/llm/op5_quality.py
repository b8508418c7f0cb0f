"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad. What a line looks like, and what the lines next
to it look like, are its features; the labels of neighbouring lines are tied by the
chain. The forward-backward marginals of a document's lines, weighted by their
lengths, are its score.

Weights are fitted on a bounded sample of labelled documents (`SAMPLE` documents, and
of a longer one `SAMPLE_LINES` lines in a row, drawn by a hash of the text), where each
line takes the label of its document. Every text is scored whole.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanbook.llm.common import each, remainder, rows, small_batches, utf8, whole_rows
from loanbook.llm.sample import labelled

#: Labelled documents the model is fitted on, and lines of each, at most.
SAMPLE = 6_000
SAMPLE_LINES = 64
MODULUS, HELD_OUT = 3, 1
THRESHOLD = 0.5
ROUNDS = 60
#: What a line looks like, and the same of the lines before and after.
LOOKS = 9
WIDTH = 3 * LOOKS + 3

_UPPER = string.ascii_uppercase.encode()
_DIGITS = string.digits.encode()
_USUAL = b".,;:'\"!?()-"
_ODD = bytes(c for c in string.punctuation.encode() if c not in _USUAL)


def lines_of(text: str | None) -> list[bytes]:
    """Lines that are not blank."""
    return [line for line in utf8(text).split(b"\n") if line.strip()]


def looks(line: bytes) -> tuple[float, ...]:
    """Shares and rates of one line, all of about the same scale."""
    n, own = len(line), line.split()
    k = len(own)

    def share(kind: bytes) -> float:
        return (n - len(line.translate(None, kind))) / n

    repeats = sum(map(eq, own, own[1:])) / max(1, k - 1)
    return (
        np.log1p(k) / 5, min(2.0, n / k / 10), 3 * share(_UPPER), 10 * share(_ODD), 5 * share(_USUAL),
        5 * share(_DIGITS), len(set(own)) / k, repeats, 5 * share(b"!"),
    )


def observed(lines: list[bytes]) -> np.ndarray:
    """`(lines, WIDTH)`: looks of each line and its neighbours, two edges and a constant."""
    n = len(lines)
    out = np.zeros((n, WIDTH))
    out[:, :LOOKS] = np.array([looks(line) for line in lines]).reshape(n, LOOKS)
    out[1:, LOOKS : 2 * LOOKS] = out[:-1, :LOOKS]
    out[:-1, 2 * LOOKS : 3 * LOOKS] = out[1:, :LOOKS]
    out[:1, -3] = out[-1:, -2] = 1.0
    out[:, -1] = 1.0
    return out


def drawn(text: str | None) -> np.ndarray:
    """What the field learns from in a text: all its lines, or `SAMPLE_LINES` in a row of a longer one."""
    lines = lines_of(text)
    start = xxhash.xxh64_intdigest(utf8(text)) % max(1, len(lines) - SAMPLE_LINES + 1)
    first = max(0, start - 1)  # a line more at both ends, whose looks the lines beside them have
    return observed(lines[first : start + SAMPLE_LINES + 1])[start - first :][:SAMPLE_LINES]


def marginals(good: np.ndarray, ties: np.ndarray) -> np.ndarray:
    """P(line is good) for `(documents, lines)` log-odds that all have the same length.

    `ties` are the four log-weights of neighbouring labels, from bad and good to bad and good.
    """
    forward, backward, _ = _passes(good, ties)
    odds = forward[..., 1] + backward[..., 1] - forward[..., 0] - backward[..., 0]
    return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def _passes(good: np.ndarray, ties: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    emit = np.stack([np.zeros_like(good), good], axis=-1)
    n = good.shape[1]
    forward, backward = np.zeros_like(emit), np.zeros_like(emit)
    forward[:, 0] = emit[:, 0]
    for t in range(1, n):
        forward[:, t] = emit[:, t] + np.logaddexp(forward[:, t - 1, :1] + ties[0], forward[:, t - 1, 1:] + ties[1])
    for t in range(n - 2, -1, -1):
        ahead = emit[:, t + 1] + backward[:, t + 1]
        backward[:, t] = np.logaddexp(ahead[:, :1] + ties[:, 0], ahead[:, 1:] + ties[:, 1])
    return forward, backward, emit


def fit(texts: list[np.ndarray], labels: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the looks and of the ties, by adaptive gradient steps on the likelihood."""
    weights, ties = np.zeros(WIDTH), np.zeros((2, 2))
    by_length: dict[int, list[int]] = {}
    for i, seen in enumerate(texts):
        by_length.setdefault(len(seen), []).append(i)
    groups = [(np.stack([texts[i] for i in own]), np.array([labels[i] for i in own])) for own in by_length.values()]
    total = sum(x.shape[0] * x.shape[1] for x, _ in groups)
    if not total:
        return weights, ties
    m, v = np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)
    for step in range(1, ROUNDS + 1):
        gradient = -1e-4 * np.concatenate([weights, ties.ravel()])
        for x, y in groups:
            forward, backward, emit = _passes(x @ weights, ties)
            whole = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
            p = np.exp(forward[..., 1] + backward[..., 1] - whole[:, None])
            gradient[:WIDTH] += np.tensordot(y[:, None] - p, x, axes=([0, 1], [0, 1])) / total
            if x.shape[1] > 1:
                joint = (
                    forward[:, :-1, :, None] + ties + (emit + backward)[:, 1:, None, :] - whole[:, None, None, None]
                )
                there = np.zeros((2, 2))
                there[0, 0], there[1, 1] = (y == 0).sum(), (y == 1).sum()
                gradient[WIDTH:] += ((there * (x.shape[1] - 1)) - np.exp(joint).sum(axis=(0, 1))).ravel() / total
        m, v = 0.8 * m + 0.2 * gradient, 0.95 * v + 0.05 * gradient**2
        move = 0.15 * (m / (1 - 0.8**step)) / (np.sqrt(v / (1 - 0.95**step)) + 1e-8)
        weights, ties = weights + move[:WIDTH], ties + move[WIDTH:].reshape(2, 2)
    return weights, ties


def _fitted(documents: DataFrame, labels: DataFrame) -> dict:
    sample = labelled(documents, labels, "quality", MODULUS, HELD_OUT, SAMPLE)
    schema = pa.schema([("looks", pa.binary()), ("label", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, label in each([batch], "text", "label"):
                seen = drawn(text)
                if len(seen):
                    out.append((seen.astype(np.float32).tobytes(), label))
            if out:
                yield rows(schema, looks=[o[0] for o in out], label=[o[1] for o in out])

    found = sample.mapInArrow(run, "looks binary, label int").collect()
    texts = [np.frombuffer(bytes(r.looks), dtype=np.float32).reshape(-1, WIDTH).astype(np.float64) for r in found]
    marks = [r.label for r in found]
    weights, ties = fit(texts, marks)
    return {"weights": weights, "ties": ties, "usual": (sum(marks) + 1) / (len(marks) + 2)}


def scored(documents: DataFrame, labels: DataFrame, carry: list[str]) -> DataFrame:
    """The columns in `carry`, and `_held_out`, `_score`, `_lines` and `_bad` of every row."""
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(_fitted(documents, labels))
    given = documents.select(
        *carry, F.col("text").alias("_text"), (remainder("doc_id", MODULUS) == HELD_OUT).alias("_held_out")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            scores, sizes, bad = [], [], []
            for (text,) in each([batch], "_text"):
                lines = lines_of(text)
                sizes.append(len(lines))
                if lines:
                    p = marginals((observed(lines) @ m["weights"])[None], m["ties"])[0]
                    lengths = np.array([len(line) for line in lines], dtype=np.float64)
                    scores.append(round(float(np.clip(p @ lengths / lengths.sum(), 0, 1)), 12))
                    bad.append(int((p < 0.5).sum()))
                else:
                    scores.append(m["usual"])
                    bad.append(0)
            kept = [batch.column(batch.schema.get_field_index(c)) for c in [*carry, "_held_out"]]
            new = [pa.array(scores, pa.float64()), pa.array(sizes, pa.int32()), pa.array(bad, pa.int32())]
            yield pa.RecordBatch.from_arrays([*kept, *new], names=[*carry, "_held_out", "_score", "_lines", "_bad"])

    added = T.StructType().add("_score", "double").add("_lines", "integer").add("_bad", "integer")
    schema = T.StructType(given.drop("_text").schema.fields + added.fields)
    return given.mapInArrow(run, schema)


def line_labels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id, line, text, p_good, good` of every line that is not blank.

    `line` counts the lines of the text from 0, blank ones too; `p_good` is the marginal
    probability that the line is good, and `good` whether it is at least a half. A null
    text has no lines. Repeated rows and null ids give rows like any others; without
    labels every `p_good` is 0.5. An empty table gives an empty result.
    """
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(_fitted(documents, labels))
    schema = pa.schema([("doc_id", pa.int64()), ("line", pa.int32()), ("text", pa.string()), ("p_good", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for doc_id, text in each(batches, "doc_id", "text"):
            own = [(i, line) for i, line in enumerate((text or "").split("\n")) if utf8(line).strip()]
            if own:
                numbers, lines = zip(*own)
                p = marginals((observed([utf8(line) for line in lines]) @ m["weights"])[None], m["ties"])[0]
                yield rows(schema, doc_id=[doc_id] * len(p), line=numbers, text=lines, p_good=p)

    found = documents.select("doc_id", "text").mapInArrow(run, "doc_id long, line int, text string, p_good double")
    return found.withColumn("good", F.col("p_good") >= 0.5)


def score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id, held_out, score, predicted, n_lines, n_bad` of every document.

    `score` is between 0 and 1, higher for better texts. A null text, or one without
    any line that is not blank, gets the share of good documents in the sample. Rows
    are scored on their own, so repeated rows give a row each; a null id counts as the
    empty text in the crc32. Without labels every score is 0.5. An empty table gives
    an empty result.
    """
    return scored(documents, labels, ["doc_id"]).select(
        "doc_id", F.col("_held_out").alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"),
        F.col("_lines").alias("n_lines"), F.col("_bad").alias("n_bad"),
    )


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is at least `THRESHOLD`, with all their columns."""
    given = whole_rows(documents, F.col("doc_id"), F.col("text"))
    return scored(given, labels, ["row"]).where(F.col("_score") >= THRESHOLD).select("row.*")
