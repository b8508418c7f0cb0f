"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import remainder


def labelled(documents: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, bound: int) -> DataFrame:
    """`(doc_id, text, label)` of at most `bound` labels, the first by a hash of the id.

    Labels whose remainder is `held_out`, and null ids or labels, are not used. An id
    with several labels counts once, with the larger label.
    """
    drawn = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (remainder("doc_id", modulus) != held_out))
        .groupBy("doc_id").agg(F.max(label).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )
    # At most `bound` ids and labels: small enough for every task.
    return documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic regression by Newton steps, the constant last."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weights = np.zeros(x.shape[1])
    if not len(y):
        return weights
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (y - p) - ridge * len(y) * np.append(weights[:-1], 0)
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * len(y) * np.eye(len(weights))
        weights = weights + np.clip(np.linalg.solve(curve, gradient), -3, 3)
    return weights


def logit(p):
    return np.log(p) - np.log1p(-p)
