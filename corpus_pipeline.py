"""From raw documents to token ids: five stages, each written and read again.

Every stage takes `(spark, docs, sf_dir)`. All but the last return the columns of
`documents`, with `n_chars` kept true to the text.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loanbook.llm import (
    op1_ngram_join,
    op2_line_dedup,
    op4_sentencepiece,
    op5_quality,
    op7_decontamination,
)
from loanbook.llm.common import table
from loanbook.llm.links import stored

#: No stage but the decontamination can be written in SQL.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return op5_quality.accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; those that had nothing else go."""
    return op2_line_dedup.keep_first_lines(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id."""
    return op1_ngram_join.first_of_groups(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return op7_decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of the decoded text."""
    return op4_sentencepiece.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), digest=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_join),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each but the last goes through a Parquet table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
