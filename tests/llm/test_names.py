"""Columns of a user that have the names operators use themselves."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from loanbook.llm import op1_ngram_join as op1
from loanbook.llm import op2_line_dedup as op2
from loanbook.llm import op5_quality as op5
from loanbook.llm import op7_decontamination as op7
from loanbook.llm import op8_sharding as op8
from loanbook.llm import op11_spelling as op11
from loanbook.llm import op12_fim as op12
from loanbook.llm import op13_packing as op13
from tests.llm.conftest import prose
from tests.llm.test_words import TOKENIZER

NAMES = [
    "row", "text_hash", "lines", "removed", "all", "out", "long", "every", "of_id", "of_hash", "_lines", "_removed", "_out",
    "_all", "_id", "_hash", "_text_hash", "_long", "_text", "_held_out", "_score", "_bad", "_found_id", "found_id",
    "found_hash", "_gone_id", "gone_id", "gone_hash", "component", "spot", "key", "node", "n", "keys", "cut", "form",
    "ids", "word", "block", "part", "label", "quality", "a dotted.name",
]


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(9)
    texts = [prose(rng, 60, 3000) for _ in range(12)]
    texts += [texts[0], texts[1] + "\nand more", "item words that leak into this text today", None, ""]
    rows = [(i, t, *[f"{name}{i}" for name in NAMES]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in NAMES))


def untouched(found, documents):
    """Rows of `found` have the values they came with, but for the text."""
    names = [f"`{n}`" for n in documents.columns if n != "text"]
    assert found.columns[: len(documents.columns)] == documents.columns
    kept, given = ({r.doc_id: r for r in f.select(*names).collect()} for f in (found, documents))
    assert kept and all(given[i] == r for i, r in kept.items())
    return sorted(kept)


def test_rows_come_back_as_they_were(spark, documents):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(17)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "item words that leak into this text today", "x")], "item_id long, text string, size string")
    assert 12 not in untouched(op1.first_of_groups(documents), documents)
    counted = op2.dedup_lines(documents)
    assert len(untouched(counted, documents)) == 17
    assert counted.columns[-2:] == ["_lines_", "_removed_"]
    assert {r.doc_id for r in counted.where("_removed_ > 0").collect()} == {12, 13}
    assert untouched(op2.keep_first_lines(documents), documents) == [i for i in range(17) if i != 12]
    assert untouched(op5.accepted(documents, labels), documents) == list(range(17))
    assert untouched(op7.decontaminate(documents, items), documents) == [i for i in range(17) if i != 14]


def test_sharded_rows_keep_their_columns(spark):
    names = ["size", "shard", "slot", "_place", "_order", "_rank", "cell", "takes", "row", "_within", "a dotted.name"]
    given = spark.createDataFrame([(i, f"text {i}", *[f"{n}{i}" for n in names]) for i in range(50)],
                                  "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    found = op8.shard(given, 5, carry=tuple(names))
    assert found.columns == ["doc_id", "size", "text_crc32", "shard", "slot", *names]
    rows = [tuple(r) for r in found.collect()]
    assert all(r[5:] == tuple(f"{n}{r[0]}" for n in names) for r in rows)
    assert sorted((r[3], r[4]) for r in rows) == [(s, k) for s in range(5) for k in range(10)]


def test_names_do_not_matter_where_columns_are_not_kept(documents):
    plain = documents.select("doc_id", "text")
    for made in (
        lambda d: op11.variants(d, 3, 2), op12.fill_in_middle, lambda d: op13.pack(d, TOKENIZER, 256),
        op1.join_groups, lambda d: op5.score(d, d.select("doc_id", F.lit(1).alias("quality"))),
    ):
        assert sorted(map(str, made(documents).collect())) == sorted(map(str, made(plain).collect()))
