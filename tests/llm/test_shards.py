"""Shard sizes, the matrix and the uniformity of the shuffle."""

from __future__ import annotations

import zlib
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from loanbook.llm import op8_sharding as op8
from tests.llm.conftest import DOCUMENTS


@pytest.mark.parametrize(("total", "marked", "drawn"), [(30, 11, 9), (5, 5, 2), (7, 0, 3), (6, 3, 6), (0, 0, 0), (40, 39, 20)])
def test_draws_follow_the_hypergeometric_law(spark, total, marked, drawn):
    n = 4000
    args = [F.lit(x).cast("bigint") for x in (total, marked, drawn)]
    at = (F.col("id") + 0.5) / n
    found = Counter(r[0] for r in spark.range(n).select(op8.hypergeometric(*args, at)).collect())
    for k in range(drawn + 1):
        share = comb(marked, k) * comb(total - marked, drawn - k) / comb(total, drawn) if drawn - k <= total - marked else 0
        assert abs(found[k] / n - share) <= 1.5 / n


def test_matrix_has_exact_sums(spark):
    cells = spark.range(70).select(F.col("id").alias("cell"), (F.col("id") * 7 % 50).alias("n")).where("n > 0")
    total = cells.agg(F.sum("n")).first()[0]
    takes = [total // 5 + (s < total % 5) for s in range(5)]
    found = op8.matrix(cells, 2, takes, 3).collect()
    assert {r.cell: sum(r.takes) for r in found} == {r.cell: r.n for r in cells.collect()}
    assert [sum(r.takes[s] for r in found) for s in range(5)] == takes


def test_every_row_has_a_place(sample, sample_rows, nothing):
    found = op8.shard(sample, 24, carry=("text",)).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter((i, t) for i, t, *_ in sample_rows)
    for r in found:
        data = (r.text or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
    sizes = Counter(r.shard for r in found)
    assert len(sizes) == 24 and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sizes[s]))
    assert op8.shard(nothing).count() == 0


def test_fewer_rows_than_shards(spark):
    found = op8.shard(spark.createDataFrame([(1, "a", None, None, None), (None, None, None, None, None)], DOCUMENTS)).collect()
    assert len(found) == 2 and {r.slot for r in found} == {0} and len({r.shard for r in found}) == 2


def test_the_shuffle_is_uniform(spark):
    """Neighbours part, every shard draws from all of the table, slots follow no order."""
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    found = op8.shard(rows, 6).toPandas()
    means = found.groupby("shard")["doc_id"].mean()
    assert ((means - 2999.5).abs() < 4.5 * 1732 / 1000**0.5).all()
    assert abs(found["doc_id"].corr(found["slot"])) < 0.06
    together = (found.sort_values("doc_id")["shard"].diff() == 0).mean()
    assert abs(together - 1 / 6) < 0.03


def test_places_do_not_depend_on_the_run(spark):
    rows = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    first, second = (Counter(map(tuple, op8.shard(rows).collect())) for _ in "ab")
    assert first == second


def test_no_python_in_the_plan(sample):
    plan = op8.shard(sample)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
