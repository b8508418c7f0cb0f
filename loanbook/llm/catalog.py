"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.llm import (
    op1_ngram_join,
    op2_line_dedup,
    op3_fingerprints,
    op4_sentencepiece,
    op5_quality,
    op6_html,
    op7_decontamination,
    op8_sharding,
    op9_lm_scoring,
    op10_toxicity,
    op11_spelling,
    op12_fim,
    op13_packing,
)
from loanbook.llm.common import document_key, table


def op1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_ngram_join.join_groups(table(spark, sf_dir, "documents"))


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = op2_line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "text", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"))


def op3_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op4_sentencepiece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return op4_sentencepiece.encode(table(spark, sf_dir, "documents"), path, digest=True)


def op5_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_html.extract(table(spark, sf_dir, "pages"))


def op7_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(*document_key(), "text")
    found = op7_decontamination.contained(documents, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "item_id", F.col("shared").alias("n_shared"), F.col("size").alias("n_item"),
        (F.col("shared") / F.col("size")).alias("containment"),
    )


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = op8_sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_lm_scoring.score(table(spark, sf_dir, "documents"))


def op10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_spelling.variants(table(spark, sf_dir, "documents"))


def op12_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = op12_fim.fill_in_middle(table(spark, sf_dir, "documents"))
    restored = op12_fim.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored.cast("binary"), 256).alias("restored_sha256"),
    )


def op13_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = op13_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_groups,
    "op2_line_dedup": op2_lines,
    "op3_fingerprints": op3_edits,
    "op4_sentencepiece": op4_sentencepiece_ids,
    "op5_quality": op5_scores,
    "op6_html_extract": op6_texts,
    "op7_decontamination": op7_leaks,
    "op8_sharding": op8_shards,
    "op9_lm_scoring": op9_scores,
    "op10_toxicity": op10_scores,
    "op11_spelling": op11_variants,
    "op12_fim": op12_orders,
    "op13_packing": op13_sequences,
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _one_byte(name: str) -> str:
    """SQL for a word with a byte for each letter, as `levenshtein` counts bytes."""
    letters = "".join(map(chr, range(0xC0, 0x100)))
    # Characters that no word has: all of printable ASCII but lower-case letters and the quote.
    spare = "".join(chr(c) for c in range(0x21, 0x7F) if c != 0x27 and not chr(c).islower())
    return f"translate({name}, '{letters}', '{spare[: len(letters)]}')"


def _words(name: str, id_name: str) -> str:
    """Words of every text that has any, as SQL."""
    return f"""
    select {id_name}, w
    from (select {id_name}, regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+') as w
          from {name}) where len(w) > 0"""


#: Distinct runs of k of the words w, as SQL.
_RUNS = "list_distinct(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')))"

ORACLES: dict[str, str] = {
    "op7_decontamination": f"""
with item_words as (select *, least(5, len(w)) as k from ({_words("benchmark", "item_id")})),
items as (select item_id, k, {_RUNS} as s from item_words),
doc_words as ({_words("documents", "doc_id")}),
docs as (select doc_id, k, {_RUNS} as s from doc_words join (select distinct k from items) on len(w) >= k),
item_shingles as (select item_id, k, len(s) as n_item, unnest(s) as h from items),
doc_shingles as (select doc_id, k, unnest(s) as h from docs),
shared as (
    select doc_id, item_id, n_item, count(*) as n_shared
    from doc_shingles join item_shingles using (k, h) group by all)
select doc_id, item_id, n_shared, n_item, n_shared / n_item as containment
from shared where n_shared * 100 >= n_item * 80""",
    "op11_spelling": f"""
with recursive bytes as (select range as b from range(256)),
crc_table as (
    select list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, ignored: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by b) as t
    from bytes),
runs as (
    select doc_id, run, count(*) as n
    from (select doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[A-Za-zÀ-ÿ]+')) as run
          from documents) group by all),
spelled as (
    select run, n, flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
        lambda c: case when unicode(c) < 128 then [unicode(c)::bigint] else [195::bigint, unicode(c)::bigint - 64] end)) as u
    from runs),
drawn as (
    select run, n, xor(list_reduce(list_prepend(4294967295::bigint, u),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as h
    from spelled, crc_table),
seen as (
    select case when h % 199 = 0 then left(run, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2)
        else run end as word, n from drawn),
words as (select word, sum(n)::bigint as n from seen where length(word) >= 6 group by word having sum(n) >= 5),
halves as (
    select word, n, length(word) as len, base, unnest([true, false]) as by_start
    from (select word, n, unnest([length(word), length(word) - 1]) as base from words)),
tiles as (
    select *, case when by_start then left(word, base // 2) else right(word, base - base // 2) end as half from halves),
near as (
    select distinct a.word, b.word as other, b.n as other_n
    from tiles a join tiles b using (base, by_start, half)
    where a.word <> b.word and levenshtein({_one_byte("a.word")}, {_one_byte("b.word")}) = 1),
best as (
    select word, count(*) as n_near, max(other_n) as best_n, arg_min(other, (-other_n, other)) as best from near group by word),
formed as (
    select words.word, n, coalesce(n_near, 0) as n_near, case when best_n >= 5 * n then best end as form,
        case when best_n >= 5 * n then best_n end as form_n
    from words left join best on words.word = best.word),
ways as (
    select word, word as root from formed where form is null
    union all select f.word, w.root from formed f join ways w on f.form = w.word)
select word, form, root, n, n_near, form_n from formed join ways using (word)""",
    "op12_fim": """
with units as (
    select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
        sha256('1:' || coalesce(doc_id::varchar, '')) as d
    from documents),
drawn as (
    select doc_id, t, u, len(u) as n,
        ('0x' || d[1:8])::bigint % (len(u) + 1) as x, ('0x' || d[9:16])::bigint % (len(u) + 1) as y,
        case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
            or ('0x' || d[17:24])::bigint % 100 >= 90 then 'plain'
            when ('0x' || d[25:32])::bigint % 100 < 20 then 'spm' else 'psm' end as form
    from units),
parts as (
    select doc_id, t, n, form, array_to_string(u[1:least(x, y)], '') as p,
        array_to_string(u[least(x, y) + 1:greatest(x, y)], '') as m, array_to_string(u[greatest(x, y) + 1:], '') as s
    from drawn)
select doc_id, n::bigint as n, form,
    case when form <> 'plain' then length(p)::bigint end as prefix_chars,
    case when form <> 'plain' then length(m)::bigint end as middle_chars,
    sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
        else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
    sha256(case form when 'plain' then t else p || m || s end) as restored_sha256
from parts""",
}
