"""Tokens, quality, extraction, scoring and toxicity, document by document."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from loanbook.llm import op4_sentencepiece as op4
from loanbook.llm import op5_quality as op5
from loanbook.llm import op6_html as op6
from loanbook.llm import op9_lm_scoring as op9
from loanbook.llm import op10_toxicity as op10
from tests.llm.conftest import DOCUMENTS, prose, words

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LABELS = "doc_id long, quality int, toxic int, text string"


def crc(i):
    return zlib.crc32(("" if i is None else str(i)).encode())


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


# --- SentencePiece ---------------------------------------------------------


def test_ids_equal_the_library(sample, sample_rows, model):
    found = op4.encode(sample, MODEL).collect()
    wanted = Counter((i, tuple(model.encode(t or "")), model.decode(model.encode(t or "")) if t else "") for i, t, *_ in sample_rows)
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in found) == wanted


def test_digests_equal_the_library(sample, sample_rows, model, nothing):
    found = op4.encode(sample, MODEL, digest=True).collect()
    wanted = Counter()
    for i, text, *_ in sample_rows:
        ids = model.encode(text or "")
        listed, decoded = ",".join(map(str, ids)), model.decode(ids) if ids else ""
        wanted[i, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, decoded))] += 1
    assert Counter(map(tuple, found)) == wanted
    assert op4.encode(nothing, MODEL).count() == 0


def test_chunks_of_any_text(model, monkeypatch):
    rng = random.Random(1)
    parts = ["a", "the", " ", "  ", "▁", "\n", "\t", "é", "\x00", "日", "🙂", "</s>", "<0x41>", "​", "�", "W" * 70]
    table = op4.ChunkTable(model)
    monkeypatch.setattr(op4, "CHUNKS", 50)
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert table.ids(text) == model.encode(text)


# --- quality ---------------------------------------------------------------


def line_documents(rng, n):
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.6
        text = prose(rng, rng.choice([12, 60, 200]))
        if not good:
            text = rng.choice([text.upper().replace(" ", "!! "), text.replace(" ", " | "), text.replace(" ", "*** "), "spam " * 90])
        rows.append((i, f"A shared first line.\n{text}" if i % 4 == 0 else text, None, None, None))
        labels.append((i, int(good), 0, None))
    return rows, labels


def test_quality_is_learned(spark):
    rows, labels = line_documents(random.Random(2), 500)
    extra = [(None, rows[0][1], None, None, None), (900, None, None, None, None), (901, " \n\n", None, None, None), rows[0], (902, "x" * 200_000 + "\n" * 50_000, None, None, None)]
    documents = spark.createDataFrame(rows + extra, DOCUMENTS).repartition(4)
    table = spark.createDataFrame([*labels, (None, 1, 1, None), (3, None, 1, None), (7, 0, 0, None)], LABELS)
    found = op5.score(documents, table).collect()
    assert len(found) == len(rows) + len(extra)
    marks = {i: q for i, q, *_ in labels}
    held = [r for r in found if r.held_out and r.doc_id in marks]
    assert len(held) > 100 and all(r.held_out == (crc(r.doc_id) % 3 == 1) for r in found)
    assert np.mean([r.predicted == marks[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert {r.score for r in found if r.doc_id in (900, 901)} == {next(r.score for r in found if r.doc_id == 900)}
    kept = op5.accepted(documents, table)
    assert kept.columns == documents.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in found if r.score >= 0.5)


def test_marginals_by_enumeration():
    rng = np.random.default_rng(0)
    good, ties = rng.normal(size=(1, 6)), rng.normal(size=(2, 2))
    total = np.zeros(6)
    weight = 0.0
    for labels in np.ndindex(*[2] * 6):
        w = math.exp(sum(good[0, i] * x for i, x in enumerate(labels)) + sum(ties[a, b] for a, b in zip(labels, labels[1:])))
        weight += w
        total += w * np.array(labels)
    assert np.allclose(op5.marginals(good, ties)[0], total / weight)


def test_scores_of_texts_by_brute_force(spark):
    """Scores and labels of lines from all labellings of a short text, with the fitted weights."""
    rows, labels = line_documents(random.Random(8), 200)
    texts = ["One line.", "Some line here.\n\n SHOUT SHOUT!!\nand a | last | one", "a\nb b\n*** ***\nWords of prose, again.\nmore"]
    documents = spark.createDataFrame(rows + [(1000 + i, t, None, None, None) for i, t in enumerate(texts)], DOCUMENTS)
    table = spark.createDataFrame(labels, LABELS)
    fitted = op5._fitted(documents, table)
    scores = {r.doc_id: r for r in op5.score(documents, table).collect()}
    lines = {(r.doc_id, r.line): r for r in op5.line_labels(documents, table).where("doc_id >= 1000").collect()}
    assert len(lines) == 9
    for i, text in enumerate(texts):
        own = [(k, line) for k, line in enumerate(text.split("\n")) if line.strip()]
        good = op5.observed([line.encode() for _, line in own]) @ fitted["weights"]
        weights = {}
        for labelling in np.ndindex(*[2] * len(own)):
            tied = sum(fitted["ties"][a, b] for a, b in zip(labelling, labelling[1:]))
            weights[labelling] = math.exp(sum(g * x for g, x in zip(good, labelling)) + tied)
        p = [sum(w for x, w in weights.items() if x[k]) / sum(weights.values()) for k in range(len(own))]
        wanted = sum(q * len(line) for q, (_, line) in zip(p, own)) / sum(len(line) for _, line in own)
        assert scores[1000 + i].score == pytest.approx(wanted, abs=1e-9)
        assert scores[1000 + i].n_bad == sum(q < 0.5 for q in p)
        for q, (k, line) in zip(p, own):
            found = lines[1000 + i, k]
            assert found.text == line and found.p_good == pytest.approx(q, abs=1e-9) and found.good == (q >= 0.5)


def test_long_documents_are_learned_from():
    lines = [f"line {i} {'!' * (i % 7)}" for i in range(200)]
    seen, whole = op5.drawn("\n".join(lines)), op5.observed([line.encode() for line in lines])
    assert len(seen) == op5.SAMPLE_LINES
    assert any(np.array_equal(seen, whole[i : i + len(seen)]) for i in range(len(whole) - len(seen) + 1))
    assert np.array_equal(op5.drawn("\n".join(lines[:64])), op5.observed([line.encode() for line in lines[:64]]))
    assert len(op5.drawn(None)) == 0 == len(op5.drawn(" \n "))


def test_scores_without_labels_or_documents(spark, sample, nothing):
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in op5.score(sample, none).collect()} <= {0.5}
    assert {r.score for r in op10.score(sample, none).collect()} == {0.5}
    assert op5.score(nothing, none).count() == 0 == op10.score(nothing, none).count()


# --- pages -----------------------------------------------------------------

PAGE = (
    '<!doctype html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>'
    '<header>Site</header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- <p>no</p> --><div class="cookie-notice">Cookies?</div>'
    "<article><h1>Head &amp; line</h1><p>One\n  two &lt;b&gt; <b>bold</b>text<br>next<p>Open paragraph"
    '<div class="ad">Buy</div><ul><li>item</ul><form><input>Sign up</form><p>&#233;nd</p></article>'
    '<section id="comments"><article><p>First!</p></article></section><aside>Side</aside><footer>&copy; me</footer></body></html>'
)


def test_article_lines():
    lines = op6.lines_of(PAGE)
    assert [t for z, t in lines if z == op6.ARTICLE] == ["Head & line", "One two <b> boldtext next", "Open paragraph", "item", "énd"]
    assert op6.lines_of(None) == [] == op6.lines_of("") == op6.lines_of("<p></p>")
    assert op6.lines_of("<p>never closed <b>at all") == [(op6.PLAIN, "never closed at all")]
    assert op6.lines_of("a < b && c") == [(op6.PLAIN, "a < b && c")]


def test_common_lines_are_a_longest_subsequence(monkeypatch):
    rng = random.Random(3)
    for _ in range(600):
        monkeypatch.setattr(op6, "TABLE", rng.choice([4, 40, 2**28]))
        a, b = (rng.choices(range(rng.choice([2, 5, 30])), k=rng.randrange(25)) for _ in "ab")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found, rest = op6.common_lines(a, b), iter(b)
        assert len(found) == table[-1][-1]
        assert all(a[i] in rest for i in sorted(found))  # one after the other in b


def test_template_lines_go(spark):
    def page(i, body):
        return f"<div>Top of site</div><div><p>{body}</p></div><div>Bottom of site {'' if i else ''}</div>"

    rows = [(i, f"https://h{i % 3}.example.com/a/b{i}?q=1", page(i, f"Own words of page {i}, quite a few of them")) for i in range(30)]
    rows += [(50, "https://alone.example.com/x", page(50, "Alone")), (51, None, page(51, "No url")), (52, "https://h0.example.com/n", None), (53, "nonsense", PAGE), (None, "https://h1.example.com/a/b", page(1, "No id but many words of its own")), rows[4]]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string").repartition(4)
    found = op6.extract(pages).collect()
    assert Counter((r.page_id, r.url) for r in found) == Counter((i, u) for i, u, _ in rows)
    got = {r.page_id: r for r in found}
    for i in range(30):
        assert got[i].text == f"Own words of page {i}, quite a few of them"
    assert got[50].text.split("\n") == ["Top of site", "Alone", "Bottom of site"]
    assert got[52].text == "" and got[52].n_chars == 0
    assert got[53].text.startswith("Head & line") and got[53].n_chars == len(got[53].text)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert op6.extract(empty).count() == 0


def differenced(spark, pages):
    """Articles of pages of one host that are all in one range."""
    rows = [(i, f"http://x.example.com/a/{i:03d}", "".join(f"<div>{line}</div>" for line in lines)) for i, lines in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        return [r.text.split("\n") for r in sorted(op6.extract(frame).collect(), key=lambda r: r.page_id)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)


def test_copies_on_both_sides_go_to_the_next_other_page(spark):
    template = ["Top of the site", "Menu one", "Menu two"], ["Imprint", "Menu one"]
    articles = [["A first article with some words", "and a second line"], *[["The article that was copied here", "again and again"]] * 5, ["A last one, which has a little more text than its template", "The end"]]
    found = differenced(spark, [[*template[0], *a, *template[1]] for a in articles])
    assert found == articles


def test_short_articles_in_a_large_template(spark):
    template = [f"Line {i} of a very large template that all the pages of this site have" for i in range(40)]
    articles = [[f"Short {i}, and no more than these few words that page {i} has, repeated {i * 31} times over and over, as {i ** 5} and {i ** 7} and {i ** 9} show",
                 f"More of {i}: {'x' * 400}{i}"] for i in range(12)]
    found = differenced(spark, [[*template[:20], *a, *template[20:]] for a in articles])
    assert found[1:-1] == articles[1:-1]
    assert all(set(a) <= set(f) for a, f in zip(articles, found))


# --- language model --------------------------------------------------------


def test_base_scores_and_counts(sample, sample_rows, nothing):
    found = op9.score(sample).collect()
    assert len(found) == len(sample_rows)
    counts = Counter()
    for i, text, *_ in sample_rows:
        if crc(i) % 10:
            counts.update([*words(text), None])
    total = sum(counts.values())
    values = {(r.doc_id, r.n_tokens): r for r in found}
    for i, text, *_ in sample_rows:
        own = [*words(text), None]
        r = values[i, len(own)]
        assert r.held_out == (crc(i) % 10 == 0) and r.train_tokens == total
        assert r.n_known == sum(counts[w] > 0 for w in own)
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (len(counts) + 1))) for w in own)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0
    assert op9.score(nothing).count() == 0


def test_rare_words_meet_their_counts_in_the_join(sample, monkeypatch):
    """The same scores whether words are sent to the tasks or joined."""
    whole = {(r.doc_id, r.n_tokens): (r.base_score, r.score, r.n_known) for r in op9.score(sample).collect()}
    monkeypatch.setattr(op9, "FREQUENT", 20)
    for r in op9.score(sample).collect():
        assert (r.base_score, r.score, r.n_known) == pytest.approx(whole[r.doc_id, r.n_tokens], rel=1e-6)


def test_the_model_is_a_distribution_and_learns():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(op9.FEATURES, op9.CLASSES))
    assert np.allclose(op9.probabilities(weights, np.arange(0, op9._HISTORIES, 97)).sum(axis=1), 1)


def test_word_order_is_learned(spark):
    rng = random.Random(9)
    follow = {k: f"b{k}" for k in range(12)}
    texts = [" ".join(x for k in (rng.randrange(12) for _ in range(40)) for x in (f"a{k}", follow[k])) for _ in range(200)]
    found = op9.score(spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCUMENTS)).collect()
    held = [r for r in found if r.held_out]
    assert len(held) > 5 and all(r.score > r.base_score for r in held)


def paired_texts(rng, count, names=40):
    """Texts of pairs `p3zz q3zz`: all words end alike, and the first says the second."""
    return [" ".join(f"p{k}zz q{k}zz" for k in (rng.randrange(names) for _ in range(15))) for _ in range(count)]


def test_words_before_are_told_apart(spark):
    """Words with the same last bytes: right pairs are likelier than pairs of the same words dealt anew."""
    rng = random.Random(12)
    texts = paired_texts(rng, 300)
    held = [i for i in range(1000, 3000) if crc(i) % 10 == 0][:40]
    rows = list(enumerate(texts))
    for right, wrong in zip(held[::2], held[1::2]):
        own = paired_texts(rng, 1)[0].split(" ")
        rows.append((right, " ".join(own)))
        own[1::2] = own[3::2] + own[1:2]
        rows.append((wrong, " ".join(own)))
    documents = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCUMENTS)
    found = {r.doc_id: r for r in op9.score(documents).collect()}
    assert all(found[i].held_out and found[i].n_known == 31 for i in held)
    assert all(found[i].score > found[j].score + 15 * 0.5 for i, j in zip(held[::2], held[1::2]))


def test_classes_follow_counts():
    rng = np.random.default_rng(2)
    frequent = np.sort(np.append(rng.integers(-(2**62), 2**62, 5000), op9.END))
    counts = np.floor(1e6 / (1 + rng.permutation(len(frequent)))) + 1
    kinds = op9.classes_by_count(frequent, counts, 32)
    assert kinds[0] == 0 and (kinds[1:] > 0).all() and kinds.max() == 30
    order = np.argsort(-counts[1:], kind="stable")
    assert (np.diff(kinds[1:][order]) >= 0).all()
    mass = np.bincount(kinds, weights=np.sqrt(counts))[1:]
    assert mass.max() < 2.5 * mass.min()


def test_scores_by_brute_force(spark):
    rng = random.Random(5)
    texts = paired_texts(rng, 120, 12) + [prose(rng, rng.choice([1, 2, 5, 30])) for _ in range(80)] + ["", None, "never0 seen0 p1zz"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    documents = spark.createDataFrame(rows, DOCUMENTS)
    learned = [i for i in range(len(texts)) if crc(i) % 10]
    _, total, unseen, model = op9.fitted(documents.where(F.col("doc_id").isin(*learned)))
    counts, pairs = Counter(), Counter()
    for i in learned:
        own = [*words(texts[i]), None]
        counts.update(own)
        pairs.update(zip([None, *own], own))
    pairs = {p: n for p, n in pairs.items() if n > 1}
    assert total == sum(counts.values()) and len(pairs) > 20
    listed = sorted(w for w in counts if w)
    hashes = {None: op9.END, **dict(zip(listed, op9.hashed(pa.array(listed)).tolist()))}
    places = {h: k for k, h in enumerate(model["classed"].tolist())}
    kind = {w: int(model["kinds"][places[hashes[w]]]) for w in counts}
    sizes = Counter()
    for w, n in counts.items():
        sizes[kind[w]] += n + op9.EXTRA
    number = len(model["classes"])
    whole = sum(max(sizes[k], op9.EXTRA) for k in range(number))

    def word_share(before, word):
        k = kind[word]
        usual = {w: (n + op9.EXTRA) / sizes[k] for w, n in counts.items() if kind[w] == k}
        after = {w: n for (v, w), n in pairs.items() if v == before and kind[w] == k}
        if not after:
            return usual[word]
        if len(after) == len(usual):
            return (after[word] - op9.DISCOUNT) / sum(n - op9.DISCOUNT for n in after.values())
        others = max(0, counts[before] - sum(n for (v, _), n in pairs.items() if v == before)) * sizes[k] / whole
        shares = {w: (n - op9.DISCOUNT) / (sum(after.values()) + others) for w, n in after.items()}
        return shares.get(word) or usual[word] * (1 - sum(shares.values())) / (1 - sum(usual[w] for w in after))

    def class_shares(history):
        at = op9.features(np.array([[hashes.get(w) or int(op9.hashed(pa.array([w]))[0]) for w in history]]), len(model["weights"]))[0]
        logits = [float(model["weights"][0, k]) + sum(float(model["weights"][a, k]) for a in at) for k in range(number)]
        powers = [math.exp(x) for x in logits]
        return [x / sum(powers) for x in powers]

    found = {r.doc_id: r for r in op9.score(documents).collect()}
    for i, text in enumerate(texts):
        wanted, before = 0.0, [None, None, None]
        for w in [*words(text), None]:
            known = math.log10((1 - unseen) * class_shares(before)[kind[w]] * word_share(before[0], w)) if w in counts else math.log10(unseen)
            wanted, before = wanted + known, [w, *before[:2]]
        assert found[i].score == pytest.approx(wanted, rel=1e-4)
    for before in ([None] * 3, ["p1zz", None, None], ["q1zz", "p1zz", None], ["never0", "q2zz", "p2zz"]):
        shares = class_shares(before)
        assert sum(shares[kind[w]] * word_share(before[0], w) for w in counts) == pytest.approx(1, rel=1e-6)


# --- toxicity --------------------------------------------------------------


def test_segments_by_brute_force():
    """Maximal segments: each beats all others inside it, and none can be joined."""
    rng = np.random.default_rng(4)

    def brute(scores, shift=0):
        best = max(((scores[i:j].sum(), -(j - i), i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0,))
        if best[0] <= 0:
            return []
        s, _, i, j = best
        return [*brute(scores[:i], shift), (s, shift + i, shift + j), *brute(scores[j:], shift + j)]

    for _ in range(150):
        scores = rng.integers(-6, 6, rng.integers(0, 14)) + rng.random() / 7
        scores = scores + rng.random(len(scores)) / 1000  # no ties
        found = op10.segments(scores)
        assert [(round(float(s), 6), a, b) for s, a, b in found] == [(round(float(s), 6), a, b) for s, a, b in brute(scores)]


def test_decay_is_the_root():
    scores = np.array([-1.0] * 9 + [2.0])
    assert np.exp(op10.decay(scores) * scores).mean() == pytest.approx(1.0, abs=1e-6)
    assert op10.decay(np.array([])) == 1.0 == op10.decay(np.array([1.0]))


def test_toxicity_is_learned(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(700):
        own, toxic = prose(rng, rng.choice([20, 60, 150])).split(" "), rng.random() < 0.2
        if toxic:
            at = rng.randrange(len(own))
            own[at:at] = [f"vile{rng.randrange(400)}" for _ in range(4)]
        rows.append((i, " ".join(own), None, None, None))
        labels.append((i, 1, int(toxic), None))
    extra = [(None, rows[0][1], None, None, None), (900, None, None, None, None), (901, "", None, None, None), rows[1], (902, "plain " * 50_000, None, None, None)]
    documents = spark.createDataFrame(rows + extra, DOCUMENTS).repartition(4)
    found = op10.score(documents, spark.createDataFrame([*labels, (None, 1, 1, None), (2, 1, None, None)], LABELS)).collect()
    assert len(found) == len(rows) + len(extra)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (crc(r.doc_id) % 4 == 2) for r in found)
    marks = {i: t for i, _, t, _ in labels}
    held = [r for r in found if r.held_out and r.doc_id in marks]
    hits = [r.predicted for r in held if marks[r.doc_id]]
    false = [r.predicted for r in held if not marks[r.doc_id]]
    assert np.mean(hits) > 0.9 and np.mean(false) < 0.05
    assert not any(r.predicted for r in found if r.doc_id in (900, 901, 902))


def test_passages_are_where_they_say(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        own, toxic = prose(rng, rng.choice([20, 60, 150])).split(" "), i % 4 == 0
        if toxic:
            at = rng.randrange(len(own))
            own[at:at] = [f"vile{rng.randrange(99)}" for _ in range(5)]
        rows.append((i, "Ünï 🙂 " + " -- ".join(own), None, None, None))
        labels.append((i, 1, int(toxic), None))
    rows += [(900, None, None, None, None), (901, "", None, None, None), rows[0], (None, rows[0][1], None, None, None)]
    documents, table = spark.createDataFrame(rows, DOCUMENTS).repartition(3), spark.createDataFrame(labels, LABELS)
    found = op10.passages(documents, table).collect()
    texts = {i: t for i, t, *_ in rows}
    assert Counter(r.doc_id for r in found) == Counter(
        r.doc_id for r in op10.score(documents, table).collect() for _ in range(r.n_segments)
    )
    assert all(texts[r.doc_id][r.start : r.end] == r.text and r.above > -math.log(op10.CHANCE) for r in found)
    vile = {i for i in range(0, 400, 4)}
    assert len(vile & {r.doc_id for r in found if "vile" in r.text}) > 90
    assert op10.passages(documents.limit(0), table).count() == 0


def test_a_step_adds_up_all_slopes(monkeypatch):
    """Features seen once, a few times and often in a step, against sums one by one; as many rows go at once as a cache holds."""
    rng = np.random.default_rng(20)
    history = (rng.zipf(1.3, (3000, 3)) % 900).astype(np.int64)
    kinds = rng.integers(0, 8, 3000)
    weights = rng.normal(size=(4096, 8)).astype(np.float32)
    places, missed = op9.features(history, 4096), -op9.probabilities(weights, history)
    missed[np.arange(3000), kinds] += 1
    slope = np.zeros((4096, 8))
    np.add.at(slope, places.ravel(), np.repeat(missed, op9.ACTIVE, axis=0))
    slope[0] = missed.sum(axis=0)
    squares = (slope**2).sum(axis=1)
    wanted = weights + slope * (op9.RATE / np.sqrt(squares / 8 + 1))[:, None]
    found, own, visits = weights.copy(), np.zeros(4096), np.zeros(4096)
    op9.learn(found, own, visits, history, kinds)
    assert np.allclose(found, wanted, atol=1e-4) and np.allclose(own, squares, rtol=1e-3, atol=1e-3)
    assert visits[0] == 3000 and visits[1:].sum() == 3000 * op9.ACTIVE

    rows, shares = [], op9.probabilities
    monkeypatch.setattr(op9, "probabilities", lambda w, h: rows.append(len(h)) or shares(w, h))
    long = np.tile(history, (4, 1))
    model = {
        "weights": weights, "pairs": np.zeros(0, np.int64), "pair_adds": np.zeros(0), "shares": np.zeros(0, np.int64),
        "share_adds": np.zeros(0), "kept": 0.0, "classes": np.zeros(8),
    }
    nothing = np.full(len(long), -1)
    out = op9.conditional(model, long, np.tile(kinds, 4), nothing, nothing)
    assert np.allclose(out, np.log10(shares(weights, long)[np.arange(len(long)), np.tile(kinds, 4)]), atol=1e-5)
    assert sum(rows) == len(long) and max(rows) <= 4096
