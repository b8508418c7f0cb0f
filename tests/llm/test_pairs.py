"""N-gram join, line dedup, fingerprints and decontamination against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loanbook.llm import links
from loanbook.llm import op1_ngram_join as op1
from loanbook.llm import op2_line_dedup as op2
from loanbook.llm import op3_fingerprints as op3
from loanbook.llm import op7_decontamination as op7
from loanbook.llm.common import WordHashes
from tests.llm.conftest import DOCUMENTS, Groups, edited, prose, shingle_set


def brute_groups(rows, size, percent):
    """Rows as (id, set size, least id of the group)."""
    sets = [(i, frozenset(shingle_set(t, size))) for i, t, *_ in rows]
    groups, distinct = Groups(), sorted({s for _, s in sets if s}, key=lambda s: (len(s), sorted(s)))
    for a, x in enumerate(distinct):
        for b in range(a):
            y = distinct[b]
            if 100 * len(x & y) >= percent * len(x | y):
                groups.join(a, b)
    place, least = {s: i for i, s in enumerate(distinct)}, {}
    for i, s in sets:
        if s and i is not None:
            g = groups.find(place[s])
            least[g] = min(i, least.get(g, i))
    return [(i, len(s), least.get(groups.find(place[s])) if s else i) for i, s in sets]


def test_ngram_groups(sample, sample_rows):
    found = op1.join_groups(sample).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, found)) == Counter(brute_groups(sample_rows, 3, 90))


def test_ngram_links_within_a_mixed_bucket(spark):
    """Chains of edits: the ends are linked only through others, not through a hub."""
    rng = random.Random(5)
    rows, text = [], prose(rng, 200)
    for i in range(30):
        rows.append((100 - i, text, None, None, None))
        text = edited(rng, text, 2)
    found = op1.join_groups(spark.createDataFrame(rows, DOCUMENTS)).collect()
    assert Counter(map(tuple, found)) == Counter(brute_groups(rows, 3, 90))


def test_first_of_groups(sample, sample_rows):
    kept = op1.first_of_groups(sample)
    assert kept.columns == sample.columns
    wanted = {}
    for (i, text, *_), (_, size, least) in zip(sample_rows, brute_groups(sample_rows, 3, 90)):
        if size and i == least:
            wanted[i] = True
    assert {r.doc_id for r in kept.collect() if (r.text or "").split()} == set(wanted)
    assert kept.where("trim(text) = '' or text is null").count() == sum(not (r[1] or "").strip(" ") for r in sample_rows)


def test_empty_tables(spark, nothing):
    items = spark.createDataFrame([], "item_id long, text string")
    keyed = nothing.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    assert op1.join_groups(nothing).count() == 0 == op1.first_of_groups(nothing).count()
    assert op2.dedup_lines(nothing).count() == 0
    assert op3.compare_edits(nothing).count() == 0 == op3.near_duplicates(nothing).count()
    assert op7.contained(keyed, items).count() == 0 == op7.decontaminate(nothing, items).count()


def test_parities_rule_out_no_similar_pair(spark):
    """Sets on both sides of a power of two, long and short; unlike ones mostly go."""
    import numpy as np

    rng, rows, pairs, node = np.random.default_rng(3), [], [], 0
    for n in (9, 60, 500, 530, 1000, 1050, 4090, 4200):
        for _ in range(12):
            own = rng.integers(0, 2**63, n).astype(np.uint64)
            near = np.concatenate([own[n // 25 :], rng.integers(0, 2**63, n // 30).astype(np.uint64)])
            for values in (own, near, rng.integers(0, 2**63, n).astype(np.uint64)):
                short, long = op1.parity(values, 8), op1.parity(values, op1.parity_words(len(values)))
                rows.append((node, len(values), *short.tolist(), long.tolist()))
                node += 1
            pairs += [(node - 3, node - 2), (node - 3, node - 1)]
    schema = "node long, n long, " + "".join(f"{p} long, " for p in op1._PARITIES) + "parity array<bigint>"
    kept = op1.near_parities(spark.createDataFrame(pairs, "a long, b long"), spark.createDataFrame(rows, schema), 90)
    found = {tuple(r) for r in kept.collect()}
    assert set(pairs[::2]) <= found
    assert len(found & set(pairs[1::2])) == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    groups = Groups()
    for a, b in edges:
        if a != b:
            groups.join(a, b)
    found = links.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {x: groups.find(x) for x in groups.parent}


def test_edit_distance():
    rng = random.Random(3)
    for _ in range(400):
        a, b = ([rng.choice("abc") for _ in range(rng.randrange(14))] for _ in "ab")
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        assert op2.edit_distance(a, b) == row[-1]


def test_unlike_lines_need_no_distance(monkeypatch):
    """What shared words rule out is what the distance rules out, without working it out."""
    rng = random.Random(8)
    lines = [[rng.choice("abcdefgh") for _ in range(rng.randrange(1, 14))] for _ in range(300)]
    for a, b in zip(lines[::2], lines[1::2]):
        near = [x if rng.random() < 0.85 else "z" for x in a]
        for other in (b, near, near[1:]):
            longer = max(len(a), len(other))
            assert op2.similar(a, other) == (100 * (longer - op2.edit_distance(a, other)) >= 80 * longer)
    worked_out = []
    monkeypatch.setattr(op2, "edit_distance", lambda a, b: worked_out.append(1) or len(a))
    assert not op2.similar(list(range(20)), [*range(15), *"vwxyz"]) and not worked_out
    op2.similar(list(range(20)), [*range(16), *"wxyz"])
    assert worked_out


def test_simhash_blocks():
    """Lines of any length, against plain bit sums."""
    import numpy as np

    from loanbook.llm.common import mixed

    lengths = np.array([1, 3, 255, 256, 700])
    hashes = np.random.default_rng(0).integers(0, 2**63, lengths.sum()).astype(np.uint64)
    found, at = op2.simhashes(hashes, lengths), 0
    for i, n in enumerate(lengths):
        for k, seed in enumerate(op2._SEEDS):
            own = np.unpackbits(mixed(hashes[at : at + n] + seed).view(np.uint8).reshape(-1, 8), axis=1)
            blocks = np.packbits(own.sum(axis=0, dtype=np.int64) * 2 > n).view(np.uint32)
            assert found[i, 2 * k : 2 * k + 2].tolist() == blocks.tolist()
        at += n


def test_lines_are_kept_once(spark):
    rng = random.Random(4)
    passage = " ".join(f"p{rng.randrange(999)}" for _ in range(55))
    near = passage.replace(" ", "  ", 1).upper() + "!"
    rows = [(i, f"own {prose(rng, 8)}\n{passage if i % 2 else near}\n\nshort line", "x", None, None) for i in range(20)]
    rows += [(50, None, None, None, None), (51, "", None, None, None), (None, passage, None, None, None), (52, passage, "y", None, None), (52, passage, "y", None, None)]
    found = op2.dedup_lines(spark.createDataFrame(rows, DOCUMENTS))
    assert found.columns == [*DOCUMENTS.names, "_lines", "_removed"]
    got = {r.doc_id: r for r in found.collect()}
    # A null id comes first, so its text keeps the passage.
    assert got[None].text == passage and got[None]._removed == 0
    assert got[50].text is None and got[50]._lines == 0 and got[51].text == "" and got[51]._removed == 0
    for i in range(20):
        own, _, *rest = rows[i][1].split("\n")[-4:]
        assert got[i].text == rows[i][1].replace("\n" + (passage if i % 2 else near), "", 1)
        assert got[i]._removed == 1
    assert got[52].text == "" and found.where("doc_id = 52").count() == 2


def test_near_lines_are_verified(spark):
    """Whatever is removed is connected by edit similarity; one word of many is found."""
    rng = random.Random(6)
    bases = [[f"v{rng.randrange(5000)}" for _ in range(80)] for _ in range(40)]
    rows, lines = [], []
    for i, base in enumerate(bases):
        for k in range(4):
            own = list(base)
            for _ in range(k % 2):
                own[rng.randrange(80)] = f"z{rng.randrange(10**6)}"
            rows.append((4 * i + k, " ".join(own), None, None, None))
            lines.append(own)
    groups = Groups()
    for a in range(len(lines)):
        for b in range(a):
            if op2.similar(lines[a], lines[b]):
                groups.join(a, b)
    found = op2.dedup_lines(spark.createDataFrame(rows, DOCUMENTS)).collect()
    removed = {r.doc_id for r in found if r._removed}
    assert removed <= {i for i in range(len(lines)) if groups.find(i) != i}
    assert len(removed) >= 0.75 * sum(groups.find(i) != i for i in range(len(lines)))


def test_edited_texts(sample, sample_rows):
    found = op3.compare_edits(sample).collect()
    assert len(found) == len(sample_rows)
    order = sorted({(i, t) for i, t, *_ in sample_rows if i is not None}, key=lambda r: r[0], reverse=True)
    got = {r.doc_id: r for r in found if r.doc_id is not None}
    cache = WordHashes()
    same = {}
    for k, (i, text) in enumerate(order):
        text, r = text or "", got[i]
        assert r.n_chars == len(text)
        assert same.setdefault(r.fingerprint, op3.readable(op3.signature(op3.shingle_hashes(text, cache)))) == r.fingerprint
        if k + 1 < len(order) and not any(x == i for x, _ in [(a, b) for a, b, *_ in sample_rows[-4:-2]]):
            after = order[k + 1][1] or ""
            half = len(text) // 2
            changed = text[: len(text) - half] + after[:half]
            if r.edited_sha256 != hashlib.sha256(changed.encode()).hexdigest():
                # Only a repeated row can be the next document of its own copy.
                assert sum(x[0] == i for x in sample_rows) > 1


def test_next_document_goes_round(spark):
    rows = [(i, f"text {i} " + "abc " * i, None, None, None) for i in range(40)]
    found = {r.doc_id: r for r in op3.compare_edits(spark.createDataFrame(rows, DOCUMENTS).repartition(5)).collect()}
    for i, text, *_ in rows:
        after, half = rows[(i - 1) % 40][1], len(text) // 2
        wanted = text[: len(text) - half] + after[:half]
        assert found[i].edited_sha256 == hashlib.sha256(wanted.encode()).hexdigest()
        assert 0 <= found[i].near_edited <= 1


def test_signatures_estimate_similarity():
    rng, cache = random.Random(7), WordHashes()
    for changes in (0, 5, 20, 80):
        text = prose(rng, 600, 10**6)
        a, b = (op3.shingle_hashes(t, cache) for t in (text, edited(rng, text, changes)))
        exact = len(set(a) & set(b)) / len(set(a) | set(b))
        assert abs(op3.likeness(op3.signature(a), op3.signature(b)) - exact) < 0.15


def test_near_duplicates(sample, sample_rows):
    cache = WordHashes()
    sets = [(i, frozenset(op3.shingle_hashes(t, cache).tolist())) for i, t, *_ in sample_rows]
    distinct = sorted({s for _, s in sets if s}, key=sorted)
    groups, least = Groups(), {}
    for a, x in enumerate(distinct):
        for b in range(a):
            if 100 * len(x & distinct[b]) >= 80 * len(x | distinct[b]):
                groups.join(a, b)
    place = {s: k for k, s in enumerate(distinct)}
    for i, s in sets:
        if s and i is not None:
            g = groups.find(place[s])
            least[g] = min(i, least.get(g, i))
    wanted = Counter((i, least.get(groups.find(place[s])) if s else i) for i, s in sets)
    assert Counter(map(tuple, op3.near_duplicates(sample).collect())) == wanted


def test_contained_items(spark, sample, sample_rows):
    rng = random.Random(8)
    items = [(k, prose(rng, n)) for k, n in enumerate([15, 20, 33, 57, 5, 3, 4, 2, 1])] + [(90, None), (91, ""), (None, "null id item of six words")]
    rows = list(sample_rows)
    for k, (_, text) in enumerate(items[:4]):
        rows.append((1000 + k, prose(rng, 200) + " " + text.upper() + " " + prose(rng, 200), None, None, None))
        own = text.split()
        rows.append((1100 + k, prose(rng, 90) + " " + " ".join(own[: len(own) * 9 // 10]), None, None, None))
        rows.append((1200 + k, " ".join(own[: len(own) // 2]), None, None, None))
    rows += [(1300, items[5][1], None, None, None), (1301, "x " + items[5][1], None, None, None)]
    # Short items inside long documents, and words of one that do not follow each other.
    rows += [(1310 + k, f"{prose(rng, 300)} {items[k][1]} {prose(rng, 300)}", None, None, None) for k in (5, 6, 7, 8)]
    rows.append((1320, " between ".join(items[6][1].split()), None, None, None))
    documents = spark.createDataFrame(rows, DOCUMENTS)
    keyed = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    table = spark.createDataFrame(items, "item_id long, text string")
    found = op7.contained(keyed, table).select("doc_id", "item_id", "shared", "size").collect()
    wanted, leaked = set(), set()
    for i, text, *_ in rows:
        for k, item in items:
            asked, length = shingle_set(item, 5), min(5, len((item or "").split()))
            # A text of fewer words is one shingle, shorter than any of such an item.
            own = shingle_set(text, length) if length else set()
            if asked and 100 * len(own & asked) >= 80 * len(asked):
                wanted.add((i, k, len(own & asked), len(asked)))
                leaked.add((i, text))
    assert Counter(map(tuple, found)) == Counter(wanted)
    assert {(1310 + k, k) for k in (5, 6, 7, 8)} <= {w[:2] for w in wanted}
    kept = op7.decontaminate(documents, table)
    assert kept.columns == documents.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in rows if r[:2] not in leaked)


@pytest.mark.parametrize("size", range(1, 70))
def test_sketches_miss_nothing(size):
    """More hashes than a containing document can lack."""
    missing = size - -(-size * 80 // 100)
    assert op7.sketch_length(size) > missing or op7.sketch_length(size) == size


def test_lines_with_many_edits_are_found(spark):
    """A tenth or a fifth of the words of real lengths replaced, and one edit in short lines."""
    rng = random.Random(12)
    pairs = []
    for k in range(180):
        n = rng.randrange(61, 200) if k < 120 else rng.randrange(5, 10)
        base = [f"v{rng.randrange(5000)}" for _ in range(n)]
        own = list(base)
        if k >= 120 and k % 3:
            (own.pop if k % 3 == 1 and n > 5 else lambda i: own.insert(i, "more"))(rng.randrange(n))
        else:
            for at in rng.sample(range(n), n // 10 if k < 60 else n // 5):
                own[at] = f"z{rng.randrange(10**6)}"
        assert op2.similar(base, own)
        pairs.append((" ".join(base), " ".join(own)))
    rows = [(2 * k + i, text, None, None, None) for k, pair in enumerate(pairs) for i, text in enumerate(pair)]
    found = {r.doc_id: r._removed for r in op2.dedup_lines(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert all(found[2 * k] == 0 for k in range(180))
    removed = [found[2 * k + 1] for k in range(180)]
    assert sum(removed[:60]) == 60 and sum(removed[60:120]) >= 54 and sum(removed[120:]) == 60


def test_lines_without_spaces_and_short_lines(spark):
    rng = random.Random(13)
    thai, han = ("".join(chr(rng.randrange(lo, hi)) for _ in range(40)) for lo, hi in ((0x0E01, 0x0E2F), (0x4E00, 0x9FA0)))
    run = "".join(rng.choice("abcdefghij0123456789") for _ in range(60))
    texts = [f"{prose(rng, 8)}\n{line}" for line in (thai, han, run)]
    near = [f"{prose(rng, 8)}\n{line}" for line in (thai[:20] + "ก" + thai[21:], han[:9] + han[10:], run[:30] + "zz" + run[31:])]
    copy = f"Heading\n{prose(rng, 9)}\n* * *\n\nThe end"
    rows = [(i, t, None, None, None) for i, t in enumerate([*texts, *texts, *near, copy, copy, f"Heading\n{prose(rng, 9)}", "Heading\nnew end"])]
    got = {r.doc_id: r for r in op2.dedup_lines(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert [got[i]._removed for i in range(3)] == [0] * 3
    # Exact copies go whole; of near copies the own line stays.
    assert all(got[i].text == "" for i in range(3, 6))
    assert [got[i].text for i in range(6, 9)] == [t.rsplit("\n", 1)[0] for t in near]
    assert got[9].text == copy and got[9]._removed == 0
    assert got[10].text == "" and got[10]._removed == 4
    assert got[11].text.startswith("Heading\n") and got[12].text == "Heading\nnew end"


def test_fingerprint_query_groups_near_duplicates(spark, sample, sample_rows, tmp_path):
    from loanbook.llm import catalog

    sample.write.parquet(str(tmp_path / "documents.parquet"))
    found = catalog.QUERIES["op3_fingerprints"](spark, str(tmp_path))
    columns = op3.compare_edits(sample).columns
    assert found.columns == [*columns, "group_id"]
    found = found.collect()
    assert Counter(tuple(r)[:-1] for r in found) == Counter(map(tuple, op3.compare_edits(sample).collect()))
    wanted = op3.near_duplicates(sample).collect()
    assert Counter((r.doc_id, r.group_id) for r in found) == Counter(map(tuple, wanted))
    assert len({r.group_id for r in found}) < len({r.doc_id for r in found})


def test_unlike_texts_of_a_bucket_are_no_pairs(spark, monkeypatch):
    """Copies alike to every degree share bands; what reaches the verification does not grow with their square."""
    rng, rows, counts = random.Random(14), [], []
    base = prose(rng, 60, 10**6)
    for i in range(240):
        rows.append((i, edited(rng, base, 1 + i % 3), None, None, None))
    near = op3.near_parities

    def counted(pairs, *more):
        counts.append(pairs.count())
        return near(pairs, *more)

    monkeypatch.setattr(op3, "near_parities", counted)
    sample = spark.createDataFrame(rows, DOCUMENTS)
    found = {r.doc_id: r.group_id for r in op3.near_duplicates(sample).collect()}
    cache, groups = WordHashes(), Groups()
    sets = {i: frozenset(op3.shingle_hashes(t, cache).tolist()) for i, t, *_ in rows}
    for a in sets:
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                groups.join(a, b)
    wanted: dict = {}
    for i in sets:
        wanted[groups.find(i)] = min(i, wanted.get(groups.find(i), i))
    assert found == {i: wanted[groups.find(i)] for i in sets}
    assert sum(counts) <= 8 * len(rows)


def test_intermediates_of_lines_go_early(spark, monkeypatch):
    """Keys go before words are fetched, and what a verification made is stored and removed: only the lines are left."""
    rng, left = random.Random(15), []
    base = [f"v{rng.randrange(5000)}" for _ in range(80)]
    rows = [(i, " ".join([*base[:i], f"z{i}", *base[i + 1 :]]), None, None, None) for i in range(12)]
    put, gone, tokens_of = links.stored, [], op2._tokens

    def stored(frame, label):
        table = put(frame, label)
        left.append((label, table.scratch_path))
        return table

    def discard(table):
        gone.append(table.scratch_path)

    def tokens(documents, chosen):
        assert [path for label, path in left if label == "keyed"] == gone
        return tokens_of(documents, chosen)

    for module in (links, op2):
        monkeypatch.setattr(module, "stored", stored)
        monkeypatch.setattr(module, "discard", discard)
    monkeypatch.setattr(op2, "_tokens", tokens)
    removed = {r.doc_id: r._removed for r in op2.dedup_lines(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert removed == {i: int(i > 0) for i in range(12)}
    labels = [label for label, path in left if path not in gone]
    assert labels == ["lines"] and "links" in [label for label, _ in left]


def test_cut_lines_are_normalised_lines():
    """Lines cut all at once have the words of lines cut one by one, and equal lines only have equal hashes."""
    import numpy as np

    rng = random.Random(16)
    parts = ["a", "B", "the", "...", " ", "\t", "\n", "\n", "é", "漢字", "ไทย", "x" * 25, "ab,cd", "’", "\r", "\x00", "z" * 140, " ", "k̈"]
    texts = ["", "\n", "one", " \n*** ***\n\n!", *("".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(300))]
    raw = [t.encode() for t in texts]
    hashes, sizes, many = op2.cut(raw)
    lines = [op2.normalised(line) for t in raw for line in t.split(b"\n")]
    assert sizes.tolist() == [len(own) for own in lines] and many.tolist() == [t.count(b"\n") + 1 for t in raw]
    words = [w for own in lines for w in own]
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))
    found = op2.line_hashes(hashes, sizes[sizes > 0]).tolist()
    full = [tuple(own) for own in lines if own]
    assert len(set(zip(full, found))) == len(set(full)) == len(set(found))
    numbered = op2.numbered(hashes, sizes[sizes > 0])
    assert (numbered >> 16 == (hashes >> np.uint64(16) << np.uint64(16)).view(np.int64) >> 16).all()
    at = 0
    for own in full:
        part = numbered[at : at + len(own)].tolist()
        assert len(set(part)) == len(part)
        assert sorted(x & 0xFFFF for x in part) == sorted(k for n in Counter(own).values() for k in range(n))
        at += len(own)


def test_members_that_may_be_alike_stay_together(monkeypatch):
    """Of a slice no pair that may be a link is lost, copies come once, and unlike members of a bucket go."""
    import numpy as np

    rng = np.random.default_rng(17)
    lines, rows = [], []
    for bucket in range(40):
        base = rng.integers(0, 2**63, 30).astype(np.uint64)
        for k in range(int(rng.integers(1, 7))):
            own = base.copy()
            changed = int(rng.integers(0, 20))
            own[:changed] = rng.integers(0, 2**63, changed)
            lines.append(own[: 30 - int(rng.integers(0, 4))])
            rows += [(bucket, len(lines))] * (1 + k % 2)
    words = op2.parities(np.concatenate(lines), np.array([len(x) for x in lines]))
    members = np.zeros(len(rows), dtype=op2._MEMBER)
    for i, (bucket, node) in enumerate(rows):
        members[i] = (bucket, node, len(lines[node - 1]), *(p[node - 1] for p in words))
    kept, key = op2.near_members(rng.permutation(members), 3)
    assert len(kept) == len(set(kept["node"].tolist())) < len(lines)
    group = dict(zip(kept["node"].tolist(), key.tolist()))
    of, linked = dict((node, bucket) for bucket, node in rows), set()
    for a in of:
        for b in range(1, a):
            if of[a] == of[b] and op2.similar(lines[a - 1].tolist(), lines[b - 1].tolist()):
                assert group[a] == group[b]
                linked |= {a, b}
    assert linked and len(group) < 2 * len(linked)
    monkeypatch.setattr(op2, "COMPARED", 1)  # too many to compare: all of a bucket stay
    many, _ = op2.near_members(members, 3)
    assert set(many["node"].tolist()) >= set(group)


def test_words_of_unlike_lines_are_not_fetched(spark, monkeypatch):
    """Lines that share a run of words and nothing else meet in a bucket, and go before their words are fetched."""
    import numpy as np

    rng, chosen, tokens_of = random.Random(18), [], op2._tokens
    shared = " ".join(f"common{k}" for k in range(8))
    rows = [(i, f"{shared} " + " ".join(f"w{rng.randrange(10**9)}" for _ in range(40)), None, None, None) for i in range(60)]
    near = rows[0][1].rsplit(" ", 1)[0] + " other"
    rows.append((99, near, None, None, None))

    def tokens(documents, filled):
        chosen.append(int(np.unpackbits(filled).sum()))
        return tokens_of(documents, filled)

    monkeypatch.setattr(op2, "_tokens", tokens)
    removed = {r.doc_id: r._removed for r in op2.dedup_lines(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert {i for i, n in removed.items() if n} == {99}
    assert chosen[0] < 20


def test_alike_lines_beyond_a_hub_make_few_pairs(spark, monkeypatch):
    """Lines somewhat alike pass the parities; what comes out of the join of a bucket does not grow with their square."""
    rng, counts, verified = random.Random(19), [], op2._verified
    base = [f"v{k}" for k in range(60)]
    rows = []
    for i in range(150):
        own = list(base)
        for at in rng.sample(range(8, 60), 14):
            own[at] = f"z{rng.randrange(10**6)}"
        rows.append((i, " ".join(own), None, None, None))

    def counted(pairs, tokens):
        counts.append(pairs.count())
        return verified(pairs, tokens)

    monkeypatch.setattr(op2, "_verified", counted)
    found = op2.dedup_lines(spark.createDataFrame(rows, DOCUMENTS)).collect()
    groups = Groups()
    lines = [r[1].split() for r in rows]
    for a in range(len(lines)):
        for b in range(a):
            if op2.similar(lines[a], lines[b]):
                groups.join(a, b)
    assert {r.doc_id for r in found if r._removed} <= {i for i in range(len(lines)) if groups.find(i) != i}
    assert sum(counts) <= 8 * len(rows)
