from __future__ import annotations

import random

import numpy as np

from starmart.llm import jaccard
from starmart.llm.jaccard import gram_links, grams, least_overlap, one_of_each, walk
from tests.llm import corpus


def brute(rows):
    """Row number -> size and smallest id reachable, by all pairs."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                group[root(i)] = root(j)
    first = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            first[root(i)] = min(first.get(root(i), doc_id), doc_id)
    return [(rows[i][0], len(sets[i]), first.get(root(i), rows[i][0])) for i in range(len(rows))]


def edited(rng, text, changes):
    w = text.split()
    for _ in range(changes):
        w[rng.randrange(len(w))] = corpus.words(rng, 1)
    return " ".join(w)


def test_components_against_all_pairs(spark):
    rng = random.Random(9)
    common = corpus.words(rng, 12)
    texts = []
    for size in (4, 5, 8, 30, 90, 200):
        base = corpus.words(rng, size)
        texts += [base, base.upper(), *[edited(rng, base, k) for k in range(6)], common + " " + base]
    chain = corpus.words(rng, 100).split()
    texts += [" ".join(chain[k : k + 60]) for k in range(0, 40, 4)]
    texts += [f"{common} {corpus.words(rng, 40)}" for _ in range(40)]
    texts += ["", None, " \n", "a", "A", "a b", "b a", corpus.words(rng, 5000)]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[0])]
    docs = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, cls string, root int")
    got = [tuple(r) for r in gram_links(docs.repartition(6)).select("doc_id", "n_shingles", "component_id").collect()]
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(key, got)) == sorted(map(key, brute(rows)))


def links_of(rows):
    """Row number -> other rows with a similar set, by all pairs."""
    sets = [set(grams(text).tolist()) for _, text in rows]
    similar = [[bool(x and y) and 100 * len(x & y) >= 75 * len(x | y) for y in sets] for x in sets]
    return [sum(row) - bool(s) for row, s in zip(similar, sets, strict=True)]


def test_links_are_counted_by_all_pairs(spark, monkeypatch):
    rng = random.Random(3)
    texts = []
    for size, copies in ((6, 3), (40, 9), (90, 30), (200, 20)):
        base = corpus.words(rng, size)
        texts += [edited(rng, base, k % 4) for k in range(copies)] + [base, base.upper()]
    chain = corpus.words(rng, 100).split()
    texts += [" ".join(chain[k : k + 60]) for k in range(0, 40, 4)] + ["", None, "a", "A", corpus.words(rng, 50)]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    key = lambda r: (-1 if r[0] is None else r[0], r[1])
    wanted = sorted(zip([r[0] for r in rows], links_of(rows), strict=True), key=key)
    for bound in (512, 7):
        monkeypatch.setattr(jaccard, "TREE", bound)
        assert sorted(map(tuple, gram_links(docs).select("doc_id", "n_links").collect()), key=key) == wanted


def test_one_document_of_each_group_stays(spark):
    docs = corpus.documents(spark)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    wanted = {c for i, _, c in brute([(r["doc_id"], r["text"]) for r in docs.collect()]) if i is not None}
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted(wanted)
    # The null id of a copy goes with its text; the row without words is a copy of none.
    assert [r["text"] for r in kept.where("doc_id is null").collect()] == [None]
    assert one_of_each(corpus.empty(spark)).count() == 0 and gram_links(corpus.empty(spark)).count() == 0


def test_tree_walk_counts_or_prunes():
    rng = random.Random(2)
    base = corpus.words(rng, 300)
    probe = grams(base)
    members = [grams(edited(rng, base, k)) for k in range(0, 40, 2)] + [probe, probe[:5], grams("a b")]
    found = walk(probe, [m[::-1].copy() for m in members])
    for m, n in zip(members, found, strict=True):
        both = np.intersect1d(probe, m).size
        assert n == (both if both >= least_overlap(probe.size, m.size) else -1)


def test_order_of_frequent_grams_changes_no_result(spark, monkeypatch):
    docs = corpus.documents(spark, seed=4)
    one = sorted(map(str, gram_links(docs).select("doc_id", "component_id").collect()))
    monkeypatch.setattr(jaccard, "FREQUENT", 1)
    assert sorted(map(str, gram_links(docs).select("doc_id", "component_id").collect())) == one


def test_rows_without_an_id_link_and_one_row_stays(spark):
    w = corpus.words(random.Random(8), 100).split()
    parts = [" ".join(w[k : k + 68]) for k in (0, 9, 18)]  # neighbours have 55 of 73 n-grams in common
    rows = [(1, parts[0]), (None, parts[1]), (2, parts[2]), (None, parts[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r["n_links"], r["doc_id"] or 0, r["component_id"]) for r in gram_links(docs).collect())
    assert found == [(2, 1, 1), (2, 2, 1), (3, 0, 1), (3, 0, 1)]
    assert [tuple(r) for r in one_of_each(docs).collect()] == [rows[0]]
    lone = spark.createDataFrame([(None, parts[0])] * 3 + [(None, parts[1]), (None, "")] + [(None, "")] + [(7, ""), (7, "")], "doc_id long, text string")
    kept = sorted(((r["doc_id"] or 0, r["text"]) for r in one_of_each(lone).collect()))
    assert len(kept) == 4 and [k for k in kept if not k[1]] == [(0, ""), (0, ""), (7, "")] and kept[2][1] in parts
    assert {r["component_id"] for r in gram_links(lone).where("doc_id is null").collect()} == {None}


def test_hot_ngrams_and_blocks(spark, monkeypatch):
    """All n-grams hot and dealt into parts, blocks of two sets: the same components."""
    rng = random.Random(11)
    common = corpus.words(rng, 30)
    texts = [edited(rng, common, k % 5) + " " + corpus.words(rng, k % 7) for k in range(60)] + [corpus.words(rng, 30) for _ in range(20)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for name, value in (("HOT", 1), ("SALTS", 3), ("TREE", 2)):
        monkeypatch.setattr(jaccard, name, value)
    got = sorted(map(tuple, gram_links(docs).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == sorted(brute(rows)) and len({c for _, _, c in got}) < 70


def test_sets_alone_in_their_part_of_a_hot_ngram_link(spark, monkeypatch):
    """Every n-gram that two sets share is hot, and each set lies in a part of its own."""
    rng = random.Random(12)
    texts = []
    for size, copies in ((60, 2), (60, 3), (90, 4)):
        base = corpus.words(rng, size)
        texts += [edited(rng, base, k > 0) for k in range(copies)]
    rows = list(enumerate(texts)) + [(100 + k, text) for k, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    for name, value in (("HOT", 1), ("SALTS", 1_000_000_007)):
        monkeypatch.setattr(jaccard, name, value)
    got = sorted(map(tuple, gram_links(docs).select("doc_id", "n_shingles", "component_id", "n_links").collect()))
    assert got == sorted((*row, n) for row, n in zip(brute(rows), links_of(rows), strict=True))
    assert {c for _, _, c, _ in got} == {0, 2, 5}
