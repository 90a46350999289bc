from __future__ import annotations

import random
import re

import numpy as np
import pytest

from scanyard.llm import ngram_join


def word_sets(text, n):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    size = min(n, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute(rows, n, threshold):
    sets = [word_sets(text, n) for _, text in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= threshold * len(
                    sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return {doc: (len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(rows)}


def copies(seed, families, most, words=60):
    """Families of edited copies, passages many share, and short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=12))
    texts = []
    for _ in range(families):
        base = rng.choices(vocabulary, k=rng.randint(3, words))
        for _ in range(rng.randint(1, most)):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                text.append(passage)
            texts.append(" ".join(text))
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("few,block,members,pivots,n,threshold", [
    (24, 768, 1 << 20, 16, 4, 85), (2, 4, 1 << 20, 2, 4, 85), (1, 3, 1 << 20, 1, 5, 80),
    (3, 1000, 90, 4, 2, 60)])
def test_equals_brute_force(docs, by_id, monkeypatch, few, block, members, pivots, n, threshold):
    """Also with so small limits that every n-gram is frequent and has several blocks."""
    monkeypatch.setattr(ngram_join, "MEMBERS", members)
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "PIVOTS", pivots)
    rows = copies(few, 25, 14)
    got = by_id(ngram_join.near_groups(docs(rows), n=n, threshold=threshold))
    assert {i: (r[0].n_shingles, r[0].component_id) for i, r in got.items()} == brute(
        rows, n, threshold)


def test_edges(edges, by_id):
    got = by_id(ngram_join.near_groups(edges))
    assert [(r.n_shingles, r.component_id) for i in (1, 2, 3) for r in got[i]] == [
        (0, 1), (0, 2), (0, 3)]
    assert [(r.n_shingles, r.component_id) for i in (4, 5) for r in got[i]] == [(1, 4)] * 3
    assert [(r.n_shingles, r.component_id) for r in got[None]] == [(1, None)]
    assert [(r.n_shingles, r.component_id) for i in (6, 7, 8) for r in got[i]] == [
        (1, 6), (1, 7), (1, 8)]


def test_one_per_group(edges, nothing):
    kept = ngram_join.one_per_group(edges)
    assert kept.columns == edges.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 8]
    assert ngram_join.near_groups(nothing).count() == 0
    assert ngram_join.one_per_group(nothing).count() == 0


def test_texts_under_one_id_each_keep_their_links(docs):
    a, b = (" ".join(f"{letter}{i}" for i in range(40)) for letter in "ab")
    rows = [(1, a), (1, b), (2, b + " z"), (3, a + " z"), (4, "far away from all of them"),
            (1, a), (None, b), (None, "known by null ids only, twice"),
            (None, "known by null ids only, twice")]
    got = sorted((r.id or 0, r.component_id or 0) for r in
                 ngram_join.near_groups(docs(rows)).collect())
    assert got == [(0, 0), (0, 0), (0, 1), (1, 1), (1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]
    kept = sorted((r.doc_id or 0, r.text) for r in ngram_join.one_per_group(docs(rows)).collect())
    assert kept == [(0, "known by null ids only, twice"), (1, a), (1, b),
                    (4, "far away from all of them")]


def test_near_texts_under_one_id_leave_one(docs):
    a = " ".join(f"a{i}" for i in range(40))
    rows = [(1, a), (1, a + " y"), (1, a + " z"), (2, a + " x"), (1, a)]
    kept = ngram_join.one_per_group(docs(rows)).collect()
    assert len(kept) == 1 and kept[0].doc_id == 1


def test_prefixes_share_as_many_members_as_promised():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 50, 1 << ngram_join.CELL_BITS).astype(np.uint16)
    for _ in range(300):
        base = rng.integers(0, 1 << 63, rng.integers(5, 200)).astype(np.uint64)
        a, b = (np.unique(np.concatenate([
            base[rng.random(len(base)) < 0.95], rng.integers(0, 1 << 63, 4).astype(np.uint64)]))
            for _ in range(2))
        if ngram_join.linked(len(np.intersect1d(a, b)), len(a), len(b)):
            (p, l), (q, m) = (ngram_join.prefix(s, counts) for s in (a, b))
            assert len(np.intersect1d(p, q)) >= min(l, m)


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(1000, 1001)],
                                  "a long, b long")
    got = {r.node: r.component for r in ngram_join.components(chain).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}
