from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from scanyard.llm import divergence
from scanyard.llm.divergence import Audit, count_shard, pointers, sort_pointers

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, least):
    """Counts, kept terms and both reports from (text, lang, source) by definition."""
    rows = [(t or "", lang or "", source or "") for t, lang, source in rows]
    seen = defaultdict(set)
    for i, (t, lang, _) in enumerate(rows):
        for term in terms(t):
            seen[lang, term].add(i)
    kept = defaultdict(set)
    for (lang, term), where in seen.items():
        if len(where) >= least:
            kept[lang].add(term)
    own, whole = defaultdict(Counter), defaultdict(Counter)
    for t, lang, source in rows:
        hits = [x for x in terms(t) if x in kept[lang]]
        own[lang, source].update(hits)
        whole[lang].update(hits)

    def share(counter, lang, term):
        total = sum(counter.values()) + 5 * len(kept[lang])
        return 1 + 10**9 * (counter[term] + 5) // total

    pairs, over = set(), set()
    for lang, source in own:
        mine = {t: share(own[lang, source], lang, t) for t in kept[lang]}
        found = []
        for other_lang, other in own:
            if other_lang == lang and other != source:
                found.append((-sum(abs(mine[t] - share(own[lang, other], lang, t))
                                   for t in kept[lang]), other.encode()))
        pairs |= {(lang, source, o.decode(), -v, i + 1) for i, (v, o) in enumerate(sorted(found))}
        found = [(share(whole[lang], lang, t) - mine[t], t.encode()) for t in kept[lang]
                 if own[lang, source][t] and mine[t] > share(whole[lang], lang, t)]
        over |= {(lang, source, t.decode(), -v, i + 1) for i, (v, t) in enumerate(sorted(found))}
    return pairs, over


def make(seed, size=120):
    rng = random.Random(seed)
    words = ["The", "the", "cat", "abcdefgh", "abcdefghi", "abcdefgh" * 9, "abcdefgh" * 9 + "x",
             "Äpfel", "äpfel", "naïve", "x" * 300, "x" * 301, "日本語のテキスト", "日本語"]
    return [(rng.choice([None, "", "12 3", " ".join(rng.choices(words, k=rng.randint(1, 20)))]),
             rng.choice(["en", "en", "de", None]), rng.choice(["s1", "s2", "s3", None, "é", "Z"]))
            for _ in range(size)]


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents of (text, lang, source) beside columns named as those made inside."""
    schema = "text string, lang string, source string, term int, n int, p string, block int"

    def build(rows):
        return spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], schema)
    return build


def test_sorted_pointers_equal_sorted_terms():
    rng = random.Random(3)
    bodies = [bytes(rng.choices(b"aAbB \xc3\xa9z", k=rng.randint(0, 400))) for _ in range(30)]
    bodies += [b"q" * 500 + b" " + b"q" * 501 + b" " + b"q" * 500]
    raw = b"".join(bodies)
    buffer = divergence._LETTERS[np.frombuffer(raw, np.uint8)]
    texts = np.cumsum([0] + [len(b) for b in bodies])
    starts, sizes = pointers(buffer, texts[:-1])
    found = [buffer[s:s + n].tobytes() for s, n in zip(starts, sizes)]
    by_hand = [t for b in bodies for t in re.findall(rb"[a-z\x80-\xff]+", b.lower())]
    assert found == by_hand
    order, run = sort_pointers(buffer, starts, sizes)
    assert order.tolist() == sorted(range(len(found)), key=found.__getitem__)
    distinct = sorted(set(found))
    assert [distinct[r] for r in run] == sorted(found)


def test_counts_of_a_slice_of_a_batch():
    whole = pa.array([b"left out", b"one two", b"", b"two", b"two two", b"left out"])
    group, found, n, docs = count_shard(whole.slice(1, 4), np.array([0, 0, 1, 1]))
    rows = sorted(zip(group.tolist(), found.to_pylist(), n.tolist(), docs.tolist()))
    assert rows == [(0, b"one", 1, 1), (0, b"two", 1, 1), (1, b"two", 3, 2)]
    assert count_shard(pa.array([b"", b"1 2"]), np.array([0, 0])) is None


@pytest.mark.parametrize("least, block_terms", [(1, 2048), (3, 3), (30, 2048), (1000, 2048)])
def test_reports_equal_brute_force(corpus, monkeypatch, least, block_terms):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", block_terms)
    rows = make(least)
    audit = Audit(corpus(rows), least=least)
    pairs, over = brute(rows, least)
    got = [tuple(r) for r in audit.pairs().select(
        "lang", "source", "other", "value", "rank").collect()]
    assert len(got) == len(pairs) and set(got) == pairs
    got = [tuple(r) for r in audit.terms().select(
        "lang", "source", "term", "value", "rank").collect()]
    assert len(got) == len(over) and set(got) == over
    top = {tuple(r) for r in audit.terms(most=2).select(
        "lang", "source", "term", "value", "rank").collect()}
    assert top == {r for r in over if r[-1] <= 2}


def test_wide_counts_stay_exact(spark):
    big = 9_000_000_000_000
    row = spark.range(1).select(divergence.share(
        *(divergence.F.lit(x).cast("long") for x in (big - 1, 3 * big, 7))).alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 4) // (3 * big + 35)


def test_edges(edges, nothing, spark):
    named = edges.selectExpr("*", "'en' as lang", "cast(doc_id % 2 as string) as source")
    audit = Audit(named, least=1)
    assert {r.source for r in audit.groups.collect()} == {"", "0", "1"}
    assert {r.term: r.n for r in audit.kept.collect()}["word"] == 40_000
    empty = Audit(nothing.selectExpr("*", "'en' as lang", "'s' as source"))
    assert empty.groups.count() == empty.pairs().count() == empty.terms().count() == 0
