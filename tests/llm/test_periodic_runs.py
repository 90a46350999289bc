from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__ as entry
from scanyard.llm import periodic_runs
from scanyard.llm.periodic_runs import Catchers, collapsed, runs_of

SF = "/root/testdata/sf0.001"


def brute(words, exponent=4, least=6):
    """All maximal stretches by definition: for each period, where words that far apart are equal."""
    found = {}
    n = len(words)
    for q in range(1, n // exponent + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - start >= max(least, exponent * q) and (start, end + q) not in found:
                found[start, end + q] = q
            start = end + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def text(rng, size, letters):
    """Random words with repeats of random stretches."""
    out = []
    while len(out) < size:
        piece = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
        out += piece * rng.choice([1, 1, 2, 4, 5, 9])
        if rng.random() < 0.3 and out:
            out = out[:-rng.randint(1, len(piece))] or out
    return out


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "abcdefgh"])
def test_runs_equal_brute_force(letters):
    rng = random.Random(letters)
    texts = [text(rng, rng.randint(0, 130), letters) for _ in range(250)] + [[]]
    assert runs_of(texts) == [brute(t) for t in texts]
    assert runs_of(texts, exponent=5, least=9) == [brute(t, 5, 9) for t in texts]


@pytest.mark.parametrize("step", [1, 2, 7, 64])
def test_appending_step_by_step_finds_the_same(step):
    rng = random.Random(step)
    for _ in range(25):
        words = np.array([ord(c) for c in text(rng, 150, "abc")])
        catchers = Catchers()
        for at in range(0, len(words), step):
            catchers.append(words[at:at + step])
            so_far = words[:at + step].tolist()
            assert catchers.runs() == brute(so_far)


def test_long_and_nested_periods():
    words = (["x"] * 700 + [str(i) for i in range(300)]) * 9 + ["y"] * 4
    assert runs_of([words, ["z"] * 50_000, words[:10]]) == [
        brute(words), [(0, 50_000, 1)], brute(words[:10])]


def test_least_exponent():
    with pytest.raises(ValueError):
        Catchers(exponent=3)


def test_edges(edges, nothing, by_id):
    got = by_id(periodic_runs.find(edges))
    assert sum(map(len, got.values())) == edges.count()
    assert len(got[5]) == 2 and got[5][0] == got[5][1]
    for i, own in ((1, b""), (2, b""), (3, b""), (4, b"Same text here"), (None, b"no id")):
        assert got[i][0].runs == [] and bytes(got[i][0].collapsed) == own
    long = got[6][0]
    assert [tuple(r) for r in long.runs] == [(0, 40_000, 1)] and bytes(long.collapsed) == b"word"
    assert periodic_runs.find(nothing).count() == 0


def test_words_part_at_ascii_white_space_only(docs, by_id):
    row = by_id(periodic_runs.find(docs([(1, "a\x0bb\x0cc\x1cd e f\x85g")])))[1][0]
    assert bytes(row.collapsed).decode() == "a b c\x1cd e f\x85g"


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in entry.LLM["op11_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    found = 0
    for doc in docs:
        words = (doc.text or "").encode().split()
        n, h = len(words), zlib.crc32(str(doc.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        found += len(runs)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        row = got[doc.doc_id]
        assert row.n_runs == len(runs)
        assert (row.start, row.length, row.period) == (best or (None,) * 3)
        assert row.exponent_milli == (best and 1000 * best[1] // best[2])
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert row.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        kept = b" ".join(collapsed(words, runs))
        assert row.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
    assert found > 5


def test_brute_force_of_collapsing():
    assert collapsed(list("xababababyz"), [(1, 8, 2)]) == list("xabyz")
