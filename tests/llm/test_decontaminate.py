from __future__ import annotations

import random

import pytest

from scanyard.llm import decontaminate
from scanyard.llm.decontaminate import WuManber, words


@pytest.mark.parametrize("length", [1, 2, 3, 5, 6, 10])
def test_search_equals_brute_force(length):
    rng = random.Random(length)
    letters = [b"a", b"b", b"c", "é".encode()]
    for _ in range(60):
        strings = [tuple(rng.choices(letters, k=length)) for _ in range(rng.randint(1, 12))]
        text = rng.choices(letters, k=rng.randint(0, 120))
        search = WuManber(strings)
        got = sorted((at, search.strings[n]) for at, n in search.find(text))
        want = sorted((at, s) for s in set(strings) for at in range(len(text) - length + 1)
                      if tuple(text[at:at + length]) == s)
        assert got == want


def brute(text, items, window=10):
    seq, hit, found = words((text or "").encode()), set(), set()
    for item, body in items:
        item_words = words((body or "").encode())
        size = min(window, len(item_words))
        for i in range(len(item_words) - size + 1 if item_words else 0):
            for at in range(len(seq) - size + 1):
                if seq[at:at + size] == item_words[i:i + size]:
                    hit |= set(range(at, at + size))
                    if item is not None:
                        found.add(str(item))
    return len(seq), len(hit), sorted(found)


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"),
         (10, "One-Two, three four FIVE six seven eight nine ten!"), (2, "short item"), (3, None),
         (4, "..."), (None, "without id"), (5, "short item")]
TEXTS = [(1, "x one two three four five six seven eight nine ten eleven y"), (2, None), (3, ""),
         (4, "a short item and SHORT  item"), (5, "without id at all"), (6, "clean"),
         (6, "clean"), (7, "z " * 30_000 + "short item"), (None, "short item"),
         (8, "one two three four five six seven eight nine")]


@pytest.mark.parametrize("part_bytes", [decontaminate.PART_BYTES, 40])
def test_equals_brute_force(spark, docs, part_bytes):
    """Also with a benchmark read in several parts."""
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contamination(docs(TEXTS), bench, part_bytes=part_bytes)
    rows = sorted(((r.id, r.n_words, r.n_hit, list(r["items"])) for r in got.collect()), key=repr)
    assert rows == sorted(((i, *brute(t, ITEMS)) for i, t in TEXTS), key=repr)
    kept = decontaminate.clean(docs(TEXTS), bench, part_bytes=part_bytes)
    assert kept.columns == docs(TEXTS).columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 6, 6, 8]


def test_empty_tables(spark, docs, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(nothing, none).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(docs(TEXTS), none).collect()} == {0}
    assert decontaminate.clean(docs(TEXTS), none).count() == len(TEXTS)


@pytest.mark.parametrize("operator", [decontaminate.contamination, decontaminate.clean])
def test_one_part_of_the_benchmark_at_a_time(spark, docs, monkeypatch, operator):
    """Each is searched, and the result written, before the one after the next is fetched."""
    events, parts, keep = [], decontaminate.parts, decontaminate.keep

    def fetched(*args):
        for part in parts(*args):
            events.append("fetch")
            yield part

    def kept(*args):
        events.append("write")
        return keep(*args)

    monkeypatch.setattr(decontaminate, "parts", fetched)
    monkeypatch.setattr(decontaminate, "keep", kept)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert operator(docs(TEXTS), bench, part_bytes=40).count()
    n = events.count("fetch")
    assert n > 2 and events == ["fetch"] + ["fetch", "write"] * (n - 1)
