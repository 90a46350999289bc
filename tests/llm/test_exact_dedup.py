from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from scanyard.llm import exact_dedup


def az(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, largest):
    groups = {}
    for i, text in rows:
        groups.setdefault(az(text), []).append(i)
    out = []
    for text, ids in groups.items():
        order = sorted(ids, key=lambda i: (i is not None, i or 0), reverse=largest)
        for place, i in enumerate(order):
            out.append((i, order[0], len(ids), place == 0,
                        hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select(
        "id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


@pytest.mark.parametrize("largest", [False, True])
def test_edges_equal_brute_force(edges, largest):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    assert found(exact_dedup.groups(edges, largest=largest)) == brute(rows, largest)


@pytest.mark.parametrize("weak", [F.length, lambda t: F.lit(0), exact_dedup.content_hash])
def test_collisions_are_told_apart_by_bytes(docs, weak):
    random.seed(5)
    rows = [(i, random.choice("abcdefABC") * random.randint(0, 3)) for i in range(60)]
    got = exact_dedup.groups(docs(rows), hashed=lambda t: weak(t).cast("string").cast("binary"))
    assert found(got) == brute(rows, False)


def test_rows_that_stay_have_all_columns(edges):
    kept = exact_dedup.deduplicate(edges)
    assert kept.columns == edges.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 6, 7, 8]
    kept = exact_dedup.deduplicate(edges, largest=True)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3, 5, 6, 7, 8]


def test_empty_table(nothing):
    assert exact_dedup.groups(nothing).count() == 0
    assert exact_dedup.deduplicate(nothing).count() == 0
