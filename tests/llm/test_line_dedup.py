from __future__ import annotations

import random

import pytest

from scanyard.llm import line_dedup


def key(line):
    line = line.strip(" \t\n\x0b\f\r")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)


def brute(rows, least=10):
    """(id, lines, lost, kept text) of every row."""
    first = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                first.setdefault(key(line), []).append((i is not None, i or 0))
    out = []
    for i, text in rows:
        every = (text or "").split("\n")
        kept = [x for x in every if len(key(x)) < least
                or min(first[key(x)]) == (i is not None, i or 0)]
        out.append((i, len(every), len(every) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(docs, **options):
    kept = line_dedup.apply(docs, line_dedup.bitmaps(docs, **options))
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in kept.collect()),
                  key=repr)


def make(seed, size=150):
    rng = random.Random(seed)
    pool = ["a line of text", "  A LINE of text\t", "\x0banother one here\r", "short", "", "ÄÖÜ äöü ÄÖÜ",
            "äöü äöü äöü", "ten points", "nine poin", "日本語のテキストの行です", " a line of text"]
    pool += [f"line number {i} of all" for i in range(40)]
    return [(rng.choice([None, *range(size)]), "\n".join(rng.choices(pool, k=rng.randint(0, 90))))
            for _ in range(size)]


def test_kept_lines_equal_brute_force(docs):
    rows = make(1)
    assert found(docs(rows)) == brute(rows)
    assert found(docs(rows), least=13) == brute(rows, 13)


def test_frequent_lines_are_cut_into_pieces(docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "SAMPLE", 4000)
    rows = make(2) + [(5, "a line of text\n" * 200), (None, "a line of text")]
    frame = docs(rows)
    hot = line_dedup._frequent(line_dedup.keep(line_dedup._rows(
        frame, "doc_id", "text", 10), "lines")).collect()
    assert max(len(r.cuts) for r in hot) > 3
    assert found(frame) == brute(rows)


def test_bitmaps_hold_only_words_with_a_line_lost(docs):
    every = [f"line {i} of this text" for i in range(300)]
    rows = [(1, "\n".join(every[70:72])), (2, "\n".join(every))]
    maps = line_dedup.bitmaps(docs(rows)).collect()
    assert len(maps) == 1 and maps[0].id == 2 and maps[0].n_dropped == 2
    assert [(w.word, w.bits) for w in maps[0].bitmap] == [(1, ~(0b11 << 6))]


def test_edges(edges, docs, nothing):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    assert found(edges) == brute(rows)
    rows = [(7, "the same line of text"), (7, "the same line of text\nthe same line of text"),
            (8, "x" * 300_000 + "\n" + "x" * 300_000), (9, "X" * 300_000), (9, None)]
    assert found(docs(rows)) == brute(rows)
    assert found(nothing) == []


def test_other_columns_of_any_name_stay(spark):
    frame = spark.createDataFrame(
        [(1, "one line of text", 1, 2, 3, 4), (2, "one line of text", 5, 6, 7, 8)],
        "doc_id long, text string, bitmap int, key int, `row` int, sig int")
    kept = line_dedup.apply(frame, line_dedup.bitmaps(frame))
    assert kept.columns == [*frame.columns, "n_lines", "n_dropped", "kept_text"]
    assert {(r.doc_id, r.sig, r.n_dropped) for r in kept.collect()} == {(1, 4, 0), (2, 8, 1)}
    with pytest.raises(ValueError):
        line_dedup.apply(frame.withColumnRenamed("sig", "n_lines"), line_dedup.bitmaps(frame))


def test_no_python_in_the_plan(docs):
    kept = line_dedup.apply(frame := docs(make(3)), line_dedup.bitmaps(frame))
    plan = kept._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan and "Pandas" not in plan
