from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from scanyard.llm import toxicity
from scanyard.llm.toxicity import Words, gradients, train, window_rows, windows

BAD = ["grobian", "schuft", "lump"]


def corpus(seed, count, words=(0, 120)):
    """Clean and toxic texts: the toxic ones hold a bad word, bent in many ways, now and then."""
    rng = random.Random(seed)
    syllables = ["ta", "mo", "ri", "sel", "ka", "do", "ne", "lu", "pa", "vi"]
    rows = []
    for i in range(count):
        text = ["".join(rng.choices(syllables, k=rng.randint(1, 4)))
                for _ in range(rng.randint(*words))]
        toxic = rng.random() < 0.4
        if toxic:
            for _ in range(1 + len(text) // 20):
                bad = rng.choice(BAD) + rng.choice(syllables)
                text.insert(rng.randint(0, len(text)), rng.choice([bad, bad.upper(), bad + "!!"]))
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_windows_cover_every_word():
    for n in (0, 1, 47, 48, 49, 72, 73, 200, 1000):
        starts = windows(n)
        covered = {w for s in starts for w in range(s, min(s + toxicity.WINDOW, n))}
        assert covered == set(range(n)) and (n == 0) == (len(starts) == 0)


def started(rng, texts):
    vocabulary = sorted({w for t in texts for w in t})
    placed = [np.array([vocabulary.index(w) for w in t], np.int32) for t in texts]
    return {k: v.astype(np.float64) for k, v in toxicity._start(
        rng, placed, vocabulary, np.array([0, 1])).items()}


def plain_score(model, window):
    """One window's score, word by word and number by number."""
    def vector(word):
        given = Words([[word]])
        word_part = model["word"][given.word[0]]
        grams = [model["gram"][g] for g in given.grams]
        return np.concatenate([word_part, sum(grams) / len(grams)])

    def step(x, state, units):
        size = len(state)
        h = [sum(state[i] * units[i][j] for i in range(size)) for j in range(3 * size)]
        out = []
        for j in range(size):
            z = 1 / (1 + np.exp(-(x[j] + h[j])))
            r = 1 / (1 + np.exp(-(x[size + j] + h[size + j])))
            n = np.tanh(x[2 * size + j] + r * h[2 * size + j])
            out.append(n + z * (state[j] - n))
        return out

    inputs = [vector(w) @ model["in"] + model["in_bias"] for w in window]
    # Short windows are filled with words of zeros, which attention leaves out.
    inputs += [model["in_bias"]] * (toxicity.WINDOW - len(window))
    half, size = len(model["in_bias"]) // 2, toxicity.STATE
    ahead, back, state = [], [], [0.0] * size
    for x in inputs:
        ahead.append(state := step(x[:half], state, model["ahead"]))
    state = [0.0] * size
    for x in reversed(inputs):
        back.insert(0, state := step(x[half:], state, model["back"]))
    both = [np.array(a + b) for a, b in zip(ahead, back)][:len(window)]
    worth = np.array([np.tanh(s @ model["attend"] + model["attend_bias"]) @ model["worth"]
                      for s in both])
    share = np.exp(worth) / np.exp(worth).sum()
    return sum(p * s for p, s in zip(share, both)) @ model["out"] + model["out_bias"][0]


def test_window_scores_equal_plain_loops():
    rng = np.random.default_rng(4)
    texts = [[b"abc", b"de", b"f"], [b"w%d" % (i % 17) for i in range(130)], [], [b"abc"] * 48]
    model = started(rng, texts)
    found = toxicity.window_scores(model, Words(texts), batch=2)
    for text, got in zip(texts, found):
        cuts = [text[s:s + toxicity.WINDOW] for s in windows(len(text))]
        assert len(got) == len(cuts)
        assert got == pytest.approx([plain_score(model, c) for c in cuts], rel=1e-4, abs=1e-4)
    model |= {"base": 0.25, "text": np.array([0.5, 1.0, -0.5, 0.1])}
    got = toxicity.scores(model, [b" ".join(t) for t in texts])
    for text, value in zip(texts, got):
        s = np.array([plain_score(model, text[a:a + toxicity.WINDOW]) for a in windows(len(text))])
        if len(s):
            x = 0.5 * s.mean() + s.max() - 0.5 * (s > 0).mean() + 0.1
        assert value == pytest.approx(1 / (1 + np.exp(-x)) if len(s) else 0.25, abs=1e-4)


def test_numbered_words_equal_words():
    texts = [[b"abc", b"de", b"abc"], [], [b"zz", b"de"]]
    vocabulary = [b"not used", b"zz", b"abc", b"de"]
    a = Words.numbered([np.array([vocabulary.index(w) for w in t], np.int32) for t in texts],
                       vocabulary)
    b = Words(texts)
    for own, other in zip(a.texts, b.texts):
        assert [a.word[w] for w in own] == [b.word[w] for w in other]


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    texts = [[b"abc", b"de", b"f"], [b"abc", b"xyz", b"abc", b"q", b"de"]]
    given = Words(texts)
    rows = np.concatenate([window_rows(t, windows(len(t)), given.count) for t in given.texts])
    model = started(rng, texts)
    target, weight = np.array([0.0, 1.0]), np.array([1.0, 2.0])
    _, g = gradients(model, given, rows, target, weight)
    for name in ("out", "worth", "attend", "ahead", "back", "in_bias", "in"):
        at = tuple(rng.integers(0, n) for n in model[name].shape)
        before, step = model[name][at], 1e-3
        loss = []
        for value in (before + step, before - step):
            model[name][at] = value
            loss.append(gradients(model, given, rows, target, weight)[0])
        model[name][at] = before
        assert g[name][at] == pytest.approx((loss[0] - loss[1]) / (2 * step), rel=0.05, abs=2e-4)


def test_learns_words_bent_in_ways_it_has_not_seen():
    rows = corpus(1, 900)
    model = train([t.encode() for _, t, _ in rows], [y for *_, y in rows])
    new = corpus(2, 300, words=(5, 400))
    got = toxicity.scores(model, [t.encode() for _, t, _ in new])
    right = np.mean((got >= 0.5) == np.array([y for *_, y in new]))
    assert right > 0.95 and got.min() >= 0 and got.max() <= 1


def test_column_scores_edges(spark, edges, nothing):
    rows = corpus(3, 400)
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = frame.select("doc_id", "toxic").unionByName(
        spark.createDataFrame([(None, 1), (99_999, 1), (1, None)], "doc_id long, toxic int"))
    model = toxicity.fit(frame, labels)
    got = edges.select("doc_id", toxicity.score(edges, model).alias("score")).collect()
    assert len(got) == edges.count() and all(0 <= r.score <= 1 for r in got)
    base = {r.score for r in got if r.doc_id in (1, 2, 3)}
    assert base == {model["base"]}
    assert nothing.select(toxicity.score(nothing, model)).count() == 0


def test_without_two_classes_every_text_gets_the_share(spark, edges, nothing):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(edges, labels)
    assert model == {"base": 0.5}
    one = spark.createDataFrame([(i, 0) for i in range(9)], "doc_id long, toxic int")
    model = toxicity.fit(edges, one)
    assert {r[0] for r in edges.select(toxicity.score(edges, model)).collect()} == {0.0}


def test_held_out_rows_are_not_learned_from(spark):
    from pyspark.sql import functions as F
    ids = spark.range(50).withColumn("held", toxicity.held_out(F.col("id")))
    assert {r.id: r.held for r in ids.collect()} == {
        i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(50)}


def test_learns_from_all_windows_of_a_long_text(monkeypatch):
    """What makes it toxic may stand in any of them."""
    seen, gradients = [], toxicity.gradients

    def counted(model, given, rows, *more):
        seen.extend(given.texts)
        return gradients(model, given, rows, *more)

    monkeypatch.setattr(toxicity, "gradients", counted)
    bodies = [b"word " * 2000 for _ in range(10)]
    toxicity.train(bodies, [0, 1] * 5, epochs=1)
    # One text of each class is set aside for the last layer.
    assert len(seen) == 8 * len(toxicity.windows(2000)) > 8 * 8
