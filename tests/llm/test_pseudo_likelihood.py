from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from scanyard.llm import pseudo_likelihood as lm


def test_probabilities_sum_to_one_and_gradients_equal_differences():
    rng = np.random.default_rng(2)
    model = {k: v.astype(np.float64) for k, v in lm.start([50, 20, 5], 10).items()}
    text = rng.integers(0, lm.UNITS, 12)
    around = lm.context(text)
    every = np.arange(lm.UNITS)
    logs, _ = lm.log_probabilities(model, np.repeat(around[:1], lm.UNITS, axis=0), every)
    assert np.exp(logs).sum() == pytest.approx(1)
    _, g = lm.log_probabilities(model, around, text, train=True)
    places = {"hidden": (3, 2), "class": (1, 4), "vector": (int(text[3]), 1),
              "word": (int(text[5]) // lm.PER_CLASS, 2, int(text[5]) % lm.PER_CLASS),
              "class_bias": (int(text[5]) // lm.PER_CLASS,), "hidden_bias": (0,)}
    for name, at in places.items():
        before, step, loss = model[name][at], 1e-5, []
        for value in (before + step, before - step):
            model[name][at] = value
            loss.append(-lm.log_probabilities(model, around, text)[0].sum())
        model[name][at] = before
        assert g[name][at] == pytest.approx((loss[0] - loss[1]) / (2 * step), rel=1e-3, abs=1e-6)


def test_context_leaves_the_word_itself_out():
    assert lm.context(np.array([7, 8, 9])).tolist() == [
        [lm.UNITS, lm.UNITS, 8, 9], [lm.UNITS, 7, 9, lm.UNITS], [7, 8, lm.UNITS, lm.UNITS]]


def test_words_in_their_usual_order_are_likelier(docs):
    rng = np.random.default_rng(5)
    sentences = ["the cat sat on the mat", "a dog ran to the park", "we ate bread and cheese"]
    rows = [(i, " ".join(rng.choice(sentences, 12))) for i in range(400)]
    frame = docs(rows).repartition(3)
    model, vocabulary = lm.fit(frame, rounds=16)
    shuffled = [(i, " ".join(rng.permutation(t.split()))) for i, t in rows[:100]]
    usual, odd = (np.mean([r.per_token for r in lm.score(
        docs(some), model, vocabulary).collect()]) for some in (rows[:100], shuffled))
    assert usual > odd + 0.5


def test_averages_weigh_by_places(spark, monkeypatch):
    """Also where copies are added up in several levels."""
    monkeypatch.setattr(lm, "FAN", 2)
    like = lm.start([3], 1)
    rng = np.random.default_rng(1)
    copies, rows = [], []
    for part in range(5):
        flat, places = rng.standard_normal(lm._flat(like).size), float(part + 1)
        copies.append((flat, places))
        for n, piece in enumerate(np.array_split(flat * places, lm.SLICES)):
            rows.append((n, part, places, bytearray(piece.tobytes())))
    got = lm._flat(lm.average(spark.createDataFrame(rows, lm._COPIES), like))
    want = sum(f * p for f, p in copies) / 15
    assert np.allclose(got, want, atol=1e-5)


def test_edges(edges, nothing, by_id):
    model, vocabulary = lm.fit(edges)
    got = by_id(lm.score(edges, model, vocabulary))
    assert [(r.n_tokens, r.log_likelihood, r.per_token) for i in (1, 2, 3) for r in got[i]] == [
        (0, 0.0, None)] * 3
    assert got[6][0].n_tokens == 40_000 and len(got[5]) == 2 and got[None][0].n_tokens == 2
    for row in got[4]:
        assert row.per_token == pytest.approx(row.log_likelihood / row.n_tokens)
    model, vocabulary = lm.fit(nothing)
    assert vocabulary == [] and lm.score(nothing, model, vocabulary).count() == 0


def test_every_word_has_a_probability_of_its_own(docs, by_id):
    """Of all words counted, many more than the network has units."""
    names = [f"w{n}" for n in range(9000)]
    rows = [(n, " ".join([w] * (2 + n % 2))) for n, w in enumerate(names)]
    model, vocabulary = lm.fit(docs(rows))
    got = by_id(lm.score(docs([*enumerate(names), (-1, "neverseen")]), model, vocabulary))
    logs = np.array([got[n][0].log_likelihood for n in range(len(names))])
    unit = lm.Vocabulary(list(vocabulary)).__getitem__
    assert np.exp(logs).sum() == pytest.approx(1, abs=0.01)
    rare = [n for n in range(len(names)) if unit(names[n].encode()) == unit(b"neverseen")]
    assert len(rare) > 10 and got[-1][0].log_likelihood < logs[rare].min()
    # A word counted three times is half as likely again as one of its bucket counted twice.
    often, seldom = (next(n for n in rare if n % 2 == odd) for odd in (1, 0))
    assert np.exp(logs[often] - logs[seldom]) == pytest.approx(1.5)


@pytest.mark.parametrize("rounds", [1, lm.ROUNDS])
def test_every_place_is_learned_from_once(docs, monkeypatch, rounds):
    """Those of texts of one and two words too."""
    seen, average = [], lm.average

    def counted(copies, model):
        seen.extend(r.places for r in copies.where("slice = 0").collect())
        return average(copies, model)

    monkeypatch.setattr(lm, "average", counted)
    sizes = [1, 1, 1, 2, 3, 7, 8, 9, 40]
    lm.fit(docs([(n, "a " * size) for n, size in enumerate(sizes)]), rounds=rounds)
    assert sum(seen) == sum(sizes)


def test_scores_equal_plain_loops(docs, by_id):
    """Token by token: the class, the word in it, and a bucket word's share of its bucket."""
    names = [f"w{n}" for n in range(4000)]
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(rng.choice(names[:40], 30)) + " " + " ".join(names[i * 40:i * 40 + 40]))
            for i in range(100)] + [(100, None), (101, "w3"), (102, "NEVER w5 seen")]
    known = docs(rows[:102])
    model, vocabulary = lm.fit(known)
    counts = {bytes(r.word): r["count"] for r in vocabulary.counts.collect()}
    units_of = lm.Vocabulary(list(vocabulary))
    got = by_id(lm.score(docs(rows), model, vocabulary))

    def plain(text):
        words, total = lm.words((text or "").encode()), 0.0
        units = [units_of[w] for w in words]
        for at, unit in enumerate(units):
            inputs = []
            for place in (at - 2, at - 1, at + 1, at + 2):
                own = units[place] if 0 <= place < len(units) else lm.UNITS
                inputs += model["vector"][own].tolist()
            hidden = [np.tanh(sum(x * model["hidden"][i][j] for i, x in enumerate(inputs))
                              + model["hidden_bias"][j]) for j in range(lm.HIDDEN)]
            group, word = divmod(unit, lm.PER_CLASS)
            for weights, bias, chosen in ((model["class"], model["class_bias"], group), (
                    model["word"][group], model["word_bias"][group], word)):
                scores = np.array([sum(h * weights[j][k] for j, h in enumerate(hidden)) + bias[k]
                                   for k in range(len(bias))], np.float64)
                total += scores[chosen] - np.log(np.exp(scores).sum())
            if unit >= lm.UNITS - lm.BUCKETS:
                total += np.log(counts.get(words[at], lm.UNSEEN)
                                / (vocabulary.totals[unit - lm.UNITS + lm.BUCKETS]
                                   + lm.UNSEEN))
        return len(words), total

    for i, text in (rows[0], rows[57], *rows[100:]):
        n, total = plain(text)
        assert got[i][0].n_tokens == n
        assert got[i][0].log_likelihood == pytest.approx(total, rel=1e-4, abs=1e-3)
    both = by_id(lm.fit_and_score(known))
    assert all(both[i][0].log_likelihood == pytest.approx(got[i][0].log_likelihood, rel=1e-4)
               for i in range(100))


def test_split_finds_the_words_of_each_text():
    bodies = [b"", b"One two,two ", "Zwölf\tone".encode(), b" \n", b"x", b"two"]
    found, sizes = lm.split(pa.array(bodies, pa.binary()))
    every = iter(found.to_pylist())
    assert [[next(every) for _ in range(n)] for n in sizes] == [lm.words(b) for b in bodies]
    found, sizes = lm.split(pa.array([], pa.binary()))
    assert len(found) == 0 and sizes.tolist() == []


@pytest.mark.parametrize("most", [0, 40, 10_000])
def test_only_rare_words_are_joined(docs, by_id, monkeypatch, most):
    """The counts of common words travel with the vocabulary; scores are the same either way."""
    names = [f"w{n}" for n in range(4000)]
    rows = [(i, " ".join(names[i * 40:i * 40 + 40] * (1 + (i == 99)))) for i in range(100)]
    frame = docs([*rows, (100, None), (101, "never seen w3 w3900")])
    want = by_id(lm.fit_and_score(frame))
    monkeypatch.setattr(lm, "COMMON", most)
    model, vocabulary = lm.fit(frame)
    encoded = lm.encode(lm.pairs(frame, "doc_id", "text"), vocabulary)
    joined = {bytes(o.word) for r in encoded.select("others").collect() for o in r.others}
    # Words counted twice or three times are the 40 of text 99, w3 and w3900.
    unit, times = lm.Vocabulary(list(vocabulary)).__getitem__, {
        bytes(r.word): r["count"] for r in vocabulary.counts.collect()}
    outside = {w for w in times if unit(w) >= lm.UNITS - lm.BUCKETS}
    assert joined == {w for w in outside if times[w] < vocabulary.least}
    assert set(vocabulary.common) == outside - joined and len(vocabulary.common) <= most
    assert (joined == set()) == (most == 10_000)
    got = by_id(lm.fit_and_score(frame))
    assert all(got[i][0].log_likelihood == pytest.approx(want[i][0].log_likelihood, rel=1e-9)
               for i in range(102))


def test_contexts_stop_at_the_ends_of_texts():
    texts = [np.array(t, np.int64) for t in ([1, 2, 3], [], [4], [5, 6])]
    flat, sizes = np.concatenate(texts), np.array(list(map(len, texts)))
    want = np.concatenate([lm.context(t) for t in texts])
    assert lm.contexts(flat, sizes).tolist() == want.tolist()
    assert lm.contexts(flat, sizes, np.array([0, 3, 5])).tolist() == want[[0, 3, 5]].tolist()
