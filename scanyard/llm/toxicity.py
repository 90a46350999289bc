"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is cut into words, its words into overlapping windows, all of which are scored. A word
enters the network as a learned vector of its own and the mean of the vectors of its character
n-grams. Gated recurrent units read a window from both ends, attention weighs their states into
one, which gives the window's score. A logistic layer over a text's window scores (mean, largest,
share above zero) gives the text's score.

It learns from a bounded sample of labelled texts (``MOST_TOXIC`` and ``MOST_CLEAN`` texts of the
smallest hash of id, all windows of each, which weigh as much as one), in one task. Weights undo
the sampling by class. Tables start from the log-odds of what the sample shows. The score depends
on the text alone.

Defined cases: null and empty texts, and texts without words, get the sample's share of toxic
texts; without labels of both classes every text does; labels that are null, or whose id is null
or unknown, are not learned from; repeated labels count each; columns other than id and text are
not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanyard.llm.common import findable, give_back, pairs, remembered
from scanyard.llm.decontaminate import words

MOST_TOXIC, MOST_CLEAN = 1500, 3000
WINDOW, STRIDE = 48, 24
WORD_BITS, GRAM_BITS = 14, 16
WORD_SIZE, GRAM_SIZE, STATE = 6, 10, 8
GRAMS = (3, 4, 5, 6, 7)
EPOCHS, BATCH, RATE = 3, 384, 0.01
# Text scored at once.
SCORED_BYTES = 512 << 10
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """Distinct words of some texts, with their word bucket and their n-gram buckets."""

    def __init__(self, texts: Iterable[list[bytes]]):
        number: dict[bytes, int] = _Numbers()
        self.texts = [np.fromiter(map(number.__getitem__, t), np.int32, len(t)) for t in texts]
        self._hash(list(number))

    @classmethod
    def numbered(cls, texts: list[np.ndarray], vocabulary: list[bytes]) -> Words:
        """From texts that are places in a vocabulary already."""
        own = cls.__new__(cls)
        every = np.concatenate(texts) if texts else np.zeros(0, np.int32)
        known, place = np.unique(every, return_inverse=True)
        cuts = np.cumsum([len(t) for t in texts])[:-1]
        own.texts = np.split(place.astype(np.int32), cuts) if texts else []
        own._hash([vocabulary[n] for n in known.tolist()])
        return own

    def _hash(self, distinct: list[bytes]) -> None:
        self.count = len(distinct)
        marked = b"".join(b"<" + w + b">" for w in distinct)
        lengths = np.fromiter(map(len, distinct), np.int64, self.count) + 2
        ends = np.cumsum(lengths)
        letters = np.frombuffer(marked, np.uint8).astype(np.uint64) + np.uint64(1)
        # A polynomial hash of every prefix of the joined bytes gives that of every n-gram.
        buckets, owners = [], []
        left = np.repeat(ends, lengths) - np.arange(len(letters))
        owner = np.repeat(np.arange(self.count), lengths)
        with np.errstate(over="ignore"):
            rolling = letters.copy()
            for n in range(2, max(GRAMS) + 1):
                rolling = rolling[:-1] * _MIX + letters[n - 1:] if len(rolling) > 1 else rolling[:0]
                if n in GRAMS:
                    inside = np.flatnonzero(left[:len(rolling)] >= n)
                    mixed = (rolling[inside] ^ np.uint64(n)) * _MIX
                    buckets.append((mixed >> np.uint64(64 - GRAM_BITS)).astype(np.int32))
                    owners.append(owner[inside].astype(np.int32))
        buckets, owners = np.concatenate(buckets), np.concatenate(owners)
        rank = np.argsort(owners, kind="stable")
        self.grams, self.owners = buckets[rank], owners[rank]
        self.per = np.bincount(self.owners, minlength=self.count)
        self.first = np.cumsum(self.per) - self.per
        self.scale = 1 / np.maximum(self.per, 1).astype(np.float32)
        whole = np.zeros(self.count, np.uint64)
        if self.count:
            with np.errstate(over="ignore"):
                place = np.arange(len(letters), dtype=np.uint64) - np.repeat(
                    ends - lengths, lengths).astype(np.uint64)
                part = (letters + place * np.uint64(257)) * _MIX
                part ^= part >> np.uint64(29)
                whole = np.add.reduceat(part * _MIX, ends - lengths)
        self.word = (whole * _MIX >> np.uint64(64 - WORD_BITS)).astype(np.int32)

    def vectors(self, model: dict) -> np.ndarray:
        """A row per distinct word and, last, one of zeros that fills short windows."""
        out = np.zeros((self.count + 1, WORD_SIZE + GRAM_SIZE), np.float32)
        out[:-1, :WORD_SIZE] = model["word"][self.word]
        step = 1 << 16  # words at once, to bound the gathered rows
        for at in range(0, self.count, step):
            stop = min(at + step, self.count)
            lo, hi = self.first[at], self.first[stop - 1] + self.per[stop - 1]
            rows = model["gram"][self.grams[lo:hi]]
            # Every marked word has three bytes or more, so each has an n-gram.
            out[at:stop, WORD_SIZE:] = np.add.reduceat(
                rows, self.first[at:stop] - lo) * self.scale[at:stop, None]
        return out


class _Numbers(dict):
    def __missing__(self, key):
        self[key] = value = len(self)
        return value


def windows(length: int) -> np.ndarray:
    """First words of a text's windows; the last one ends with the text."""
    if length <= WINDOW:
        return np.zeros(min(length, 1), np.int64)
    return np.append(np.arange(0, length - WINDOW, STRIDE), length - WINDOW)


def window_rows(text: np.ndarray, starts: np.ndarray, fill: int) -> np.ndarray:
    if len(text) < WINDOW:
        text = np.concatenate([text, np.full(WINDOW - len(text), fill, np.int32)])
    return text[starts[:, None] + np.arange(WINDOW)]


def sigmoid(x):
    return np.tanh(x * 0.5) * 0.5 + 0.5


def _read(inputs, rows, units, order, keep_steps):
    """States of one direction (time first), and what its gradient needs."""
    size = units.shape[0]
    state = np.zeros((len(rows), size), np.float32)
    states = np.empty((rows.shape[1], len(rows), size), np.float32)
    kept = []
    for t in order:
        x, h = inputs[rows[:, t]], state @ units
        gates = sigmoid(x[:, :2 * size] + h[:, :2 * size])
        z, r = gates[:, :size], gates[:, size:]
        inner = h[:, 2 * size:]
        n = np.tanh(x[:, 2 * size:] + r * inner)
        before, state = state, n + z * (state - n)
        states[t] = state
        if keep_steps:
            kept.append((before, z, r, inner, n))
    return states, kept


def forward(model, vectors, rows, fill, keep_steps=False):
    """Window scores before the sigmoid."""
    inputs = vectors @ model["in"] + model["in_bias"]
    half = inputs.shape[1] // 2
    steps = range(rows.shape[1])
    ahead, a = _read(inputs[:, :half], rows, model["ahead"], steps, keep_steps)
    back, b = _read(inputs[:, half:], rows, model["back"], steps[::-1], keep_steps)
    states = np.concatenate([ahead, back], axis=2)
    seen = np.tanh(states @ model["attend"] + model["attend_bias"])
    worth = seen @ model["worth"] + np.where(rows.T == fill, np.float32(-1e4), np.float32(0))
    worth = np.exp(worth - worth.max(axis=0))
    share = worth / worth.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", share, states)
    score = pooled @ model["out"] + model["out_bias"][0]
    return score, (a, b, states, seen, share, pooled)


def _unread(kept, order, units, given, count, rows):
    """Gradients of one direction: of its inputs per distinct word and of its units."""
    size = units.shape[0]
    flow = np.zeros_like(given[0])
    into = np.empty((rows.shape[1], len(rows), 3 * size), np.float32)
    d_units = np.zeros_like(units)
    for t, (before, z, r, inner, n) in zip(reversed(order), reversed(kept)):
        flow = flow + given[t]
        d_n = flow * (1 - z) * (1 - n * n)
        d_z = flow * (before - n) * z * (1 - z)
        d_r = d_n * inner * r * (1 - r)
        d_x = np.concatenate([d_z, d_r, d_n], axis=1)
        d_h = np.concatenate([d_z, d_r, d_n * r], axis=1)
        d_units += before.T @ d_h
        flow = flow * z + d_h @ units.T
        into[t] = d_x
    return _sum_by(rows.T.ravel(), into.reshape(-1, 3 * size), count), d_units


def _sum_by(keys, values, count):
    """Rows of ``values`` added up by key."""
    out = np.zeros((count, values.shape[1]), np.float32)
    if len(keys):
        order = np.argsort(keys, kind="stable")
        found = keys[order]
        first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        out[found[first]] = np.add.reduceat(values[order], first)
    return out


def gradients(model, given: Words, rows, target, weight):
    """Loss and gradients of a batch of windows."""
    fill = given.count
    vectors = given.vectors(model)
    score, (a, b, states, seen, share, pooled) = forward(model, vectors, rows, fill, True)
    p = sigmoid(score)
    loss = -np.mean(weight * np.log(np.where(target > 0, p, 1 - p) + 1e-7))
    d_score = (weight * (p - target) / len(rows)).astype(np.float32)
    g = {"out": pooled.T @ d_score, "out_bias": np.array([d_score.sum()], np.float32)}
    d_pooled = d_score[:, None] * model["out"]
    d_states = share[:, :, None] * d_pooled[None]
    d_share = np.einsum("bh,tbh->tb", d_pooled, states)
    d_worth = share * (d_share - (share * d_share).sum(axis=0))
    g["worth"] = np.einsum("tb,tbk->k", d_worth, seen)
    d_seen = d_worth[:, :, None] * model["worth"] * (1 - seen * seen)
    g["attend"] = np.einsum("tbh,tbk->hk", states, d_seen)
    g["attend_bias"] = d_seen.sum(axis=(0, 1))
    d_states = d_states + d_seen @ model["attend"].T
    size, steps, count = STATE, range(rows.shape[1]), given.count + 1
    ahead, g["ahead"] = _unread(a, steps, model["ahead"], d_states[:, :, :size], count, rows)
    back, g["back"] = _unread(b, steps[::-1], model["back"], d_states[:, :, size:], count, rows)
    d_inputs = np.concatenate([ahead, back], axis=1)
    g["in"], g["in_bias"] = vectors.T @ d_inputs, d_inputs.sum(axis=0)
    d_vectors = (d_inputs @ model["in"].T)[:-1]
    g["word"] = _sum_by(given.word, d_vectors[:, :WORD_SIZE], len(model["word"]))
    d_grams = d_vectors[:, WORD_SIZE:] * given.scale[:, None]
    g["gram"] = _sum_by(given.grams, d_grams[given.owners], len(model["gram"]))
    return float(loss), g


def _start(rng, texts: list[np.ndarray], vocabulary: list[bytes], labels: np.ndarray) -> dict:
    """Random weights; the first entry of each word and n-gram vector is its log-odds."""
    def random(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    width = WORD_SIZE + GRAM_SIZE
    model = {
        "word": random(1 << WORD_BITS, WORD_SIZE, scale=0.05),
        "gram": random(1 << GRAM_BITS, GRAM_SIZE, scale=0.05),
        "in": random(width, 6 * STATE, scale=0.4), "in_bias": np.zeros(6 * STATE, np.float32),
        "ahead": random(STATE, 3 * STATE, scale=0.3), "back": random(STATE, 3 * STATE, scale=0.3),
        "attend": random(2 * STATE, STATE, scale=0.4), "attend_bias": np.zeros(STATE, np.float32),
        "worth": random(STATE, scale=0.4), "out": random(2 * STATE, scale=0.4),
        "out_bias": np.zeros(1, np.float32)}
    seen = {"word": np.zeros((2, 1 << WORD_BITS)), "gram": np.zeros((2, 1 << GRAM_BITS))}
    for at in range(0, len(texts), 50):
        some = Words.numbered(texts[at:at + 50], vocabulary)
        bounds = some.first + some.per
        for text, label in zip(some.texts, labels[at:at + 50]):
            mine = np.unique(text)
            seen["word"][label][np.unique(some.word[mine])] += 1
            if len(mine):
                grams = np.concatenate([some.grams[some.first[w]:bounds[w]] for w in mine])
                seen["gram"][label][np.unique(grams)] += 1
    n = np.bincount(labels, minlength=2)
    for table, (clean, toxic) in seen.items():
        odds = np.log((toxic + 0.5) / (n[1] + 1)) - np.log((clean + 0.5) / (n[0] + 1))
        error = np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
        sure = np.clip(np.abs(odds) - 2 * error, 0, None) * np.sign(odds)
        model[table][:, 0] += np.where(toxic + clean >= 3, sure, 0).astype(np.float32)
    return model


class Adam:
    def __init__(self, model, rate):
        self.rate, self.steps = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in model.items()}
        self.v = {k: np.zeros_like(v) for k, v in model.items()}

    def step(self, model, g):
        self.steps += 1
        scale = self.rate * np.sqrt(1 - 0.999 ** self.steps) / (1 - 0.9 ** self.steps)
        for k, d in g.items():
            self.m[k] += 0.1 * (d - self.m[k])
            self.v[k] += 0.001 * (d * d - self.v[k])
            model[k] -= (scale * self.m[k] / (np.sqrt(self.v[k]) + 1e-7)).astype(np.float32)


def _features(scores: np.ndarray) -> list[float]:
    scores = np.clip(scores, -10, 10)
    return [scores.mean(), scores.max(), (scores > 0).mean(), 1.0]


def train(bodies: list[bytes], labels: list[int], shares: dict[int, float] | None = None,
          epochs: int = EPOCHS) -> dict:
    """Fit on texts and their labels; ``shares`` weighs the classes as they are in all rows."""
    labels = np.array(labels, np.int64)
    # The words of all texts once, and the texts as places among them.
    number = _Numbers()
    texts = [np.fromiter(map(number.__getitem__, words(body)), np.int32) for body in bodies]
    vocabulary = list(number)
    weight = np.array([(shares or {}).get(int(c), 1.0) for c in labels], np.float32)
    base = float(np.average(labels, weights=weight)) if len(labels) else 0.5
    if len(set(labels.tolist())) < 2:
        return {"base": base}
    rng = np.random.default_rng(7)
    # The layer over window scores learns from texts the network has not seen.
    later = np.zeros(len(texts), bool)
    for label in (0, 1):
        some = rng.permutation(np.flatnonzero(labels == label))
        later[some[:len(some) // 5]] = True
    for_layer = [t for t, x in zip(texts, later) if x], labels[later], weight[later]
    texts, labels = [t for t, x in zip(texts, later) if not x], labels[~later]
    model = _start(rng, texts, vocabulary, labels)
    adam = Adam(model, RATE)
    # Every window of every text: its text, its first word, its weight.
    first = [windows(len(text)) for text in texts]
    owner = np.repeat(np.arange(len(texts)), [len(f) for f in first])
    first = np.concatenate(first)
    balance = np.where(labels > 0, 0.5 / max(1, (labels > 0).sum()),
                       0.5 / max(1, (labels == 0).sum()))
    each = (balance[owner] / np.bincount(owner)[owner]).astype(np.float32)
    each *= len(each) / each.sum()
    for epoch in range(epochs):
        adam.rate = RATE * (1 - epoch / epochs)
        shuffled = rng.permutation(len(owner))
        for at in range(0, len(shuffled), BATCH):
            some = shuffled[at:at + BATCH]
            cut = [texts[o][f:f + WINDOW] for o, f in zip(owner[some].tolist(),
                                                          first[some].tolist())]
            given = Words.numbered(cut, vocabulary)
            rows = np.concatenate([window_rows(t, np.zeros(1, np.int64), given.count)
                                   for t in given.texts])
            target = labels[owner[some]].astype(np.float32)
            _, g = gradients(model, given, rows, target, np.minimum(each[some], 8))
            adam.step(model, g)
    model["base"] = base
    texts, labels, weight = for_layer if len(set(for_layer[1].tolist())) == 2 else (
        texts, labels, np.ones(len(labels)))
    full = np.array([len(t) > 0 for t in texts], bool)
    features = np.array([_features(s) for at in range(0, len(texts), 50)
                         for s in window_scores(model, Words.numbered(
                             texts[at:at + 50], vocabulary)) if len(s)])
    model["text"] = _logistic(features, labels[full], weight[full])
    return model


def _logistic(x, y, weight, decay=1e-3, rounds=60):
    """Weights of a logistic layer, by Newton steps."""
    w = np.array([0.5, 0.5, 0.0, 0.0])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        slope = x.T @ (weight * (p - y)) / len(y) + decay * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x / len(y) + decay * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w - step * min(1.0, 2.0 / (np.abs(step).max() + 1e-9))
    return w


def window_scores(model: dict, given: Words, batch: int = 1024) -> list[np.ndarray]:
    """The scores of all windows of each text."""
    vectors = given.vectors(model)
    starts = [windows(len(t)) for t in given.texts]
    out = np.empty(sum(map(len, starts)), np.float32)
    done, waiting, size = 0, [], 0

    def run():
        nonlocal done, waiting, size
        rows = np.concatenate(waiting)
        for at in range(0, len(rows), batch):
            score, _ = forward(model, vectors, rows[at:at + batch], given.count)
            out[done:done + len(score)] = score
            done += len(score)
        waiting, size = [], 0

    for text, first in zip(given.texts, starts):
        if len(first):
            waiting.append(window_rows(text, first, given.count))
            size += len(first)
            if size >= batch:
                run()
    if waiting:
        run()
    return np.split(out, np.cumsum([len(s) for s in starts])[:-1])


def scores(model: dict, bodies: list[bytes]) -> np.ndarray:
    """A score from 0 to 1 for each text."""
    out = np.full(len(bodies), model["base"])
    if "text" not in model:
        return out
    for at, found in enumerate(window_scores(model, Words(map(words, bodies)))):
        if len(found):
            out[at] = sigmoid(np.dot(_features(found), model["text"]))
    return out


def held_out(id_column: Column) -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0; null ids are as empty."""
    text = F.coalesce(id_column.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", most_toxic: int = MOST_TOXIC,
        most_clean: int = MOST_CLEAN) -> dict:
    """The model learned from labelled rows that are not held out."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("id").isNotNull()
                        & ~held_out(F.col("id")))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}

    def some(label, most):
        return known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(most)

    # The sample's bound is the sum of the two limits, so it may be broadcast.
    sample = F.broadcast(some(1, most_toxic).unionByName(some(0, most_clean)))
    shares = {1: counts.get(1, 0) / max(1, min(most_toxic, counts.get(1, 0))),
              0: counts.get(0, 0) / max(1, min(most_clean, counts.get(0, 0)))}
    texts = pairs(docs, id_col, text_col).join(sample, "id").select("body", "label")

    def run(batches):
        remembered("toxicity", dict)
        bodies, given = [], []
        for batch in batches:
            bodies += batch.column("body").to_pylist()
            given += batch.column("label").to_pylist()
        # Rows come in any order; sorted, the same sample gives the same model.
        both = sorted(zip(bodies, given))
        bodies.clear()
        model = train([b for b, _ in both], [c for _, c in both], shares)
        del both
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    found = texts.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else {"base": 0.5}


def score(docs: DataFrame, model: dict, text_col: str = "text") -> Column:
    """A column with the score of each row's text."""
    findable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        remembered("toxicity", dict)
        for batch in batches:
            bodies = batch.tolist()
            sizes = np.cumsum(list(map(len, bodies))) // SCORED_BYTES
            out = [scores(shared.value, bodies[lo:hi]) for lo, hi in _runs(sizes)]
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))
        give_back()

    return of(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal values."""
    if not len(values):
        return []
    cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return list(zip(cuts[:-1], cuts[1:]))
