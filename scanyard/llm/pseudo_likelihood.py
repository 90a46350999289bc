"""Masked pseudo-likelihood of documents under a bidirectional window network.

The network predicts each word from the ``SIDE`` words before and after it, itself masked: the
vectors of those words, by place, feed a hidden layer, which gives the word's class and then the
word within its class. Summed log-probabilities of all words score a document.

The vocabulary is the most frequent words of all documents, as many as the network has units less
the buckets in which all other words are hashed. A word of a bucket has the bucket's probability
times the word's share of the words counted in it; ``UNSEEN`` of a count there stands for all words
never counted. The table of all counts stays in the shared folder and is joined by word, so it
grows with the input and no machine holds it. Words are counted over all documents, and the
network learns from all of them: in each round every part of the input trains a copy on its own
documents, at every ``STRIDE``-th place, the next ones each round, and the copies are averaged by
the places they have seen. ``STRIDE`` rounds learn every place once; fewer rounds take shorter
strides, so no place is ever left out. Averages are taken in groups of ``FAN`` copies, and groups of those,
so no task gathers more. The vocabulary and the weights are of fixed size.

Defined cases: null and empty texts, and texts without words, have no tokens, a sum of 0 and a null
mean; without any words the weights stay as they begin; repeated rows each get a row; columns
other than id and text are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanyard.llm.common import keep, pairs, slices
from scanyard.llm.decontaminate import WORD_BYTES, words  # noqa: F401

CLASSES, PER_CLASS = 48, 48
UNITS = CLASSES * PER_CLASS
BUCKETS = 256
KEY = np.min_scalar_type(UNITS)  # numpy sorts short integers by radix
SIDE, SIZE, HIDDEN = 2, 12, 16
ROUNDS, STRIDE, BATCH, RATE = 2, 2, 4096, 0.015
FAN = 64
SLICES = 16
UNSEEN = 0.5
SCORED = 3 << 20  # twice the bytes of units worked on at once
COMMON = 1 << 17  # words at most whose counts are broadcast; those of all others are joined


class Words(list):
    """The frequent words, the table of all words' counts and the sum of counts in each bucket.

    ``common`` has the logarithm of the count of each word that is not frequent but counted
    ``least`` times or more.
    """

    def __init__(self, frequent: list[bytes], counts: DataFrame, totals: np.ndarray, least: int,
                 common: dict[bytes, float]):
        super().__init__(frequent)
        self.counts, self.totals, self.least, self.common = counts, totals, least, common


def common_words(counts: DataFrame, frequent: list[bytes]) -> tuple[int, dict[bytes, float]]:
    """The least count that no more than ``COMMON`` words reach, and these words' logarithms."""
    steps = counts.groupBy(F.floor(F.log2("count") * 16).alias("step")).agg(
        F.count("*").alias("words"), F.min("count").alias("least")).collect()
    least, total = np.iinfo(np.int64).max, 0
    for row in sorted(steps, key=lambda r: -r["least"]):
        total += row["words"]
        if total > COMMON:
            break
        least = row["least"]
    rows = counts.where(F.col("count") >= int(least)).collect()
    logs = {bytes(r["word"]): float(np.log(r["count"])) for r in rows}
    for word in frequent:
        logs.pop(word, None)
    return int(least), logs


def hashed(words: list[bytes]) -> np.ndarray:
    """The units of words that are not frequent."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    return (UNITS - BUCKETS + hashes % BUCKETS).astype(np.uint16)


class Vocabulary(dict):
    """Unit of a word; words outside are hashed to the last units."""

    def __init__(self, frequent: list[bytes]):
        super().__init__((w, n) for n, w in enumerate(frequent))
        self.known = len(frequent)
        self.most = 200_000

    def __missing__(self, word: bytes) -> int:
        unit = int(hashed([word])[0])
        if len(self) < self.most:  # remembers so many, the others are hashed each time
            self[word] = unit
        return unit


def values(column: pa.Array) -> list[bytes]:
    """The values of a column without nulls; much faster than ``to_pylist`` for short ones."""
    if not len(column):
        return []
    column = column.cast(pa.binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset:][:len(column) + 1].tolist()
    data = data.to_pybytes() if data else b""
    return [data[a:b] for a, b in itertools.pairwise(ends)]


def split(bodies: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of texts that lie one behind another, and how many each text has.

    The words are those of ``decontaminate.words``; equal ones are found by Arrow.
    """
    texts = bodies.to_pylist()
    line = b"".join([b" ", b" ".join(texts), b" "]).translate(WORD_BYTES)
    line = np.frombuffer(line, np.uint8)
    inside = line != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begins, ends = edges[0::2], edges[1::2]
    offsets = np.zeros(len(begins) + 1, np.int32)
    np.cumsum(ends - begins, out=offsets[1:])
    found = pa.Array.from_buffers(pa.binary(), len(begins), [
        None, pa.py_buffer(offsets), pa.py_buffer(line[inside])])
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return found.dictionary_encode(), np.diff(np.searchsorted(begins, bounds))


def count_words(texts: DataFrame) -> DataFrame:
    """(word, count) over all documents."""
    def run(batches):
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            found, _ = split(batch.column("body"))
            counts = np.bincount(found.indices.to_numpy(), minlength=len(found.dictionary))
            yield pa.RecordBatch.from_arrays(
                [found.dictionary, pa.array(counts, pa.int64())], ["word", "count"])

    return texts.mapInArrow(run, "word binary, count long").groupBy("word").agg(
        F.sum("count").alias("count"))


def bucket_totals(counts: DataFrame, frequent: list[bytes]) -> np.ndarray:
    """The sum of the counts of the words in each bucket."""
    shared = counts.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        units_of, totals = Vocabulary(shared.value), np.zeros(UNITS, np.int64)
        for batch in batches:
            units = np.fromiter(map(units_of.__getitem__, values(batch.column("word"))),
                                np.int64, batch.num_rows)
            np.add.at(totals, units, batch.column("count").to_numpy())
        found = np.flatnonzero(totals[UNITS - BUCKETS:])
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int64()), pa.array(totals[UNITS - BUCKETS + found])],
            ["bucket", "count"])

    out = np.zeros(BUCKETS)
    for row in counts.mapInArrow(run, "bucket long, count long").groupBy("bucket").agg(
            F.sum("count").alias("count")).collect():
        out[row["bucket"]] = row["count"]
    return out


def start(frequent: list[int], others: int) -> dict[str, np.ndarray]:
    """Weights before training: words as frequent as counted, whatever is around them."""
    rng = np.random.default_rng(11)

    def random(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    counts = np.full(UNITS, 0.5)
    counts[:len(frequent)] += frequent
    counts[UNITS - BUCKETS:] += others / BUCKETS
    by_class = counts.reshape(CLASSES, PER_CLASS)
    return {
        # The last row is the place before a text's first and after its last word.
        "vector": random(UNITS + 1, SIZE, scale=0.3),
        "hidden": random(2 * SIDE * SIZE, HIDDEN, scale=0.2),
        "hidden_bias": np.zeros(HIDDEN, np.float32),
        "class": random(HIDDEN, CLASSES, scale=0.05),
        "class_bias": np.log(by_class.sum(1) / counts.sum()).astype(np.float32),
        "word": random(CLASSES, HIDDEN, PER_CLASS, scale=0.05),
        "word_bias": np.log(by_class / by_class.sum(1, keepdims=True)).astype(np.float32)}


def _softmax(x, at, train):
    """Logarithm of the softmax at one column of each row, and in training the softmax. Alters x."""
    x -= x.max(axis=1, keepdims=True)
    found = x[np.arange(len(x)), at]
    np.exp(x, out=x)
    total = x.sum(axis=1)
    return found - np.log(total), np.divide(x, total[:, None], out=x) if train else None


def contexts(flat: np.ndarray, sizes: np.ndarray, chosen=slice(None)) -> np.ndarray:
    """The units around the chosen places of texts that lie one behind another."""
    place = np.arange(len(flat)) + SIDE * np.repeat(np.arange(1, len(sizes) + 1), sizes)
    padded = np.full(len(flat) + SIDE * (len(sizes) + 1), UNITS, np.int32)
    padded[place] = flat
    place = place[chosen]
    out = np.empty((len(place), 2 * SIDE), np.int32)
    for column, off in enumerate(i for i in range(-SIDE, SIDE + 1) if i):
        out[:, column] = padded.take(place + off)
    return out


def context(units: np.ndarray) -> np.ndarray:
    """The units around each place of a text."""
    return contexts(units, np.array([len(units)]))


def log_probabilities(model, around: np.ndarray, units: np.ndarray, train: bool = False):
    """Log-probability of each unit given those around it; with ``train`` also gradients."""
    inputs = model["vector"].take(around, axis=0).reshape(len(around), -1)
    pre = inputs @ model["hidden"]
    pre += model["hidden_bias"]
    hidden = np.tanh(pre, out=pre)
    # In the order of the classes, so that each class's rows lie together.
    order = np.argsort(units.astype(KEY), kind="stable")
    group, word = np.divmod(units.take(order), PER_CLASS)
    bounds = np.searchsorted(group, np.arange(CLASSES + 1)).tolist()
    given, every = hidden.take(order, axis=0), np.arange(len(units))
    rows = [(c, slice(*at)) for c, at in enumerate(itertools.pairwise(bounds)) if at[0] < at[1]]
    x = given @ model["class"]
    x += model["class_bias"]
    found, d_class = _softmax(x, group, train)
    # Only products are made class by class, all else for all rows at once.
    x = np.empty((len(units), PER_CLASS), given.dtype)
    for c, mine in rows:
        logits = np.matmul(given[mine], model["word"][c], out=x[mine])
        logits += model["word_bias"][c]
    logs, d_word = _softmax(x, word, train)
    found += logs
    out = np.empty_like(found)
    out[order] = found
    g = {}
    if train:
        g = {k: np.zeros_like(v) for k, v in model.items()}
        d_class[every, group] -= 1
        g["class"], g["class_bias"] = given.T @ d_class, d_class.sum(0)
        d_hidden = d_class @ model["class"].T
        d_word[every, word] -= 1
        d_given = np.empty_like(d_hidden)
        for c, mine in rows:
            d = d_word[mine]
            np.matmul(given[mine].T, d, out=g["word"][c])
            np.add.reduce(d, axis=0, out=g["word_bias"][c])
            np.matmul(d, model["word"][c].T, out=d_given[mine])
        d_hidden += d_given
        np.multiply(given, given, out=given)
        np.subtract(1, given, out=given)
        d_hidden *= given
        d_pre = np.empty_like(d_hidden)
        d_pre[order] = d_hidden
        g["hidden"], g["hidden_bias"] = inputs.T @ d_pre, d_pre.sum(0)
        d_inputs = (d_pre @ model["hidden"].T).reshape(-1, SIZE)
        keys = around.ravel().astype(KEY)
        rank = np.argsort(keys, kind="stable")
        keys = keys.take(rank)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        g["vector"][keys.take(first)] = np.add.reduceat(d_inputs.take(rank, axis=0), first)
    return out, g


class Learner:
    """One copy of the network and its running gradient scales."""

    def __init__(self, model):
        self.model = {k: v.copy() for k, v in model.items()}
        self.m = {k: np.zeros_like(v) for k, v in model.items()}
        self.v = {k: np.zeros_like(v) for k, v in model.items()}
        self.steps = self.places = 0

    def learn(self, around, units):
        _, g = log_probabilities(self.model, around, units, train=True)
        self.steps += 1
        self.places += len(units)
        scale = RATE * np.sqrt(1 - 0.99 ** self.steps) / (1 - 0.9 ** self.steps)
        for k, d in g.items():
            m, v = self.m[k], self.v[k]
            d /= np.float32(len(units))
            square = d * d
            d -= m
            d *= np.float32(0.1)
            m += d
            square -= v
            square *= np.float32(0.01)
            v += square
            np.sqrt(v, out=square)
            square += np.float32(1e-6)
            np.multiply(np.float32(scale), m, out=d)
            d /= square
            self.model[k] -= d


def _flat(model) -> np.ndarray:
    return np.concatenate([model[k].ravel() for k in sorted(model)]).astype(np.float32)


def _shaped(flat: np.ndarray, like) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


_ENCODED = ("row long, id {id}, units binary, common double, "
            "others array<struct<word: binary, n: long>>")


def encode(texts: DataFrame, vocabulary: Words) -> DataFrame:
    """The units of each text as 16-bit numbers, and what its words have of their buckets.

    Texts are split into words here, once for all rounds of learning and for scoring. ``common``
    sums up the logarithms of the common words' counts, ``others`` has how often the text has
    which other word of a bucket.
    """
    shared = texts.sparkSession.sparkContext.broadcast((list(vocabulary), vocabulary.common))

    def run(batches):
        from pyspark import TaskContext
        frequent, common = shared.value
        listed = pa.array([*frequent, *common], pa.binary())
        listed_units = np.concatenate(
            [np.arange(len(frequent), dtype=np.uint16), hashed(list(common))])
        listed_logs = np.array([*[0.0] * len(frequent), *common.values()])
        row = TaskContext.get().partitionId() << 33
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            found, sizes = split(batch.column("body"))
            terms, at = found.dictionary, found.indices.to_numpy()
            place = pa.compute.index_in(terms, listed).fill_null(-1).to_numpy()
            known, other = np.flatnonzero(place >= 0), place < 0
            units, logs = np.empty(len(terms), np.uint16), np.zeros(len(terms))
            units[known] = listed_units.take(place.take(known))
            logs[known] = listed_logs.take(place.take(known))
            units[other] = hashed(values(terms.filter(pa.array(other))))
            text = np.repeat(np.arange(len(sizes)), sizes)
            sums = np.bincount(text, logs.take(at), len(sizes)).astype(np.float64)
            asked = np.flatnonzero(other.take(at))
            # One number for a text and a word.
            named, n = np.unique(text.take(asked) * len(terms) + at.take(asked),
                                 return_counts=True)
            text, word = np.divmod(named, max(len(terms), 1))
            pieces = pa.StructArray.from_arrays(
                [terms.take(pa.array(word)), pa.array(n, pa.int64())], ["word", "n"])
            bounds = np.searchsorted(text, np.arange(len(sizes) + 1))
            flat = units.take(at).astype("<u2").tobytes()
            ends = np.cumsum([0, *(2 * sizes)]).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(sizes))), batch.column("id"),
                 pa.array([flat[a:b] for a, b in itertools.pairwise(ends)], pa.binary()),
                 pa.array(sums), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pieces)],
                ["row", "id", "units", "common", "others"])
            row += len(sizes)

    return texts.mapInArrow(run, _ENCODED.format(id=texts.schema["id"].dataType.simpleString()))


def _units(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The units of a batch's texts one behind another, and how many each text has."""
    texts = batch.column("units").to_pylist()
    return (np.frombuffer(b"".join(texts), "<u2").astype(np.int32),
            np.array([len(t) // 2 for t in texts], np.int64))


_COPIES = "slice int, part long, places double, weights binary"


def _copies(encoded: DataFrame, model, phase: int, stride: int) -> DataFrame:
    """Each part's copy after learning at every place of one phase, in slices."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        from pyspark import TaskContext
        learner = Learner(shared.value)
        around, units = [], []

        def step():
            a, u = np.concatenate(around), np.concatenate(units)
            for at in range(0, len(u), BATCH):
                learner.learn(a[at:at + BATCH], u[at:at + BATCH])
            around.clear()
            units.clear()

        held = 0
        for batch in itertools.chain.from_iterable(
                slices(b, "units", SCORED // 2) for b in batches):
            flat, sizes = _units(batch)
            ends = np.cumsum(sizes)
            # Texts begin at other places of the stride, so short ones count alike.
            left = np.repeat(ends, sizes) - np.arange(len(flat))
            chosen = np.flatnonzero((left + phase) % stride == 0)
            every, flat = contexts(flat, sizes, chosen), flat.take(chosen)
            at = 0
            # A step takes whole texts.
            for end in np.searchsorted(chosen, ends).tolist():
                if held + end - at >= 8 * BATCH:
                    around.append(every[at:end])
                    units.append(flat[at:end])
                    step()
                    at, held = end, 0
            if at < len(flat):
                around.append(every[at:])
                units.append(flat[at:])
                held += len(flat) - at
        if units:
            step()
        if learner.places:
            rows = np.array_split(_flat(learner.model).astype(np.float64) * learner.places, SLICES)
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SLICES), pa.int32()), pa.array([part] * SLICES, pa.int64()),
                 pa.array([float(learner.places)] * SLICES),
                 pa.array([r.tobytes() for r in rows], pa.binary())],
                ["slice", "part", "places", "weights"])

    return encoded.select("units").mapInArrow(run, _COPIES)


def _add(frame):
    import pandas as pd
    total = np.sum([np.frombuffer(w, np.float64) for w in frame["weights"]], axis=0)
    return pd.DataFrame({"slice": frame["slice"].iloc[:1], "part": frame["part"].iloc[:1] // FAN,
                         "places": [frame["places"].sum()], "weights": [total.tobytes()]})


def average(copies: DataFrame, model) -> dict[str, np.ndarray]:
    """The copies' mean, weighed by the places each has seen."""
    copies = keep(copies, "copies")
    last = copies.agg(F.max("part")).first()[0]
    if last is None:
        return model
    while last > 0:
        copies = keep(copies.groupBy("slice", F.expr(f"part div {FAN}")).applyInPandas(
            _add, _COPIES), "copies")
        last //= FAN
    rows = sorted(copies.collect(), key=lambda r: r["slice"])  # one row per slice
    flat = np.concatenate([np.frombuffer(r["weights"], np.float64) / r["places"] for r in rows])
    return _shaped(flat, model)


def _learned(texts: DataFrame, rounds: int) -> tuple[dict[str, np.ndarray], Words, DataFrame]:
    """Weights, words, and the encoded texts they come from."""
    counts = keep(count_words(texts), "words")
    rows = counts.orderBy(F.desc("count"), "word").limit(UNITS - BUCKETS).collect()
    frequent = [bytes(r["word"]) for r in rows]
    vocabulary = Words(frequent, counts, bucket_totals(counts, frequent),
                       *common_words(counts, frequent))
    model = start([r["count"] for r in rows], int(vocabulary.totals.sum()))
    encoded = keep(encode(texts, vocabulary), "units")
    stride = min(STRIDE, rounds)
    for phase in range(rounds):
        model = average(_copies(encoded, model, phase % stride, stride), model)
    return model, vocabulary, encoded


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        rounds: int = ROUNDS) -> tuple[dict[str, np.ndarray], Words]:
    """Weights and words learned from all documents."""
    return _learned(pairs(docs, id_col, text_col), rounds)[:2]


def _by_unit(encoded: DataFrame, model, vocabulary: Words) -> DataFrame:
    """(row, id, n_tokens, log_likelihood) with one count for each rarer word of a bucket."""
    shared = encoded.sparkSession.sparkContext.broadcast((model, vocabulary.totals))
    kind = encoded.schema["id"].dataType.simpleString()

    def run(batches):
        given, totals = shared.value
        # What a single count is worth in a bucket; units of one word have no such share.
        single = np.concatenate([np.zeros(UNITS - BUCKETS), -np.log(totals + UNSEEN)])
        for batch in itertools.chain.from_iterable(
                slices(b, "units", SCORED // 2) for b in batches):
            flat, sizes = _units(batch)
            around = contexts(flat, sizes)
            logs = [log_probabilities(given, around[at:at + BATCH], flat[at:at + BATCH])[0]
                    + single[flat[at:at + BATCH]] for at in range(0, len(flat), BATCH)]
            sums = np.concatenate([[0.0], np.cumsum(np.concatenate(logs, dtype=np.float64))]
                                  ) if logs else np.zeros(1)
            ends, common = np.cumsum(sizes), batch.column("common").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(sizes),
                 pa.array(sums[ends] - sums[ends - sizes] + common)],
                ["row", "id", "n_tokens", "log_likelihood"])

    return encoded.select("row", "id", "units", "common").mapInArrow(
        run, f"row long, id {kind}, n_tokens long, log_likelihood double")


def _scored(encoded: DataFrame, model: dict[str, np.ndarray], vocabulary: Words) -> DataFrame:
    found = encoded.select("row", F.explode("others").alias("other")).select(
        "row", "other.word", "other.n").join(
            vocabulary.counts.where(F.col("count") < vocabulary.least), "word", "left")
    share = F.col("n") * F.log(F.coalesce(F.col("count").cast("double"), F.lit(UNSEEN)))
    shares = found.groupBy("row").agg(F.sum(share).alias("shares"))
    total = F.col("log_likelihood") + F.coalesce("shares", F.lit(0.0))
    return _by_unit(encoded, model, vocabulary).join(shares, "row", "left").select(
        "id", "n_tokens", total.alias("log_likelihood"),
        F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("per_token"))


def score(docs: DataFrame, model: dict[str, np.ndarray], vocabulary: Words,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, log_likelihood, per_token."""
    texts = pairs(docs, id_col, text_col)
    return _scored(keep(encode(texts, vocabulary), "units"), model, vocabulary)


def fit_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rounds: int = ROUNDS) -> DataFrame:
    """The documents' scores under what is learned from them; they are split and numbered once."""
    model, vocabulary, encoded = _learned(pairs(docs, id_col, text_col), rounds)
    return _scored(encoded, model, vocabulary)
