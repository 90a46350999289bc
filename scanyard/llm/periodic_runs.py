"""Runs of periodic words by online dyadic square catching.

A run is a stretch of words with smallest period q and at least ``EXPONENT`` * q and ``LEAST``
words that cannot be extended with that period. Words are appended, any number at a time. Level k
keeps a catcher for every completed block of 2^k words that starts at a multiple of 2^k: it waits for
the block to come again 2^k to 2^(k+1) - 1 words later. Every appended word completes one window of
2^k words per level, whose fingerprint is compared with that of the catcher in charge, the block
before the one in which the window starts. A catch, confirmed by the next block of the same
distance, is a square; it is extended word by word, left and right, and merges with what is known
of the same stretch. Stretches that reach the last word stay open and grow with the next ones. A run of
four periods holds two such blocks and their copies, so none is missed.

Fingerprints only propose: stretches are compared word by word, so runs are exact. Fingerprints of
a level are kept for the last few blocks. Many texts go through one stream, parted by marks that
equal nothing. Memory is in proportion to the bytes of a slice of a batch, or of one text.

Defined cases: null and empty texts have no words, no runs and an empty text; repeated rows each
get a row; of runs none is preferred; an empty table gives an empty result; columns other than
id and text are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scanyard.llm.common import findable, pairs, slices

EXPONENT, LEAST = 4, 6
# Bytes of text in a stream, and words appended at a time.
SLICE_BYTES, CHUNK = 4 << 20, 1 << 18

_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _ODD
    x ^= x >> _HALF
    x *= _MIX
    x ^= x >> _HALF
    return x


class _Level:
    """Fingerprints of the windows of 2^k words; those before ``low`` are forgotten."""

    def __init__(self, size: int):
        self.size, self.low, self.next = size, 0, 0
        self.prints = np.empty(0, np.uint64)

    def add(self, prints: np.ndarray) -> None:
        self.prints = np.concatenate([self.prints, prints])

    @property
    def end(self) -> int:
        return self.low + len(self.prints)

    def forget(self, keep_from: int) -> None:
        cut = min(max(keep_from - self.low, 0), len(self.prints))
        self.prints, self.low = self.prints[cut:].copy(), self.low + cut


class Catchers:
    """Stream of word numbers and the periodic stretches found in it so far."""

    def __init__(self, exponent: int = EXPONENT, least: int = LEAST):
        if exponent < 4:
            raise ValueError("catchers are sure of runs of four periods and more")
        self.exponent, self.least = exponent, least
        self.words = np.empty(0, np.int32)
        self.levels: list[_Level] = []
        # Period of a known run over each word, 0 for none, and where it ends.
        self.period, self.until = np.empty(0, np.int32), np.empty(0, np.int32)
        self.found: dict[tuple[int, int], int] = {}
        self.open: dict[int, int] = {}

    def append(self, words: np.ndarray, longest: int | None = None) -> None:
        """Append words. Unless ``longest`` is None, no text that goes on has more words than it."""
        old = len(self.words)
        self.words = np.concatenate([self.words, words.astype(np.int32)])
        zeros = np.zeros(len(words), np.int32)
        self.period = np.concatenate([self.period, zeros])
        self.until = np.concatenate([self.until, zeros])
        waiting, self.open = self.open, {}
        for period, start in waiting.items():
            self._merge(start, self._right(old - period, old) + period, period)
        total = len(self.words)
        while (size := 1 << len(self.levels)) <= total and (
                longest is None or size * self.exponent <= longest):
            self.levels.append(_Level(size))
        for number in range(len(self.levels)):
            self._advance(number)
        for level in self.levels:
            level.forget(level.next - 4 * level.size)

    def _advance(self, number: int) -> None:
        """Fingerprint the windows that are now complete and compare them with their catchers."""
        level, total = self.levels[number], len(self.words)
        size = level.size
        if number == 0:
            level.add(_mixed(self.words[level.end:].astype(np.uint64) + np.uint64(1)))
        elif level.end <= total - size:
            below = self.levels[number - 1]
            if level.end < below.low:
                # Begun late: texts that have ended had no use for this level.
                level.low = below.low
            start, stop = level.end - below.low, total - size + 1 - below.low
            half = size // 2
            level.add(_mixed(below.prints[start:stop] * _MIX
                             ^ (below.prints[start + half:stop + half] + _ODD)))
        # A window counts once the block after it is complete too; its catcher must be there.
        first = max(level.next, (-(-level.low // size) + 1) * size)
        last = total - 2 * size + 1
        if last <= first:
            return
        level.next = last
        at = np.arange(first, last)
        block = ((at >> number) - 1) << number
        low = level.low
        hits = np.flatnonzero(level.prints[first - low:last - low] == level.prints[block - low])
        if len(hits):
            self._catch(level, at[hits], block[hits], size)

    def _catch(self, level: _Level, at: np.ndarray, block: np.ndarray, size: int) -> None:
        prints, low = level.prints, level.low
        # The same distance has to hold for the next block, and not for the one before: each chain
        # of blocks is caught once.
        sure = prints[at + size - low] == prints[block + size - low]
        before = block - size >= low
        sure &= ~(before & (prints[np.maximum(at - size - low, 0)]
                            == prints[np.maximum(block - size - low, 0)]))
        # A multiple of the period of a run that covers both blocks is nothing new.
        for place in (block, block + size):
            known = self.period[place]
            sure &= ~((known > 0) & ((at - block) % np.maximum(known, 1) == 0)
                      & (at + 2 * size <= self.until[place]))
        for i, j in zip(block[sure].tolist(), at[sure].tolist()):
            period = j - i
            if self.period[i] and period % self.period[i] == 0 and j + size <= self.until[i]:
                continue
            self._merge(self._left(i, j), self._right(i, j) + period, period)

    def _right(self, i: int, j: int) -> int:
        """The end of the stretch from i on that equals the one from j on."""
        words, total, step = self.words, len(self.words), 16
        while j < total:
            n = min(step, total - j)
            differ = words[i:i + n] != words[j:j + n]
            if differ.any():
                return i + int(differ.argmax())
            i, j, step = i + n, j + n, step * 2
        return i

    def _left(self, i: int, j: int) -> int:
        """The start of the stretch up to i that equals the one up to j."""
        words, step = self.words, 16
        while i > 0:
            n = min(step, i)
            differ = words[i - n:i][::-1] != words[j - n:j][::-1]
            if differ.any():
                return i - int(differ.argmax())
            i, j, step = i - n, j - n, step * 2
        return i

    def _merge(self, start: int, end: int, period: int) -> None:
        """Take note of a stretch of which no word can be added with this period."""
        if end == len(self.words) and end - start >= 2 * period:
            self.open[period] = min(start, self.open.get(period, start))
        if end - start < max(self.least, self.exponent * period):
            return
        known = self.found.get((start, end))
        if known is None or period < known:
            self.found[start, end] = period
            here, until = self.period[start:end], self.until[start:end]
            stronger = (here == 0) | (period <= here)
            here[stronger], until[stronger] = period, end

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs up to now, by start and period."""
        # A stretch that has grown was noted with its former end too.
        longest: dict[tuple[int, int], int] = {}
        for (start, end), period in self.found.items():
            longest[start, period] = max(end, longest.get((start, period), 0))
        smallest: dict[tuple[int, int], int] = {}
        for (start, period), end in longest.items():
            smallest[start, end] = min(period, smallest.get((start, end), period))
        return sorted((start, end - start, period) for (start, end), period in smallest.items())


def runs_of(texts: list[list], exponent: int = EXPONENT, least: int = LEAST) \
        -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words."""
    catchers = Catchers(exponent, least)
    every = itertools.chain.from_iterable
    numbers = dict(zip(set(every(texts)), itertools.count()))
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(np.append(0, sizes + 1))
    marks = np.zeros(int(starts[-1]), bool)
    marks[starts[1:] - 1] = True
    stream = np.empty(len(marks), np.int32)
    stream[~marks] = np.fromiter(map(numbers.__getitem__, every(texts)), np.int32, sizes.sum())
    # The mark after a text is a number of its own.
    stream[marks] = np.arange(len(numbers), len(numbers) + len(texts))
    step = max(CHUNK, len(stream) // 8 + 1)
    for at in range(0, len(stream), step):
        catchers.append(stream[at:at + step], int(sizes.max()))
    out: list[list] = [[] for _ in texts]
    found = catchers.runs()
    owner = np.searchsorted(starts, [s for s, _, _ in found], "right") - 1
    for text, (start, length, period) in zip(owner.tolist(), found):
        out[text].append((start - int(starts[text]), length, period))
    return out


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that come after the first period of a run."""
    stay = np.ones(len(words), bool)
    for start, length, period in runs:
        stay[start + period:start + length] = False
    return list(itertools.compress(words, stay))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """One row per document: id, runs by start and period, and the text with each run cut to its
    first period, words joined by one space."""
    given = pairs(docs, id_col, text_col)
    kind = given.schema["id"].dataType.simpleString()
    run_type = pa.list_(pa.struct(
        [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    findable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SLICE_BYTES):
                texts = [body.split() for body in part.column("body").to_pylist()]
                runs = runs_of(texts, exponent, least)
                kept = [b" ".join(collapsed(t, r) if r else t) for t, r in zip(texts, runs)]
                listed = [[dict(zip(("start", "length", "period"), r)) for r in own]
                          for own in runs]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(listed, run_type), pa.array(kept, pa.binary())],
                    ["id", "runs", "collapsed"])

    return given.mapInArrow(run, f"id {kind}, runs array<struct<start long, length long, "
                                 "period long>>, collapsed binary")
