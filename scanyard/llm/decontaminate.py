"""Benchmark decontamination: Wu-Manber search for many test strings over words.

The test strings are the windows of the benchmark items: ten consecutive words, or the whole item
where it has fewer. The alphabet is the set of their words. A table of blocks of words tells how
far the search may shift; where it may not, the hash of a window's last words selects the strings
to compare with, and a direct comparison confirms an occurrence. Windows of another length than
ten have tables of their own.

The benchmark is a set of queries against all rows. It is split into parts of ``PART_BYTES`` of
text; each part is broadcast and every document read against it, so no broadcast outgrows that.
Spark deals the items out by hash, and the driver fetches a part when those before it are done with
and their broadcasts dropped. Finds of earlier parts travel with the document through the shared
folder, as do the rows that are still clean.

Defined cases: null or empty texts have no words and are never hit; items without words match
nothing; items of equal text all count; an item
without an id hits words but is not listed; repeated rows each get a row of their own; an empty
benchmark leaves every document clean; columns other than id and text are not read.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanyard.llm.common import findable, keep, pairs, slices

WINDOW = 10
# Benchmark text broadcast at once.
PART_BYTES = 2 << 20

# A-Z become a-z; letters, digits and bytes of other scripts stay; the rest parts words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def words(body: bytes) -> list[bytes]:
    return body.translate(WORD_BYTES).split()


class WuManber:
    """Strings of one length in words: shift table, suffix buckets, comparison."""

    def __init__(self, strings: Iterable[tuple[bytes, ...]]):
        self.strings = list(dict.fromkeys(strings))
        self.length = len(self.strings[0])
        # A block of three words shifts further than one of two, where a window holds enough.
        self.block = 3 if self.length >= 6 else min(2, self.length)
        self.most = self.length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[int, list[int]] = defaultdict(list)
        for number, string in enumerate(self.strings):
            for end in range(self.block, self.length + 1):
                block = string[end - self.block:end]
                self.shift[block] = min(self.shift.get(block, self.most), self.length - end)
            self.bucket[hash(string[-self.block:])].append(number)

    def find(self, text: list[bytes]) -> Iterator[tuple[int, int]]:
        """(position of the first word, number of the string) of every occurrence."""
        shift, most, block, length = self.shift.get, self.most, self.block, self.length
        end, last = length, len(text)
        while end <= last:
            tail = tuple(text[end - block:end])
            step = shift(tail, most)
            if step:
                end += step
                continue
            for number in self.bucket.get(hash(tail), ()):
                if self.strings[number] == tuple(text[end - length:end]):
                    yield end - length, number
            end += 1


class Benchmark:
    """Search tables for the windows of some items."""

    def __init__(self, items: Iterable[tuple[object, bytes]], window: int = WINDOW):
        owners: dict[tuple, set] = defaultdict(set)
        for item, body in items:
            seq = words(body or b"")
            size = min(window, len(seq))
            for at in range(len(seq) - size + 1 if seq else 0):
                owners[tuple(seq[at:at + size])] |= {str(item)} if item is not None else set()
        by_length: dict[int, list[tuple]] = defaultdict(list)
        for string in owners:
            by_length[len(string)].append(string)
        self.searches = [WuManber(strings) for _, strings in sorted(by_length.items())]
        self.owners = [[owners[s] for s in search.strings] for search in self.searches]

    def hits(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges inside occurrences, and the items that own them."""
        ranges, items = [], set()
        for search, owners in zip(self.searches, self.owners):
            for at, number in search.find(text):
                ranges.append((at, at + search.length))
                items |= owners[number]
        return ranges, items


def covered(ranges: Iterable[tuple[int, int]]) -> int:
    """Words inside at least one range."""
    total, reach = 0, 0
    for start, end in sorted(ranges):
        total += max(0, end - max(start, reach))
        reach = max(reach, end)
    return total


_FOUND = "n_words long, starts array<int>, ends array<int>, items array<string>"
_DIGEST = "id {id}, n_words long, n_hit long, items array<string>"


def _search(docs: DataFrame, shared: Broadcast, window: int, last: bool) -> DataFrame:
    """Add one part's finds to those a row has; after the last part, count the words hit."""
    kind = docs.schema["id"].dataType.simpleString()
    schema = _DIGEST.format(id=kind) if last else f"id {kind}, body binary, {_FOUND}"
    first = "items" not in docs.columns

    def run(batches):
        search = Benchmark(shared.value, window)
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            seqs = list(map(words, batch.column("body").to_pylist()))
            finds = list(map(search.hits, seqs))
            before = [([], set())] * len(seqs) if first else [
                (list(zip(s, e)), set(i)) for s, e, i in zip(*(
                    batch.column(c).to_pylist() for c in ("starts", "ends", "items")))]
            ranges = [found[0] + old[0] for found, old in zip(finds, before)]
            items = pa.array([sorted(found[1] | old[1]) for found, old in zip(finds, before)],
                             pa.list_(pa.string()))
            n = pa.array(map(len, seqs), pa.int64())
            if last:
                columns = [n, pa.array(map(covered, ranges), pa.int64()), items]
                names = ["id", "n_words", "n_hit", "items"]
            else:
                columns = [batch.column("body"), n, *(
                    pa.array([[r[side] for r in x] for x in ranges], pa.list_(pa.int32()))
                    for side in (0, 1)), items]
                names = ["id", "body", "n_words", "starts", "ends", "items"]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names)

    return docs.mapInArrow(run, schema)


def parts(benchmark: DataFrame, id_col: str, text_col: str,
          most: int = PART_BYTES) -> Iterator[list[tuple[object, bytes]]]:
    """The benchmark in lists of about ``most`` bytes of text, fetched as they are asked for."""
    items = pairs(benchmark, id_col, text_col).distinct()
    total = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    rows, size = [], 0
    # One partition is on the driver at a time; it holds about as much as a list.
    for row in items.repartition(total // most + 1, "id", "body").toLocalIterator():
        body = bytes(row["body"])
        if rows and size + len(body) > most:
            yield rows
            rows, size = [], 0
        rows.append((row["id"], body))
        size += len(body)
    yield rows


def _each(docs: DataFrame, lists: Iterator[list], apply: Callable, tag: str) -> DataFrame:
    """``apply`` rows, a part's broadcast and whether it is the last, for one part after another.

    What all parts but the last give is written, and their broadcasts are dropped.
    """
    context = docs.sparkSession.sparkContext
    part = next(lists)
    for following in lists:
        shared = context.broadcast(part)
        docs = keep(apply(docs, shared, False), tag)
        shared.destroy()
        part = following
    return apply(docs, context.broadcast(part), True)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW,
                  part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per document: id, n_words, n_hit, items (sorted texts of item ids)."""
    return _each(pairs(docs, id_col, text_col),
                 parts(benchmark, item_col, item_text_col, part_bytes),
                 lambda found, part, last: _search(found, part, window, last), "found")


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
          part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of ``docs`` without a word inside an occurrence, with all their columns."""
    findable(docs.sparkSession)
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return _each(docs, parts(benchmark, item_col, item_text_col, part_bytes),
                 lambda rows, part, last: rows.where(~_hit(part, window)(body)), "clean")


def _hit(shared: Broadcast, window: int):
    @F.pandas_udf("boolean")
    def hit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        search = Benchmark(shared.value, window)
        for batch in batches:
            yield batch.map(lambda body: bool(search.hits(words(body))[0])).astype(bool)

    return hit
