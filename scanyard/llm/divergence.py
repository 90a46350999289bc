"""Source divergence audit: sorted pointers to the starts of terms, per shard of the texts.

A term is a stretch of letters A-Z, a-z and characters beyond ASCII, A-Z lower-cased. A shard is a
slice of an Arrow batch: its texts lie in one buffer, and a pointer is the place where a term
starts. The pointers are sorted by a multikey quicksort that compares eight bytes at a time: sort by
one slice of the terms, then go on within equal runs, for those terms only that are longer. Equal
runs at the end are the distinct terms; their pointers, still in the order of the texts, give
occurrences and document frequency of every language and source. Spark adds up the shards.

Terms in at least ``LEAST`` documents of a language are kept. Relative frequencies of a source are
smoothed and scaled to integers (``share``), so every sum is exact. The distance of two sources is
the sum over kept terms of the difference of their shares. Terms are dealt into blocks; a block is
a matrix of shares, terms by sources, whose rows add to the sums of all pairs of sources. No pairs are
made per term. A block has at most ``BLOCK_TERMS`` terms and ``CELLS`` cells, or one term; what it
gives is a row per pair of sources, as the report itself does.

Defined cases: null text, language and source are empty; texts without terms count as documents of
their group; repeated rows are documents of their own; an empty table gives empty results; columns
other than the three are not read. A language without kept terms has distances of 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanyard.llm.common import findable, keep, slices

LEAST = 30
SCALE = 1_000_000_000
SMOOTH = 5
# Bytes of text in a shard; kept terms and cells in a matrix of shares.
SHARD_BYTES, BLOCK_TERMS, CELLS = 8 << 20, 2048, 4 << 20

# Lower-cased letters and bytes beyond ASCII as they are; 0 parts terms.
_LETTERS = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0
                     for b in range(256)], np.uint8)
# Bytes of a slice, and bytes up to which terms are compared by slices.
_SLICE, _DEEP = 8, 64


def pointers(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the terms in the letters of ``buffer``; texts begin at ``offsets``."""
    inside = buffer != 0
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    # Terms end where a text ends, even if the next one starts with a letter.
    bounds = offsets[(offsets > 0) & (offsets < len(buffer))]
    start[bounds] = inside[bounds]
    end[bounds - 1] = inside[bounds - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1 - starts


def sort_pointers(buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """(order of the pointers by their terms, number of the run of each pointer in that order).

    Pointers of equal terms stay in the order given.
    """
    padded = np.concatenate([buffer, np.zeros(_SLICE, np.uint8)])
    eights = np.lib.stride_tricks.sliding_window_view(padded, _SLICE)

    def key(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The next eight bytes as a number; those beyond the term are 0."""
        raw = np.ascontiguousarray(eights[at]).view(">u8").ravel().astype(np.uint64)
        cut = np.uint64(64) - np.minimum(left, _SLICE).astype(np.uint64) * np.uint64(8)
        return raw >> cut << cut

    first = key(starts, sizes)
    order = np.argsort(first, kind="stable")
    first = first[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = first[1:] != first[:-1]
    places = np.arange(len(order))
    group = np.cumsum(fresh) - 1
    for depth in range(_SLICE, _DEEP + 1, _SLICE):
        # Runs of several terms, some of which go on beyond what is compared so far.
        longer = np.zeros(int(group[-1]) + 1, bool)
        longer[group[sizes[order[places]] > depth]] = True
        going = longer[group] & (np.bincount(group) > 1)[group]
        places, group = places[going], group[going]
        if not len(places) or depth == _DEEP:
            break
        mine = order[places]
        following = key(starts[mine] + np.minimum(depth, sizes[mine]),
                        np.maximum(sizes[mine] - depth, 0))
        within = np.lexsort((following, group))
        order[places] = mine[within]
        following = following[within]
        changes = np.ones(len(places), bool)
        changes[1:] = (following[1:] != following[:-1]) | (group[1:] != group[:-1])
        fresh[places] |= changes
        group = np.cumsum(changes) - 1
    if len(places):
        # Very long terms that agree so far are compared whole.
        raw, mine = buffer.tobytes(), order[places]
        rest = [(g, raw[s + _DEEP:s + max(n, _DEEP)]) for g, s, n in zip(
            group.tolist(), starts[mine].tolist(), sizes[mine].tolist())]
        within = sorted(range(len(rest)), key=rest.__getitem__)
        order[places] = mine[within]
        fresh[places] |= [not i or rest[w] != rest[within[i - 1]] for i, w in enumerate(within)]
    return order, np.cumsum(fresh) - 1


def count_shard(body: pa.Array, groups: np.ndarray) -> tuple | None:
    """Terms of the texts by group number: (group, term, occurrences, documents) as arrays."""
    wide = np.int64 if pa.types.is_large_binary(body.type) else np.int32
    offsets = np.frombuffer(body.buffers()[1], wide)[body.offset:body.offset + len(body) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    if low == high:
        return None
    buffer = _LETTERS[np.frombuffer(body.buffers()[2], np.uint8)[low:high]]
    texts = offsets.astype(np.int64) - low
    starts, sizes = pointers(buffer, texts[:-1])
    if not len(starts):
        return None
    order, run = sort_pointers(buffer, starts, sizes)
    text = np.searchsorted(texts, starts[order], "right") - 1
    # One entry per run and text, then per run and group.
    new = np.ones(len(order), bool)
    new[1:] = (run[1:] != run[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(order)))
    many = int(groups.max()) + 1
    cell, place = np.unique(run[at].astype(np.int64) * many + groups[text[at]],
                            return_inverse=True)
    occurrences = np.bincount(place, weights=times).astype(np.int64)
    documents = np.bincount(place)
    heads = order[np.flatnonzero(np.diff(run, prepend=-1))]
    raw = buffer.tobytes()
    terms = [raw[s:s + n] for s, n in zip(starts[heads].tolist(), sizes[heads].tolist())]
    return cell % many, pa.array(terms, pa.binary()).take(pa.array(cell // many)), occurrences, \
        documents


_COUNTS = "lang string, source string, term binary, n long, docs long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, most=SHARD_BYTES):
            known: dict[tuple, int] = {}
            names = zip(part.column("lang").to_pylist(), part.column("source").to_pylist())
            groups = np.array([known.setdefault(name, len(known)) for name in names], np.int64)
            counted = count_shard(part.column("body"), groups)
            if counted is None:
                continue
            group, terms, n, docs = counted
            langs, sources = (pa.array(names, pa.string()).take(pa.array(group))
                              for names in zip(*known))
            yield pa.RecordBatch.from_arrays(
                [langs, sources, terms, pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
                ["lang", "source", "term", "n", "docs"])


def _plain(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term."""
    findable(docs.sparkSession)
    given = docs.select(_plain(lang_col).alias("lang"), _plain(source_col).alias("source"),
                        _plain(text_col).cast("binary").alias("body"))
    shards = given.mapInArrow(_count, _COUNTS)
    return shards.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")).withColumn(
            "term", F.col("term").cast("string"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * kept)), exactly."""
    wide = (n + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    whole = (total + SMOOTH * kept).cast("decimal(20,0)")
    return F.call_function("div", wide, whole) + 1


class Audit:
    """Tables of one audit, each in the shared folder.

    ``groups``: (lang, source, total, kept), of every group that occurs. ``kept`` is the number of
    kept terms of the language, ``total`` their occurrences in the group.
    ``kept``: (lang, term, n), kept terms. ``counts``: (lang, source, term, n), kept terms that
    occur in the group.
    """

    def __init__(self, docs: DataFrame, least: int = LEAST, text_col: str = "text",
                 lang_col: str = "lang", source_col: str = "source"):
        counts = keep(term_counts(docs, text_col, lang_col, source_col), "counts")
        self.kept = keep(counts.groupBy("lang", "term").agg(
            F.sum("n").alias("n"), F.sum("docs").alias("docs")).where(
                F.col("docs") >= least).drop("docs"), "kept")
        self.counts = keep(counts.drop("docs").join(
            self.kept.select("lang", "term").hint("merge"), ["lang", "term"], "left_semi")
            .select("lang", "source", "term", "n"), "kept-counts")
        every = docs.select(_plain(lang_col).alias("lang"),
                            _plain(source_col).alias("source")).distinct()
        totals = self.counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        self.langs = keep(self.kept.groupBy("lang").agg(
            F.sum("n").alias("lang_total"), F.count("*").alias("kept")), "langs")
        self.groups = keep(every.join(totals, ["lang", "source"], "left").join(
            self.langs.select("lang", "kept"), "lang", "left").select(
                "lang", "source", F.coalesce("total", F.lit(0)).cast("long").alias("total"),
                F.coalesce("kept", F.lit(0)).cast("long").alias("kept")), "groups")

    def terms(self, most: int | None = None) -> DataFrame:
        """(lang, source, term, value, rank): terms more frequent here than in the language.

        By value, largest first, then by term; ``most`` of each group, or all.
        """
        whole = self.kept.join(self.langs, "lang").select(
            "lang", "term", share(F.col("n"), F.col("lang_total"), F.col("kept")).alias("q"))
        own = self.counts.join(self.groups, ["lang", "source"]).select(
            "lang", "source", "term",
            share(F.col("n"), F.col("total"), F.col("kept")).alias("p"))
        over = own.join(whole.hint("merge"), ["lang", "term"]).where("p > q").select(
            "lang", "source", "term", (F.col("p") - F.col("q")).alias("value"))
        ranked = over.withColumn("rank", _rank("term"))
        return ranked if most is None else ranked.where(F.col("rank") <= most)

    def pairs(self) -> DataFrame:
        """(lang, source, other, value, rank): distances to each other source of the language."""
        sources = self.groups.groupBy("lang").agg(F.count("*").alias("sources"),
                                                  F.max("kept").alias("kept"))
        deal = F.greatest(F.lit(1), F.least(F.lit(BLOCK_TERMS), F.lit(CELLS) / F.col("sources")))
        blocks = sources.select("lang", F.greatest(F.lit(1), F.ceil(
            F.col("kept") / deal)).cast("int").alias("blocks"))
        # How many kept terms each block has, and the share of a term that does not occur.
        sizes = self.kept.join(blocks, "lang").groupBy("lang", _block("term").alias("block")).agg(
            F.count("*").alias("size"))
        base = self.groups.join(sizes, "lang", "left").select(
            "lang", "source", F.coalesce("block", F.lit(0)).alias("block"),
            F.coalesce("size", F.lit(0)).alias("size"), F.lit(None).cast("string").alias("term"),
            F.when(F.col("size") > 0, share(F.lit(0), F.col("total"), F.col("kept")))
            .otherwise(0).alias("p"))
        cells = self.counts.join(self.groups, ["lang", "source"]).join(blocks, "lang").select(
            "lang", "source", _block("term").alias("block"), F.lit(None).cast("long").alias(
                "size"), "term", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"))
        findable(self.kept.sparkSession)
        sums = base.unionByName(cells).groupBy("lang", "block").applyInPandas(
            _distances, "lang string, source string, other string, value long")
        total = sums.groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
        return total.withColumn("rank", _rank("other"))


def _block(term: str) -> Column:
    return F.pmod(F.xxhash64(term), F.col("blocks")).cast("int")


def _rank(item: str) -> Column:
    return F.row_number().over(Window.partitionBy("lang", "source").orderBy(
        F.desc("value"), F.asc(item)))


def _distances(block: pd.DataFrame) -> pd.DataFrame:
    """Sums over the terms of one block for all pairs of sources of one language."""
    base = block[block["size"].notna()].sort_values("source")
    cells = block[block["size"].isna()]
    sources = base["source"].to_numpy()
    column = {s: i for i, s in enumerate(sources)}
    absent = base["p"].to_numpy(np.int64)
    rows, terms = pd.factorize(cells["term"])
    columns = cells["source"].map(column).to_numpy(np.int64)
    shares = np.repeat(absent[None, :], len(terms), axis=0)
    shares[rows, columns] = cells["p"].to_numpy(np.int64)
    out = []
    for i, source in enumerate(sources):
        sums = np.abs(shares - shares[:, i:i + 1]).sum(axis=0)
        # Kept terms of the language that occur in none of these rows differ by the base alone.
        sums += (int(base["size"].iloc[0]) - len(terms)) * np.abs(absent - absent[i])
        others = np.arange(len(sources)) != i
        out.append(pd.DataFrame({"source": source, "other": sources[others],
                                 "value": sums[others]}))
    found = pd.concat(out) if out else pd.DataFrame({"source": [], "other": [], "value": []})
    return found.assign(lang=block["lang"].iloc[0])[["lang", "source", "other", "value"]]
