"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct word n-grams, as 64-bit hashes. Two documents link when
their Jaccard similarity reaches a threshold. All n-grams have one global order, rarest first. If
two sets share at least T members, their prefixes of size - T + l members share at least l, for
every l. A document's l is chosen by what its prefix is estimated to cost: the rows of its
n-grams, and the candidates left when l of them must be shared. Pairs that share as many prefix
members as the smaller l of both are verified on whole sets.

How it runs:

1. One pass hashes every text and keeps, per row, the set's size and a 128-bit digest. Rows of
   equal sets become one numbered node, so copies are never paired, and two texts under one id
   are two nodes.
2. The order comes from counts of all n-grams that repeat within a part of the input, summed by
   ``2^CELL_BITS`` cells of the hash, a table of fixed size. An n-gram's cell only decides where it
   stands in the order, so clashes of cells cost time, never a link.
3. A second pass cuts the prefixes. N-grams found in one node only go away in a grouping by n-gram.
4. N-grams of few nodes (``FEW``) give pairs, which are counted, and verified when they share
   enough. N-grams of more nodes are dealt out in blocks of about ``BLOCK`` nodes, or ``MEMBERS``
   members where sets are large, with their whole sets. A task joins a block with itself and with some pivots all blocks share, and gives no more
   links than it has nodes. Where there are several blocks, the nodes outside the n-gram's largest
   component are then joined with all blocks; pairs inside that component need no link.
5. Links become components, named by the smallest id of their rows.

Defined cases: null and empty texts, and texts without words, are empty sets and link with
nothing; rows that repeat an id are documents of their own, whose texts each have their links, and
rows of one set share a component; a null id is the largest, and a set known by null ids only links
with nothing and has a null component; an empty table gives an empty result; columns other than id
and text are not read, and may bear any name.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanyard.llm.common import (body_of, give_back, keep, near_keys, pairs, remembered, slices,
                                 without)

SHINGLE, THRESHOLD = 5, 80
CELL_BITS = 20
FEW, BLOCK, MEMBERS, PIVOTS = 24, 768, 1 << 20, 16
# The l to choose from; what verifying a pair costs in posting rows for each 64 members; and how
# many others are expected to share, by chance, an n-gram that no part of the input repeats.
LENGTHS = (1, 2, 3, 4, 6, 8)
VERIFY = 8.0
CHANCE = 0.05
MOST_WORDS = 200_000
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
            0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)


class _Hashes(dict):
    def __missing__(self, word):
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingles(body: bytes, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of words; fewer words are one n-gram."""
    # Bytes are lower-cased for A-Z and split at the six white-space characters, no others.
    words = body.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = remembered("n-grams", _Hashes)
    if len(known) > MOST_WORDS:
        known.clear()
    hashed = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(n, len(words))
    count = len(words) - size + 1
    with np.errstate(over="ignore"):
        total = np.full(count, size, np.uint64)
        for i in range(size):
            total = (total ^ hashed[i:i + count]) * np.uint64(_FACTORS[i % len(_FACTORS)])
            total ^= total >> np.uint64(31)
    return np.unique(total)


def least_shared(size, threshold: int = THRESHOLD):
    """Members a set of this size shares with any set it links with, at least."""
    return -(-size * threshold // 100)


def linked(shared, a, b, threshold: int = THRESHOLD):
    return 100 * shared >= threshold * (a + b - shared)


def prefix(members: np.ndarray, counts: np.ndarray, threshold: int = THRESHOLD):
    """The members of a document's prefix and its l."""
    cells = counts[members >> np.uint64(64 - CELL_BITS)]
    order = np.lexsort((members, cells))
    size, least = len(members), least_shared(len(members), threshold)
    rows = np.cumsum(np.maximum(cells[order].astype(np.float64), CHANCE))
    best, best_cost = 1, np.inf
    for length in LENGTHS:
        if length > least:
            break
        # Nodes met on the way, and those that can be met often enough.
        met = rows[size - least + length - 1]
        cost = met + VERIFY * size / 64 * met / length
        if cost < best_cost:
            best, best_cost = length, cost
    return members[order[:size - least + best]], best


_STATS = "id {id}, key long, n long, lo long, hi long, cell int, copies long"


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    """128 bits of each set, as two numbers."""
    joined = b"".join(xxhash.xxh128_digest(s.tobytes()) for s in sets)
    return np.frombuffer(joined, np.int64).reshape(-1, 2)


def statistics(texts: DataFrame, n: int) -> DataFrame:
    """Rows of two kinds: size and digest of each text; counts of cells of repeated n-grams.

    ``key`` is handed on from ``texts``.
    """
    schema = _STATS.format(id=texts.schema["id"].dataType.simpleString())
    names = ["id", "key", "n", "lo", "hi", "cell", "copies"]

    def run(batches):
        seen: list[np.ndarray] = []
        held = 0
        kind = None

        def repeated():
            every = np.concatenate(seen)
            seen.clear()
            every.sort()
            same = np.flatnonzero(np.diff(every, prepend=~every[:1], append=~every[-1:]) != 0)
            runs = np.diff(same)
            many = runs > 1
            cells = (every[same[:-1][many]] >> np.uint64(64 - CELL_BITS)).astype(np.int64)
            # The largest run of a cell stands for it.
            order = np.argsort(cells, kind="stable")
            cells, runs = cells[order], runs[many][order]
            first = np.flatnonzero(np.diff(cells, prepend=-1))
            if not len(first):
                return
            top = np.maximum.reduceat(runs, first)
            rows = len(first)
            none = pa.nulls(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(rows, kind), none, none, none, none,
                 pa.array(cells[first], pa.int32()), pa.array(top, pa.int64())], names)

        for batch in itertools.chain.from_iterable(map(slices, batches)):
            kind = batch.column("id").type
            sets = [shingles(body, n) for body in batch.column("body").to_pylist()]
            halves = _digests(sets)
            rows = len(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key"), pa.array(map(len, sets), pa.int64()),
                 pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.nulls(rows, pa.int32()),
                 pa.nulls(rows, pa.int64())], names)
            seen += sets
            held += sum(map(len, sets))
            if held > 4_000_000:
                yield from repeated()
                held = 0
        if held:
            yield from repeated()

    return texts.mapInArrow(run, schema)


def cell_counts(stats: DataFrame) -> np.ndarray:
    """Counts by cell, as logarithms, so that near counts leave the order to the hash."""
    rows = stats.where("cell is not null").groupBy("cell").agg(F.sum("copies").alias("copies"))
    table = rows.toArrow()
    counts = np.zeros(1 << CELL_BITS, np.uint16)
    scaled = np.clip(table["copies"].to_numpy(), 1, 60_000)
    counts[table["cell"].to_numpy()] = 2 ** np.floor(np.log2(scaled))
    return counts


_SETS = "id {id}, lo long, hi long, n long, members array<long>"
_PREFIXES = "id {id}, lo long, hi long, n long, l int, prefix array<long>"


def _lists(sets: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, sets)])
    flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def prefixes(texts: DataFrame, counts: np.ndarray, n: int, threshold: int) -> DataFrame:
    schema = _PREFIXES.format(id=texts.schema["id"].dataType.simpleString())
    shared = texts.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            sets = [shingles(body, n) for body in batch.column("body").to_pylist()]
            cut = [prefix(s, shared.value, threshold) if len(s) else (s, 0) for s in sets]
            halves = _digests(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                 pa.array(map(len, sets), pa.int64()), pa.array([c[1] for c in cut], pa.int32()),
                 _lists([c[0] for c in cut])], ["id", "lo", "hi", "n", "l", "prefix"])

    return texts.mapInArrow(run, schema)


def whole_sets(texts: DataFrame, n: int) -> DataFrame:
    schema = _SETS.format(id=texts.schema["id"].dataType.simpleString())

    def run(batches):
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            sets = [shingles(body, n) for body in batch.column("body").to_pylist()]
            halves = _digests(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                 pa.array(map(len, sets), pa.int64()), _lists(sets)],
                ["id", "lo", "hi", "n", "members"])

    return texts.mapInArrow(run, schema)


class _Forest:
    def __init__(self, count: int):
        self.up = list(range(count))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def join_sets(sets: list[np.ndarray], asking: np.ndarray, groups: list, threshold: int,
              step: int = 1 << 21) -> list[tuple[int, int]]:
    """Links from the sets marked in ``asking`` to any other, as far as they join components.

    Sets of equal ``groups`` count as joined from the start. Shared members are counted through
    lists of the sets that have each member.
    """
    sizes = np.array(list(map(len, sets)), np.int64)
    flat = np.concatenate(sets)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(flat[order]) != 0]))
    times = np.diff(np.append(first, len(flat)))
    place = np.empty(len(flat), np.int64)
    place[order] = np.repeat(np.arange(len(first)), times)
    owners = owner[order]
    forest, links, seen = _Forest(len(sets)), [], {}
    for at, group in enumerate(groups):
        if group is not None:
            forest.join(seen.setdefault(group, at), at)
    for at in np.flatnonzero(asking):
        mine = place[ends[at] - sizes[at]:ends[at]]
        mine = mine[times[mine] > 1]
        shared = np.zeros(len(sets), np.int64)
        total = np.cumsum(times[mine])
        for part in np.split(mine, np.flatnonzero(np.diff(total // step)) + 1):
            n = times[part]
            stops = np.cumsum(n)
            count = int(stops[-1]) if len(n) else 0
            rows = np.arange(count) + np.repeat(first[part] - stops + n, n)
            shared += np.bincount(owners[rows], minlength=len(sets))
        found = linked(shared, sizes[at], sizes, threshold)
        found[at] = False
        for other in np.flatnonzero(found):
            if forest.join(int(at), int(other)):
                links.append((int(at), int(other)))
    return links


def _joined(rows: DataFrame, keys: list[str], threshold: int) -> DataFrame:
    """Links found in each group of rows (id, group, asking, members)."""
    import pandas as pd
    kind = rows.schema["id"].dataType.simpleString()

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("asking").drop_duplicates("id", keep="last")
        ids = frame["id"].tolist()
        groups = [None if g is None or g != g else g for g in frame["group"].tolist()]
        sets = [np.asarray(s).view(np.uint64) for s in frame["members"]]
        found = join_sets(sets, frame["asking"].to_numpy(bool), groups, threshold)
        del sets
        give_back()
        return pd.DataFrame({"a": pd.Series([ids[i] for i, _ in found], dtype=frame["id"].dtype),
                             "b": pd.Series([ids[j] for _, j in found], dtype=frame["id"].dtype)})

    return rows.groupBy(*keys).applyInPandas(run, f"a {kind}, b {kind}")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; the component is its smallest node.

    Alternating stars: each node's larger neighbours move to its smallest one, then its smaller
    neighbours do, until nothing moves.
    """
    edges = keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .where("u <> v").distinct(), "edges")
    before = None
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
                    .first())
        if now == before:
            named = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return named.unionByName(
                named.select(F.col("component").alias("node"), "component").distinct())
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = keep(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = both.join(least.hint("merge"), "u").where("v > u and v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = keep(large, "large")
        low = keep(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        moved = large.join(low.hint("merge"), "u")
        edges = keep(moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE,
          threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with their node (id, key, n, node, first), the nodes (node, first), and links
    between nodes (a, b).

    A row is named by its id and ``row_key``; ``first`` is the smallest id of a node's rows. The
    links join all nodes of a component; within it, not every link is listed.
    """
    texts = pairs(docs, id_col, text_col)
    stats = keep(statistics(texts.withColumn("key", F.xxhash64("body")), n), "stats")
    counts = cell_counts(stats)
    rows = stats.where("n is not null")
    # Numbers stay as they are written.
    nodes = keep(rows.where("n > 0").groupBy("lo", "hi", "n").agg(F.min("id").alias("first"))
                 .withColumn("node", F.monotonically_increasing_id()), "nodes")
    named = rows.join(nodes.hint("merge"), ["lo", "hi", "n"], "left").select(
        "id", "key", "n", "node", "first")

    # Each node's set is read from the text of one of its rows.
    heads = nodes.where("first is not null").select(
        F.col("first").alias("id"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "node")
    same = (F.col("lo") == F.col("_lo")) & (F.col("hi") == F.col("_hi"))
    cut = keep(prefixes(texts, counts, n, threshold).where("n > 0").join(
        heads.hint("merge"), "id").where(same).dropDuplicates(["node"]).select(
        F.col("node").alias("id"), "n", "l", "prefix"), "prefixes")
    grams = cut.select("id", "n", "l", F.explode("prefix").alias("gram"))
    shared = keep(grams.groupBy("gram").agg(
        F.count("*").alias("df"), F.sum("n").alias("weight")).where("df > 1"), "shared")
    posted = keep(near_keys(grams, F.col("gram"), shared.select("gram")).join(
        shared.hint("merge"), "gram"), "posted")

    few = posted.where(F.col("df") <= FEW)
    left = few.select("gram", F.col("id").alias("a"), F.col("n").alias("n_a"),
                      F.col("l").alias("l_a"))
    right = few.select("gram", F.col("id").alias("b"), F.col("n").alias("n_b"),
                       F.col("l").alias("l_b"))
    close = 100 * F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b")
    pairs_of_few = left.join(right.hint("merge"), "gram").where((F.col("a") < F.col("b")) & close)
    candidates = keep(pairs_of_few.groupBy("a", "b").agg(
        F.count("*").alias("common"), F.min(F.least("l_a", "l_b")).alias("l"))
        .where("common >= l").select("a", "b"), "candidates")

    many = posted.where(F.col("df") > FEW).select("gram", "df", "weight", "id", "n")
    wanted = candidates.select(F.col("a").alias("id")).unionByName(
        candidates.select(F.col("b").alias("id"))).unionByName(many.select("id")).distinct()
    wanted = keep(wanted.withColumnRenamed("id", "node").join(heads.hint("merge"), "node"),
                  "wanted")
    sets = keep(whole_sets(near_keys(texts, F.col("id"), wanted.select("id")), n)
                .join(wanted.hint("merge"), "id").where(same).dropDuplicates(["node"])
                .select(F.col("node").alias("id"), "members"), "sets")

    first = candidates.join(sets.select(F.col("id").alias("a"), F.col("members").alias("m_a"))
                            .hint("merge"), "a")
    second = first.join(sets.select(F.col("id").alias("b"), F.col("members").alias("m_b"))
                        .hint("merge"), "b")
    common = F.size(F.array_intersect("m_a", "m_b"))
    verified = second.where(linked(common, F.size("m_a"), F.size("m_b"), threshold))
    found = keep(verified.select("a", "b"), "found")

    # Blocks of frequent n-grams. A node's block is the same for n-grams of as many blocks.
    blocked = many.withColumn("blocks", _pieces(F.col("df"), F.col("weight"))).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    pivots = _pivots(blocked)
    own = blocked.select("gram", "block", "id", F.lit(True).alias("asking"))
    spread = pivots.select("gram", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias(
        "block"), "id", F.lit(False).alias("asking"))
    none = F.lit(None).cast("long")
    inside = own.unionByName(spread).join(sets.hint("merge"), "id").withColumn("group", none)
    found = keep(found.unionByName(_joined(inside, ["gram", "block"], threshold)), "found")

    # Nodes outside an n-gram's largest component so far, against all its blocks.
    wide = keep(blocked.where("blocks > 1"), "wide")
    if not wide.isEmpty():
        known = keep(components(found), "known").withColumnRenamed("node", "id")
        placed = keep(wide.join(known.hint("merge"), "id", "left").withColumn(
            "group", F.coalesce("component", "id")).drop("component"), "placed")
        sums = placed.groupBy("gram", "group").agg(
            F.count("*").alias("size"), F.sum("n").alias("weight"))
        order = F.struct("size", "group")
        largest = sums.groupBy("gram").agg(
            F.max_by("group", order).alias("top"),
            (F.sum("size") - F.max("size")).alias("outside"),
            (F.sum("weight") - F.max_by("weight", order)).alias("outside_weight"))
        placed = placed.drop("weight").join(
            keep(largest.where("outside > 0"), "largest").hint("merge"), "gram")
        slots = _pieces(F.col("outside"), F.col("outside_weight"))
        asking = placed.where("group <> top").select(
            "gram", "id", "group", F.lit(True).alias("asking"),
            F.pmod(F.xxhash64("id"), slots).cast("int").alias("slot"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        asked = placed.select(
            "gram", "id", "group", F.lit(False).alias("asking"),
            F.explode(F.sequence(F.lit(0), slots - 1)).alias("slot"), "block")
        across = asking.unionByName(asked).join(sets.hint("merge"), "id")
        found = keep(found.unionByName(
            _joined(across, ["gram", "slot", "block"], threshold)), "found")
    return named, nodes.select("node", "first"), found


def _pieces(nodes, members):
    """Blocks for so many nodes whose sets have so many members in all."""
    return F.greatest(F.ceil(nodes / BLOCK), F.ceil(members / MEMBERS)).cast("int")


def _pivots(blocked: DataFrame) -> DataFrame:
    """The nodes of the smallest hashes of each n-gram of several blocks."""
    order = F.xxhash64(F.col("id"), F.lit(1))
    # First in each block, then among those few, so no n-gram's nodes meet in one task.
    in_block = Window.partitionBy("gram", "block").orderBy(order, "id")
    over_all = Window.partitionBy("gram").orderBy(order, "id")
    firsts = blocked.where("blocks > 1").withColumn("nth", F.row_number().over(in_block)).where(
        F.col("nth") <= 2)
    return firsts.withColumn("nth", F.row_number().over(over_all)).where(
        F.col("nth") <= PIVOTS).select("gram", "blocks", "id")


def row_key(text_col: str):
    """64 bits of a text, which tell apart texts under one id."""
    return F.xxhash64(body_of(text_col))


def _grouped(docs: DataFrame, id_col: str, text_col: str, n: int,
             threshold: int) -> DataFrame:
    """(id, key, n, node, part, component_id): the rows with their component, by its smallest
    node and by its smallest id."""
    named, nodes, found = links(docs, id_col, text_col, n, threshold)
    parts = keep(components(found), "parts")
    leaders = parts.join(nodes.hint("merge"), "node").groupBy("component").agg(
        F.min("first").alias("leader"))
    parts = parts.join(leaders.hint("merge"), "component")
    joined = named.join(parts.hint("merge"), "node", "left")
    alone = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("first"))
    return joined.select("id", "key", "n", "node", F.coalesce("component", "node").alias("part"),
                         F.coalesce("leader", alone).alias("component_id"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                n: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id reachable)."""
    return _grouped(docs, id_col, text_col, n, threshold).select(
        "id", F.col("n").alias("n_shingles"), "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  n: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """One row of each component, with all columns: one that bears its smallest id.

    Rows with empty sets all stay. Of several texts under that id, or rows that repeat one, one
    stays.
    """
    rows = keep(_grouped(docs, id_col, text_col, n, threshold).where("n > 0"), "grouped")
    leads = F.col("id").eqNullSafe(F.col("component_id"))
    several = rows.where(leads).groupBy("part").agg(
        F.min("key").alias("top"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    among = rows.where(leads).join(several.hint("merge"), "part").select(
        "id", "key", (F.col("key") == F.col("top")).alias("stays"))
    marks = rows.where(~leads).select("id", "key", F.lit(False).alias("stays")).unionByName(among)
    marks = keep(marks.groupBy("id", "key").agg(F.max("stays").alias("stays")), "marks")
    return without(docs, id_col, row_key(text_col), marks)
