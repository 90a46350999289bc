"""A map of the keys of a list, small enough to broadcast, that tells which rows can't be in it.

Every key sets one bit. Bits lie in chunks of ``CHUNK_BITS``, built by Spark's bitmap aggregate,
and there are as many chunks as the list needs for ``KEYS_PER_CHUNK`` keys each, up to
``MOST_CHUNKS``: 128 MB, whatever the list. About one key in sixteen that is not listed seems to
be, more when a list outgrows the ceiling (from some 67 million keys). What seems to be listed
must be joined with the list itself; the other rows need no shuffle for it.

The size of the list is read inside the plan, so nothing runs before the frame does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BITS = 1 << 15
KEYS_PER_CHUNK = CHUNK_BITS >> 4
MOST_CHUNKS = 1 << 15


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that the frame doesn't have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def _chunk(hashed: Column, chunks: Column) -> Column:
    return F.pmod(hashed, chunks)


def _slot(hashed: Column) -> Column:
    return F.pmod(F.xxhash64(hashed), F.lit(CHUNK_BITS))


def with_may_be_listed(df: DataFrame, key: Column, listed: DataFrame, name: str) -> DataFrame:
    """``df`` with a boolean ``name``: false only where ``key`` is surely not in ``listed``.

    ``listed`` has one column of the key's type. NULL is never listed.
    """
    value = F.col(f"`{listed.columns[0]}`")
    keys = listed.where(value.isNotNull()).select(F.xxhash64(value).alias("h"))
    needed = F.ceil(F.count("*") / KEYS_PER_CHUNK)
    many = free_name(df, "_chunks")
    # One row, joined rather than asked for as a value: what holds a value is not shared by the
    # uses of one frame, and would be computed for each. All numbers leave nothing when divided by
    # one, so every row meets it by an equality.
    nothing = free_name(df, "_nothing")
    chunks = F.broadcast(keys.agg(
        F.greatest(F.lit(1), F.least(F.lit(MOST_CHUNKS), needed)).cast("bigint").alias(many),
        F.pmod(F.count("*"), F.lit(1)).alias(nothing)))

    def with_chunks(rows: DataFrame, hashed: Column) -> DataFrame:
        return rows.join(chunks, F.pmod(hashed, F.lit(1)) == F.col(nothing)).drop(nothing)

    bits = with_chunks(keys, F.col("h")).groupBy(_chunk(F.col("h"), F.col(many)).alias("chunk")).agg(
        F.bitmap_construct_agg(_slot(F.col("h"))).alias("bits"))
    # Eight bytes a word, so that a row is answered by one look into an array.
    words = F.transform(F.sequence(F.lit(0), F.lit(CHUNK_BITS // 64 - 1)), lambda w: F.conv(
        F.hex(F.substring("bits", w * 8 + 1, F.lit(8))), 16, -10).cast("bigint"))
    at, where = free_name(df, "_chunk"), free_name(df, "_words")
    known = F.broadcast(bits.select(F.col("chunk").alias(at), words.alias(where)))
    hashed = F.xxhash64(key)
    slot = _slot(hashed)
    # Bytes of a word are in order, the lowest bit of a byte is its first.
    place = (7 - F.shiftright(slot, 3) % 8) * 8 + slot % 8
    bit = F.getbit(F.get(F.col(where), F.shiftright(slot, 6).cast("int")), place.cast("int"))
    near = F.coalesce(key.isNotNull() & (bit == 1), F.lit(False))
    return with_chunks(df, hashed).withColumn(at, _chunk(hashed, F.col(many))).join(
        known, at, "left").withColumn(name, near).drop(at, where, many)
