"""Exact deduplication: 128-bit content hash, then a comparison of bytes inside each group.

Texts are equal when identical after lower-casing A-Z. Rows are grouped by a 128-bit hash of that
form. The rows of each group larger than one are compared, byte by byte, with the text of the row
that stays; rows that differ (a collision) form groups of their own in another round, until none
is left. Only hashes, ids and counts are shuffled for all rows; texts move only for groups larger
than one, and their hot keys are joined with one text each, which Spark can split.

Defined cases: a null text is an empty one; empty texts equal each other; a null id counts as the
smallest; of rows that repeat both id and text exactly one is marked as kept; an empty table gives
an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanyard.llm.common import keep, lower_az, near_keys, without


def content_hash(text: Column) -> Column:
    """128 bits of the text, as binary."""
    return F.unhex(F.md5(text.cast("binary")))


def _normal(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = lower_az(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return docs.select(F.col(id_col).alias("id"), text.alias("text"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           largest: bool = False, hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    The smallest id of equal texts stays, or the largest one with ``largest``.
    """
    texts = _normal(docs, id_col, text_col).withColumn("key", hashed(F.col("text")))
    rows = keep(
        texts.select("id", "key", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
        .groupBy("id", "key", "sha").agg(F.count("*").alias("copies"))
        .withColumn("round", F.lit(0)), "rows")

    def heads(members: DataFrame) -> DataFrame:
        # Nulls are left out of max; min gives way to a null.
        first = F.max("id") if largest else F.when(
            F.count("id") == F.count("*"), F.min("id"))
        return members.groupBy("key", "round").agg(
            first.alias("keep_id"), F.sum("copies").alias("size"),
            F.count("*").alias("distinct"))

    # Rows of other bytes than the row that stays go on to the next round under the same key.
    # A row is named by id, key and sha; two texts of one id and key differ in sha.
    number = 0
    several = keep(heads(rows).where("distinct > 1").select("key", "keep_id"), "several")
    likely = near_keys(texts, F.col("key"), several.select("key"))
    members = keep(likely.join(several.hint("merge"), "key").select(
        "id", "key", "text", "keep_id"), "members")
    while True:
        # One text per group, from files, so that a group of very many rows can be split.
        head = keep(members.where(F.col("id").eqNullSafe(F.col("keep_id"))).groupBy("key").agg(
            F.min("text").alias("head")), "head")
        other = members.join(head.hint("merge"), "key").where(F.col("text") != F.col("head"))
        clash = keep(other.select("id", "key", "text"), "clash")
        if clash.isEmpty():
            break
        number += 1
        moved = clash.select("id", "key", F.sha2(F.col("text").cast("binary"), 256).alias("sha"),
                             F.lit(True).alias("moved")).distinct()
        rows = keep(rows.join(moved, ["id", "key", "sha"], "left").select(
            "id", "key", "sha", "copies",
            F.when(F.col("moved"), number).otherwise(F.col("round")).alias("round")), "rows")
        again = heads(rows.where(F.col("round") == number)).select("key", "keep_id")
        members = clash.join(again, "key")

    # Both sides come from files, so a key with very many rows can be split.
    found = rows.join(keep(heads(rows), "heads").hint("merge"), ["key", "round"])
    nth = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return found.withColumn("nth", nth).select(
        "id", "keep_id", F.col("size").alias("group_size"),
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                largest: bool = False) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of rows that repeat both the id and the text that stay, one row is kept.
    """
    marks = groups(docs, id_col, text_col, largest)
    found = keep(marks.groupBy("id", F.col("text_sha256").alias("key")).agg(
        F.max("kept").alias("stays"), F.count("*").alias("n")).where("not stays or n > 1").drop(
        "n"), "found")
    text = lower_az(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return without(docs, id_col, F.sha2(text.cast("binary"), 256), found)
