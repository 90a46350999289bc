"""Line dedup: hashes in ranges, sorted by document and position; keep bitmaps come back, not text.

Each line's key (white space stripped, A-Z lower-cased) of at least ``LEAST`` code points becomes a
row of its 128-bit hash, document and position. The rows are partitioned by ranges of the hash and
sorted there by document and position, so the first occurrence of a hash is streamed first and
names the document that keeps the line; the others lose theirs. What returns to the documents
are bitmaps, 64 lines a word, and only words in which a line is lost: all others are ones. Texts
that lose lines move once, to meet their bitmap; most others stay where they are.

A hash too frequent for one range is cut into pieces by document, as a sample of bounded size
says; what is first where a piece begins comes from one row per such hash. The sample only bears
on balance. Two keys of one 128-bit hash would count as one; for 10^12 lines the odds are 10^-15.

Everything is a DataFrame expression.

Defined cases: a null or empty text is one empty line; lines shorter than ``LEAST`` always stay; a
null id counts as the smallest; rows under one id are one document, so none of them loses a line
to another, and each has a bitmap for its own text; rows that repeat id and text fare alike; an
empty table gives empty results; other columns are passed through by ``apply`` under any name
but those it adds, and not read otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanyard.llm.common import keep, lower_az
from scanyard.operators.keymap import with_may_be_listed

LEAST = 10
# Rows of the sample per range, and the rows of one hash in it that make a piece.
SAMPLE, PIECE = 64, 16
_SPACE = " \t\n\x0b\f\r"
_WORD = 64


def _text(docs: DataFrame, text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def text_hash(text: Column) -> Column:
    """128 bits that tell apart texts under one id."""
    return F.unhex(F.md5(text.cast("binary")))


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _rows(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """(hash, id, sig, pos) of every line long enough."""
    text = _text(docs, text_col)
    given = docs.select(F.col(id_col).alias("id"), text_hash(text).alias("sig"),
                        F.posexplode(lines(lower_az(text))).alias("pos", "line"))
    key = F.btrim("line", F.lit(_SPACE))
    return given.select("id", "sig", "pos", key.alias("key")).where(
        F.length("key") >= least).select(text_hash(F.col("key")).alias("hash"), "id", "sig", "pos")


def _frequent(rows: DataFrame) -> DataFrame:
    """(hash, cuts, low, blank): hashes too frequent for one range.

    ``cuts`` are ids that part them into pieces; the smallest id is ``low``, or null if ``blank``.
    At most ``SAMPLE`` / ``PIECE`` cuts per range are made, whatever the number of rows.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stride = max(1, rows.count() // (SAMPLE * ranges))
    sampled = rows.where(F.pmod(F.xxhash64("hash", "id", "sig", "pos"), F.lit(stride)) == 0)
    ids = F.sort_array(F.collect_list("id"))
    cuts = sampled.groupBy("hash").agg(F.count("*").alias("n"), ids.alias("ids")).where(
        F.col("n") >= 2 * PIECE).select("hash", F.filter(
            "ids", lambda _, i: i % PIECE == PIECE - 1).alias("cuts"))
    cuts = keep(cuts, "cuts")
    first = rows.join(F.broadcast(cuts.select("hash")), "hash", "left_semi").groupBy("hash").agg(
        F.min("id").alias("low"), F.bool_or(F.col("id").isNull()).alias("blank"))
    return keep(cuts.join(first, "hash"), "frequent")


def bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            least: int = LEAST) -> DataFrame:
    """(id, sig, n_dropped, bitmap) of each document text that loses lines.

    ``bitmap`` holds (word, bits) for the words with a line lost, by word: line ``64 * word + b``
    stays if bit ``b`` is one. Words that are not listed are all ones.
    """
    rows = keep(_rows(docs, id_col, text_col, least), "lines")
    pieces = rows.join(F.broadcast(_frequent(rows)), "hash", "left").withColumn(
        "piece", F.when(F.col("cuts").isNull(), 0).otherwise(
            F.size(F.filter("cuts", lambda c: c <= F.col("id")))))
    sweep = Window.partitionBy("hash", "piece").orderBy(F.asc_nulls_first("id"), "sig", "pos")
    opening = F.when(~F.col("blank"), F.col("low"))
    first = F.when(F.col("piece") == 0, F.first("id").over(sweep)).otherwise(opening)
    swept = pieces.repartitionByRange("hash", "piece").withColumn("first", first)
    lost = swept.where(~F.col("id").eqNullSafe(F.col("first")))
    bit = F.expr(f"shiftleft(1L, pos % {_WORD})")
    words = lost.groupBy("id", "sig", F.expr(f"pos div {_WORD}").cast("int").alias("word")).agg(
        F.bit_or(bit).alias("bits"))
    return keep(words.groupBy("id", "sig").agg(
        F.sum(F.bit_count("bits")).alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits"))))
        .alias("bitmap")), "bitmaps")


def lost_lines(bitmap: Column) -> Column:
    """Positions whose bit is zero."""
    bits = F.sequence(F.lit(0), F.lit(_WORD - 1))
    return F.flatten(F.transform(bitmap, lambda w: F.transform(
        F.filter(bits, lambda b: F.getbit(w["bits"], b) == 0), lambda b: w["word"] * _WORD + b)))


def apply(docs: DataFrame, maps: DataFrame, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with n_lines, n_dropped and kept_text besides."""
    added = ["n_lines", "n_dropped", "kept_text"]
    if clash := set(added) & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} are there already")
    whole = docs.select(F.struct("*").alias("row"))
    text = F.coalesce(whole["row"][text_col].cast("string"), F.lit(""))
    whole = whole.select("row", text.alias("text"), text_hash(text).alias("key"))
    marked = with_may_be_listed(whole, F.col("key"), maps.select("sig"), "near")
    # The columns of each step are used more than once by the next, so Spark works them out once.
    found = marked.where("near").join(maps.hint("merge"), F.col("row")[id_col].eqNullSafe(
        maps["id"]) & (F.col("key") == maps["sig"]), "left").select(
        "row", "text", "n_dropped", lines(F.col("text")).alias("every"),
        lost_lines(F.col("bitmap")).alias("lost"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("every") - 1), F.col("lost"))
    kept = F.array_join(F.transform(stay, lambda i: F.get("every", i)), "\n")
    near = found.select(
        "row", F.size("every").cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("lost").isNull(), F.col("text")).otherwise(kept).alias("kept_text"))
    # Texts that surely lose nothing stay where they are.
    far = marked.where("not near").select(
        "row", F.size(lines(F.col("text"))).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_dropped"), F.col("text").alias("kept_text"))
    return near.unionByName(far).select("row.*", *added)
