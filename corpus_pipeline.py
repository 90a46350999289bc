"""Documents to training sequences: toxicity, exact and near copies, benchmark texts, packing.

Each stage takes what the one before kept, written as Parquet and read again. All but the last
return the columns of their documents, which may bear any name.

Defined cases, of every stage: a null text is as an empty one; an empty table gives an empty one;
very long texts are read whole. What a stage does with ids, ties and repeated rows it says itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scanyard.llm import decontaminate, exact_dedup, ngram_join, packing, toxicity
from scanyard.llm.common import keep, rest, table
from scanyard.session import tune


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half stay.

    Empty texts have the score of the sample's share of toxic ones. Ids serve to find labels only,
    so a null id is one without; repeated rows fare alike.
    """
    rest(tune(spark))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score(docs, model) < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, A-Z lower-cased, the smallest id stays.

    A null id is the smallest; of rows that repeat both text and id one stays; empty texts are
    equal.
    """
    rest(tune(spark))
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, five words and 80 %, the row of the smallest id stays.

    A null id is the largest; of several texts under that id, or rows that repeat one, one stays;
    texts without words are no copies of anything and all stay.
    """
    rest(tune(spark))
    return ngram_join.one_per_group(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark stay.

    Texts without words stay; ids are not looked at, and repeated rows fare alike. An empty
    benchmark takes nothing out.
    """
    rest(tune(spark))
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences.

    An empty text is its end id; null ids and repeated rows are documents of their own.
    """
    rest(tune(spark))
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

# A trained network, a search for components and a tokenizer: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
