from __future__ import annotations

import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from scanyard.llm import ngram_join, toxicity
from scanyard.llm.decontaminate import Benchmark, words
from scanyard.llm.tokens import Encoder, vocabulary_path
from tests.check_catalog import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n in entry.LLM if n in entry.LLM_SQL])
def test_query_matches_sql(spark, name):
    rows, problem = compare(spark, connect(SF), SF, entry.LLM[name], entry.LLM_SQL[name])
    assert problem is None and rows > 0


@pytest.mark.parametrize("name", [n for n in entry.LLM if n not in entry.LLM_SQL])
def test_query_gives_each_document(spark, name):
    got = entry.LLM[name](spark, SF)
    key = "page_id" if "page_id" in got.columns else "doc_id"
    table = "pages" if key == "page_id" else "documents"
    ids = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()}
    found = {r[0] for r in got.select(key).collect()}
    assert found <= ids and (found == ids or name == "pipeline")


def test_stages_equal_brute_force(spark):
    """Each stage on what the one before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = toxicity.scores(model, [t.encode() for t in texts.values()])
    kept = {i: t for (i, t), s in zip(texts.items(), scores) if s < 0.5}
    stages = dict(corpus_pipeline.STAGES)

    def run(name, rows):
        out = stages[name](spark, docs.where(docs.doc_id.isin(list(rows))), SF)
        assert out.columns == docs.columns
        return {r.doc_id for r in out.collect()}

    assert run("toxicity", texts) == set(kept)
    first = {}
    for i in sorted(kept):
        first.setdefault("".join(c.lower() if "A" <= c <= "Z" else c for c in kept[i]), i)
    assert run("exact_dedup", kept) == set(first.values())
    kept = {i: kept[i] for i in first.values()}
    ids = sorted(kept)
    sets = [ngram_join.shingles(kept[i].encode(), 5) for i in ids]
    links = ngram_join.join_sets(sets, np.ones(len(sets), bool), [None] * len(sets), 80)
    forest = ngram_join._Forest(len(ids))
    for a, b in links:
        forest.join(a, b)
    heads = {ids[i] for i in range(len(ids)) if forest.root(i) == i}
    assert run("ngram_join", kept) == heads
    bench = Benchmark([(r.item_id, r.text.encode()) for r in spark.read.parquet(
        f"{SF}/benchmark.parquet").collect()])
    clean = {i for i in heads if not bench.hits(words(kept[i].encode()))[0]}
    assert run("decontamination", heads) == clean
    encode = Encoder(vocabulary_path()).tokenizer.encode
    pieces = stages["packing"](spark, docs.where(docs.doc_id.isin(list(clean))), SF).collect()
    sizes = {}
    for p in pieces:
        sizes[p.doc_id] = sizes.get(p.doc_id, 0) + p.length
    assert sizes == {i: len(encode(kept[i], add_special_tokens=False).ids) + 1 for i in clean}


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_contract():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "ngram_join", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and callable(corpus_pipeline.run)
    for _, stage in corpus_pipeline.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {
        n.split("_")[0] for n in entry.LLM}


NAMES = ("row key near near_ marked mark stays id sha text_sha256 _chunk _words node first part "
         "component body item hits score word __id __sha __gone __word __near __bits __slot").split()


def test_stages_take_columns_of_any_name(spark):
    """Every name the stages use inside, and all columns come back as they were."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = docs.unionByName(docs.limit(5))
    wide = docs.select("*", *[F.lit(f"own {name}").alias(name) for name in NAMES])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, out = stage(spark, docs, SF), stage(spark, wide, SF)
        assert out.columns == wide.columns, name
        assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in plain.collect())
        assert all(r[n] == f"own {n}" for r in out.limit(3).collect() for n in NAMES)
    pieces = corpus_pipeline.STAGES[-1][1](spark, wide, SF)
    assert pieces.count() == corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()


def test_stages_take_nulls_ties_and_repeats(spark):
    """Null ids and texts, empty texts, equal rows and equal ids with other texts."""
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(None, None), (None, text), (1, None), (2, ""), (3, text), (3, text), (3, text + " x"),
            (4, text.upper()), (5, "other " * 40_000), (6, "short")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    found = {}
    for name, stage in corpus_pipeline.STAGES[1:4]:
        found[name] = sorted(((r.doc_id or 0, len(r.text or "")) for r in
                              stage(spark, docs, SF).collect()))
    size = len(text)
    # Equal texts leave the smallest id, of which null is the smallest: 3 and 4 go with their copies.
    assert found["exact_dedup"] == [(0, 0), (0, size), (3, size + 2), (5, 240_000), (6, 5)]
    # Near copies leave the smallest id, of which null is the largest; empty sets all stay.
    assert [f for f in found["ngram_join"] if f[1] == 0] == [(0, 0), (1, 0), (2, 0)]
    assert [f[0] for f in found["ngram_join"] if f[1]] == [3, 5, 6]
    assert len(found["decontamination"]) == len(rows)
    scored = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert scored.columns == docs.columns and scored.count() <= len(rows)
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, SF)
    assert pieces.where("start = 0").count() == len(rows)
