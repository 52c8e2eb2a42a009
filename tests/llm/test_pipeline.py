"""The pipeline against its parts done by hand, and every query on the small tables."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from checks.compare import duck, rows
from poiweave.llm.oracles import oracles
from poiweave.llm.queries import registered
from poiweave.llm.shared import listed
from .test_operators import brute_components, word_sets

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracles()))
def test_query_equals_oracle(spark, sf_dir, name):
    df = registered()[name](spark, sf_dir)
    found = duck(sf_dir).execute(oracles()[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, found.fetchall())


@pytest.mark.parametrize("name", sorted(set(registered()) - set(oracles())))
def test_query_runs_over_its_whole_table(spark, sf_dir, name):
    df = registered()[name](spark, sf_dir)
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    if name.startswith("op6_"):
        assert set(df.columns) >= {"doc_id", "item_id"}
    elif name.startswith("op7_"):
        assert df.count() == n + spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    else:
        assert df.count() == n


def test_stages_drop_what_they_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == len(set(names)) == 5
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], SF).cache())
    assert all(f.columns == docs.columns for f in frames[:-1])
    texts = [[(r.doc_id, r.text) for r in f.collect()] for f in frames[:-1]]
    kept = {}
    for i, t in texts[1]:
        kept[t] = max(kept.get(t, -1), i)
    assert Counter(texts[2]) == Counter((i, t) for t, i in kept.items())
    of = brute_components(word_sets(texts[2], 5))
    assert Counter(i for i, _ in texts[3]) == Counter(i for i, root in of.items() if i == root)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not [i for i, t in texts[4] if any(x in t for x in items)]
    assert len(texts[3]) - len(texts[4]) <= sum(any(x in t for x in items) for _, t in texts[3]) + 3
    final = frames[-1].collect()
    assert Counter(r.doc_id for r in final) == Counter(i for i, _ in texts[4]) and all(r.lossless for r in final)


def test_a_run_leaves_one_table_behind(spark, sf_dir):
    before = set(listed(spark))
    out = corpus_pipeline.run(spark, sf_dir)
    assert len(set(listed(spark)) - before) == 1
    assert 0 < out.count() <= spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_empty_documents(spark):
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0
