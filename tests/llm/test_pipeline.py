"""Every stage of the pipeline against a brute-force version of its decisions."""

from __future__ import annotations

from collections import Counter

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL
from support import DOCS, odd_documents
from test_decontaminate import brute as leaks
from test_simhash_dedup import brute as near

import corpus_pipeline
from ledgerline.llm import mixing, quality
from ledgerline.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF_SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_SMALL), f"test-{name}")
        out.append(docs)
    return out


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "mixture", "sharding"]
    assert all(df.columns == COLUMNS for df in stages[:-1])


def test_quality_keeps_what_the_score_keeps(spark, stages):
    scored = quality.score(table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")).collect()
    assert ids(stages[0]) == Counter(r["doc_id"] for r in scored if r["quality_score"] >= 0.3)
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF_SMALL, "labels").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in ids(stages[0]) for i in good) >= 0.95 * len(good)


def test_one_of_each_near_duplicate_group(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[0].collect()]
    assert ids(stages[1]) == Counter({i: 1 for i, _, c in near(rows) if i == c})


def test_leaks_are_gone(spark, stages):
    docs = [(r["doc_id"], r["text"]) for r in stages[1].collect()]
    items = [tuple(r) for r in pq.read_table(f"{SF_SMALL}/benchmark.parquet").to_pylist() for r in [(r["item_id"], r["text"])]]
    bad = {i for i, *_ in leaks(docs, items)}
    assert ids(stages[2]) == Counter({i: 1 for i, _ in docs if i not in bad})


def test_mixture_repeats_what_the_plan_takes(stages):
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix(stages[2]).collect()}
    assert ids(stages[3]) == Counter({i: c for i, c in plan.items() if c})


def test_shards_hold_every_row(stages):
    rows = stages[4].collect()
    assert Counter(r["doc_id"] for r in rows) == ids(stages[3])
    load = Counter(r["shard"] for r in rows)
    counts = [load.get(s, 0) for s in range(40)]
    assert max(counts) - min(counts) <= 1


def test_run_equals_the_stages(spark, stages):
    assert ids(corpus_pipeline.run(spark, SF_SMALL)) == ids(stages[4])


def test_odd_rows_pass_every_stage(spark):
    docs = spark.createDataFrame(odd_documents(), DOCS)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        assert out.count() <= 3 * docs.count()
        assert stage(spark, docs.where("false"), SF_SMALL).count() == 0
