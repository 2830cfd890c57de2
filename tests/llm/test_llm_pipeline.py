"""The pipeline's stages, each against brute force on its own input."""

import corpus_pipeline
import pytest
from test_llm_operators import brute_components, brute_removal

from matchwright.llm.batches import table
from matchwright.sources.staging import stage_table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF_DIR, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage_table(stage(spark, docs, SF_DIR))
        out.append(docs)
    return out


def test_stages_keep_columns_and_good_documents(spark, stages):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    assert all(s.columns == docs.columns for s in stages[:-1])
    good = labels.where("quality = 1").join(docs, "doc_id")
    ids = {r.doc_id for r in stages[1].select("doc_id").collect()}
    fine = [r.doc_id for r in good.collect() if len((r.text or "").split()) >= 20]
    assert sum(i in ids for i in fine) >= 0.95 * len(fine)
    junk = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert len(junk & ids) <= 0.1 * len(junk)


def test_duplicates_and_passages(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    want = {i for i, (_, root) in brute_components(rows, 5, 80).items() if i == root}
    kept = [(r.doc_id, r.text) for r in stages[2].collect()]
    assert {i for i, _ in kept} == want
    texts, removal = dict(kept), brute_removal(kept)
    for r in stages[3].collect():
        _, removed, left = removal[r.doc_id]
        assert r.text == (left if removed else texts[r.doc_id])


def test_packing_takes_all(stages):
    packed = {r.doc_id: r.n for r in stages[4].groupBy("doc_id").agg({"length": "sum"}).toDF("doc_id", "n").collect()}
    assert set(packed) == {r.doc_id for r in stages[3].select("doc_id").collect()}
