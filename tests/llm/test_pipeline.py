import pytest

import corpus_pipeline
from tallywell.llm.decontaminate import Matcher
from tallywell.session import table

SF_DIR = "/root/testdata/sf0.001"


def test_stages_in_a_row(spark, documents):
    docs, before = documents, None
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR).cache()
        assert docs.columns == documents.columns
        counts.append(docs.count())
        before = docs
    assert counts[0] < documents.count() and counts[1] < counts[0] and counts[2] <= counts[1]
    items = [r.text.encode() for r in table(spark, SF_DIR, "benchmark").collect()]
    assert not Matcher(items).matches([r.text.encode() for r in before.collect()])
    last = corpus_pipeline.shards(spark, docs, SF_DIR)
    assert last.count() == counts[-1]
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, last.collect()), key=str)


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_odd_rows(spark, odd, none, k):
    name, stage = corpus_pipeline.STAGES[k]
    own = odd.select("doc_id", "text", "lang", "source", "n_chars")
    out = stage(spark, own, SF_DIR)
    if k < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == own.columns
    out.collect()
    assert stage(spark, none.select(*own.columns), SF_DIR).count() == 0
