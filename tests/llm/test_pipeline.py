import sys

import pytest

import corpus_pipeline
from supportlens.llm import personal_data, quality_rules
from supportlens.llm.common import read

from . import cases
from .test_decontamination_licenses import brute as brute_hits
from .test_near_dedup import brute as brute_groups

SMALL = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = read(spark, SMALL, "documents")
    items = [(r.item_id, r.text) for r in read(spark, SMALL, "benchmark").collect()]
    rules = quality_rules.score_texts(docs)
    left = {r.doc_id: r for r in docs.join(rules.where("kept").select("doc_id"), "doc_id").collect()}
    groups = brute_groups([(i, r.text) for i, r in left.items()], 5)
    left = {i: r for i, r in left.items() if groups[i][2]}
    left = {i: r for i, r in left.items() if not brute_hits(r.text, items, 10)[1]}
    got = cases.by_id(corpus_pipeline.run(spark, SMALL))
    assert set(got) == set(left)
    for i, r in got.items():
        assert not personal_data.base_spans(r.text)
        if not personal_data.base_spans(left[i].text) and not personal_data.candidates(left[i].text):
            assert r.text == left[i].text
        assert (r.lang, r.source, r.n_chars) == (left[i].lang, left[i].source, len(r.text))


@pytest.mark.parametrize("empty", [False, True])
def test_cases_pass_every_stage(spark, empty):
    docs = cases.documents(spark)
    docs = docs.limit(0) if empty else docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        assert out.count() <= docs.count()
        if name != "source_mix":
            assert out.columns == docs.columns


def test_registered(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline"} <= names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert "pyspark" in sys.modules
