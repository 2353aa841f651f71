"""The corpus pipeline on odd rows and on the smallest tables."""

import re

import corpus_pipeline
import pytest

from tracewell.llm import secrets
from tracewell.llm.common import stage, table

SF = "/root/testdata/sf0.001"


def staged(spark, docs):
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SF), f"test-{name}")
        yield name, docs


def test_stages(spark):
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    before = set(texts)
    for name, after in staged(spark, docs):
        rows = after.collect()
        ids = {r.doc_id for r in rows}
        assert ids <= before
        if name != "packing":
            assert after.columns == docs.columns and [f.dataType for f in after.schema] == [f.dataType for f in docs.schema]
        if name == "language":
            assert {r.lang for r in rows} == {"de", "en", "es", "fr"}
        if name in ("quality", "near_copies"):
            assert len(ids) < len(before)
        if name == "near_copies":
            assert len(rows) == len(ids)
        if name == "secrets":
            assert ids == before
            for r in rows:
                for kind, pattern, group, least in secrets.SHAPES:
                    assert not any(len(m[group]) >= least for m in re.finditer(pattern, r.text))
                assert r.n_chars == len(r.text)
        if name == "packing":
            assert ids == before
        before = ids


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "12 34", None, None, None)]])
def test_nothing_comes_of_nothing(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert all(after.count() == 0 for _, after in staged(spark, docs))
