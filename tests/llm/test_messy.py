"""Every operator and stage on awkward and on empty tables: defined results, no crash."""

from __future__ import annotations

import public_tokenizers as P
import pytest

import corpus_pipeline
from reelyard.llm import (
    bpe,
    decontaminate,
    fuzzydedup,
    licensescan,
    linededup,
    neardup,
    pii,
    pitmanyor,
    quality,
    suffixdedup,
    toxicity,
)
from tests.llm import cases

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
SOME = [(1, 1, 0), (10, 0, 1), (14, 1, 0), (11, None, None), (None, 1, 1), (10, 0, 1), (99, 1, 1)]


def items(spark, docs):
    return spark.createDataFrame([(1, None), (2, ""), (4, cases.prose(2, 60)), (4, cases.prose(2, 60)), (None, "zzz")], "item_id long, text string")


REPORTS = {
    "op1": lambda s, d: toxicity.score(d, toxicity.fit(d, cases.labels(s, SOME))),
    "op1_unlabelled": lambda s, d: toxicity.score(d, toxicity.fit(d, cases.labels(s))),
    "op2": lambda s, d: fuzzydedup.report(d),
    "op3": lambda s, d: bpe.digests(d, RANKS, P.PATTERN),
    "op4": lambda s, d: pitmanyor.score(d),
    "op5": lambda s, d: suffixdedup.report(d),
    "op6": lambda s, d: linededup.report(d),
    "op7": lambda s, d: quality.report(d, quality.fit(d, cases.labels(s, SOME))),
    "op7_unlabelled": lambda s, d: quality.report(d, quality.fit(d, cases.labels(s))),
    "op8": lambda s, d: pii.replace(d, b"k", counted=True),
    "op9": lambda s, d: decontaminate.report(d, items(s, d)),
    "op9_no_items": lambda s, d: decontaminate.report(d, items(s, d).limit(0)),
    "op10": lambda s, d: neardup.near_duplicates(d),
    "op11": lambda s, d: licensescan.report(d),
}


@pytest.mark.parametrize("name", REPORTS)
def test_one_row_for_each_document(spark, name):
    rows = REPORTS[name](spark, cases.messy(spark)).collect()
    order = lambda ids: sorted(ids, key=lambda i: (i is None, i))
    assert order(r.doc_id for r in rows) == order(r[0] for r in cases.messy_rows())
    by_id = {}
    for r in rows:  # a repeated row gets the same answer again
        if r.doc_id == 2:
            said = {c: v for c, v in r.asDict().items() if c not in ("lang", "mark", "toxic", "item_id")}  # some pass through
            assert by_id.setdefault(2, said) == said
    assert REPORTS[name](spark, cases.empty(spark)).collect() == []


@pytest.mark.parametrize("name,stage", [s for s in corpus_pipeline.STAGES])
def test_stages_take_awkward_and_empty_tables(spark, name, stage, scratch):
    sf = scratch("tables")
    cases.labels(spark, SOME).write.parquet(f"{sf}/labels.parquet")
    items(spark, None).write.parquet(f"{sf}/benchmark.parquet")
    docs = cases.messy(spark)
    out = stage(spark, docs, sf)
    if name != "byte_bpe":
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        texts = {(r[0], r[1]) for r in cases.messy_rows()}
        if name != "line_dedup":
            assert {(r.doc_id, r.text) for r in out.collect()} <= texts
    assert stage(spark, cases.empty(spark), sf).collect() == []


def test_null_and_empty_results(spark):
    docs = cases.messy(spark)
    got = {r.doc_id: r for r in linededup.report(docs).collect()}
    assert (got[4].n_lines, got[4].n_dropped) == (1, 0) == (got[5].n_lines, got[5].n_dropped)
    near = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    assert [near[i].n_shingles for i in (4, 5, 6, 7, 8, 9)] == [0, 0, 0, 1, 1, 1]
    assert near[4].component_id == 4 and near[4].kept
    assert near[8].component_id == 7 and near[2].component_id == 1  # case does not count
    cut = {r.doc_id: r for r in suffixdedup.report(docs).collect()}
    assert cut[4].n_bytes == 0 and cut[12].n_removed == 5000 and cut[12].n_spans == 1 and cut[2].n_removed == cut[2].n_bytes
    model = {r.doc_id: r for r in pitmanyor.score(docs).collect()}
    assert model[4].n_tokens == model[5].n_tokens == model[6].n_tokens == 1
    said = {r.doc_id: r for r in quality.report(docs, quality.fit(docs, cases.labels(spark))).collect()}
    assert said[4].n_words == 0 and said[4].base_failed and not said[4].kept
    assert said[17].n_dup_lines == 1 and said[16].n_repeat_words == 400 and said[16].base_failed
    private = {r.doc_id: r for r in pii.replace(docs, b"k", counted=True).collect()}
    assert private[4].text is None and private[5].text == ""
