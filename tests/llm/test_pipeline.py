from __future__ import annotations

import os
from collections import defaultdict

import pytest

import corpus_pipeline
from barline.llm.importance import importance_sample
from barline.llm.ngram_join import ngram_join
from barline.llm.quality_rules import quality_rules
from barline.llm.queries import table
from barline.llm.store import staged

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not here")


def test_stages_act_on_their_verdicts(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    verdicts = {"quality_classifier": lambda d: importance_sample(d, table(spark, SF, "labels")),
                "quality_rules": quality_rules, "ngram_join": ngram_join}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = staged(stage(spark, docs, SF), name)
        assert made.columns == columns
        before, after = ({r["doc_id"] for r in d.select("doc_id").collect()} for d in (docs, made))
        if name in verdicts:
            assert after == {r["doc_id"] for r in verdicts[name](docs).where("kept").collect()}
        else:
            assert after == before
        docs = made
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == after
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in packed:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
    for parts in (*bins.values(), *([(s, n) for _, s, n in sorted(p)] for p in pieces.values())):
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
    assert all(sum(n for _, n in b) <= 1024 for b in bins.values())
