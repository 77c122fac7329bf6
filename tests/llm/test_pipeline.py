"""The pipeline's stages against plain versions of their rules."""
import numpy as np

import corpus_pipeline
from newsflow.llm import decontaminate, quality_rules
from newsflow.llm.common import table
from newsflow.session import materialize
from tests.llm.test_helpers import brute_components, brute_hits

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    kept = {}
    before = [(r.doc_id, r.text) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "stage")
        after = {r.doc_id: r for r in docs.collect()}
        kept[name] = set(after)
        if name == "quality rules":   # no host of this table is bad enough to be rejected
            want = set()
            for i, t in before:
                n, _, _, _, repeats = quality_rules.measure_text(t)
                if not (n < 10 or 100 * repeats > 20 * n):
                    want.add(i)
            assert kept[name] == want
        if name == "near-dedup":
            ids = [i for i, _ in before]
            order = sorted(range(len(ids)), key=lambda k: ids[k])
            up, _ = brute_components([before[k][1] for k in order])
            assert kept[name] == {ids[order[k]] for k, u in enumerate(up) if u == k}
        if name == "benchmark decontamination":
            items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
            assert kept[name] == {i for i, t in before if not brute_hits(t, items)[1]}
        if name == "mixing":
            assert all(1 <= r.repeats <= 3 for r in after.values()) and kept[name] <= {i for i, _ in before}
        before = [(r.doc_id, r.text) for r in after.values()]
    assert all(kept[n] for n in kept)


def test_run_chains_the_stages(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "STAGES", [corpus_pipeline.STAGES[0], corpus_pipeline.STAGES[-1]])
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*table(spark, SF, "documents").columns, "repeats"]
    assert np.all([r.repeats > 0 and quality_rules.measure_text(r.text)[0] >= 10 for r in out.collect()])


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "near-dedup", "benchmark decontamination", "mixing"]


def test_words_differ_between_operators():
    assert decontaminate.words_of("A-b é_c") == [b"a", b"b", "é".encode(), b"c"]
