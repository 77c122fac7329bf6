"""Every query and pipeline stage on nulls, empty and long texts, repeated
rows, empty tables and clashing extra columns."""
from collections import Counter

import pytest

import corpus_pipeline
from newsflow.llm import queries
from newsflow.llm.common import table
from newsflow.session import apply_job_conf, materialize
from tests.llm.conftest import BENCH_ROWS, DOC_ROWS, PAGE_ROWS, VEC_ROWS

OF_PAGES = ("op4_html_blocks", "op8_url_filter")


def rows_of(df):
    return Counter(tuple(str(v) for v in r) for r in df.collect())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_odd_rows(spark, odd_dir, clash_dir, name):
    apply_job_conf(spark)
    q = queries.QUERIES[name]
    df = q(spark, odd_dir)
    rows = rows_of(df)
    want = [r[0] for r in (PAGE_ROWS if name in OF_PAGES else VEC_ROWS[:-4] if name == "op11_vector_codes" else DOC_ROWS)]
    assert Counter(str(v) for v in want) == Counter(k[0] for k in rows.elements())
    assert rows == rows_of(q(spark, clash_dir))
    if name == "op9_minhash":
        got = {(r.doc_id, r.n_shingles): r for r in df.collect()}
        assert {r.component_id for r in got.values() if r.n_shingles > 300} >= {1, 6}
        assert got[(3, 0)].component_id == 3 and got[(3, 0)].kept
    if name == "op3_decontamination":
        got = {r.doc_id: r for r in df.collect()}
        assert (got[7].n_hit, got[7].n_items) == (12, 1) and got[8].n_hit == 400 and got[3].n_words == 0
    if name == "op1_quality_rules":
        got = {r.doc_id: r for r in df.collect()}
        assert got[8].n_repeat_words == 400 and got[8].base_failed and not got[3].kept
    if name == "op10_licenses":
        assert "mit,reserved" in {r.families for r in df.collect()}
    if name == "op4_html_blocks":
        got = {r.page_id: r.text for r in df.collect()}
        assert got[1] == "Hi & bye" and got[2] == "T\nOne two" and got[3] == "" == got[4]


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, empty_dir, name):
    apply_job_conf(spark)
    assert queries.QUERIES[name](spark, empty_dir).collect() == []


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, clash_dir, empty_dir, name, stage):
    docs = table(spark, clash_dir, "documents")
    out = materialize(stage(spark, docs, clash_dir), "stage")
    assert out.columns[:len(docs.columns)] == docs.columns
    assert rows_of(out.select(docs.columns)) <= rows_of(docs)
    ids = Counter(r.doc_id for r in out.collect())
    if name == "quality rules":
        assert ids[1] == 1 and ids[2] == 2 and not ids[3] and not ids[8] and not ids[9]
    if name == "near-dedup":
        assert (ids[1], ids[2], ids[3], ids[4], ids[6], ids[11]) == (1, 0, 1, 1, 1, 2)
    if name == "benchmark decontamination":
        assert not ids[7] and not ids[8] and ids[2] == 2 and ids[3] == 1
    assert stage(spark, table(spark, empty_dir, "documents"), empty_dir).collect() == []


def test_fixture_has_the_cases():
    assert any(r[0] is None for r in BENCH_ROWS) and any(len(r[1] or "") > 1_000_000 for r in DOC_ROWS)
