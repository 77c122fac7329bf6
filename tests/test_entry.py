from __spark_entry__ import entry


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["doc_id", "sentence_no", "chunk_no", "persons", "chunk"]
    assert df.count() >= 0


def test_workers_import_package_from_any_cwd(spark, tmp_path, monkeypatch):
    """mapInPandas closures need newsflow in the Python workers (shipped by addPyFile)."""
    monkeypatch.chdir(tmp_path)
    from __spark_entry__ import queries
    assert queries()["page_links"](spark, "/root/testdata/sf0.001").count() > 0
