import datetime as dt

from newsflow.sources.crawl import latest_fetch
from tests.conftest import SF_SMALL


def test_latest_fetch_keeps_newest(spark):
    rows = [("u1", 404, "old", dt.datetime(2024, 1, 1)), ("u1", 200, "new", dt.datetime(2024, 1, 2)),
            ("u2", 200, "only", dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "url string, status_code int, html string, fetched_at timestamp_ntz")
    got = {r["url"]: (r["status_code"], r["html"]) for r in latest_fetch(df).collect()}
    assert got == {"u1": (200, "new"), "u2": (200, "only")}


def test_latest_fetch_by_site_with_missing_times(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", "u", 200, "a1", None), ("a", "u", 200, "a2", t), ("b", "u", 200, "b", None), ("b", "v", 200, "v", None), ("b", "v", 200, "v", None)]
    df = spark.createDataFrame(rows, "site string, url string, status_code int, html string, fetched_at timestamp_ntz")
    got = sorted((r["site"], r["url"], r["html"]) for r in latest_fetch(df).collect())
    assert got == [("a", "u", "a2"), ("b", "u", "b"), ("b", "v", "v")]


def test_scan_is_left_to_spark(spark):
    from newsflow.plans.bindings import table
    plan = table(spark, SF_SMALL, "documents", "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_shared_folder_must_be_named_on_a_cluster(spark):
    import pytest
    from newsflow import session

    class Fake:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)
    with pytest.raises(RuntimeError):
        session.shared_dir(Fake)
