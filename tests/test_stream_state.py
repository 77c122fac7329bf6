"""Streams with state: the batch results whatever the order of arrival."""
import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from newsflow.operators.extract import extract_links, links_until_error
from newsflow.plans import bindings as B
from newsflow.session import scratch_path
from newsflow.streaming import state as ST


def page(hrefs):
    return None if hrefs is None else "<nav>" + "".join(f'<li><a href="{h}">x</a></li>' for h in hrefs) + "</nav>"


@pytest.fixture(scope="module")
def pages():
    draw = random.Random(4)
    site = next(iter(B.pages_profiles()))
    other = list(B.pages_profiles())[1]
    rows = [(site, n, page([f"/{n}-{k}" for k in range(draw.randrange(0, 4))])) for n in range(1, 41)]
    rows += [(other, n, page([f"/o{n}"]) if n not in (17, 9, 30) else None) for n in range(1, 41)]
    rows += [(other, 8, page(["/again"])), (other, None, page(["/unnumbered"])), (None, 3, page(["/nowhere"])), (None, 1, None)]
    return rows


@pytest.mark.parametrize("order", [0, 1, 2])
def test_links_equal_batch_in_any_order(spark, pages, order):
    profiles, rows = B.pages_profiles(), list(pages)
    random.Random(order).shuffle(rows)
    landing, log, progress = (scratch_path(spark, n) for n in ("sl", "slog", "sp"))
    for k in range(3):
        spark.createDataFrame(rows[k::3], ST.PAGES).repartition(2).write.mode("append").parquet(landing)
        ST.start_links_stream(spark, landing, log, progress, profiles, salts=3, max_files_per_trigger=1).awaitTermination()
        some = spark.createDataFrame([r for j in range(k + 1) for r in rows[j::3]], ST.PAGES)
        want = links_until_error(extract_links(some, profiles)).select("site", "page_no", "card_no", "href")
        got = ST.links_so_far(spark, log)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    before = got.count()
    ST.start_links_stream(spark, landing, log, progress, profiles, salts=3).awaitTermination()     # nothing new: nothing twice
    assert ST.links_so_far(spark, log).count() == before


def test_state_keeps_links_behind_a_known_failure_out(spark, pages):
    profiles = B.pages_profiles()
    other = list(profiles)[1]
    landing, log, progress = (scratch_path(spark, n) for n in ("sl", "slog", "sp"))
    for rows in ([r for r in pages if r[2] is None], [r for r in pages if r[2] is not None]):
        spark.createDataFrame(rows, ST.PAGES).write.mode("append").parquet(landing)
        ST.start_links_stream(spark, landing, log, progress, profiles, salts=1).awaitTermination()
    logged = spark.read.schema(ST.LOG).parquet(log).where(F.col("site") == other)
    assert logged.where("kind = 'link'").agg(F.max("page_no")).first()[0] == 8
    assert logged.where("kind = 'cut'").count() == 1


def test_a_failed_batch_runs_again_once(spark, pages):
    """A run that dies within a batch leaves no rows; the next one writes them once."""
    profiles = B.pages_profiles()
    landing, log, progress = (scratch_path(spark, n) for n in ("sl", "slog", "sp"))
    spark.createDataFrame(pages, ST.PAGES).write.parquet(landing)
    bad = spark.readStream.schema(ST.PAGES).parquet(landing).withColumn(
        "html", F.when(F.col("page_no") == 40, F.raise_error(F.lit("lost"))).otherwise(F.col("html")))
    with pytest.raises(Exception, match="lost"):
        ST._start(ST.links_log(bad, profiles, 3), log, progress, True).awaitTermination()
    ST.start_links_stream(spark, landing, log, progress, profiles, salts=3).awaitTermination()
    want = links_until_error(extract_links(spark.createDataFrame(pages, ST.PAGES), profiles))
    assert ST.links_so_far(spark, log).count() == want.count()


def test_requests_wait_for_their_pages(spark):
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    rs, ps = "url string, requested_at timestamp", "url string, fetched_at timestamp, status int"
    asked, landed, out, progress = (scratch_path(spark, n) for n in ("fr", "fp", "fo", "fc"))

    def run(requests, pages):
        spark.createDataFrame(requests, rs).write.mode("append").parquet(asked)
        spark.createDataFrame(pages, ps).write.mode("append").parquet(landed)
        q = ST.start_fetch_stream(spark.readStream.schema(rs).parquet(asked), spark.readStream.schema(ps).parquet(landed),
                                  out, progress, "status", delay="10 hours", late="2 hours", salts=3)
        q.awaitTermination()
        rows = sorted((r.url or "", r.status or 0) for r in spark.read.schema("url string, requested_at timestamp, status int").parquet(out).collect())
        last = [json.loads(p.json) if hasattr(p, "json") else p for p in q.recentProgress]
        return rows, sum(o["numRowsTotal"] for o in last[-1]["stateOperators"])

    rows, _ = run([("a", t(0)), ("a", t(1)), ("b", t(0)), ("c", t(1)), (None, t(0))], [("b", t(0), 200), ("b", t(11), 500), ("x", t(1), 200)])
    assert rows == [("b", 200)]                         # the second page came too late
    rows, waiting = run([("d", t(3))], [("a", t(3), 404)])
    assert rows == [("a", 404)] * 2 + [("b", 200)]
    rows, left = run([("last request", t(60))], [("last page", t(60), None)])
    assert rows == [("", 0)] + [("a", 404)] * 2 + [("b", 200), ("c", 0), ("d", 0)]
    assert left < waiting
