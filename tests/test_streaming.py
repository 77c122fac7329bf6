from pyspark.sql import functions as F

from newsflow.functions.crypto import decrypt
from newsflow.operators.sentiment import LexiconScorer
from newsflow.plans import bindings as B
from newsflow.session import scratch_path
from newsflow.streaming import jobs
from tests.conftest import SF_SMALL
from tests.test_extract import ARTICLES

KEY = "cw_0x689RpI-jtRR7oE8h_eQsKImvJapLeSbXpwF4e4="


def test_articles_stream_matches_batch(spark):
    landing, out, rej, ck = (scratch_path(spark, n) for n in ("land", "arts", "rej", "ck"))
    rows = [(s, f"u/{s}", 200, h, None) for s, h in ARTICLES.items()]
    spark.createDataFrame(rows[:3], jobs.CRAWL_SCHEMA).write.parquet(landing)
    q = jobs.start_articles_stream(spark, landing, out, rej, ck, run_ts="2024-06-01 12:00:00")
    q.awaitTermination(120)
    spark.createDataFrame(rows[3:], jobs.CRAWL_SCHEMA).write.mode("append").parquet(landing)
    q = jobs.start_articles_stream(spark, landing, out, rej, ck, run_ts="2024-06-01 12:00:00")
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert sorted(r["art_url"] for r in got.collect()) == sorted(f"u/{s}" for s in ARTICLES)
    assert got.select("batch_id").distinct().count() == 2


def test_mentions_stream(spark):
    arts_dir, out, ck = (scratch_path(spark, n) for n in ("sarts", "smen", "sck"))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    arts = B.articles_from_documents(docs)
    arts.write.parquet(arts_dir)
    q = jobs.start_mentions_stream(spark, arts_dir, arts.schema, out, ck, KEY, LexiconScorer({"the": 1}))
    q.awaitTermination(180)
    got = spark.read.parquet(out)
    assert got.count() > 0
    sample = got.select(decrypt(F.col("Sentiment"), KEY).alias("s")).distinct().collect()
    assert {r["s"] for r in sample} <= {"highly negative", "negative", "neutral", "positive", "highly positive"}
